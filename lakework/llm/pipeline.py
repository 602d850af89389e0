"""Stages of the corpus pipeline: each takes documents and returns documents, the last returns pieces.

All of them keep columns that they don't know, whatever their names, and turn an
empty table into an empty result.  What becomes of nulls, empty texts and repeated
rows is said at each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakework.llm import dedup, mixing, packing, pii, quality


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    Null and empty texts have no words and go; so do other texts under ten words.
    Long texts are judged whole.  Repeated rows are judged alike.  A null language has
    a reference of its own; a language with little text has none, and only the base
    rule judges it.
    """
    return quality.filter_documents(docs)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the least id.

    Null and empty texts are linked with nothing and stay, should any come here.  Rows
    that repeat the kept document's id and text all stay, as they are that document;
    rows with a null id stay if their whole group has null ids.
    """
    return dedup.keep_one(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; ``n_chars`` counts the new text.

    A null text stays null (and so does its ``n_chars``), an empty one empty.  Each row
    is rewritten by itself, so repeated rows stay equal.
    """
    out = docs.withColumn("text", pii.redacted(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the target mixture, shuffled globally.

    Sources weigh as the square root of their sizes; a null source is one of them.
    Texts don't matter here.  Rows with the same id are repeated as often as each other.
    """
    return mixing.mix(docs, details=False)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of full windows.

    A null or empty text is one separator token.  Every row is packed, copies too.
    """
    return packing.pack(docs)
