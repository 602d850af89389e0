"""Incremental extraction: what has to run again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakework.functions.jsonx import strict_json

BUCKETS = ("new", "skipped", "changed", "definition_changed", "forced")


def batch_history(recs: DataFrame) -> DataFrame:
    """Successes of all segments as distinct (id, source hash, definition hash)."""
    return recs.where("success").select(F.col("note_id").alias("id"), F.col("source_content_hash").alias("src"), F.col("definition_hash").alias("def")).distinct()


def source_state(source: DataFrame, id_column: str, hash_column: str | None = "content_hash", where: str | None = None) -> DataFrame:
    """(id, current hash in lower-case hex, or null) of the source's rows."""
    rows = source.where(F.expr(where)) if where else source
    current = F.lower(F.hex(F.col(hash_column).cast("binary"))) if hash_column and hash_column in source.columns else F.lit(None).cast("string")
    return rows.select(F.col(id_column).cast("string").alias("id"), current.alias("current"))


def categorise(source: DataFrame, history: DataFrame, definition: str | None = None, forced: DataFrame | None = None, on_definition_change: bool = False) -> DataFrame:
    """The source's (id, current) with ``category``, by this order of rules.

    No history: ``new``.  History without a hash (from before hashes): ``forced`` if
    asked, else ``skipped``.  No history with the current hash: ``changed``, a null
    current hash included.  Another definition, if that counts: ``definition_changed``.
    Then ``forced`` if asked, else ``skipped``.
    """
    some = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    wanted = F.lit(definition).cast("string")
    pairs = source.select("id", "current").join(history.select(F.col("id").alias("_h"), "src", "def"), F.col("id") == F.col("_h"), "left")
    flags = pairs.groupBy("id", "current").agg(
        F.count("_h").alias("n"),
        some(F.col("_h").isNotNull() & F.col("src").isNull()).alias("legacy"),
        some(F.col("src") == F.col("current")).alias("same"),
        some((F.col("src") == F.col("current")) & (F.col("def") == wanted)).alias("same_definition"),
    )
    if forced is not None:
        flags = flags.join(forced.select(F.col(forced.columns[0]).cast("string").alias("_f")).distinct(), F.col("id") == F.col("_f"), "left").withColumn("_force", F.col("_f").isNotNull())
    else:
        flags = flags.withColumn("_force", F.lit(False))
    again = F.when(F.col("_force"), "forced").otherwise("skipped")
    category = F.when(F.col("n") == 0, "new").when(F.col("legacy"), again).when(~F.col("same"), "changed")
    if on_definition_change:
        category = category.when(~F.col("same_definition"), "definition_changed")
    return flags.select("id", "current", category.otherwise(again).alias("category"))


def unseen_forced(source: DataFrame, forced: DataFrame) -> DataFrame:
    """Forced ids that the source doesn't have."""
    ids = forced.select(F.col(forced.columns[0]).cast("string").alias("id")).distinct()
    return ids.join(source.select("id").distinct(), "id", "left_anti")


def resume(notes: DataFrame, done: DataFrame, id_column: str = "id", hash_column: str = "hash") -> DataFrame:
    """Notes whose (id, hash) isn't done, nor their id under a record without a hash."""
    exact = done.where("src is not null").select(F.col("id").alias("_i"), F.col("src").alias("_s")).distinct()
    legacy = done.where("src is null").select(F.col("id").alias("_i")).distinct()
    left = notes.join(exact, (F.col(id_column) == F.col("_i")) & (F.col(hash_column) == F.col("_s")), "left_anti")
    return left.join(legacy, F.col(id_column) == F.col("_i"), "left_anti")


def prune_failed(lines: DataFrame, value: str = "value") -> DataFrame:
    """Lines without those of failed records; malformed lines stay as they are."""
    found = strict_json(F.col(value))
    return lines.where(found.isNull() | F.coalesce(F.try_variant_get(found, "$.success", "boolean"), F.lit(False)))
