"""The corpus pipeline: raw documents to packed training windows.

Stages, in order: quality rules, near-duplicate removal, redaction of personal
data, mixing of sources, packing.  Every stage reads what the one before wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakework.llm import pipeline
from lakework.llm.common import work_dir

STAGES = [
    ("quality", pipeline.quality_stage),
    ("near_duplicates", pipeline.dedup_stage),
    ("personal_data", pipeline.pii_stage),
    ("mixing", pipeline.mixing_stage),
    ("packing", pipeline.packing_stage),
]

#: Token ids, learnt weights and set similarities are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written as Parquet in the shared folder and read again."""
    folder = work_dir(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.option("compression", "zstd").parquet(path)
        docs = spark.read.parquet(path)
    return docs
