"""Incremental ingest: new inbox files upserted as they come, without a replay.

An extension of ours over the replay: a file-source stream remembers which files
it has read, and each micro-batch is one upsert.  ``trigger(availableNow)`` makes
it a batch job that continues where the last one stopped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakework.operators.versions import latest
from lakework.sources.lake import exists, rename, remove, upsert_table


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, kind: str = "csv", max_files: int | None = None, **options) -> DataFrame:
    """A stream of a folder's files, with each row's file name as ``_file``."""
    reader = spark.readStream.schema(schema).format(kind).options(**options)
    if kind == "csv":
        reader = reader.option("header", True).option("multiLine", True).option("escape", '"')
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder).withColumn("_file", F.col("_metadata.file_name"))


def upsert_stream(stream: DataFrame, table: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None, key: str = "key_hash") -> StreamingQuery:
    """Upsert each micro-batch into a Parquet table; of a key's rows in one batch the last file's wins.

    An upsert repeated after a failure changes nothing, so every file counts once.
    """

    def write(batch: DataFrame, _: int) -> None:
        rows = transform(batch) if transform else batch
        if "_file" in rows.columns:
            rows = latest(rows, [key], ["_file"]).drop("_file")
        if not rows.isEmpty():
            spark = rows.sparkSession
            if not exists(spark, table) and exists(spark, f"{table}.old"):  # a swap was cut short
                rename(spark, f"{table}.old", table)
            upsert_table(rows, table)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, at: str, late: str = "1 hour", width: str = "1 day", by: tuple[str, ...] = ()) -> DataFrame:
    """Events per time window and group; events later than ``late`` are left out."""
    return stream.withWatermark(at, late).groupBy(F.window(at, width), *by).agg(F.count(F.lit(1)).alias("n"))


def clear(spark: SparkSession, *paths: str) -> None:
    """Forget a stream's table and progress, for a full replay."""
    for p in paths:
        if exists(spark, p):
            remove(spark, p)
