"""Writers: staged tables and small files."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from lakework.operators.upsert import upsert
from lakework.session import shared_dir


def _paths(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _paths(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> bool:
    fs, p = _paths(spark, path)
    return fs.delete(p, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    fs, a = _paths(spark, old)
    _, b = _paths(spark, new)
    if not fs.rename(a, b):
        raise OSError(f"can't rename {old} to {new}")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: steps after it don't run those before it again."""
    path = f"{shared_dir(df.sparkSession)}/lakework-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_table(df: DataFrame, path: str, partition_by: Iterable[str] = ()) -> None:
    """Replace a Parquet table: write beside it, then swap by renames.

    The table may be among ``df``'s inputs, since nothing it reads is overwritten.
    If the swap is cut short, the old table is in ``path.old``.
    """
    spark, staging, old = df.sparkSession, f"{path}.new-{uuid.uuid4().hex}", f"{path}.old"
    df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(staging)
    if exists(spark, old):
        remove(spark, old)
    if exists(spark, path):
        rename(spark, path, old)
    rename(spark, staging, path)
    remove(spark, old)


def upsert_table(new: DataFrame, path: str) -> None:
    """upsert into a Parquet table on disk."""
    spark = new.sparkSession
    write_table(upsert(spark.read.parquet(path) if exists(spark, path) else None, new), path)


def write_json(path: Path, value: object) -> Path:
    """A JSON file in one step: written beside it, flushed, renamed."""
    path.parent.mkdir(parents=True, exist_ok=True)
    staging = path.with_name(f".{path.name}.{uuid.uuid4().hex}.tmp")
    with staging.open("w") as f:
        f.write(json.dumps(value, indent=2, default=str))
        f.flush()
        os.fsync(f.fileno())
    staging.replace(path)
    return path


def write_jsonl(df: DataFrame, folder: str, column: str | None = None) -> None:
    """JSON lines, a file per task; ``column`` holds ready JSON."""
    if column:
        df.select(column).write.mode("append").text(folder)
    else:
        df.write.mode("append").json(folder)


def promote(folder: Path, target: Path) -> Path:
    """A segment's part files as one file, in order, in one step."""
    target.parent.mkdir(parents=True, exist_ok=True)
    if target.exists():
        raise FileExistsError(target)
    staging = target.with_name(f".{target.name}.tmp")
    with staging.open("wb") as out:
        for part in sorted(folder.glob("part-*")):
            with part.open("rb") as f:
                while block := f.read(1 << 20):
                    out.write(block)
        out.flush()
        os.fsync(out.fileno())
    staging.replace(target)
    return target
