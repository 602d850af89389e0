"""A tree of digests beside a table, so that a delta reads only what differs.

Rows are kept in folders by a bucket of their key's hash.  A small table has each
bucket's digest, an order-free sum over its rows' hashes, and the sums over groups of
buckets above it.  Two snapshots whose digests agree on a bucket have the same keys and
contents there; only the other buckets are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakework.operators import diff
from lakework.sources import lake

#: Buckets of a table, and how many lie under one digest of the level above.
BUCKETS, FAN_OUT = 1024, 32
BUCKET = "digest_bucket"


def bucket_of(key: Sequence[str], buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*(F.col(f"`{k}`") for k in key)), F.lit(buckets)).cast("int")


def _row_digest(columns: Sequence[str]) -> Column:
    """128 bits of a row's text, as two numbers that can be summed in any order; nulls differ from every text."""
    whole = F.md5(F.to_json(F.struct(*(F.col(f"`{c}`") for c in sorted(columns))), {"ignoreNullFields": "false"}))
    return F.struct(*(F.conv(F.substring(whole, a, 15), 16, 10).cast("decimal(38,0)").alias(n) for a, n in ((1, "high"), (17, "low"))))


def digest_rows(df: DataFrame, key: Sequence[str], columns: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """(level, bucket, n, high, low): level 0 is a row per bucket, level 1 one per ``FAN_OUT`` buckets, level 2 the table."""
    leaves = df.select(bucket_of(key, buckets).alias("bucket"), _row_digest(columns).alias("d")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("d.high").alias("high"), F.sum("d.low").alias("low"))
    above = leaves.select(F.explode(F.array(*(F.struct(F.lit(k).alias("level"), (F.col("bucket") / size).cast("int").alias("bucket")) for k, size in enumerate((1, FAN_OUT, buckets))))).alias("at"), "n", "high", "low")
    return above.groupBy("at.level", "at.bucket").agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low"))


def write_with_digests(df: DataFrame, path: str, key: Sequence[str], columns: Sequence[str], buckets: int = BUCKETS) -> None:
    """Replace the table at ``path`` by ``df`` in buckets, and the digests beside it (``path.digests``)."""
    rows = lake.staged(df, "digests")
    lake.write_table(rows.withColumn(BUCKET, bucket_of(key, buckets)).repartition(BUCKET), path, [BUCKET])
    lake.write_table(digest_rows(rows, key, columns, buckets), f"{path}.digests")


def differing_buckets(old: DataFrame, new: DataFrame) -> list[int]:
    """The buckets on which two tables of digests differ; level by level, so equal tables cost one row.

    At most ``BUCKETS`` small numbers come to the driver, however large the tables are.
    """

    def differing(level: int, groups: list[int] | None = None) -> list[int]:
        def pick(d: DataFrame) -> DataFrame:
            rows = d.where(F.col("level") == level).drop("level")
            return rows if groups is None else rows.where((F.col("bucket") / FAN_OUT).cast("int").isin(groups))

        a, b = pick(old), pick(new)
        both = a.join(b.toDF("o_bucket", "o_n", "o_high", "o_low"), F.col("bucket") == F.col("o_bucket"), "full_outer")
        same = F.col("n").eqNullSafe(F.col("o_n")) & F.col("high").eqNullSafe(F.col("o_high")) & F.col("low").eqNullSafe(F.col("o_low"))
        return sorted(r[0] for r in both.where(~same).select(F.coalesce("bucket", "o_bucket")).collect())

    return differing(0, differing(1)) if differing(2) else []


def snapshot_delta(spark: SparkSession, old_path: str, new_path: str, key: str = "key_hash", content: str = "content_hash") -> DataFrame:
    """G1: ``diff.keyed_delta`` of two tables written with digests over their key and content; only differing buckets are read.

    Buckets are the tables' partition column, so the other folders aren't even listed for the
    scan.  Rows of buckets that agree are unchanged, and counted by their digests.
    """
    old, new = (spark.read.parquet(f"{p}.digests") for p in (old_path, new_path))
    changed = differing_buckets(old, new)
    rest = new.where((F.col("level") == 0) & ~F.col("bucket").isin(changed)).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    mine = lambda path: spark.read.parquet(path).where(F.col(BUCKET).isin(changed)).select(key, content)
    return diff.keyed_delta(mine(old_path), mine(new_path), key, content).withColumn("unchanged", F.col("unchanged") + F.lit(rest).cast("bigint"))
