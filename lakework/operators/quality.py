"""Data-quality checks (N1 to N9, E2 to E4).  Each check is a frame of findings with one layout."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from pathlib import Path

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakework.functions.jsonx import strict_json

#: A lake folder's id columns, which must not be null; folders that are keyed by hash need those columns too.
ID_COLUMNS = {
    "pathology": ("report_id",),
    "fc_extractions": ("record_id",),
    "fc_reviews": ("event_key",),
    "fc_adjudications": ("adjudication_key",),
    "runs": ("run_id",),
    "tombstones": ("event_id",),
}
HASHED = ("pathology", "fc_extractions", "fc_reviews", "fc_adjudications")

LAYOUT = "check string, severity string, dataset string, detail string, n bigint"


def _finding(check: str, severity: str, dataset: str, detail, n):
    return [F.lit(check).alias("check"), F.lit(severity).alias("severity"), F.lit(dataset).alias("dataset"), (detail if not isinstance(detail, str) else F.lit(detail)).alias("detail"), n.cast("bigint").alias("n")]


def table_profile(df: DataFrame, keys: Sequence[str], key: str = "key_hash") -> DataFrame:
    """E2 to E4 in one pass: rows, duplicate keys (null counts as a value), nulls per key column."""
    nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"null_{c}") for c in keys if c in df.columns]
    extra = []
    if key in df.columns:
        distinct = F.countDistinct(key) + F.coalesce(F.max(F.col(key).isNull().cast("int")), F.lit(0))
        extra = [(F.count(F.lit(1)) - distinct).alias("duplicate_keys")]
    return df.agg(F.count(F.lit(1)).alias("n_rows"), *extra, *nulls)


def readable(spark: SparkSession, paths: Mapping[str, str]) -> tuple[dict[str, DataFrame], DataFrame]:
    """The tables that can be read, and a finding for each that can't."""
    good, bad = {}, []
    for name, path in paths.items():
        try:
            df = spark.read.parquet(path)
            df.limit(1).collect()
            good[name] = df
        except PySparkException as e:
            bad.append(("parquet_readable", "error", name, str(e).splitlines()[0][:300], 1))
        except Exception as e:  # py4j wraps what the readers throw
            bad.append(("parquet_readable", "error", name, type(e).__name__, 1))
    return good, spark.createDataFrame(bad, LAYOUT)


def required_columns(spark: SparkSession, tables: Mapping[str, DataFrame], required: Mapping[str, Sequence[str]]) -> DataFrame:
    """From schemas alone, no data is read."""
    missing = {n: [c for c in required.get(n, ()) if c not in df.columns] for n, df in tables.items()}
    return spark.createDataFrame([("required_columns", "error", n, ", ".join(m), len(m)) for n, m in missing.items() if m], LAYOUT)


def null_ids(df: DataFrame, dataset: str, keys: Sequence[str]) -> DataFrame:
    """Nulls per key column, all columns in one aggregation."""
    present = [c for c in keys if c in df.columns]
    if not present:
        return df.sparkSession.createDataFrame([], LAYOUT)
    counts = df.agg(F.array(*(F.struct(F.lit(c).alias("c"), F.count_if(F.col(f"`{c}`").isNull()).alias("n")) for c in present)).alias("x"))
    return counts.select(F.explode("x").alias("x")).where("x.n > 0").select(*_finding("null_ids", "error", dataset, F.col("x.c"), F.col("x.n")))


def duplicate_keys(df: DataFrame, dataset: str, key: str = "key_hash") -> DataFrame:
    """Rows beyond the first of each key."""
    if key not in df.columns:
        return df.sparkSession.createDataFrame([], LAYOUT)
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n")).where("n > 0").select(*_finding("duplicate_keys", "warning", dataset, key, F.col("n")))


def unparseable_lines(lines: DataFrame, dataset: str, value: str = "value") -> DataFrame:
    """Lines that aren't JSON; blank ones don't count."""
    bad = F.count_if((F.trim(F.col(value)) != "") & strict_json(F.col(value)).isNull())
    return lines.agg(bad.alias("n")).where("n > 0").select(*_finding("jsonl_parseable", "error", dataset, "malformed lines", F.col("n")))


def empty_dataset(df: DataFrame, dataset: str) -> DataFrame:
    """A table without rows."""
    return df.limit(1).agg(F.count(F.lit(1)).alias("n")).where("n = 0").select(*_finding("empty_dataset", "warning", dataset, "no rows", F.lit(1)))


def alignment(lake: Mapping[str, DataFrame], tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """Do lake files and catalog tables have the same number of rows?  Unreadable files are left out by the caller."""
    frames = []
    for name, df in lake.items():
        other = tables.get(name)
        counts = df.agg(F.count(F.lit(1)).alias("a"))
        counts = counts.join(F.broadcast(other.agg(F.count(F.lit(1)).alias("b"))), F.lit(True)) if other is not None else counts.withColumn("b", F.lit(None).cast("bigint"))
        detail = F.concat(F.lit("lake "), F.col("a").cast("string"), F.lit(", table "), F.coalesce(F.col("b").cast("string"), F.lit("missing")))
        frames.append(counts.where(~F.col("a").eqNullSafe(F.col("b"))).select(*_finding("db_alignment", "warning", name, detail, F.abs(F.col("a") - F.coalesce("b", F.lit(0))))))
    return reduce(lambda a, b: a.unionByName(b), frames)


def run_checks(spark: SparkSession, paths: Mapping[str, str], keys: Mapping[str, Sequence[str]], logs: Mapping[str, DataFrame] | None = None, tables: Mapping[str, DataFrame | None] | None = None) -> DataFrame:
    """All findings.  The lake passes if none of them is an error."""
    good, findings = readable(spark, paths)
    frames = [findings, required_columns(spark, good, {n: [*keys.get(n, ()), *(("key_hash", "content_hash") if n.split("/")[0] in HASHED or "/" not in n else ())] for n in good})]
    for name, df in good.items():
        frames += [null_ids(df, name, keys.get(name, ())), duplicate_keys(df, name), empty_dataset(df, name)]
    frames += [unparseable_lines(df, name) for name, df in (logs or {}).items()]
    if tables:
        # what can't be read is reported already, and a table that isn't in the catalog yet isn't out of step
        both = {n: df for n, df in good.items() if n in tables}
        frames += [alignment(both, tables)] if both else []
    return reduce(lambda a, b: a.unionByName(b), frames)


def check_lake(spark: SparkSession, inbox: Path, lake: Path, folders: Mapping[str, tuple[str, str]]) -> DataFrame:
    """N8 for a lake on disk: every table by folder and name, its id columns, the inbox's logs, and the catalog's tables if it has been built."""
    paths, keys, tables = {}, {}, {}
    for folder, (_, database) in folders.items():
        for path in sorted((lake / folder).glob("*.parquet")):
            name = f"{folder}/{path.stem}"
            paths[name], keys[name] = str(path), ID_COLUMNS.get(folder, ())
            if spark.catalog.databaseExists(database):
                table = f"`{database}`.`{path.stem}`"
                tables[name] = spark.table(table) if spark.catalog.tableExists(table) else None
    logs = {str(p.relative_to(inbox)): spark.read.text(str(p)) for p in sorted(inbox.rglob("*.jsonl"))} if inbox.exists() else {}
    return run_checks(spark, paths, keys, logs, {n: t for n, t in tables.items() if t is not None} or None)


def passes(findings: DataFrame) -> bool:
    return findings.where("severity = 'error'").isEmpty()
