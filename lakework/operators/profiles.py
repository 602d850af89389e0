"""Profiles of tables that are kept and merged instead of rescanned."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Sketch sizes: distinct counts within 3.3 %, ranks within 1.4 %, each at two standard errors or more.
HLL_LG_K, KLL_K = 12, 200
DISTINCT_ERROR, RANK_ERROR = 0.033, 0.0165


def profile(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """A row per group of ``by`` and column: counts, extremes as text, and sketches of distinct values and quantiles.

    All columns are profiled in one pass: rows are turned into (column, value) pairs only as
    aggregates, so nothing but sketches is shuffled.  Blank texts count as blank, not as null.
    Numbers have a quantile sketch, other columns a null one.  Merge profiles by ``merge``.
    """
    names = [c for c in df.columns if c not in by]
    numeric = {f.name for f in df.schema if f.dataType.typeName() in ("byte", "short", "integer", "long", "float", "double", "decimal")}
    aggregates = []
    for i, c in enumerate(names):
        col = F.col(f"`{c}`")
        text = col.cast("string")
        aggregates += [
            F.count(F.lit(1)).alias(f"n{i}"), F.count_if(col.isNull()).alias(f"null{i}"), F.count_if(F.trim(text) == "").alias(f"blank{i}"), F.min(col).cast("string").alias(f"min{i}"), F.max(col).cast("string").alias(f"max{i}"),
            F.hll_sketch_agg(text, HLL_LG_K).alias(f"hll{i}"), (F.kll_sketch_agg_double(col.cast("double"), KLL_K) if c in numeric else F.lit(None).cast("binary")).alias(f"kll{i}"),
        ]
    wide = df.groupBy(*by).agg(*aggregates)
    rows = F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("n"), F.col(f"null{i}").alias("n_null"), F.col(f"blank{i}").alias("n_blank"), F.col(f"min{i}").alias("least"), F.col(f"max{i}").alias("most"), F.lit(c in numeric).alias("numeric"), F.col(f"hll{i}").alias("hll"), F.col(f"kll{i}").alias("kll")) for i, c in enumerate(names)))
    return wide.select(*by, F.explode(rows).alias("p")).select(*by, "p.*")


def merge(profiles: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Profiles of parts (files, days, segments) as one of the whole, per ``by``; exact but for the sketches' stated errors."""
    # numbers are compared as numbers, and keep their text
    size = F.when(F.col("numeric"), F.col("least").cast("double")), F.when(F.col("numeric"), F.col("most").cast("double"))
    least = F.coalesce(F.min_by("least", size[0]), F.min(F.when(~F.col("numeric"), F.col("least"))))
    most = F.coalesce(F.max_by("most", size[1]), F.max(F.when(~F.col("numeric"), F.col("most"))))
    return profiles.groupBy(*by, "column", "numeric").agg(
        F.sum("n").alias("n"), F.sum("n_null").alias("n_null"), F.sum("n_blank").alias("n_blank"),
        least.alias("least"), most.alias("most"),
        F.hll_union_agg("hll").alias("hll"), F.kll_merge_agg_double("kll", KLL_K).alias("kll"),
    )


def report(profiles: DataFrame, ranks: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """``profiles`` with ``n_distinct`` (within ``DISTINCT_ERROR``) and ``quantiles`` (ranks within ``RANK_ERROR``) instead of sketches."""
    quantiles = F.when(F.col("numeric") & (F.kll_sketch_get_n_double("kll") > 0), F.array(*(F.kll_sketch_get_quantile_double(F.col("kll"), F.lit(r)) for r in ranks)))
    return profiles.withColumns({"n_distinct": F.hll_sketch_estimate("hll"), "quantiles": quantiles}).drop("hll", "kll", "numeric")
