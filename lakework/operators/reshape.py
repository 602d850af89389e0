"""Grouping, pivots, orders and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakework.operators.review import patient_key


def pivot_first(df: DataFrame, rows: Sequence[str], column: str, value: str, names: Sequence[str] | None = None) -> DataFrame:
    """A matrix of the least value per row and column; without ``names`` the columns are the distinct values."""
    grouped = df.groupBy(*rows)
    return (grouped.pivot(column, list(names)) if names else grouped.pivot(column)).agg(F.min(value))


def by_patient(df: DataFrame, mrn: str = "mrn", note: str = "note_id") -> DataFrame:
    """Distinct notes and rows per patient, the note standing in for a blank mrn."""
    return df.groupBy(patient_key(F.col(mrn), F.col(note)).alias("patient")).agg(F.countDistinct(note).alias("n_notes"), F.count(F.lit(1)).alias("n_rows"))


def date_range(df: DataFrame, column: str) -> DataFrame:
    """E13."""
    return df.agg(F.min(column).alias("first"), F.max(column).alias("last"))


def recent(df: DataFrame, n: int, at: str = "started_at", tie: str = "run_id", kind: tuple[str, str] | None = None) -> DataFrame:
    """The newest rows, of one kind if asked; a heap per task, no sort of all."""
    rows = df.where(F.col(kind[0]) == kind[1]) if kind else df
    return rows.orderBy(F.col(at).desc_nulls_last(), F.col(tie)).limit(n)


def by_prefix(df: DataFrame, prefix: str, column: str = "run_id") -> DataFrame:
    """L4: the first row whose id starts with a prefix."""
    return df.where(F.col(column).startswith(prefix)).orderBy(column).limit(1)


def compare_rows(df: DataFrame, a: str, b: str, fields: Sequence[str], column: str = "run_id") -> DataFrame:
    """Two rows side by side, a row per field, and whether they differ."""
    one = lambda k, s: df.where(F.col(column) == k).limit(1).select(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("v")) for f in fields)).alias(s))
    both = one(a, "x").join(F.broadcast(one(b, "y")), F.lit(True))
    pairs = both.select(F.explode(F.arrays_zip("x", "y")).alias("p"))
    return pairs.select(F.col("p.x.field").alias("field"), F.col("p.x.v").alias("left"), F.col("p.y.v").alias("right"), (~F.col("p.x.v").eqNullSafe(F.col("p.y.v"))).alias("differs"))


def notes_page(df: DataFrame, id_column: str, ids: DataFrame | None = None, limit: int | None = None) -> DataFrame:
    """O3: rows in id order; a limit counts after the id filter."""
    from lakework.operators.projection import filter_ids

    rows = filter_ids(df, ids, id_column) if ids is not None else df
    rows = rows.orderBy(id_column)
    return rows.limit(limit) if limit is not None else rows


def ordered(df: DataFrame, keys: Sequence[tuple[str, bool]]) -> DataFrame:
    """O1, O2: a total order by keys, each ascending or not, nulls last."""
    return df.orderBy(*(F.col(k).asc_nulls_last() if up else F.col(k).desc_nulls_last() for k, up in keys))


def attach_notes(df: DataFrame, notes: DataFrame, note: str = "note_id") -> DataFrame:
    """F16: note text and metadata by string id."""
    return df.join(notes.withColumn(note, F.col(note).cast("string")), note, "left")
