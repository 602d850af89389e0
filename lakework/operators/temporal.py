"""Joins over time and ranges, and sessions (operators that SQL engines lack, or plan badly).

None of them has an inequality as its only join condition: rows are dealt by buckets of
time, and what reaches over a bucket's border is carried by narrow rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Levels of interval buckets: lengths are powers of two of the unit, up to 2**62.
LEVELS = 63


def _free(*frames: DataFrame) -> str:
    """A prefix that no column begins with."""
    taken, prefix = {c.lower() for f in frames for c in f.columns}, "_t"
    while any(c.startswith(prefix) for c in taken):
        prefix = f"_{prefix}"
    return prefix


def _number(df: DataFrame, column: str) -> Column:
    """A time's seconds, or a number, as a double; a timestamp without zone counts as it reads, in any session's zone."""
    c = F.col(f"`{column}`")
    if df.schema[column].dataType.typeName() != "timestamp_ntz":
        return c.cast("double")
    seconds = F.hour(c) * 3600 + F.minute(c) * 60 + F.date_part(F.lit("SECOND"), c)
    return F.unix_date(c.cast("date")).cast("double") * 86_400 + seconds.cast("double")


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str], left_at: str, right_at: str, ties: Sequence[str], take: Sequence[str], bucket: float = 86_400.0) -> DataFrame:
    """``left`` with ``take`` of the latest ``right`` row of its ``by`` at or before ``left_at``; null where there is none.

    Of right rows of one time, the one that is last by ``ties`` counts.  Times are timestamps or
    numbers; ``bucket`` is in seconds or their unit.  Rows of one key are dealt by buckets of
    time, so a key with most of the rows is many tasks' work: inside a bucket the last right row is
    carried forward; a bucket's first left rows get the last right row of earlier buckets, which
    is carried over one narrow row a bucket.  Keys match as in ``=``: null keys, and null times,
    find nothing, but left rows stay.  The names in ``take`` must be free in ``left``.
    """
    p = _free(left, right)
    key = [f"{p}k{i}" for i in range(len(by))]
    found = F.struct(*(F.col(f"`{c}`") for c in take))
    rank = [F.col(f"`{right_at}`").alias("at"), *(F.col(f"`{t}`").alias(f"tie{i}") for i, t in enumerate(ties))]
    rights = right.where(F.col(f"`{right_at}`").isNotNull()).select(
        *(F.col(f"`{b}`").alias(k) for b, k in zip(by, key, strict=True)), F.floor(_number(right, right_at) / bucket).alias(f"{p}b"), F.struct(*rank, found.alias("found")).alias(f"{p}r")
    )
    rights = rights.where(F.expr(" AND ".join(f"{k} IS NOT NULL" for k in key)))
    lefts = left.select(
        *(F.col(f"`{b}`").alias(k) for b, k in zip(by, key, strict=True)), F.floor(_number(left, left_at) / bucket).alias(f"{p}b"), F.struct(F.col(f"`{left_at}`").alias("at")).alias(f"{p}l"), F.struct(*(F.col(f"`{c}`") for c in left.columns)).alias(f"{p}row")
    )
    # what earlier buckets end with: one row per key and bucket that has right rows
    ends = rights.groupBy(*key, f"{p}b").agg(F.max(f"{p}r").alias("end"))
    wanted = lefts.where(F.col(f"{p}b").isNotNull()).select(*key, f"{p}b").distinct().withColumn("end", F.lit(None).cast(ends.schema["end"].dataType))
    earlier = W.partitionBy(*key).orderBy(f"{p}b").rowsBetween(W.unboundedPreceding, -1)
    borders = ends.unionByName(wanted).groupBy(*key, f"{p}b").agg(F.max("end").alias("end"), F.max(F.col("end").isNull()).alias("asked"))
    carried = borders.withColumn("carried", F.last("end", ignorenulls=True).over(earlier)).where("asked and carried is not null").select(*key, f"{p}b", F.lit(0).alias(f"{p}s"), F.col("carried").alias(f"{p}r"))
    # a bucket in order: what is carried in, then right rows before left rows of the same time
    both = rights.withColumn(f"{p}s", F.lit(1)).unionByName(carried).withColumn(f"{p}at", F.when(F.col(f"{p}s") == 1, F.col(f"{p}r.at")))
    both = both.unionByName(lefts.withColumn(f"{p}s", F.lit(2)).withColumn(f"{p}at", F.col(f"{p}l.at")), allowMissingColumns=True)
    order = [F.col(f"{p}at").asc_nulls_first(), F.col(f"{p}s"), *(F.col(f"{p}r.tie{i}") for i in range(len(ties)))]
    last = F.last(f"{p}r", ignorenulls=True).over(W.partitionBy(*key, f"{p}b").orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    known = F.col(f"{p}l.at").isNotNull()
    for k in key:
        known = known & F.col(k).isNotNull()
    out = both.withColumn(f"{p}last", last).where(F.col(f"{p}row").isNotNull())
    return out.select(*(F.col(f"{p}row")[c].alias(c) for c in left.columns), *(F.when(known, F.col(f"{p}last.found")[c]).alias(c) for c in take))


def _cells(start: Column, end: Column, width: Column) -> Column:
    """The cells of one width that [start, end] touches."""
    return F.sequence(F.floor(start / width).cast("long"), F.floor(end / width).cast("long"))


def overlap_join(left: DataFrame, right: DataFrame, left_range: tuple[str, str], right_range: tuple[str, str], by: Sequence[tuple[str, str]] = (), unit: float = 1.0) -> DataFrame:
    """Pairs of rows whose closed ranges [start, end] overlap, with equal ``by`` columns; every pair once.

    A range is filed under the level whose cells are at least as long as it is, so under
    at most two cells, whatever its length: long ranges are few cells of a high level and not
    many of a low one.  Pairs of each two levels that occur meet on cells of the higher one, which the
    other's ranges look up; so the join is an equality on (levels, cell), and a hot cell is
    split as any skewed key.  A pair that meets in two cells counts where the later of its
    starts lies.  Ranges with a null end, or that end before they start, overlap nothing.
    A point is a range whose ends are equal.  Ends are timestamps or numbers; ``unit`` is the
    length of the lowest level's cells.  Columns of both sides must have different names.
    """
    p = _free(left, right)

    def filed(df: DataFrame, ends: tuple[str, str], side: str) -> DataFrame:
        a, b = (_number(df, c) / unit for c in ends)
        rows = df.where(a <= b).withColumns({f"{p}{side}a": a, f"{p}{side}b": b})
        length = F.col(f"{p}{side}b") - F.col(f"{p}{side}a")
        return rows.withColumn(f"{p}{side}l", F.when(length <= 1, 0).otherwise(F.least(F.ceil(F.log2(length)).cast("int"), F.lit(LEVELS - 1))))

    lefts, rights = filed(left, left_range, "x"), filed(right, right_range, "y")
    # which levels occur: at most 63 numbers a side
    levels = {s: sorted(r[0] for r in df.select(f"{p}{s}l").distinct().collect()) for s, df in (("x", lefts), ("y", rights))}

    def placed(df: DataFrame, side: str, other: str) -> DataFrame:
        pairs = F.transform(F.array(*map(F.lit, levels[other])), lambda o: F.struct(F.col(f"{p}{side}l").alias("mine"), o.alias("theirs"), F.greatest(F.col(f"{p}{side}l"), o).alias("at")))
        rows = df.withColumn(f"{p}{side}p", F.explode(pairs))
        width = F.pow(F.lit(2.0), F.col(f"{p}{side}p.at"))
        return rows.withColumn(f"{p}{side}c", F.explode(_cells(F.col(f"{p}{side}a"), F.col(f"{p}{side}b"), width)))

    if not levels["x"] or not levels["y"]:
        lefts, rights = lefts.limit(0), rights.limit(0)
        levels = {"x": [0], "y": [0]}
    a, b = placed(lefts, "x", "y"), placed(rights, "y", "x")
    on = (F.col(f"{p}xp.mine") == F.col(f"{p}yp.theirs")) & (F.col(f"{p}xp.theirs") == F.col(f"{p}yp.mine")) & (F.col(f"{p}xc") == F.col(f"{p}yc"))
    for x, y in by:
        on = on & (a[f"`{x}`"] == b[f"`{y}`"])
    met = a.join(b, on).where((F.col(f"{p}xa") <= F.col(f"{p}yb")) & (F.col(f"{p}ya") <= F.col(f"{p}xb")))
    width = F.pow(F.lit(2.0), F.col(f"{p}xp.at"))
    once = F.floor(F.greatest(f"{p}xa", f"{p}ya") / width).cast("long") == F.col(f"{p}xc")
    return met.where(once).select(*(a[f"`{c}`"] for c in left.columns), *(b[f"`{c}`"] for c in right.columns))


def sessions(events: DataFrame, by: Sequence[str], at: str, gap: str = "30 minutes", late: str | None = None, sums: Sequence[str] = ()) -> DataFrame:
    """Sessions per key: start, end (of the last event), number of events and sums; a pause of more than ``gap`` ends one.

    A batch, or a stream with ``late``: then a session is given out when the watermark has
    passed it, and events that come later than ``late`` are left out.  Sums are partial before
    the shuffle; sessions of one key merge in the task that has the key.  Null times have none.
    """
    if events.isStreaming:
        if late is None:
            raise ValueError("a stream's sessions need a bound on late events")
        events = events.withWatermark(at, late)
    found = events.where(F.col(at).isNotNull()).groupBy(*by, F.session_window(at, gap).alias("_w"))
    counted = found.agg(F.count(F.lit(1)).alias("n_events"), F.max(at).alias("session_end"), *(F.sum(c).alias(f"sum_{c}") for c in sums))
    return counted.select(*by, F.col("_w.start").alias("session_start"), "session_end", "n_events", *(f"sum_{c}" for c in sums))
