"""Queries of what is declared of tables or kept beside them: leaves, field types, digests, profiles.

Importing this module adds them to ``queries.QUERIES``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakework.operators import digests, events, fields, flat, profiles
from lakework.plans.queries import ORACLES, _query, _records, _scratch, _t
from lakework.sources import lake


@_query("""WITH e AS (SELECT *, event_id % 2 AS seg FROM events)
           SELECT event_type, 'value' AS field, 'number' AS control, count(*) AS n, 0::BIGINT AS n_null FROM e GROUP BY event_type
           UNION ALL SELECT event_type, 'when', 'approx_date', count(*), 0 FROM e GROUP BY event_type
           UNION ALL SELECT event_type, 'ok', 'bool', count(*), 0 FROM e GROUP BY event_type
           UNION ALL SELECT event_type, 'maybe', CASE WHEN count(*) FILTER (event_id % 11 = 0) > 0 THEN 'text' END, count(*), count(*) FILTER (event_id % 11 <> 0) FROM e GROUP BY event_type
           UNION ALL SELECT event_type, 'mixed', arg_min(CASE WHEN event_id % 3 = 0 THEN 'number' ELSE 'text' END, {'s': seg, 'e': event_id}), count(*), 0 FROM e GROUP BY event_type
           UNION ALL SELECT event_type, 'tags', 'readonly', count(*), 0 FROM e GROUP BY event_type""")
def event_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H8, H9: fields and controls of each event type, inferred per segment and merged."""
    e = _t(spark, sf_dir, "events")
    event = F.concat(
        F.lit('{"value":'), F.col("value").cast("string"), F.lit(',"when":{"date":"2024","precision":1},"ok":'), (F.col("event_id") % 5 == 0).cast("string"), F.lit(',"maybe":'), F.when(F.col("event_id") % 11 == 0, '"x"').otherwise("null"),
        F.lit(',"mixed":'), F.when(F.col("event_id") % 3 == 0, "1").otherwise('"t"'), F.lit(',"tags":["a"]}'),
    )
    line = F.concat(F.lit('{"note_id":"n","success":true,"events":{"'), "event_type", F.lit('":['), event, F.lit("]}}"))
    recs = events.records(e.select((F.col("event_id") % 2).alias("segment"), F.col("event_id").alias("line_no"), line.alias("value")))
    merged = fields.merge_types([fields.field_types(recs.where(F.col("segment") == k)) for k in (0, 1)])
    return merged.select("event_type", "field", "control", "n", "n_null")


@_query("""SELECT count(*) FILTER (event_id % 1000 = 3) AS "new", count(*) FILTER (event_id % 1000 = 7) AS updated, count(*) FILTER (event_id % 1000 NOT IN (3, 4, 7)) AS unchanged FROM events""")
def digest_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1, F8: the delta of two snapshots kept with digests; buckets that agree aren't read."""
    folder, k = _scratch(spark, "snapshots"), F.col("event_id") % 1000
    e = _t(spark, sf_dir, "events")
    rows = lambda changed: e.select("event_id", F.md5(F.col("event_id").cast("string")).alias("key_hash"), F.md5(F.concat_ws("|", "event_type", F.when(changed, "new").otherwise(F.col("value").cast("string")))).alias("content_hash"))
    for name, df in (("old", rows(F.lit(False)).where(k != 3)), ("new", rows(k == 7).where(k != 4))):
        digests.write_with_digests(df, f"{folder}/{name}", ["key_hash"], ["key_hash", "content_hash"], buckets=64)
    return digests.snapshot_delta(spark, f"{folder}/old", f"{folder}/new")


_PROFILED = ("l_orderkey", "l_quantity", "l_returnflag")


@_query(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) AS n, count(*) FILTER ({c} IS NULL) AS n_null, min({c})::VARCHAR AS least, max({c})::VARCHAR AS most, true AS distinct_fits, true AS median_fits FROM lineitem" for c in _PROFILED))
def merged_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E2 to E4, S: profiles of each month, stored and merged; estimates are held against exact counts."""
    rows = _t(spark, sf_dir, "lineitem").select(*_PROFILED, F.date_format("l_shipdate", "yyyy-MM").alias("month"))
    stored = lake.staged(profiles.profile(rows, ["month"]), "profiles")
    found = profiles.report(profiles.merge(stored))
    known = {r.column: r for r in found.collect()}  # a row per column
    exact = []
    for c in _PROFILED:
        n = F.count_distinct(F.col(c).cast("string"))
        median = known[c].quantiles and known[c].quantiles[1]
        total, error = F.count(c), F.lit(profiles.RANK_ERROR)
        fits = F.lit(True) if median is None else (F.count_if(F.col(c) < median) / total - error <= 0.5) & (F.count_if(F.col(c) <= median) / total + error >= 0.5)
        exact.append(F.struct(F.lit(c).alias("c"), (F.abs(F.lit(known[c].n_distinct) - n) <= F.ceil(n * profiles.DISTINCT_ERROR)).alias("distinct_fits"), fits.alias("median_fits")))
    checked = rows.agg(F.array(*exact).alias("x")).select(F.explode("x").alias("x")).select("x.*")
    return found.join(checked, F.col("column") == F.col("c")).select("column", "n", "n_null", "least", "most", "distinct_fits", "median_fits")


@_query(ORACLES["event_flatten"])
def declared_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H3 to H5: a flat row per event with declared leaves, in columns that are known beforehand."""
    found = flat.declared_events(_records(spark, sf_dir), ["reason", "at", "at_precision", "deep_k", "deep_l", "n"], ("note_id", "mrn"), strict=True)
    return found
