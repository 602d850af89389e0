"""Queries over time and spans: as-of and overlap joins, sessions, latest-wins as a stream, evidence in notes.

Importing this module adds them to ``queries.QUERIES``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakework.operators import evidence, temporal
from lakework.plans.queries import _query, _scratch, _t
from lakework.sources import blocks
from lakework.streaming import latest


@_query("""SELECT l.event_id, l.user_id, max({'at': r.ts, 'id': r.event_id, 'value': r.value}).id AS purchase_id, max({'at': r.ts, 'id': r.event_id, 'value': r.value}).value AS price
           FROM events l LEFT JOIN events r ON l.user_id = r.user_id AND r.event_type = 'purchase' AND r.ts <= l.ts WHERE l.event_type <> 'purchase' GROUP BY l.event_id, l.user_id""")
def price_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S: the user's latest purchase at or before each other event; of one time the larger id."""
    e = _t(spark, sf_dir, "events")
    prices = e.where("event_type = 'purchase'").select(F.col("user_id").alias("u"), F.col("ts").alias("paid_at"), F.col("event_id").alias("purchase_id"), F.col("value").alias("price"))
    found = temporal.asof_join(e.where("event_type <> 'purchase'").select("event_id", "user_id", "ts"), prices.withColumnRenamed("u", "user_id"), ["user_id"], "ts", "paid_at", ["purchase_id"], ["purchase_id", "price"])
    return found.select("event_id", "user_id", "purchase_id", "price")


_STAYS = "SELECT event_id, user_id, event_type, ts AS a, ts + to_minutes(CASE WHEN event_id % 100 = 0 THEN 4000 ELSE event_id % 97 END) AS b FROM events"


@_query(f"""WITH s AS ({_STAYS}) SELECT x.event_id AS error_id, y.event_id AS view_id FROM s x JOIN s y ON x.user_id = y.user_id AND x.a <= y.b AND y.a <= x.b WHERE x.event_type = 'error' AND y.event_type = 'view'""")
def overlapping_stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S: pairs of a user's errors and views whose times overlap; a hundredth of them last days."""
    e = _t(spark, sf_dir, "events")
    minutes = F.when(F.col("event_id") % 100 == 0, F.lit(4000)).otherwise(F.col("event_id") % 97).cast("int")
    stays = lambda kind, p: e.where(F.col("event_type") == kind).select(F.col("event_id").alias(f"{p}_id"), F.col("user_id").alias(f"{p}_user"), F.col("ts").alias(f"{p}_from"), (F.col("ts") + F.make_dt_interval(mins=minutes)).alias(f"{p}_to"))
    found = temporal.overlap_join(stays("error", "error"), stays("view", "view"), ("error_from", "error_to"), ("view_from", "view_to"), [("error_user", "view_user")], unit=3600.0)
    return found.select("error_id", "view_id")


@_query("""WITH marked AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 30 MINUTES THEN 0 ELSE 1 END AS fresh FROM events),
                numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM marked)
           SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n_events, round(sum(value), 4) AS total FROM numbered GROUP BY user_id, s""")
def user_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S: a user's events until a pause of more than 30 minutes."""
    found = temporal.sessions(_t(spark, sf_dir, "events").select("user_id", "ts", "value"), ["user_id"], "ts", "30 minutes", sums=["value"])
    return found.select("user_id", "session_start", "session_end", "n_events", F.round("sum_value", 4).alias("total"))


@_query("""SELECT user_id, event_type, arg_max(event_id, {'at': ts, 'id': event_id}) AS event_id FROM events GROUP BY user_id, event_type""")
def latest_wins_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S, F3, F6: lines that arrive shuffled, in three batches of a stream, leave the rows of the batch."""
    folder = _scratch(spark, "latest")
    e = _t(spark, sf_dir, "events").select("user_id", "event_type", "event_id", F.col("ts").cast("timestamp").alias("ts"))
    for k in range(3):  # each part comes in batches of its own; late lines are among them
        e.where(F.pmod(F.xxhash64("event_id"), F.lit(3)) == k).write.mode("append").parquet(f"{folder}/in")
    files = len(blocks.matches(spark, f"{folder}/in/part-*"))
    lines = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", max(1, files // 3)).parquet(f"{folder}/in")
    changes = latest.latest_stream(lines, ["user_id", "event_type"], ["ts", "event_id"])
    query = latest.keep_latest(changes, f"{folder}/out", f"{folder}/checkpoint", ["user_id", "event_type"], ["ts", "event_id"])
    query.awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("user_id", "event_type", "event_id")


@_query(r"""WITH t AS (SELECT doc_id, lower(regexp_replace(text, '\s+', ' ', 'g')) AS t FROM documents),
                q AS (SELECT DISTINCT doc_id, t, unnest([trim(substr(t, 11, 20)), trim(substr(t, 25, 20)), trim(substr(t, 200, 3)), trim(substr(t, 40, 1))]) AS q FROM t),
                p AS (SELECT doc_id, q, unnest(string_split(t, q)) AS piece, unnest(range(1, len(string_split(t, q)) + 1)) AS i, len(string_split(t, q)) AS n FROM q WHERE q <> ''),
                s AS (SELECT DISTINCT doc_id, a, a + length(q) AS b FROM (SELECT *, sum(length(piece)) OVER (PARTITION BY doc_id, q ORDER BY i) + (i - 1) * length(q) AS a FROM p) WHERE i < n),
                f AS (SELECT *, CASE WHEN max(b) OVER (PARTITION BY doc_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) >= a THEN 0 ELSE 1 END AS fresh FROM s),
                g AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS island FROM f)
           SELECT doc_id, min(a)::BIGINT AS start, max(b)::BIGINT AS "end" FROM g GROUP BY doc_id, island""")
def evidence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of four quotes a text, in capitals and with other whitespace; those that touch are one."""
    docs = _t(spark, sf_dir, "documents").select("doc_id", F.regexp_replace("text", r"\s+", " ").alias("t"))
    capitals = lambda c: F.translate(c, "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    quotes = docs.select("doc_id", F.explode(F.array(*(F.regexp_replace(capitals(F.substring("t", a, n)), " ", "\n ") for a, n in ((11, 20), (25, 20), (200, 3), (40, 1))))).alias("quote"))
    return evidence.quote_spans(docs, quotes, "doc_id", "t")
