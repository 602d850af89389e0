"""Queries over the driver's tables, one per operator (group), with DuckDB SQL for the same rows.

The tables stand in for the lake's: ``documents`` for clean reports,
``conversations`` for line exports, ``events`` for logs, ``labels`` for worklists.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakework.functions import dates, enums, hashing, text
from lakework.operators import cohorts, collate, delta, diff, events, projection, quality, reshape, review, tombstones, upsert, versions
from lakework.operators.adjudicate import STATUSES
from lakework.session import shared_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None):
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query("""SELECT conv_id, md5(string_agg(coalesce(text, ''), '' ORDER BY turn)) AS text_md5, count(*) AS n_lines, arg_min(role, turn) AS first_role
           FROM conversations WHERE lower(trim(role)) NOT IN ('system') GROUP BY conv_id""")
def collate_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C7, E1."""
    lines = projection.drop_sections(_t(spark, sf_dir, "conversations"), "role", ["system"])
    whole = collate.concat_lines(lines.withColumn("n", F.lit(1)), ["conv_id"], ["turn"], "text", ["role"])
    counts = lines.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_lines"))
    return whole.join(counts, "conv_id").select("conv_id", F.md5("text").alias("text_md5"), "n_lines", F.col("role").alias("first_role"))


@_query("""SELECT user_id, event_type, event_id, ts FROM (
             SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1""")
def log_latest_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F6."""
    return versions.latest(_t(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "ts"), ["user_id", "event_type"], ["ts", "event_id"])


@_query("""SELECT user_id, event_type, event_id FROM (
             SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS n FROM events) WHERE n = 1""")
def log_last_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F7."""
    return versions.last_line(_t(spark, sf_dir, "events").select("user_id", "event_type", "event_id"), ["user_id", "event_type"], "event_id")


@_query("""SELECT event_type, k, count(*) AS n, count(*) FILTER (WHERE k % 2 = 0) AS succeeded
           FROM (SELECT event_type, json_extract_string(props, '$.k')::BIGINT AS k FROM events) GROUP BY event_type, k""")
def json_extract_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON field per row, by Spark's own parser, and its tally."""
    rows = _t(spark, sf_dir, "events").select("event_type", F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint").alias("k"))
    return rows.groupBy("event_type", "k").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("k") % 2 == 0).alias("succeeded"))


@_query("""SELECT l_returnflag, min(l_quantity) FILTER (WHERE l_linestatus = 'F') AS "F", min(l_quantity) FILTER (WHERE l_linestatus = 'O') AS "O" FROM lineitem GROUP BY l_returnflag""")
def pivot_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E12, M8."""
    return reshape.pivot_first(_t(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_linestatus", "l_quantity", ["F", "O"])


@_query("SELECT doc_id, lang, source FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1)")
def cohort_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C5, F15, K2."""
    cohort = _t(spark, sf_dir, "labels").where("quality = 1").select(F.col("doc_id").alias("REPORT_ID"))
    prepared, key = cohorts.prepare(cohort)
    return cohorts.restrict(_t(spark, sf_dir, "documents"), prepared, key, "doc_id").select("doc_id", "lang", "source")


@_query("SELECT doc_id, n_chars FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def unlabelled_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F9."""
    return diff.pair_anti(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "labels"), ["doc_id"]).select("doc_id", "n_chars")


@_query("SELECT doc_id, substr(sha256(text), 1, 16) AS prompt_hash, substr(sha256(concat_ws('|', doc_id::VARCHAR, coalesce(lang, 'None'))), 1, 12) AS key12 FROM documents")
def content_hash_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2, B6."""
    docs = _t(spark, sf_dir, "documents")
    return docs.select("doc_id", hashing.short_sha(F.col("text"), 16).alias("prompt_hash"), hashing.short_sha(hashing.key_text(docs, ["doc_id", "lang"]), 12).alias("key12"))


@_query("""SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace(regexp_replace('  ' || text || '    x  ----------- ', ' {3,}', '  ', 'g'), '-{10,}', '-------', 'g'), '[ \t]+(\n|$)', '\\1', 'g'), '^\\s+|\\s+$', '', 'g')) AS cleaned_md5 FROM documents""".replace("\\\\", "\\"))
def clean_whitespace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D2 on texts with runs of spaces and dashes put around them; tests cover the other rewrites."""
    wrapped = F.concat(F.lit("  "), "text", F.lit("    x  ----------- "))
    return _t(spark, sf_dir, "documents").select("doc_id", F.md5(text.clean_text(wrapped)).alias("cleaned_md5"))


_SNAPSHOTS = """WITH a AS (SELECT doc_id::VARCHAR AS k, md5(text) AS c FROM documents WHERE doc_id % 5 <> 0),
       b AS (SELECT doc_id::VARCHAR AS k, CASE WHEN doc_id % 3 = 0 THEN md5(text || '!') ELSE md5(text) END AS c FROM documents WHERE doc_id % 7 <> 0)"""


def _snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs = _t(spark, sf_dir, "documents")
    key = F.col("doc_id").cast("string").alias("key_hash")
    old = docs.where("doc_id % 5 <> 0").select(key, F.md5("text").alias("content_hash"))
    new = docs.where("doc_id % 7 <> 0").select(key, F.when(F.col("doc_id") % 3 == 0, F.md5(F.concat("text", F.lit("!")))).otherwise(F.md5("text")).alias("content_hash"))
    return old, new


@_query(_SNAPSHOTS + """SELECT count(*) FILTER (WHERE a.k IS NULL) AS "new", count(*) FILTER (WHERE a.c <> b.c) AS updated, count(*) FILTER (WHERE a.c = b.c) AS unchanged FROM b LEFT JOIN a USING (k)""")
def upsert_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1, G1: counts of an upsert."""
    return upsert.upsert_counts(*_snapshots(spark, sf_dir))


@_query(_SNAPSHOTS + "SELECT k AS key_hash, coalesce(b.c, a.c) AS content_hash FROM a FULL JOIN b USING (k)")
def upsert_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1, F17."""
    return upsert.upsert(*_snapshots(spark, sf_dir))


@_query(_SNAPSHOTS + """SELECT count(*) FILTER (WHERE NOT known) AS "new", count(*) FILTER (WHERE known AND NOT same) AS updated, count(*) FILTER (WHERE same) AS unchanged
           FROM (SELECT EXISTS (SELECT 1 FROM a WHERE a.k = b.k) AS known, EXISTS (SELECT 1 FROM a WHERE a.k = b.k AND a.c = b.c) AS same FROM b)""")
def keyed_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8, F9, E6, G1."""
    return diff.keyed_delta(*_snapshots(spark, sf_dir))


@_query("""WITH files AS (
             SELECT 0 AS f, user_id % 500 AS k, md5(event_type) AS c, event_id AS v FROM events WHERE event_id % 3 = 0
             UNION ALL SELECT 1, user_id % 500, md5(event_type), event_id FROM events WHERE event_id % 3 = 1
             UNION ALL SELECT 2, user_id % 500, md5(event_type), event_id FROM events WHERE event_id % 3 = 2
           ), unique_per_file AS (SELECT f, k, arg_min(c, v) AS c, min(v) AS v FROM files GROUP BY f, k),
           points AS (SELECT *, lag(c) OVER (PARTITION BY k ORDER BY f) AS before FROM unique_per_file)
           SELECT k, arg_max(c, f) AS content_hash, arg_max(v, f) AS v FROM points WHERE before IS NULL OR before <> c GROUP BY k""")
def dated_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the fold of upserts over three files."""
    rows = _t(spark, sf_dir, "events").select((F.col("event_id") % 3).alias("f"), (F.col("user_id") % 500).alias("k"), F.md5("event_type").alias("content_hash"), F.col("event_id").alias("v"))
    rows = rows.groupBy("f", "k").agg(F.min_by("content_hash", "v").alias("content_hash"), F.min("v").alias("v"))
    return upsert.replay(rows, "f", "k", "content_hash")


@_query("""SELECT record_id, segment, value FROM (
             SELECT user_id || '/' || event_type AS record_id, event_id % 3 AS segment, event_id AS value,
                    row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id % 3 DESC, event_id DESC) AS n FROM events) WHERE n = 1""")
def segment_highest_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F4, A13; within a segment the later line, as segments have one row per id."""
    rows = _t(spark, sf_dir, "events").select(F.concat_ws("/", F.col("user_id").cast("string"), "event_type").alias("record_id"), (F.col("event_id") % 3).alias("segment"), F.col("event_id").alias("value"))
    rows = versions.latest(rows, ["record_id", "segment"], ["value"])
    return versions.highest_segment(rows)


@_query("""SELECT user_id, event_id % 3 AS segment, event_id FROM events e
           WHERE event_id % 3 = (SELECT max(event_id % 3) FROM events x WHERE x.user_id = e.user_id)""")
def segment_highest_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5, F5, F11."""
    rows = _t(spark, sf_dir, "events").select("user_id", (F.col("event_id") % 3).alias("segment"), "event_id")
    return versions.highest_segment_rows(rows, "user_id")


@_query("""WITH a AS (SELECT doc_id, nullif(lang, 'de') AS lang FROM documents WHERE doc_id % 4 <> 0), b AS (SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN 'xx' ELSE nullif(lang, 'de') END AS lang FROM documents)
           SELECT count(*) FILTER (WHERE NOT hit) AS "new", 0::BIGINT AS updated, count(*) FILTER (WHERE hit) AS unchanged
           FROM (SELECT EXISTS (SELECT 1 FROM a WHERE a.doc_id IS NOT DISTINCT FROM b.doc_id AND a.lang IS NOT DISTINCT FROM b.lang) AS hit FROM b)""")
def snapshot_diff_unkeyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows compared as wholes, null equal to null."""
    docs = _t(spark, sf_dir, "documents").select("doc_id", F.expr("nullif(lang, 'de')").alias("lang"))
    new = docs.withColumn("lang", F.when(F.col("doc_id") % 9 == 0, "xx").otherwise(F.col("lang")))
    return diff.unkeyed_delta(docs.where("doc_id % 4 <> 0"), new)


@_query("""WITH h AS (SELECT doc_id AS id, CASE WHEN doc_id % 6 = 0 THEN NULL WHEN doc_id % 4 = 0 THEN md5(text || 'old') ELSE md5(text) END AS src,
                    CASE WHEN doc_id % 10 = 1 THEN 'd1' ELSE 'd2' END AS def FROM documents WHERE doc_id % 5 <> 0),
           f AS (SELECT d.doc_id AS id, md5(d.text) AS cur, d.doc_id % 11 = 0 AS forced, h.id IS NOT NULL AS known, h.id IS NOT NULL AND h.src IS NULL AS legacy,
                   coalesce(h.src = md5(d.text), false) AS same, coalesce(h.src = md5(d.text) AND h.def = 'd2', false) AS same_def FROM documents d LEFT JOIN h ON h.id = d.doc_id)
           SELECT CASE WHEN NOT known THEN 'new' WHEN legacy THEN CASE WHEN forced THEN 'forced' ELSE 'skipped' END WHEN NOT same THEN 'changed'
                       WHEN NOT same_def THEN 'definition_changed' WHEN forced THEN 'forced' ELSE 'skipped' END AS category, count(*) AS n, sum(id)::BIGINT AS ids FROM f GROUP BY 1""")
def delta_categorise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incremental categories with definition changes and forced ids."""
    docs = _t(spark, sf_dir, "documents").withColumn("id", F.col("doc_id").cast("string"))
    n = F.col("doc_id")
    src = F.when(n % 6 == 0, F.lit(None)).when(n % 4 == 0, F.md5(F.concat("text", F.lit("old")))).otherwise(F.md5("text"))
    history = docs.where("doc_id % 5 <> 0").select("id", src.alias("src"), F.when(n % 10 == 1, "d1").otherwise("d2").alias("def"))
    found = delta.categorise(docs.select("id", F.md5("text").alias("current")), history, "d2", docs.where("doc_id % 11 = 0").select("id"), on_definition_change=True)
    return found.groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("id").cast("bigint")).alias("ids"))


@_query("""SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic = 0 AND d.n_chars % 2 = 0)
           AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic = 1)""")
def resume_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Done by id and hash, or by an id without a hash."""
    notes = _t(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), (F.col("n_chars") % 2).cast("string").alias("hash"), "lang")
    done = _t(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.when(F.col("toxic") == 0, "0").alias("src"))
    return delta.resume(notes, done).select(F.col("id").alias("doc_id"), "lang")


@_query("""SELECT event_id, user_id || '::' || event_type || '::' || CASE WHEN user_id % 2 = 0 THEN 'id-' || substr(sha256('{"value":"' || event_type || '"}'), 1, 12)
                    || CASE WHEN row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) > 1 THEN '::' || (row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) - 1) ELSE '' END
                  ELSE (row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id))::VARCHAR END AS event_key,
                  substr(sha256('{"n":' || event_id || CASE WHEN user_id % 2 = 0 THEN ',"value":"' || event_type || '"}' ELSE ',"value":null}' END), 1, 12) AS fingerprint
           FROM events""")
def slot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identity keys where the field is set, ordinals where not, suffixes for repeats, fingerprints."""
    e = _t(spark, sf_dir, "events")
    value = F.when(F.col("user_id") % 2 == 0, F.concat(F.lit('"'), "event_type", F.lit('"'))).otherwise("null")
    body = F.concat(F.lit('{"'), "event_type", F.lit('":[{"value":'), value, F.lit(',"n":'), F.col("event_id").cast("string"), F.lit(',"evidence":["x"]}]}'))
    recs = e.select(F.col("user_id").cast("string").alias("note_id"), F.col("event_id").alias("line_no"), body.alias("events_json"))
    kinds = [r[0] for r in e.select("event_type").distinct().collect()]  # a handful of declared event types
    found = events.slots(recs, {k: ["value"] for k in kinds})
    return found.select(F.col("line_no").alias("event_id"), "event_key", "fingerprint")


_SILVER = """WITH o AS (SELECT d.doc_id, CASE WHEN d.doc_id % 13 = 0 AND l.doc_id IS NOT NULL THEN 'unreviewed' WHEN l.doc_id IS NULL THEN 'auto_accepted' WHEN l.quality = 1 THEN 'approved' ELSE 'rejected' END AS outcome
             FROM documents d LEFT JOIN labels l USING (doc_id)) """


def _placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _t(spark, sf_dir, "documents"), _t(spark, sf_dir, "labels")
    none = F.lit(None).cast("string")
    key = F.col("doc_id").cast("string").alias("event_key")
    raw = docs.select(key, F.lit("doc").alias("event_type"), F.col("source").alias("note_id"), none.alias("mrn"), F.concat(F.lit('{"lang":"'), "lang", F.lit('"}')).alias("fields_json"))
    work = labels.join(docs.select("doc_id"), "doc_id", "left_semi").select(key, none.alias("mrn"), none.alias("note_date"), none.alias("note_type"), none.alias("department"))
    log = labels.where("doc_id % 13 <> 0").join(docs.select("doc_id"), "doc_id", "left_semi")
    log = log.select(key, F.when(F.col("quality") == 1, "approved").otherwise("rejected").alias("verdict"), F.lit('{"toxic":"x"}').alias("edits_json"), none.alias("comment"), none.alias("reviewer"),
                     none.alias("reviewed_at"), none.alias("mrn"), none.alias("event_type"), none.alias("note_id"), F.lit(False).alias("is_new_event"))
    return review.placed(raw, work, log)


@_query(_SILVER + "SELECT outcome, count(*) AS n FROM o GROUP BY outcome")
def silver_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F12, I7."""
    return review.silver_counts(_placed(spark, sf_dir))


@_query(_SILVER + """SELECT doc_id::VARCHAR AS event_key, CASE outcome WHEN 'approved' THEN 'flagged_reviewed' ELSE 'unflagged_autoaccept' END AS acceptance_reason,
           CASE outcome WHEN 'approved' THEN 'approved' ELSE '' END AS review_verdict, CASE outcome WHEN 'approved' THEN '{"lang":"' || lang || '","toxic":"x"}' ELSE '{"lang":"' || lang || '"}' END AS reviewed_fields_json,
           lang, CASE outcome WHEN 'approved' THEN 'x' END AS toxic FROM o JOIN documents USING (doc_id) WHERE outcome IN ('approved', 'auto_accepted')""")
def silver_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted events with edits merged and fields flattened."""
    return review.silver(_placed(spark, sf_dir)).select("event_key", "acceptance_reason", "review_verdict", "reviewed_fields_json", "lang", "toxic")


@_query("""WITH l AS (SELECT user_id || '::' || event_type AS k, max(event_id) AS v FROM events WHERE event_id % 3 <> 0 GROUP BY 1), r AS (SELECT user_id || '::' || event_type AS k, max(event_id) AS v FROM events WHERE event_id % 3 <> 1 GROUP BY 1)
           SELECT status, count(*) AS n FROM (SELECT CASE WHEN l.k IS NULL THEN 'missing_left' WHEN r.k IS NULL THEN 'missing_right' WHEN l.v = r.v THEN 'matched' ELSE 'different' END AS status FROM l FULL JOIN r USING (k)) GROUP BY status""")
def adjudication_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches' slots side by side."""
    from lakework.operators import adjudicate

    e = _t(spark, sf_dir, "events")

    def side(rest: int) -> DataFrame:
        last = e.where(F.col("event_id") % 3 != rest).groupBy("user_id", "event_type").agg(F.max("event_id").alias("v"))
        note = F.col("user_id").cast("string")
        return last.select(F.concat_ws("::", note, "event_type").alias("event_key"), F.lit("e").alias("event_type"), note.alias("note_id"), note.alias("mrn"), F.concat(F.lit('{"evidence":[],"v":'), F.col("v").cast("string"), F.lit("}")).alias("fields_json"))

    return adjudicate.status_counts(adjudicate.align(side(0), side(1), {"e": ["v"]})).where(F.col("status").isin(*STATUSES))


@_query("""WITH s AS (SELECT user_id::VARCHAR AS note_id, list_sort(list(event_type)) AS a, list_sort(list(event_type) FILTER (WHERE event_id % 20 <> 0)) AS b, count(*) FILTER (WHERE event_id % 20 <> 0) AS n FROM events GROUP BY user_id)
           SELECT note_id FROM s WHERE n = 0 OR a <> b""")
def disagreement_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes where a second run lacks the note or sees other events."""
    e = _t(spark, sf_dir, "events").withColumn("note_id", F.col("user_id").cast("string"))

    def run(rows: DataFrame) -> DataFrame:
        items = F.transform(F.collect_list(F.struct("event_id", "event_type")), lambda x: F.concat(F.lit('{"t":"'), x["event_type"], F.lit('","n":'), x["event_id"].cast("string"), F.lit("}")))
        return rows.groupBy("note_id").agg(F.concat(F.lit('{"e":['), F.array_join(items, ","), F.lit("]}")).alias("events_json")).withColumns({"success": F.lit(True), "line_no": F.lit(1)})

    return review.disagreement_notes(run(e), [run(e.where("event_id % 20 <> 0"))], {"e": ["t"]})


@_query("""WITH l AS (SELECT user_id::VARCHAR AS target, arg_max(event_type, {'a': ts, 'b': event_id}) AS t, max(ts) AS latest FROM events GROUP BY user_id)
           SELECT target FROM l WHERE t IN ('click', 'view', 'purchase') AND t < 'd'""")
def tombstone_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets whose latest event forgets them."""
    e = _t(spark, sf_dir, "events")
    action = F.when((F.col("event_type").isin("click", "view", "purchase")) & (F.col("event_type") < "d"), "forget").otherwise("revive")
    log = e.select(F.lpad(F.col("event_id").cast("string"), 16, "0").alias("event_id"), F.lit("batch").alias("kind"), F.col("user_id").cast("string").alias("target"), action.alias("action"), F.col("ts").cast("string").alias("at"))
    return tombstones.active(log).select("target")


@_query("""SELECT p_partkey, CASE regexp_replace(lower(p_brand), '[\\s\\-_./()]+', '', 'g') WHEN 'brand#11' THEN 'first' WHEN 'brand#12' THEN 'second' ELSE trim(p_brand) END AS brand FROM part""".replace("\\\\", "\\"))
def enum_canonicalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D4, D10."""
    return _t(spark, sf_dir, "part").select("p_partkey", enums.canonical(F.concat(F.lit(" "), F.upper("p_brand"), F.lit(" ")), {"brand #11": "first", "BRAND-#12": "second"}).alias("u"), "p_brand").select("p_partkey", F.when(F.col("u").isin("first", "second"), F.col("u")).otherwise(F.trim("p_brand")).alias("brand"))


@_query("""WITH d AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y') WHEN 1 THEN strftime(o_orderdate, '%Y-%m') WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE 'soon' END AS t FROM orders)
           SELECT o_orderkey, CASE length(t) WHEN 4 THEN CASE WHEN t = 'soon' THEN t ELSE t || '-07-15' END WHEN 7 THEN t || '-15' ELSE t END AS padded,
                  CASE WHEN t = 'soon' THEN 'unknown' WHEN length(t) = 4 THEN 'year' WHEN length(t) = 7 THEN 'month' ELSE 'day' END AS precision FROM d""")
def approx_date_pad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D5 to D7."""
    k = F.col("o_orderkey") % 4
    form = F.when(k == 0, F.date_format("o_orderdate", "yyyy")).when(k == 1, F.date_format("o_orderdate", "yyyy-MM")).when(k == 2, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("soon")
    approx = F.struct(form.alias("date"), F.lit(0).alias("precision"), F.lit(None).cast("string").alias("anchor"))
    return _t(spark, sf_dir, "orders").select("o_orderkey", *dates.expand_approx(approx, "padded")[:2]).withColumnRenamed("padded_precision", "precision")


@_query("SELECT coalesce(nullif(trim(patient), ''), note_id) AS patient, count(DISTINCT note_id) AS n_notes, count(*) AS n_rows FROM (SELECT CASE WHEN user_id % 10 = 0 THEN ' ' ELSE (user_id % 50)::VARCHAR END AS patient, user_id::VARCHAR AS note_id FROM events) GROUP BY 1")
def patient_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E11."""
    note = F.col("user_id").cast("string").alias("note_id")
    return reshape.by_patient(_t(spark, sf_dir, "events").select(F.when(F.col("user_id") % 10 == 0, " ").otherwise((F.col("user_id") % 50).cast("string")).alias("mrn"), note))


@_query("""SELECT 'null_ids' AS "check", 'error' AS severity, 'docs' AS dataset, 'lang' AS detail, count(*) AS n FROM documents WHERE nullif(lang, 'es') IS NULL HAVING count(*) > 0
           UNION ALL SELECT 'duplicate_keys', 'warning', 'docs', 'key_hash', n FROM (SELECT count(*) - count(DISTINCT text) - max((text IS NULL)::INT) AS n FROM documents) WHERE n > 0
           UNION ALL SELECT 'empty_dataset', 'warning', 'none', 'no rows', 1""")
def quality_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N3, N4, N6, E3, E4."""
    docs = _t(spark, sf_dir, "documents").select("doc_id", F.expr("nullif(lang, 'es')").alias("lang"), F.col("text").alias("key_hash"))
    none = docs.where("doc_id < -1")
    return quality.null_ids(docs, "docs", ["doc_id", "lang"]).unionByName(quality.duplicate_keys(docs, "docs")).unionByName(quality.empty_dataset(none, "none")).unionByName(quality.empty_dataset(docs, "docs"))


@_query("SELECT count(*) AS n_rows, count(*) - count(DISTINCT source) AS duplicate_keys, count(*) FILTER (WHERE lang IS NULL) AS null_lang FROM documents")
def table_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E2 to E4 in one pass."""
    return quality.table_profile(_t(spark, sf_dir, "documents").withColumn("key_hash", F.col("source")), ["lang"])


@_query("""SELECT 'docs' AS dataset, 'db_alignment' AS "check", 'warning' AS severity, 'lake ' || a || ', table ' || b AS detail, a - b AS n FROM (SELECT (SELECT count(*) FROM documents) AS a, (SELECT count(*) FROM labels) AS b) WHERE a <> b""")
def db_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N7."""
    docs, labels = _t(spark, sf_dir, "documents"), _t(spark, sf_dir, "labels")
    return quality.alignment({"docs": docs, "same": labels}, {"docs": labels, "same": labels})


@_query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderdate DESC, o_orderkey LIMIT 25")
def runs_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L3, O4."""
    return reshape.recent(_t(spark, sf_dir, "orders"), 25, "o_orderdate", "o_orderkey", ("o_orderstatus", "F")).select("o_orderkey", "o_totalprice")


@_query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey::VARCHAR IN (SELECT c_custkey::VARCHAR FROM customer WHERE c_mktsegment = 'BUILDING') ORDER BY o_orderkey LIMIT 40")
def limit_after_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The limit counts rows that the id filter left."""
    ids = _t(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    rows = projection.filter_ids(_t(spark, sf_dir, "orders"), ids, "o_custkey")
    return reshape.notes_page(rows, "o_orderkey", limit=40).select("o_orderkey", "o_custkey")


@_query("""SELECT doc_id, doc_id % 2 = 0 AS own FROM (SELECT doc_id, text, translate(substr(CASE WHEN doc_id % 2 = 0 THEN text ELSE reverse(text) END, 11, 30), 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') AS q FROM documents)
           WHERE trim(q, E' \\n\\t') <> '' AND contains(regexp_replace(lower(text), '\\s+', ' ', 'g'), trim(regexp_replace(lower(q), '\\s+', ' ', 'g')))""".replace("\\\\", "\\"))
def quote_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages in other letters and with other whitespace, of the text itself or of its reverse."""
    docs = _t(spark, sf_dir, "documents").withColumn("own", F.col("doc_id") % 2 == 0)
    quote = F.substring(F.when(F.col("own"), F.col("text")).otherwise(F.reverse("text")), 11, 30)
    quote = F.regexp_replace(F.translate(quote, "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), " ", "\n ")
    return docs.where(text.quote_found(F.col("text"), quote)).select("doc_id", "own")


@_query("SELECT k AS user_id, in_left, in_right FROM (SELECT user_id AS k, bool_or(event_type = 'click') AS in_left, bool_or(event_type = 'view') AS in_right FROM events GROUP BY user_id) WHERE in_left OR in_right")
def key_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """keys of either set, and in which they are."""
    e = _t(spark, sf_dir, "events")
    s = diff.key_sets(e.where("event_type = 'click'"), e.where("event_type = 'view'"), "user_id")
    tag = lambda name, a, b: s[name].select("user_id", F.lit(a).alias("in_left"), F.lit(b).alias("in_right"))
    return diff.union_strict(tag("only_left", True, False), tag("only_right", False, True), tag("both", True, True))


@_query("SELECT 'a' AS part, doc_id, lang, NULL AS quality FROM documents UNION ALL SELECT 'b', doc_id, NULL, quality::BIGINT FROM labels")
def union_relaxed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """columns that one side lacks are null, types widen."""
    a = _t(spark, sf_dir, "documents").select(F.lit("a").alias("part"), "doc_id", "lang")
    b = _t(spark, sf_dir, "labels").select(F.lit("b").alias("part"), "doc_id", F.col("quality").cast("bigint").alias("quality"))
    return diff.union_relaxed(a, b)


@_query("SELECT event_type, count(*) AS n_events, count(DISTINCT user_id) AS n_notes FROM events GROUP BY event_type")
def run_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per type of records that have one event each."""
    e = _t(spark, sf_dir, "events")
    recs = e.select(F.col("user_id").cast("string").alias("note_id"), F.concat(F.lit('{"'), "event_type", F.lit('":[{"v":1}, 2], "other": 3}')).alias("events_json"))
    return events.run_statistics(recs)


@_query("SELECT min(o_orderdate) AS first, max(o_orderdate) AS last FROM orders")
def date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E13."""
    return reshape.date_range(_t(spark, sf_dir, "orders"), "o_orderdate")


@_query("""SELECT f.field, a.v AS "left", b.v AS "right", a.v IS DISTINCT FROM b.v AS differs FROM (VALUES ('n_name'), ('n_regionkey')) f(field)
           JOIN (SELECT unnest(['n_name', 'n_regionkey']) AS field, unnest([n_name, n_regionkey::VARCHAR]) AS v FROM nation WHERE n_nationkey = 1) a USING (field)
           JOIN (SELECT unnest(['n_name', 'n_regionkey']) AS field, unnest([n_name, n_regionkey::VARCHAR]) AS v FROM nation WHERE n_nationkey = 2) b USING (field)""")
def runs_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L5."""
    return reshape.compare_rows(_t(spark, sf_dir, "nation"), "1", "2", ["n_name", "n_regionkey"], "n_nationkey")


@_query("SELECT n.n_name, r.r_name, count(*) AS n_customers, round(sum(c_acctbal), 2) AS balance FROM customer c JOIN nation n ON c_nationkey = n_nationkey JOIN region r ON n_regionkey = r_regionkey GROUP BY ALL")
def catalog_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7: any SQL over the catalog; here a star join with a rollup."""
    from lakework.plans import catalog

    for name in ("customer", "nation", "region"):
        _t(spark, sf_dir, name).createOrReplaceTempView(f"lw_{name}")
    return catalog.sql(spark, "SELECT n_name, r_name, count(*) AS n_customers, round(sum(c_acctbal), 2) AS balance FROM lw_customer JOIN lw_nation ON c_nationkey = n_nationkey JOIN lw_region ON n_regionkey = r_regionkey GROUP BY n_name, r_name")


# --- records, files and the rest of the inventory ------------------------------------------


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extraction records made from events: a note per user, segments of its events, some failed."""
    e = _t(spark, sf_dir, "events")
    body = F.concat(
        F.lit('{"note_id":"'), F.col("user_id").cast("string"), F.lit('","mrn":'), F.when(F.col("user_id") % 4 == 0, '" "').otherwise(F.concat(F.lit('"m'), (F.col("user_id") % 20).cast("string"), F.lit('"'))),
        F.lit(',"success":'), F.when(F.col("event_id") % 5 == 0, "false").otherwise("true"), F.lit(',"rounds":2,"input_tokens":'), F.col("event_id").cast("string"),
        F.lit(',"events":{"'), "event_type", F.lit('":[{"n":'), F.col("event_id").cast("string"), F.lit(',"at":"'), F.date_format("ts", "yyyy-MM"), F.lit('","deep":{"k":"v","l":["a","b"]}}],"flag_report_for_review":'),
        F.when(F.col("event_id") % 7 == 0, '[{"reason":"r"}]').otherwise("[]"), F.lit("}}"),
    )
    lines = e.select(F.col("event_id").alias("line_no"), F.when(F.col("event_id") % 50 == 3, F.concat(body, F.lit("}"))).otherwise(body).alias("value"))
    return events.records(lines)


_RECORDS = "(SELECT *, user_id::VARCHAR AS note_id, CASE WHEN user_id % 4 = 0 THEN ' ' ELSE 'm' || (user_id % 20) END AS mrn, event_id % 5 <> 0 AS success FROM events WHERE event_id % 50 <> 3)"


@_query(f"""SELECT event_id AS line_no, note_id AS record_id, mrn, success, 2 AS rounds, event_id AS input_tokens, 0::BIGINT AS output_tokens, 3::BIGINT AS segment,
            md5('{{"' || least(event_type, 'flag_report_for_review') || '": ' || CASE WHEN event_type < 'flag_report_for_review' THEN body ELSE flag END || ', "' || greatest(event_type, 'flag_report_for_review') || '": ' || CASE WHEN event_type < 'flag_report_for_review' THEN flag ELSE body END || '}}') AS events_md5
            FROM (SELECT *, '[{{"at": "' || strftime(ts, '%Y-%m') || '", "deep": {{"k": "v", "l": ["a", "b"]}}, "n": ' || event_id || '}}]' AS body, CASE WHEN event_id % 7 = 0 THEN '[{{"reason": "r"}}]' ELSE '[]' END AS flag FROM {_RECORDS}) WHERE success""")
def wide_extractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Successful records as wide rows; malformed lines vanish."""
    rows = events.wide(_records(spark, sf_dir), "b", 3).withColumnRenamed("input_tokens", "line_no")
    return rows.select("line_no", "record_id", "mrn", "success", "rounds", F.col("line_no").alias("input_tokens"), "output_tokens", "segment", F.md5("events_json").alias("events_md5"))


@_query(f"""SELECT note_id, event_type AS tool_name, mrn, NULL AS reason, strftime(ts, '%Y-%m') || '-15' AS at, 'month' AS at_precision, 'v' AS deep_k, 'a;b' AS deep_l, event_id::VARCHAR AS n FROM {_RECORDS}
            UNION ALL SELECT note_id, 'flag_report_for_review', mrn, 'r', NULL, NULL, NULL, NULL, NULL FROM {_RECORDS} WHERE event_id % 7 = 0""")
def event_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A flat row per event, every leaf a column."""
    return events.event_table(_records(spark, sf_dir)).drop("gate_result")


@_query(f"SELECT DISTINCT note_id FROM {_RECORDS} WHERE success AND event_id % 7 = 0")
def flagged_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I1."""
    return review.flagged_notes(_records(spark, sf_dir))


@_query(f"""SELECT coalesce(nullif(trim(mrn), ''), note_id) AS patient, count(DISTINCT note_id) AS n_notes, count(*) + count(*) FILTER (WHERE event_id % 7 = 0) AS n_events FROM {_RECORDS} WHERE success GROUP BY 1""")
def worklist_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A review package's patients."""
    return review.worklist(_records(spark, sf_dir)).select("patient", F.size("notes").cast("bigint").alias("n_notes"), F.size("events").cast("bigint").alias("n_events"))


@_query(f"SELECT user_id % 3 AS part, count(*) AS total, count(*) FILTER (WHERE success) AS succeeded, count(*) FILTER (WHERE NOT success) AS failed, round(count(*) FILTER (WHERE success) / count(*), 6) AS success_rate FROM {_RECORDS} GROUP BY 1")
def run_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E7."""
    return events.run_tally(_records(spark, sf_dir).withColumn("part", F.col("note_id").cast("bigint") % 3), ["part"])


@_query("""WITH l AS (SELECT event_id, event_id % 5 <> 0 AS ok, event_id % 50 = 3 AS bad FROM events) SELECT event_id FROM l WHERE ok OR bad""")
def prune_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed records go, malformed lines stay."""
    e = _t(spark, sf_dir, "events")
    body = F.concat(F.lit('{"success":'), F.when(F.col("event_id") % 5 == 0, "false").otherwise("true"), F.when(F.col("event_id") % 50 == 3, "").otherwise("}"))
    return delta.prune_failed(e.select("event_id", body.alias("value"))).select("event_id")


@_query("""SELECT 'jsonl_parseable' AS "check", 'error' AS severity, 'log' AS dataset, 'malformed lines' AS detail, count(*) AS n FROM events WHERE event_id % 9 = 0 HAVING count(*) > 0""")
def unparseable_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N5."""
    e = _t(spark, sf_dir, "events")
    return quality.unparseable_lines(e.select(F.when(F.col("event_id") % 9 == 0, "{bad").when(F.col("event_id") % 9 == 1, " ").otherwise(F.col("props")).alias("value")), "log")


@_query("""SELECT 'required_columns' AS "check", 'error' AS severity, 'documents' AS dataset, 'key_hash, content_hash' AS detail, 2::BIGINT AS n""")
def required_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N2, from the schema alone."""
    tables = {n: _t(spark, sf_dir, n) for n in ("documents", "labels")}
    return quality.required_columns(spark, tables, {"documents": ["doc_id", "key_hash", "content_hash"], "labels": ["doc_id"]})


@_query("""WITH l AS (SELECT lpad(event_id::VARCHAR, 16, '0') AS event_id, user_id::VARCHAR AS target, CASE WHEN event_type < 'd' THEN 'forget' ELSE 'revive' END AS action, ts, event_id AS e FROM events)
           SELECT event_id, target, action, action = 'forget' AND row_number() OVER (PARTITION BY target ORDER BY ts DESC, event_id DESC) = 1 AS active FROM l""")
def tombstone_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2, J4."""
    e = _t(spark, sf_dir, "events")
    log = e.select(F.lpad(F.col("event_id").cast("string"), 16, "0").alias("event_id"), F.lit("batch").alias("kind"), F.col("user_id").cast("string").alias("target"), F.when(F.col("event_type") < "d", "forget").otherwise("revive").alias("action"), F.col("ts").cast("string").alias("at"))
    return tombstones.audit(log).select("event_id", "target", "action", "active")


@_query("""WITH a AS (SELECT user_id::VARCHAR AS k, max(event_id) AS l FROM events WHERE event_id % 3 <> 0 GROUP BY user_id), b AS (SELECT user_id::VARCHAR AS k, max(event_id) AS r FROM events WHERE event_id % 3 <> 1 GROUP BY user_id)
           SELECT k AS adjudication_key, CASE WHEN l IS NULL THEN 'missing_left' WHEN r IS NULL THEN 'missing_right' ELSE 'different' END AS adjudication_status, CASE k::BIGINT % 3 WHEN 0 THEN 'left' WHEN 1 THEN 'right' ELSE 'custom' END AS adjudication_decision,
                  CASE k::BIGINT % 3 WHEN 0 THEN l::VARCHAR WHEN 1 THEN r::VARCHAR ELSE 'own' END AS v
           FROM a FULL JOIN b USING (k) WHERE l IS DISTINCT FROM r AND l IS NOT NULL AND r IS NOT NULL AND k::BIGINT % 5 <> 4
           UNION ALL SELECT k, CASE WHEN l IS NULL THEN 'missing_left' ELSE 'missing_right' END, CASE WHEN l IS NULL THEN 'right' ELSE 'left' END, coalesce(l, r)::VARCHAR
           FROM a FULL JOIN b USING (k) WHERE (l IS NULL OR r IS NULL) AND k::BIGINT % 5 <> 4""")
def adjudicated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions applied to the disagreements of two batches, missing sides too; excluded items vanish."""
    from lakework.operators import adjudicate

    e = _t(spark, sf_dir, "events")

    def side(rest: int) -> DataFrame:
        last = e.where(F.col("event_id") % 3 != rest).groupBy(F.col("user_id").cast("string").alias("event_key")).agg(F.max("event_id").alias("v"))
        return last.select("event_key", F.lit("e").alias("event_type"), F.col("event_key").alias("note_id"), F.lit("m").alias("mrn"), F.concat(F.lit('{"v":'), F.col("v").cast("string"), F.lit("}")).alias("fields_json"))

    items = adjudicate.disagreements(adjudicate.align(side(0), side(1), {"e": ["v"]}))
    k = F.col("adjudication_key").cast("bigint")
    decision = F.when(k % 5 == 4, "exclude").when(F.col("status") == "missing_left", "right").when(F.col("status") == "missing_right", "left").when(k % 3 == 0, "left").when(k % 3 == 1, "right").otherwise("custom")
    log = items.select("adjudication_key", decision.alias("decision"), F.lit('{"v":"own"}').alias("adjudicated_fields_json"))
    return adjudicate.adjudicated(items, log).select("adjudication_key", "adjudication_status", "adjudication_decision", "v")


@_query("""WITH a AS (SELECT c_custkey AS id, c_name, c_acctbal FROM customer WHERE c_custkey % 4 <> 0), b AS (SELECT c_custkey AS id, c_name, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal FROM customer)
           SELECT count(*) FILTER (WHERE a.id IS NULL) AS "new", count(*) FILTER (WHERE a.id IS NOT NULL AND a.c_acctbal IS DISTINCT FROM b.c_acctbal) AS updated, count(*) FILTER (WHERE a.id IS NOT NULL AND a.c_acctbal IS NOT DISTINCT FROM b.c_acctbal) AS unchanged FROM b LEFT JOIN a USING (id)""")
def runs_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By id, whole rows compared null-safely."""
    c = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("run_id"), "c_name", "c_acctbal")
    return diff.identity_delta(c.where("run_id % 4 <> 0"), c.withColumn("c_acctbal", F.when(F.col("run_id") % 5 != 0, F.col("c_acctbal"))))


@_query("SELECT o_orderkey, o_orderstatus FROM orders WHERE starts_with(o_orderkey::VARCHAR, '12') ORDER BY o_orderkey::VARCHAR LIMIT 1")
def run_by_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L4."""
    orders = _t(spark, sf_dir, "orders").withColumn("id", F.col("o_orderkey").cast("string"))
    return reshape.by_prefix(orders, "12", "id").select("o_orderkey", "o_orderstatus")


@_query("""SELECT p_partkey, regexp_replace(p_type, '[^A-Za-z0-9._-]', '_', 'g') AS file_name, list_aggregate(list_transform(string_split(replace(lower(p_name), '_', ' '), ' '), lambda w: upper(w[1]) || w[2:]), 'string_agg', ' ') AS label FROM part""")
def labels_and_file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D16, D17."""
    return _t(spark, sf_dir, "part").select("p_partkey", text.safe_file_name(F.col("p_type")).alias("file_name"), text.humanise(F.lower(F.regexp_replace("p_name", " ", "_"))).alias("label"))


@_query("""SELECT o_orderkey, (o_orderkey % 3 <> 0) AND (o_orderkey % 5 <> 4) AS valid FROM orders""")
def approx_date_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edits with impossible dates or unknown precisions are refused."""
    k = F.col("o_orderkey")
    date = F.when(k % 3 == 0, F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("-02-30"))).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return _t(spark, sf_dir, "orders").select("o_orderkey", dates.valid_approx_edit(date, (k % 5).cast("int"), F.when(k % 2 == 0, "MID")).alias("valid"))


@_query("SELECT o_orderkey, o_orderdate::DATE AS d FROM orders WHERE o_orderkey % 4 <> 3 UNION ALL SELECT o_orderkey, NULL FROM orders WHERE o_orderkey % 4 = 3")
def dates_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates in several forms, one of them no date."""
    k = F.col("o_orderkey") % 4
    form = F.when(k == 0, F.date_format("o_orderdate", "MM/dd/yyyy")).when(k == 1, F.concat(F.lit(" "), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T00:00:00"))).when(k == 2, F.date_format("o_orderdate", "d MMMM yyyy")).otherwise("no date")
    return _t(spark, sf_dir, "orders").select("o_orderkey", dates.normalise_date(form).alias("d"))


def _scratch(spark: SparkSession, name: str) -> str:
    """A new folder for files that a query writes to read them."""
    return f"{shared_dir(spark)}/lakework-{name}-{uuid.uuid4().hex}"


@_query("SELECT conv_id::VARCHAR AS conv_id, '0' || turn AS turn, md5(text || chr(10) || '\"q\", x') AS text_md5 FROM conversations")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: ids keep leading zeros, quotes and line breaks stay inside fields."""
    from lakework.sources import readers

    path = _scratch(spark, "csv")
    rows = _t(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("conv_id"), F.concat(F.lit("0"), F.col("turn").cast("string")).alias("turn"), F.concat("text", F.lit('\n"q", x')).alias("text"))
    rows.write.option("header", True).option("quote", '"').option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return readers.read_csv(spark, path).select("conv_id", "turn", F.md5("text").alias("text_md5"))


@_query("SELECT event_id, event_type FROM events WHERE event_id % 10 <> 0")
def jsonl_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines written and read; blank and malformed lines vanish."""
    from lakework.sources import lake, readers

    path = _scratch(spark, "jsonl")
    body = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(',"event_type":"'), "event_type", F.lit('"}'))
    lines = _t(spark, sf_dir, "events").select(F.when(F.col("event_id") % 20 == 0, " ").when(F.col("event_id") % 20 == 10, F.concat(body, F.lit("x"))).otherwise(body).alias("line"))
    lake.write_jsonl(lines, path, "line")
    found = F.try_parse_json("value")
    return readers.json_lines(spark, path).select(F.try_variant_get(found, "$.event_id", "bigint").alias("event_id"), F.try_variant_get(found, "$.event_type", "string").alias("event_type"))


@_query("SELECT n_nationkey AS key_hash, CASE WHEN n_nationkey < 5 THEN 'b' ELSE 'a' END AS content_hash FROM nation")
def upsert_on_disk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two upserts into a Parquet table that is read while it is replaced."""
    from lakework.sources import lake

    path = _scratch(spark, "upsert")
    rows = _t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("key_hash"))
    lake.upsert_table(rows.where("key_hash < 20").withColumn("content_hash", F.lit("a")), path)
    lake.upsert_table(rows.withColumn("content_hash", F.when(F.col("key_hash") < 5, "b").otherwise("a")), path)
    return spark.read.parquet(path)
