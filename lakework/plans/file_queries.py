"""Queries for the operators that work on files, on the driver or on Python values, with SQL for the same rows.

They build what they read from the driver's tables: an inbox, logs, packages, small
values.  Folders are scratch in the shared folder, which must be mounted (an inbox is
a folder of files); what is done per row or per file on the driver is bounded by the
25 nations, five regions or four event types.  Importing this module adds them to ``queries.QUERIES``.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import uuid
from pathlib import Path
from urllib.parse import urlparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakework.config import BackendSettings, Config, load_config, save_config
from lakework.extract import registry, runner, segments
from lakework.functions import dates, hashing, jsonx, text
from lakework.operators import adjudicate, cohorts, delta, diff, events, projection, quality, reshape, review, runs, tombstones
from lakework.plans import catalog, rounds
from lakework.plans.ingest import Ingest
from lakework.plans.queries import _RECORDS, _query, _records, _scratch, _t
from lakework.schemas import REPORTS, conform
from lakework.sources import lake, packages, readers, sidecar, tombstone_files, transport


def _folder(spark: SparkSession, name: str) -> Path:
    path = Path(urlparse(_scratch(spark, name)).path)
    path.mkdir(parents=True)
    return path


def _one_file(lines: DataFrame, path: Path, *order: str) -> Path:
    """A table's column ``value`` as the lines of one file, in order: a folder of the parts that Spark's sort writes."""
    lines.orderBy(*order).select("value").write.text(str(path))
    return path


def _sql_rows(names: str, rows) -> str:
    cell = lambda v: "NULL" if v is None else "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)
    return f"(VALUES {', '.join('(' + ', '.join(map(cell, r)) + ')' for r in rows)}) AS v({names})"


# --- hashes and sidecars ----------------------------------------------------------------------


def _digest(*values: str) -> str:
    return hashlib.blake2b("|".join(values).encode(), digest_size=16).hexdigest()


#: What the hashes of every combination of values must be, computed one by one.
_HASHES = [
    (flag, k, b, _digest(flag or "", str(k) if k else ""), _digest("True" if b else "", flag or ""), _digest(flag or "", str(k), str(b)), _digest(flag or "None", str(k)), _digest(str(b), ""))
    for flag, k, b in itertools.product((None, "A", "R"), range(3), (True, False))
]


@_query(f"""SELECT key_hash, content_hash, text_hash, p_key, p_content, count(*) AS n FROM lineitem JOIN {_sql_rows("flag, k, b, key_hash, content_hash, text_hash, p_key, p_content", _HASHES)}
            ON nullif(l_returnflag, 'N') IS NOT DISTINCT FROM flag AND l_linenumber % 3 = k AND (l_linestatus = 'F') = b GROUP BY ALL""")
def row_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulls, zeros and falsehoods under the three rules, missing columns too."""
    rows = _t(spark, sf_dir, "lineitem").select(F.expr("nullif(l_returnflag, 'N')").alias("flag"), (F.col("l_linenumber") % 3).alias("k"), (F.col("l_linestatus") == "F").alias("b"))
    out = hashing.with_hashes(rows, ["flag", "k", "missing"], ["b", "flag"]).withColumn("text_hash", hashing.blake2b_128(hashing.content_text(rows, ["flag", "k", "b"])))
    passed = hashing.passthrough_hashes(out.drop("key_hash", "content_hash"), ["flag", "k"], ["b", "missing"]).withColumnsRenamed({"key_hash": "p_key", "content_hash": "p_content"})
    again = hashing.with_hashes(passed, ["flag", "k", "missing"], ["b", "flag"])
    names = ("key_hash", "content_hash", "text_hash", "p_key", "p_content")
    return again.groupBy(*(F.lower(F.hex(n)).alias(n) for n in names)).agg(F.count(F.lit(1)).alias("n"))


@_query("""SELECT r_name AS name, substr(sha256('{"prompt": "' || r_name || '", "tools": {"a": {"x": ' || r_regionkey || '}}}'), 1, 16) AS definition,
             substr(sha256('{"definition": "' || r_name || '", "events": {"e": {"comparison": ["v"], "fields": [{"control": "text", "name": "a", "options": []}, {"control": "enum", "name": "v", "options": ["x", "y"]}], "identity": ["a"]}}}'), 1, 16) AS comparability FROM region""")
def definition_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A definition's hash, and what makes two batches comparable."""
    schema = {"e": {"fields": [{"name": "v", "label": "V", "control": "enum", "options": ["y", "x"]}, {"name": "a", "control": "text", "required": True}], "event_identity_fields": ["a"], "comparison_fields": ["v"]}}
    rows = [(r.r_name, hashing.definition_hash(r.r_name, {"b": {}, "a": {"x": r.r_regionkey}}, ["b"]), hashing.adjudication_hash(r.r_name, schema)) for r in _t(spark, sf_dir, "region").collect()]
    return spark.createDataFrame(rows, "name string, definition string, comparability string")


@_query("""SELECT r_name || '.txt' AS file, CASE WHEN r_regionkey = 1 THEN 'missing' ELSE 'mismatch' END AS status FROM region WHERE r_regionkey IN (0, 1, 3)""")
def sidecar_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests are recorded, trusted while a file is as it was, and verified by the executors."""
    folder = _folder(spark, "sidecars")
    for r in _t(spark, sf_dir, "region").collect():
        path = folder / f"{r.r_name}.txt"
        path.write_text(r.r_name)
        if r.r_regionkey != 1:
            sidecar.ensure(path)
        if r.r_regionkey % 3 == 0:
            path.write_text(r.r_name + "!")
            if sidecar.is_fresh(path):
                raise AssertionError("a changed file's digest isn't fresh")
    return sidecar.verify(spark, str(folder)).select(F.regexp_extract("file", r"([^/]+)$", 1).alias("file"), "status")


# --- texts and values -------------------------------------------------------------------------


@_query(r"""WITH c AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace('HEAD  ' || coalesce(text, '') || repeat(chr(10), 4) || 'FOOTER 12  tail', ' {3,}', '  ', 'g'), '-{10,}', '-------', 'g'), '[ \t]+(\n|$)', '\1', 'g'), '^\s+|\s+$', '', 'g') AS t FROM documents)
           SELECT doc_id, md5(regexp_replace(regexp_replace(replace(regexp_replace(t, 'FOOTER [0-9]+', '', 'g'), '  ', chr(10)), '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g')) AS report_md5 FROM c""")
def clean_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3: boilerplate goes, double spaces break lines, empty lines are at most one."""
    wrapped = F.concat(F.lit("HEAD  "), F.coalesce("text", F.lit("")), F.lit("\n\n\n\nFOOTER 12  tail"))
    return _t(spark, sf_dir, "documents").select("doc_id", F.md5(text.clean_report(wrapped, ["FOOTER [0-9]+"], double_space_breaks=True)).alias("report_md5"))


@_query("""SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN true WHEN 1 THEN true WHEN 2 THEN true ELSE false END AS partial FROM orders""")
def partial_date_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D8."""
    k = F.col("o_orderkey") % 5
    form = F.when(k == 0, F.date_format("o_orderdate", "yyyy")).when(k == 1, F.date_format("o_orderdate", "yyyy-MM")).when(k == 2, F.date_format("o_orderdate", "yyyy-MM-dd")).when(k == 3, F.date_format("o_orderdate", "yyyy-M-dd 'x'"))
    return _t(spark, sf_dir, "orders").select("o_orderkey", dates.looks_partial(form).alias("partial"))


@_query("""SELECT event_id, substr(sha256('{"a":[' || event_id || ',null],"b":"' || event_type || '"}'), 1, 12) AS hash, CASE event_id % 4 WHEN 0 THEN event_type WHEN 1 THEN event_type || ';2' WHEN 2 THEN '7' ELSE '' END AS evidence FROM events""")
def json_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashes don't depend on spaces or key order; a scalar of evidence is a list of one."""
    e, quoted = _t(spark, sf_dir, "events"), F.concat(F.lit('"'), "event_type", F.lit('"'))
    body = F.concat(F.lit('{"b" : '), quoted, F.lit(', "a": [ '), F.col("event_id").cast("string"), F.lit(", null ] }"))
    k = F.col("event_id") % 4
    evidence = F.when(k == 0, quoted).when(k == 1, F.concat(F.lit("["), quoted, F.lit(", 2]"))).when(k == 2, "7").otherwise("null")
    return e.select("event_id", jsonx.json_hash(body).alias("hash"), F.array_join(jsonx.listed(evidence), ";").alias("evidence"))


@_query("""SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_brand ELSE p_size::VARCHAR END AS a_b, p_type AS a_c FROM part""")
def leaf_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H3, H4: of two leaves with one name the later wins."""
    q = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    inner = F.concat(F.lit('"a":{"b":'), q("p_brand"), F.lit(',"c":'), q("p_type"), F.lit("}"))
    outer = F.concat(F.lit('"a_b":'), F.col("p_size").cast("string"))
    even = F.col("p_partkey") % 2 == 0
    body = F.concat(F.lit("{"), F.when(even, outer).otherwise(inner), F.lit(","), F.when(even, inner).otherwise(outer), F.lit("}"))
    leaves = jsonx.flattened(body)
    return _t(spark, sf_dir, "part").select("p_partkey", leaves.alias("m")).select("p_partkey", F.col("m")["a_b"].alias("a_b"), F.col("m")["a_c"].alias("a_c"))


@_query("""SELECT event_id, event_id % 3 <> 2 AS same FROM events""")
def equal_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys in another order and null for absent are the same edit."""
    n, k = F.col("event_id").cast("string"), F.col("event_id") % 3
    a = F.concat(F.lit('{"x":'), n, F.lit(',"y":[1,2]}'))
    b = F.when(k == 0, F.concat(F.lit('{"y":[1,2],"x":'), n, F.lit("}"))).when(k == 1, F.concat(F.lit('{"z":null,"y":[1, 2],"x":'), n, F.lit("}"))).otherwise(F.concat(F.lit('{"y":[2,1],"x":'), n, F.lit("}")))
    return _t(spark, sf_dir, "events").select("event_id", jsonx.same_json(a, b).alias("same"))


@_query("""WITH s AS (SELECT user_id, bool_or(event_id % 4 = 0) AS typed, bool_or(event_id % 5 = 0) AS nulled, bool_or(event_id % 4 = 0 AND event_id % 3 = 0) AS other_typed FROM events GROUP BY user_id)
           SELECT user_id::VARCHAR AS note_id FROM s WHERE nulled""")
def agreement_of_empties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null comparable field differs from an absent one; order, provenance and empty values inside don't matter."""
    e = _t(spark, sf_dir, "events").groupBy(F.col("user_id").cast("string").alias("note_id")).agg(F.bool_or(F.col("event_id") % 4 == 0).alias("typed"), F.bool_or(F.col("event_id") % 5 == 0).alias("nulled"))

    def run(first: bool) -> DataFrame:
        lists = '"q":[{"a":1,"b":{"k":[]}},{"a":2}]' if first else '"q":[{"a":2},{"b":null,"a":1,"evidence":["x"]}]'
        null = F.when(F.col("nulled") & F.lit(first), F.lit(',"n":[{"a":null}]')).when(F.col("nulled"), F.lit(',"n":[{}]')).otherwise("")
        body = F.concat(F.lit("{" + lists), null, F.when(F.col("typed"), F.lit(',"t":[]')).otherwise(""), F.lit("}"))
        return e.select("note_id", body.alias("events_json")).withColumns({"success": F.lit(True), "line_no": F.lit(1)})

    return review.disagreement_notes(run(True), [run(False)], {"q": ["a", "b"], "n": ["a"]})


@_query("""SELECT user_id::VARCHAR AS note_id FROM events GROUP BY user_id HAVING bool_or(event_id % 4 = 0)""")
def agreement_of_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An event type without events differs from an absent one."""
    e = _t(spark, sf_dir, "events").groupBy(F.col("user_id").cast("string").alias("note_id")).agg(F.bool_or(F.col("event_id") % 4 == 0).alias("typed"))
    run = lambda empty: e.select("note_id", F.when(F.col("typed"), empty).otherwise("{}").alias("events_json")).withColumns({"success": F.lit(True), "line_no": F.lit(1)})
    return review.disagreement_notes(run('{"t":[]}'), [run("{}")], {"t": ["a"]})


# --- shapes, filters, orders ------------------------------------------------------------------


@_query("""SELECT o_orderkey::VARCHAR AS report_id, o_custkey::VARCHAR AS mrn, o_orderdate::DATE AS ordering_date, NULL AS external_name, o_orderpriority AS report_text, o_orderstatus AS extra, 'c1' AS cohort_name, o_orderstatus AS kind, NULL AS department, true AS clean, false AS lines FROM orders""")
def export_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Other names, absent columns, constants, keys as strings."""
    raw = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("case_num"), F.col("o_custkey").alias("pat_mrn_id"), F.col("o_orderdate").alias("ordering_date"), F.col("o_orderpriority").alias("report_text"), F.col("o_orderstatus").alias("extra"))
    named = projection.rename_aliases(raw, {"pat_mrn_id": "mrn", "case_num": "report_id", "extra": "report_text"})
    clean, lines = projection.is_clean_shape(named), projection.is_clean_shape(named.withColumn("mult_ln_val_storage", F.lit("x")))
    kind = projection.first_present(named, ["note_type", "extra", "report_text"])
    fixed = projection.with_literals(conform(projection.key_as_string(named, "report_id"), REPORTS), {"cohort_name": "c1", "clean": clean, "lines": lines})
    return fixed.select(*REPORTS.names[:5], "extra", "cohort_name", F.col(kind).alias("kind"), projection.optional(fixed, "department").alias("department"), "clean", "lines")


@_query("""SELECT doc_id, n_chars FROM documents WHERE n_chars > 300 AND lang <> 'de' AND doc_id % 7 <> 0 AND doc_id % 11 <> 0""")
def user_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's predicate; null texts go, blank ones are skipped."""
    blank = F.when(F.col("doc_id") % 7 == 0, " \n\t\u3000").when(F.col("doc_id") % 11 == 0, F.lit(None)).otherwise(F.col("text"))
    rows = projection.filter_notes(_t(spark, sf_dir, "documents").withColumn("text", blank), "text", "n_chars > 300 AND lang <> 'de'")
    return projection.drop_blank(rows, "text").select("doc_id", "n_chars")


@_query("""SELECT o_orderpriority, o_clerk, o_orderkey FROM (SELECT o_orderpriority, nullif(o_orderstatus, 'P') AS o_clerk, o_orderkey, o_totalprice FROM orders) ORDER BY o_clerk DESC NULLS LAST, o_orderpriority ASC NULLS LAST, o_totalprice DESC, o_orderkey LIMIT 50""")
def total_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1, O2: several keys in mixed directions, nulls last."""
    rows = _t(spark, sf_dir, "orders").withColumn("o_clerk", F.expr("nullif(o_orderstatus, 'P')"))
    return reshape.ordered(rows, [("o_clerk", False), ("o_orderpriority", True), ("o_totalprice", False), ("o_orderkey", True)]).limit(50).select("o_orderpriority", "o_clerk", "o_orderkey")


@_query("""SELECT event_id, d.text IS NOT NULL AS found, d.lang FROM events LEFT JOIN documents d ON d.doc_id = user_id""")
def notes_attached(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F16: texts and metadata by string id."""
    notes = _t(spark, sf_dir, "documents").select(F.col("doc_id").alias("note_id"), F.col("text").isNotNull().alias("has"), "lang")
    rows = reshape.attach_notes(_t(spark, sf_dir, "events").select("event_id", F.col("user_id").cast("string").alias("note_id")), notes)
    return rows.select("event_id", F.coalesce("has", F.lit(False)).alias("found"), "lang")


@_query("""SELECT count(*) FILTER (WHERE c_custkey % 4 = 0 OR c_custkey % 5 = 0) AS "new", 0::BIGINT AS updated, count(*) FILTER (WHERE c_custkey % 4 <> 0 AND c_custkey % 5 <> 0) AS unchanged FROM customer""")
def delta_without_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns that say when a row was made don't count."""
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_name", F.lit("2024").alias("made_at"))
    new = c.withColumns({"made_at": F.lit("2025"), "c_name": F.when(F.col("c_custkey") % 5 == 0, "other").otherwise(F.col("c_name"))})
    return diff.unkeyed_delta(c.where("c_custkey % 4 <> 0"), new, ["made_at"])


@_query(r"""SELECT p_partkey, CASE regexp_replace(lower(p_brand), '[\s\-_./()]+', '', 'g') WHEN 'brand#11' THEN 'first' WHEN 'brand#12' THEN 'second' ELSE upper(p_brand) END AS brand, CASE WHEN lower(p_brand) = 'brand#12' THEN 'second;x' ELSE upper(p_brand) || ';x' END AS brands FROM part WHERE lower(p_brand) <> 'brand#11'
           UNION ALL SELECT p_partkey, 'first', 'first;x' FROM part WHERE lower(p_brand) = 'brand#11'""")
def enum_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What no synonym names comes back stripped, in lists too."""
    from lakework.functions import enums

    synonyms, raw = {"brand #11": "first", "BRAND-#12": "second"}, F.concat(F.lit(" "), F.upper("p_brand"), F.lit("\t"))
    many = F.array_join(enums.canonical_list(F.array(raw, F.lit(" x ")), synonyms), ";")
    return _t(spark, sf_dir, "part").select("p_partkey", enums.canonical(raw, synonyms).alias("brand"), many.alias("brands"))


# --- readers and writers ----------------------------------------------------------------------


@_query("SELECT o_orderkey, o_orderstatus FROM orders")
def parquet_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several tables of one schema as one."""
    folder, rows = _scratch(spark, "parquet"), _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    for k in range(3):
        lake.write_table(rows.where(F.col("o_orderkey") % 3 == k), f"{folder}/{k}.parquet")
    whole = readers.read_parquet(spark, f"{folder}/0.parquet")
    return whole.union(readers.read_parquet(spark, [f"{folder}/1.parquet", f"{folder}/2.parquet"]))


@_query("SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'")
def cohort_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of a CSV file whose key column is in capitals."""
    path, c = _scratch(spark, "cohort"), _t(spark, sf_dir, "customer")
    c.where("c_mktsegment = 'BUILDING'").select(F.col("c_mktsegment").alias("group"), F.col("c_custkey").alias("NOTE_ID")).write.option("header", True).csv(path)
    read = readers.read_csv(spark, path)
    prepared, key = cohorts.prepare(read, cohorts.detect_key(read.columns))
    return cohorts.restrict(c, prepared, key, "c_custkey").select("c_custkey", "c_name")


@_query("""SELECT 'name' AS what, row_number() OVER (ORDER BY name) AS place, name FROM (SELECT '2024-' || lpad((n_nationkey % 12 + 1)::VARCHAR, 2, '0') || '-' || lpad((n_nationkey + 1)::VARCHAR, 2, '0') || '_x.csv' AS name FROM nation)
           UNION ALL SELECT 'refused', 0, 'not YYYY-MM-DD_<label>.csv or .jsonl: ' || string_agg(r_name, ', ' ORDER BY r_name) FROM region""")
def dated_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replay order, and every bad name at once."""
    names = [f"2024-{r.n_nationkey % 12 + 1:02d}-{r.n_nationkey + 1:02d}_x.csv" for r in _t(spark, sf_dir, "nation").collect()]
    rows = [("name", i, n) for i, n in enumerate(readers.dated_files(names), 1)]
    try:
        readers.dated_files([*names, *(r.r_name for r in _t(spark, sf_dir, "region").collect())])
    except ValueError as e:
        rows.append(("refused", 0, str(e)))
    return spark.createDataFrame(rows, "what string, place bigint, name string")


@_query("""SELECT conv_id::VARCHAR AS event_key, CASE WHEN arg_max(turn, turn) % 2 = 0 THEN 'approved' ELSE 'rejected' END AS verdict, lpad(max(turn)::VARCHAR, 6, '0') AS reviewed_at, '{"turn":' || max(turn) || '}' AS edits_json FROM conversations GROUP BY conv_id""")
def review_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log's lines by number; the latest verdict of an event stands."""
    c = _t(spark, sf_dir, "conversations")
    turn = F.col("turn").cast("string")
    body = F.concat(F.lit('{"event_key":"'), F.col("conv_id").cast("string"), F.lit('","verdict":" '), F.when(F.col("turn") % 2 == 0, "Approved").otherwise("REJECTED"), F.lit(' ","edits":{"turn": '), turn, F.lit('},"reviewed_at":"'), F.lpad(turn, 6, "0"), F.lit('"}'))
    path = _one_file(c.select(body.alias("value"), F.hash("conv_id", "turn").alias("o")), _folder(spark, "log") / "x.review_log.jsonl", "o")
    return review.review_log(readers.numbered_lines(spark, str(path))).select("event_key", "verdict", "reviewed_at", "edits_json")


@_query("""SELECT 'note' AS what, event_id::VARCHAR AS id, event_type AS text, 1::BIGINT AS n FROM events WHERE event_id % 10 > 1
           UNION ALL SELECT 'malformed', NULL, NULL, count(*) FILTER (WHERE event_id % 10 = 0) FROM events UNION ALL SELECT 'missing', NULL, NULL, count(*) FILTER (WHERE event_id % 10 = 1) FROM events""")
def notes_from_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: notes of JSON lines, and counts of malformed and incomplete ones."""
    k, path = F.col("event_id") % 10, _scratch(spark, "notes")
    head = F.concat(F.lit('{"id":"'), F.col("event_id").cast("string"), F.lit('"'))
    _t(spark, sf_dir, "events").select(F.when(k == 0, head).when(k == 1, F.concat(head, F.lit("}"))).otherwise(F.concat(head, F.lit(',"text":"'), "event_type", F.lit('"}')))).write.text(path)
    notes, counters = readers.notes_from_jsonl(spark, path, "id", "text")
    notes = lake.staged(notes, "notes")  # the one pass
    counted = spark.createDataFrame([(what, None, None, counters.get[what]) for what in ("malformed", "missing")], "what string, id string, text string, n bigint")
    return notes.select(F.lit("note").alias("what"), "id", "text", F.lit(1).cast("bigint").alias("n")).unionByName(counted)


@_query("SELECT row_number() OVER (ORDER BY conv_id, turn)::VARCHAR AS row_id, conv_id::VARCHAR AS conv_id, turn::VARCHAR AS turn FROM conversations")
def csv_row_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a file numbered in its order."""
    c = _t(spark, sf_dir, "conversations").select(F.lit(1).alias("k"), "conv_id", "turn", F.concat_ws(",", F.col("conv_id").cast("string"), F.col("turn").cast("string"), F.lit('"a\n""b"""')).alias("value"))
    path = _one_file(c.union(spark.sql("SELECT 0, 0L, 0L, 'conv_id,turn,note'")), Path(_scratch(spark, "rows")), "k", "conv_id", "turn")
    return readers.read_csv_numbered(spark, str(path)).where(F.col("note") == 'a\n"b"').select("row_id", "conv_id", "turn")


@_query("""SELECT 'r' || lpad(n_nationkey::VARCHAR, 3, '0') AS run_id, n_name AS name, CASE WHEN n_nationkey % 2 = 1 THEN 'completed' ELSE 'started' END AS status, CASE WHEN n_nationkey % 2 = 1 THEN n_nationkey ELSE 0 END::BIGINT AS items_processed, CASE WHEN n_nationkey % 2 = 1 THEN 60.0 END::DOUBLE AS duration_seconds, 0::BIGINT AS total_events FROM nation""")
def run_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifests written, some completed, all projected."""
    folder = _folder(spark, "runs")
    for r in _t(spark, sf_dir, "nation").collect():
        run = runs.start("fc_single", r.n_name, run_id=f"r{r.n_nationkey:03d}", started_at="2024-01-01T10:00:00")
        del run["total_events"]  # an older manifest
        runs.write_manifest(folder, run)
        if r.n_nationkey % 2 and not runs.complete(folder, run["run_id"], completed_at="2024-01-01T10:01:00", items_processed=r.n_nationkey, no_such_field=1):
            raise AssertionError("the run's file is there")
    return runs.project(spark, str(folder)).select("run_id", "name", "status", "items_processed", "duration_seconds", "total_events")


@_query("""SELECT 'conflict' AS what, n_name || '.csv' AS file FROM nation WHERE n_nationkey % 5 = 2 UNION ALL SELECT 'copied', n_name || '.csv' FROM nation WHERE n_nationkey % 5 > 2
           UNION ALL SELECT 'present', n_name || '.csv' FROM nation WHERE n_nationkey % 5 < 2 UNION ALL SELECT 'status', count(*)::VARCHAR FROM nation WHERE n_nationkey % 5 <> 2""")
def inbox_transfer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conflicts are all found before anything is copied; then only missing files are."""
    folder, rows = _folder(spark, "transfer"), []
    remote, inbox = folder / "remote" / "d", folder / "inbox" / "d"
    remote.mkdir(parents=True)
    inbox.mkdir(parents=True)
    for r in _t(spark, sf_dir, "nation").collect():
        (remote / f"{r.n_name}.csv").write_text(r.n_name)
        (remote / f"{r.n_name}.csv.sha256").write_text("left out")
        if r.n_nationkey % 5 < 3:
            (inbox / f"{r.n_name}.csv").write_text(r.n_name if r.n_nationkey % 5 < 2 else r.n_name[::-1])
    try:
        transport.pull(remote, inbox)
    except transport.ConflictError as e:
        rows += [("conflict", f) for f in e.files]
        for f in e.files:
            (remote / f).unlink()
            (inbox / f).unlink()
    done = transport.pull(remote, inbox)
    rows += [("copied", f) for f in done.copied] + [("present", f) for f in done.present]
    if transport.push(inbox, remote).copied:
        raise AssertionError("both sides are the same now")
    rows.append(("status", str(transport.status(folder / "inbox", ["d"])["d"])))
    return spark.createDataFrame(rows, "what string, file string")


@_query("""SELECT 'next' AS what, '11' AS value UNION ALL SELECT 'pin', 'kept' UNION ALL SELECT 'pin', 'refused' UNION ALL SELECT 'exists', 'refused'""")
def segment_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next segment's number; a batch keeps its definition; a segment is never replaced."""
    folder, rows = _folder(spark, "segments"), []
    for name in ("001.jsonl", "002.jsonl", "010.jsonl", "batch_notes.jsonl", "011_manifest.json"):
        (folder / name).write_text("{}\n")
    rows.append(("next", str(segments.next_segment(folder))))
    segments.pin(folder, "d", "t", "id")
    segments.pin(folder, "d", "t", "id")
    rows.append(("pin", "kept"))
    for what, step in (("pin", lambda: segments.pin(folder, "other", "t", "id")), ("exists", lambda: lake.promote(folder, folder / "001.jsonl"))):
        try:
            step()
        except (ValueError, FileExistsError):
            rows.append((what, "refused"))
    return spark.createDataFrame(rows, "what string, value string")


# --- extraction -------------------------------------------------------------------------------


def _notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _t(spark, sf_dir, "part")
    body = F.concat(F.lit("The size is "), F.col("p_size").cast("string"), F.lit(" mm"), F.when(F.col("p_partkey") % 4 == 0, "?").otherwise("."))
    return p.select(F.col("p_partkey").cast("string").alias("id"), F.when(F.col("p_partkey") % 9 == 0, " ").otherwise(body).alias("text"), F.lit("m").alias("mrn"), F.md5("p_name").alias("hash"))


@_query("""SELECT p_partkey::VARCHAR AS note_id, 'record_measurement' AS tool_name, 'size' AS kind, p_size::DOUBLE AS value, 'mm' AS unit, NULL AS reason FROM part WHERE p_partkey % 9 <> 0
           UNION ALL SELECT p_partkey::VARCHAR, 'flag_report_for_review', NULL, NULL, NULL, 'a question in the text' FROM part WHERE p_partkey % 9 <> 0 AND p_partkey % 4 = 0""")
def extract_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extraction loop with the deterministic backend; blank notes are left out."""
    out = runner.extract(_notes(spark, sf_dir), "demo", "Record measurements.", registry.DEMO)
    rows = events.event_table(events.records(out.select(F.col("line").alias("value"))), ["kind", "value", "unit", "reason"])
    return rows.select("note_id", "tool_name", "kind", F.col("value").cast("double").alias("value"), "unit", "reason")


@_query("""WITH p AS (SELECT p_partkey, p_partkey % 9 <> 0 AS spoken FROM part)
           SELECT 1::BIGINT AS run, count(*) FILTER (WHERE spoken) AS processed, NULL::BIGINT AS changed, NULL::BIGINT AS definition_changed, NULL::BIGINT AS forced, NULL::BIGINT AS skipped FROM p
           UNION ALL SELECT 2, count(*) FILTER (WHERE spoken AND p_partkey % 5 = 0), count(*) FILTER (WHERE spoken AND p_partkey % 5 = 0), NULL, NULL, count(*) FILTER (WHERE spoken AND p_partkey % 5 <> 0) FROM p
           UNION ALL SELECT 3, count(*) FILTER (WHERE spoken AND p_partkey % 7 = 0), NULL, NULL, count(*) FILTER (WHERE spoken AND p_partkey % 7 = 0), count(*) FILTER (WHERE spoken AND p_partkey % 7 <> 0) FROM p
           UNION ALL SELECT 4, count(*) FILTER (WHERE spoken), NULL, count(*) FILTER (WHERE spoken), NULL, NULL FROM p""")
def incremental_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch, then changed notes, forced ones, and another prompt."""
    inbox, notes = _folder(spark, "incremental"), _notes(spark, sf_dir)
    changed = notes.withColumn("hash", F.when(F.col("id").cast("bigint") % 5 == 0, F.concat("hash", F.lit("2"))).otherwise(F.col("hash")))
    run = lambda df, prompt, **k: segments.run_batch(spark, df, inbox, "b", "demo", prompt, registry.DEMO, "part", **k)
    found = [
        run(notes, "one"), run(changed, "one"), run(changed, "one", forced=changed.where(F.col("id").cast("bigint") % 7 == 0).select("id")),
        run(changed, "two", on_definition_change=True),
    ]
    rows = [(i, r["processed"], *(r["categories"].get(k) for k in ("changed", "definition_changed", "forced", "skipped"))) for i, r in enumerate(found, 1)]
    return spark.createDataFrame(rows, "run bigint, processed bigint, changed bigint, definition_changed bigint, forced bigint, skipped bigint")


@_query("""SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'recorded record_status' WHEN 1 THEN 'status: not one of present, absent, unclear' WHEN 2 THEN 'status: required' WHEN 3 THEN 'unknown tool ''no_such_tool''' WHEN 4 THEN 'kind: expected string; value: required' ELSE 'recorded finish_note_extraction' END AS said, event_id % 6 IN (0, 5) AS ok FROM events""")
def tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls in two shapes, some with bad arguments, checked and carried out."""
    calls = [
        {"name": "record_status", "arguments": '{"status": "present"}'}, {"function": {"name": "record_status", "arguments": {"status": "gone"}}}, {"name": "record_status", "arguments": "{bad"},
        {"name": "no_such_tool", "arguments": "{}"}, {"name": "record_measurement", "arguments": '{"kind": 5}'}, {"name": "finish_note_extraction", "arguments": None},
    ]
    body = F.element_at(F.array(*(F.lit(json.dumps([c])) for c in calls)), (F.col("event_id") % 6).cast("int") + 1)

    @F.arrow_udf("struct<said string, ok boolean>")
    def run(column: pa.Array) -> pa.Array:
        out = []
        for item in column.to_pylist():
            ((name, arguments),) = runner.tool_calls(json.loads(item))
            done = registry.DEMO.execute(name, arguments)
            out.append({"said": done["status"] if done["ok"] else done["error"], "ok": done["ok"]})
        return pa.array(out, pa.struct([("said", pa.string()), ("ok", pa.bool_())]))

    return _t(spark, sf_dir, "events").select("event_id", run(body).alias("r")).select("event_id", "r.*")


@_query("""SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' END AS gate, event_id % 3 = 0 AS tool_a, event_id % 3 = 1 AS tool_b FROM events""")
def gated_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first tool's value opens the tools of the second phase."""
    gate = registry.Tool("classify", (registry.Field("kind", required=True),))
    whole = registry.GatedRegistry(gate, "kind", {k: [registry.Tool(f"tool_{k}", ())] for k in "ab"})

    @F.arrow_udf("struct<gate string, tool_a boolean, tool_b boolean>")
    def run(column: pa.Array) -> pa.Array:
        out = []
        for kind in column.to_pylist():
            tools = whole.fresh()
            tools.execute("classify", {"kind": kind})
            out.append({"gate": tools.result, **{f"tool_{k}": tools.execute(f"tool_{k}", {})["ok"] for k in "ab"}})
        return pa.array(out, pa.struct([("gate", pa.string()), ("tool_a", pa.bool_()), ("tool_b", pa.bool_())]))

    kind = F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("event_id") % 3).cast("int") + 1)
    return _t(spark, sf_dir, "events").select("event_id", run(kind).alias("r")).select("event_id", "r.*")


_FIELDS = [
    ("declared", "record_measurement", "kind", "text", True), ("declared", "record_measurement", "value", "number", True), ("declared", "record_measurement", "unit", "text", False),
    ("declared", "record_measurement", "on", "approx_date", False), ("declared", "record_measurement", "evidence", "readonly", False), ("declared", "record_status", "status", "enum", True),
    ("declared", "record_status", "evidence", "readonly", False), ("declared", "flag_report_for_review", "reason", "text", False), ("inferred", "seen", "n", "number", False),
    ("inferred", "seen", "on", "approx_date", False), ("inferred", "seen", "ok", "bool", False), ("inferred", "seen", "more", "readonly", False), ("inferred", "seen", "never", "text", False),
]


@_query(f"SELECT * FROM {_sql_rows('origin, event_type, field, control, required', _FIELDS)} UNION ALL SELECT 'refs', 'x', 'items', '{{\"type\":\"string\"}}', false")
def field_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Controls of declared and of inferred fields; references inlined."""
    seen = [("seen", {"n": None, "on": {"date": "2024", "precision": 1}}), ("seen", {"n": 2, "ok": True, "more": [1], "never": None}), ("record_status", {"extra": 1})]
    whole = registry.backfill(registry.field_schema(registry.DEMO), registry.infer_schema(seen))
    rows = [("inferred" if kind == "seen" else "declared", kind, f["name"], f["control"], f["required"]) for kind, spec in whole.items() for f in spec["fields"]]
    inlined = registry.inline_refs({"$defs": {"S": {"type": "string"}}, "properties": {"x": {"items": {"$ref": "#/$defs/S"}}}})
    rows.append(("refs", "x", "items", jsonx.stable(inlined["properties"]["x"]["items"]), False))
    return spark.createDataFrame(rows, "origin string, event_type string, field string, control string, required boolean")


@_query("""SELECT n, ok FROM (VALUES (1, true), (2, false), (3, false), (4, false), (5, true), (6, false), (7, false), (8, true), (9, false)) AS v(n, ok)""")
def run_arguments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which options go together; names of definitions."""
    known = {"StudyForm": registry.DEMO}
    steps = [
        lambda: runner.check_arguments(None, "t", "x > 1", "c", True), lambda: runner.check_arguments("j", "t"), lambda: runner.check_arguments(None, None), lambda: runner.check_arguments("j", None, "x > 1"),
        lambda: runner.check_arguments("j", None), lambda: runner.check_arguments(None, "t", delta=True, full=True), lambda: runner.check_arguments("j", None, batch="a-b"),
        lambda: runner.resolve_definition("study-form", known), lambda: runner.resolve_definition("other", known),
    ]
    rows = []
    for n, step in enumerate(steps, 1):
        try:
            step()
            rows.append((n, True))
        except (ValueError, KeyError):
            rows.append((n, False))
    return spark.createDataFrame(rows, "n int, ok boolean")


@_query("""SELECT n_regionkey::VARCHAR AS region, count(*) AS n, sum(n_nationkey)::BIGINT AS keys, 'first' AS started_at FROM nation GROUP BY n_regionkey""")
def counter_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of segments added key by key; the first start stands."""
    parts = [{"started_at": "first" if not i else "later", "by_region": {str(r.n_regionkey): {"n": 1, "keys": r.n_nationkey}}} for i, r in enumerate(_t(spark, sf_dir, "nation").collect())]
    whole = events.merge_counters(*parts)
    return spark.createDataFrame([(k, v["n"], v["keys"], whole["started_at"]) for k, v in whole["by_region"].items()], "region string, n bigint, keys bigint, started_at string")


@_query("""SELECT DISTINCT user_id::VARCHAR AS id, md5(event_type) AS src, CASE WHEN user_id % 2 = 0 THEN 'd1' ELSE 'p1' END AS def FROM events WHERE event_id % 5 <> 0""")
def batch_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An old record's definition is its prompt's hash."""
    meta = F.when(F.col("user_id") % 2 == 0, '{"definition_hash":"d1","system_prompt_hash":"p1"}').otherwise('{"system_prompt_hash":"p1"}')
    body = F.concat(F.lit('{"note_id":"'), F.col("user_id").cast("string"), F.lit('","success":'), (F.col("event_id") % 5 != 0).cast("string"), F.lit(',"source_content_hash":"'), F.md5("event_type"), F.lit('","run_meta":'), meta, F.lit("}"))
    return delta.batch_history(events.records(_t(spark, sf_dir, "events").select(body.alias("value"))))


@_query("""SELECT doc_id::VARCHAR AS id, md5(text) AS current FROM documents WHERE lang = 'en'""")
def source_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source's ids with their hashes in hex."""
    return delta.source_state(_t(spark, sf_dir, "documents").withColumn("content_hash", F.unhex(F.md5("text"))), "doc_id", where="lang = 'en'")


# --- review, adjudication, lake ---------------------------------------------------------------


@_query(f"""SELECT note_id || '::' || kind || '::' || row_number() OVER (PARTITION BY note_id, kind ORDER BY event_id) AS event_key, coalesce(nullif(trim(mrn), ''), note_id) AS mrn, 'b' AS batch_name FROM (
              SELECT note_id, mrn, event_type AS kind, event_id FROM {_RECORDS} WHERE success UNION ALL SELECT note_id, mrn, 'flag_report_for_review', event_id FROM {_RECORDS} WHERE success AND event_id % 7 = 0)""")
def package_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A package written as one JSON file, read back and validated."""
    items = lake.staged(review.worklist_items(_records(spark, sf_dir)), "worklist")
    path = packages.write_package(items, f"{_scratch(spark, 'package')}/b.001.review_pkg.json", definition_name="d", batch="b", generated_at="2024")
    found = lake.staged(packages.package_items(spark, path), "package")
    return review.items_events(found, packages.package_head(found)).select("event_key", "mrn", "batch_name")


def _batch(spark: SparkSession, sf_dir: str, inbox: Path, name: str, rest: int | None = None) -> None:
    """A batch of two segments: a note's records are in the second if its number is even."""
    e = _t(spark, sf_dir, "events")
    e = e if rest is None else e.where(F.col("event_id") % 3 != rest)
    body = F.concat(F.lit('{"note_id":"'), F.col("user_id").cast("string"), F.lit('","mrn":"m","success":'), (F.col("event_id") % 5 != 0).cast("string"), F.lit(',"events":{"'), "event_type", F.lit('":[{"n":'), F.col("event_id").cast("string"), F.lit("}]"),
                    F.when(F.col("event_id") % 7 == 0, ',"flag_report_for_review":[{"reason":"r"}]').otherwise(""), F.lit("}}"))
    for k, segment in enumerate(("002", "001")):
        lines = e.where(F.col("user_id") % 2 == k).select(body.alias("value"), "event_id")
        _one_file(lines, inbox / "fc_extractions" / name / f"{segment}.jsonl", "event_id")
    (inbox / "fc_extractions" / name / "batch.json").write_text('{"definition": "demo", "source": "", "id_column": "id"}')


_ROUND = """WITH s AS (SELECT user_id, event_type AS kind, event_id FROM events WHERE event_id % 5 <> 0 AND user_id % 2 = 1 UNION ALL SELECT user_id, 'flag_report_for_review', event_id FROM events WHERE event_id % 5 <> 0 AND event_id % 7 = 0 AND user_id % 2 = 1),
             f AS (SELECT DISTINCT user_id FROM s WHERE kind = 'flag_report_for_review'), e AS (SELECT s.*, f.user_id IS NOT NULL AS flagged FROM s LEFT JOIN f USING (user_id)) """


@_query(_ROUND + """SELECT CASE WHEN flagged THEN 'flagged_reviewed' ELSE 'unflagged_autoaccept' END AS acceptance_reason, kind AS event_type, CASE WHEN flagged AND kind <> 'flag_report_for_review' THEN 'edited' END AS note, count(*) AS n
                    FROM e WHERE NOT (flagged AND user_id % 3 = 0) GROUP BY ALL""")
def review_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A segment's package of flagged notes, a log with verdicts and edits, and their ingest."""
    root = _folder(spark, "review")
    inbox, out = root / "inbox", root / "lake"
    _batch(spark, sf_dir, inbox, "b")
    package = rounds.review_package(spark, inbox, "b", "001", only_flagged=True)
    items = lake.staged(packages.package_items(spark, str(package)), "package")
    work = review.items_events(items, packages.package_head(items))
    edits = F.when(F.col("event_type") == "flag_report_for_review", "{}").otherwise('{"note":"edited"}')
    verdict = F.when(F.col("note_id").cast("bigint") % 3 == 0, "rejected").otherwise("approved")
    line = F.concat(F.lit('{"event_key":"'), "event_key", F.lit('","verdict":"'), verdict, F.lit('","edits":'), edits, F.lit(',"reviewed_at":"2024"}'))
    _one_file(work.select(line.alias("value"), "event_key"), inbox / "fc_reviews" / "b.001.review_log.jsonl", "event_key")
    Ingest(spark, inbox, out).run(["fc_reviews"])
    return spark.read.parquet(str(out / "fc_reviews" / "b.parquet")).groupBy("acceptance_reason", "event_type", "note").agg(F.count(F.lit(1)).alias("n"))


@_query("""WITH n AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS l_n FROM events WHERE event_id % 5 <> 0 AND event_id % 3 <> 0),
             m AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS r_n FROM events WHERE event_id % 5 <> 0 AND event_id % 3 <> 1),
             a AS (SELECT user_id || '::' || event_type || '::' || l_n AS k, event_id AS l FROM n), b AS (SELECT user_id || '::' || event_type || '::' || r_n AS k, event_id AS r FROM m)
           SELECT CASE WHEN l IS NULL THEN 'missing_left' WHEN r IS NULL THEN 'missing_right' ELSE 'different' END AS adjudication_status, CASE WHEN l IS NULL THEN 'right' ELSE 'left' END AS adjudication_decision, count(*) AS n, sum(coalesce(l, r))::BIGINT AS chosen
           FROM a FULL JOIN b USING (k) WHERE l IS DISTINCT FROM r GROUP BY ALL""")
def adjudication_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches' package, a decision for every item, and their ingest."""
    root = _folder(spark, "round")
    inbox, out = root / "inbox", root / "lake"
    for name, rest in (("left", 0), ("right", 1)):
        _batch(spark, sf_dir, inbox, name, rest)
    kinds = [r[0] for r in _t(spark, sf_dir, "events").select("event_type").distinct().collect()]  # a handful of declared event types
    schema = {k: {"fields": [{"name": "n", "control": "number"}], "comparison_fields": ["n"]} for k in kinds}
    package = rounds.adjudication_package(spark, inbox, "r1", "left", "right", schema, "demo", ("L", "R"))
    items = adjudicate.package_slots(packages.package_items(spark, str(package)))
    decision = F.when(F.col("event_type") == review.FLAG_EVENT, "exclude").when(F.col("left_fields_json").isNull(), "right").otherwise("left")
    line = F.to_json(F.struct("adjudication_key", decision.alias("decision"), F.lit("2024").alias("reviewed_at")))
    _one_file(items.select(line.alias("value"), "adjudication_key"), inbox / "fc_adjudications" / "r1.adjudication_log.jsonl", "adjudication_key")
    Ingest(spark, inbox, out).run(["fc_adjudications"])
    rows = spark.read.parquet(str(out / "fc_adjudications" / "r1.parquet"))
    return rows.groupBy("adjudication_status", "adjudication_decision").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("n").cast("bigint")).alias("chosen"))


@_query("""SELECT user_id::VARCHAR || '::e' AS event_key, CASE WHEN user_id % 3 = 0 THEN NULL WHEN user_id % 3 = 1 THEN 'approved' ELSE 'rejected' END AS verdict, false AS added FROM (SELECT DISTINCT user_id FROM events)
           UNION ALL SELECT user_id::VARCHAR || '::new', 'approved', true FROM (SELECT DISTINCT user_id FROM events WHERE user_id % 10 = 0)""")
def review_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A worklist with its verdicts and the events that reviewers added."""
    u, none = _t(spark, sf_dir, "events").select(F.col("user_id").alias("u")).distinct(), F.lit(None).cast("string")
    key = lambda end: F.concat(F.col("u").cast("string"), F.lit(end)).alias("event_key")
    work = u.select(key("::e"), F.lit("e").alias("event_type"), F.col("u").cast("string").alias("note_id"), F.lit("m").alias("mrn"), F.lit("{}").alias("fields_json"))

    def log(rows: DataFrame, end: str, verdict, new: bool) -> DataFrame:
        return rows.select(key(end), verdict.alias("verdict"), F.lit("{}").alias("edits_json"), none.alias("comment"), none.alias("reviewer"), none.alias("reviewed_at"), F.lit(new).alias("is_new_event"), F.lit("e").alias("event_type"), none.alias("note_id"), none.alias("mrn"))

    verdicts = log(u.where("u % 3 <> 0"), "::e", F.when(F.col("u") % 3 == 1, "approved").otherwise("rejected"), False)
    verdicts = verdicts.union(log(u.where("u % 10 = 0"), "::new", F.lit("approved"), True)).union(log(u.where("u % 10 = 1"), "::gone", F.lit("approved"), False))
    return review.review_state(work, verdicts).select("event_key", "verdict", "added")


@_query("""SELECT 'cohort' AS what, 'vip' AS name, (SELECT count(*) FROM labels WHERE quality = 1) AS n UNION ALL SELECT 'meta', 'vip/report_id/first', (SELECT count(*) FROM labels WHERE quality = 1) UNION ALL SELECT 'pruned', 'old', 1
           UNION ALL SELECT 'extractions', 'b', (SELECT count(DISTINCT user_id) FROM events WHERE event_id % 5 <> 0) UNION ALL SELECT 'runs', 'runs', 5 UNION ALL SELECT 'reports', 'reports', (SELECT count(DISTINCT conv_id) FROM conversations)
           UNION ALL SELECT 'tombstones', 'tombstones', 2 UNION ALL SELECT 'script', 'b', (SELECT count(DISTINCT user_id) FROM events WHERE event_id % 5 <> 0 AND user_id % 2 = 0) UNION ALL SELECT 'bad script', 'c.sql', 1
           UNION ALL SELECT 'dropped', 'stale', 1 UNION ALL SELECT 'peeked', 'p', (SELECT count(*) FROM events WHERE event_id % 50 <> 3) + (SELECT count(*) FROM events WHERE event_id % 50 <> 3 AND event_id % 7 = 0) UNION ALL SELECT 'unpeeked', 'p', 1""")
def lake_and_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An inbox ingested twice, and its catalog."""
    root, tag = _folder(spark, "lake"), f"lw_{uuid.uuid4().hex[:12]}"
    inbox, out = root / "inbox", root / "lake"
    with_head = lambda rows, head: rows.withColumn("k", F.lit(1)).unionByName(spark.sql(f"SELECT '{head}' AS value, 0L AS o, 0 AS k"))
    _one_file(with_head(_t(spark, sf_dir, "labels").where("quality = 1").select(F.col("doc_id").cast("string").alias("value"), F.col("doc_id").alias("o")), "REPORT_ID"), inbox / "cohorts" / "vip.csv", "k", "o")
    (inbox / "cohorts" / "old.csv").write_text("mrn\n1\n")
    _batch(spark, sf_dir, inbox, "b")
    (inbox / "fc_extractions" / "b" / "b.sql").write_text(f"CREATE TABLE `{tag}_transformed`.`even` AS SELECT * FROM `{tag}_extractions`.`b` WHERE record_id % 2 = 0; -- done")
    (inbox / "fc_extractions" / "b" / "c.sql").write_text("SELECT 1")
    for r in _t(spark, sf_dir, "region").collect():
        runs.write_manifest(inbox / "runs", runs.start("fc_single", r.r_name))
    c = _t(spark, sf_dir, "conversations")
    line = F.concat_ws(",", F.col("conv_id").cast("string"), (F.col("turn") + 1).cast("string"), F.lit("line"))
    _one_file(with_head(c.select(line.alias("value"), F.col("turn").alias("o")), "report_id,row_id,mult_ln_val_storage"), inbox / "pathology" / "2024-01-01_a.csv", "k", "o")
    folders = ["pathology", "fc_extractions", "cohorts", "runs", "tombstones"]

    def ingest(names) -> list:
        from lakework.plans.ingest import IngestError

        try:
            return Ingest(spark, inbox, out).run(names)
        except IngestError as e:
            return e.reports

    first = {r.folder: r for r in ingest(folders)}
    side = out / "cohorts" / "vip.cohort.json"
    lake.write_json(side, json.loads(side.read_text()) | {"created_at": "first"})
    tombstone_files.write_event(inbox / "tombstones", "cohort", "old", "forget", event_id="b" * 16, at="2024-02-02T00:00:00")
    tombstone_files.write_event(inbox / "tombstones", "cohort", "old", "revive", event_id="a" * 16, at="2024-01-01T00:00:00")
    again = {r.folder: r for r in ingest(["cohorts", "tombstones"])}
    n = lambda path: spark.read.parquet(str(out / path)).count()
    meta = cohorts.meta_table(spark, [json.loads(side.read_text())]).first()
    gone = tombstones.reconcile(["old"], ["old", "vip"], ["old"])["tombstoned"]
    rows = [("cohort", "vip", n("cohorts/vip.parquet")), ("meta", f"{meta.name}/{meta.key_column}/{meta.created_at}", meta.row_count)]
    rows += [("pruned", x, 1) for x in again["cohorts"].pruned if [x] == gone and not (out / "cohorts" / "old.parquet").exists()]
    rows += [("extractions", "b", n("fc_extractions/b.parquet")), ("runs", "runs", n("runs/runs.parquet")), ("reports", "reports", n("pathology/reports.parquet")), ("tombstones", "tombstones", n("tombstones/tombstones.parquet"))]
    rows += [("bad script", k, 1) for k in first["fc_extractions"].failures]
    owned = (f"{tag}_extractions", f"{tag}_cohort", f"{tag}_transformed")
    try:
        catalog.build(spark, {owned[0]: out / "fc_extractions", owned[1]: out / "cohorts"}, owned=owned)
        rows.append(("script", "b", spark.table(catalog.quoted(owned[2], "even")).count()))
        spark.sql(f"CREATE TABLE {catalog.quoted(owned[1], 'stale')} AS SELECT 1 AS x")
        rows += [("dropped", t, 1) for t in catalog.refresh(spark, out / "cohorts", owned[1]).dropped]
        known = {(r.database, r.table): r.n_rows for r in catalog.info(spark, owned).collect()}
        if known[owned[1], "vip"] != meta.row_count or catalog.count_tables(spark, owned[1]).count() != 1:
            raise AssertionError(f"the catalog has {known}")
        name = f"{tag}_p"
        rows.append(("peeked", "p", spark.table(catalog.peek(events.event_table(_records(spark, sf_dir)), name)).count()))
        rows += [("unpeeked", x.removeprefix(f"{tag}_"), 1) for x in catalog.unpeek(spark, name)]
    finally:
        for db in owned:
            spark.sql(f"DROP DATABASE IF EXISTS {catalog.quoted(db)} CASCADE")
    return spark.createDataFrame(rows, "what string, name string, n bigint")


@_query("""SELECT * FROM (VALUES ('parquet_readable', 'error', 'runs/bad'), ('required_columns', 'error', 'fc_reviews/b'), ('null_ids', 'error', 'fc_reviews/b'), ('empty_dataset', 'warning', 'cohorts/none'), ('jsonl_parseable', 'error', 'x.jsonl'), ('duplicate_keys', 'warning', 'fc_extractions/b')) AS v("check", severity, dataset)""")
def lake_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks of a lake with two tables of one name."""
    from lakework.plans.ingest import FOLDERS

    root = _folder(spark, "checks")
    inbox, out, nation = root / "inbox", root / "lake", _t(spark, sf_dir, "nation")
    hashed = nation.select(F.col("n_name").alias("record_id"), F.md5(F.col("n_regionkey").cast("string")).alias("key_hash"), F.lit("c").alias("content_hash"))
    hashed.write.parquet(str(out / "fc_extractions" / "b.parquet"))
    nation.select(F.when(F.col("n_nationkey") != 5, F.col("n_name")).alias("event_key"), F.col("n_name").alias("key_hash")).write.parquet(str(out / "fc_reviews" / "b.parquet"))
    nation.limit(0).select(F.col("n_name").alias("mrn")).write.parquet(str(out / "cohorts" / "none.parquet"))
    (out / "runs" / "bad.parquet").mkdir(parents=True)
    (out / "runs" / "bad.parquet" / "part-0.parquet").write_text("no parquet")
    inbox.mkdir()
    (inbox / "x.jsonl").write_text('{"a": 1}\n\n{bad\n')
    return quality.check_lake(spark, inbox, out, FOLDERS).select("check", "severity", "dataset")


@_query("""SELECT 'inbox' AS name, 'in' AS value UNION ALL SELECT 'lake', 'data/lake' UNION ALL SELECT 'backend', 'chat/http://h' UNION ALL SELECT 'key', 'k1' UNION ALL SELECT 'unknown', 'refused' UNION ALL SELECT 'default', 'data/inbox'""")
def settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4: settings saved and loaded, with named backends and keys from ``.env``."""
    folder = _folder(spark, "settings")
    name = f"LAKEWORK_TEST_{uuid.uuid4().hex}"
    (folder / ".env").write_text(f"# keys\nexport {name}='k1'\n")
    save_config(Config(inbox="in", backends={"b": BackendSettings("chat", "http://h", api_key_env=name)}), folder / "c.json")
    found = load_config(folder / "c.json")
    rows = [("inbox", found.inbox), ("lake", found.lake), ("backend", f"{found.backend('b').type}/{found.backend('b').url}"), ("key", found.backend("b").api_key()), ("default", load_config(folder / "none.json").inbox)]
    try:
        found.backend("other")
    except ValueError:
        rows.append(("unknown", "refused"))
    return spark.createDataFrame(rows, "name string, value string")


@_query("SELECT NULL::VARCHAR AS git_commit, NULL::VARCHAR AS git_branch, NULL::BOOLEAN AS git_dirty")
def provenance_without_git(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5: what git doesn't tell is null."""
    found = runs.provenance(_folder(spark, "nogit") / "none")
    return spark.createDataFrame([tuple(found.values())], "git_commit string, git_branch string, git_dirty boolean")

