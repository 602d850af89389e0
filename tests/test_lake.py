"""Sources, ingest, catalog, extraction and streams, on files in temporary folders."""

import json
import os

import pytest
from pyspark.sql import functions as F

from lakework import cli
from lakework.extract import registry, runner, segments
from lakework.operators import events, runs
from lakework.plans import catalog
from lakework.plans.ingest import Ingest, IngestError
from lakework.sources import lake, readers, sidecar, tombstone_files, transport
from lakework.streaming import incremental
from lakework.types import struct


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text if isinstance(text, str) else json.dumps(text))
    return path


def document(folder):
    """A package's parts as the one document that they are."""
    return json.loads("".join(p.read_text() for p in sorted(folder.glob("part-*"))))


def jsonl(path, *records):
    return put(path, "".join(json.dumps(r) + "\n" for r in records))


LINES = "report_id,row_id,mrn,external_name,mult_ln_val_storage,ordering_date\n"


# --- sources --------------------------------------------------------------------------------


def test_csv_keeps_zeros_quotes_and_breaks(spark, tmp_path):
    path = put(tmp_path / "a.csv", 'id,text\n007,"a, ""b""\nc"\n8,\n')
    df = readers.read_csv(spark, str(path))
    assert sorted((r.id, r.text) for r in df.collect()) == [("007", 'a, "b"\nc'), ("8", None)]
    assert sorted((r.row_id, r.id, r.text) for r in readers.read_csv_numbered(spark, str(path)).collect()) == [("1", "007", 'a, "b"\nc'), ("2", "8", None)]


def test_json_readers(spark, tmp_path):
    put(tmp_path / "x.jsonl", '{"id": "1", "text": "a"}\n\n{bad\n{"id": "2"}\n')
    assert readers.json_lines(spark, str(tmp_path)).count() == 2
    assert [(r.line_no, r.value[:5]) for r in readers.numbered_lines(spark, str(tmp_path)).collect()] == [(1, '{"id"'), (3, "{bad"), (4, '{"id"')]
    notes, counters = readers.notes_from_jsonl(spark, str(tmp_path), "id", "text")
    assert len(notes.collect()) == 1 and counters.get == {"read": 3, "malformed": 1, "missing": 1}
    assert readers.json_documents(spark, str(put(tmp_path / "d" / "o.json", {"a": 1}))).first().json == '{"a": 1}'
    with pytest.raises(ValueError, match="b.csv, x.txt"):
        readers.dated_files(["2021-01-01_a.csv", "x.txt", "b.csv"])
    assert readers.dated_files(["2021-02-01_a.csv", "2021-01-01_b.jsonl"]) == ["2021-01-01_b.jsonl", "2021-02-01_a.csv"]


def test_segments_are_numbers(spark, tmp_path):
    for name in ("001", "002", "010", "batch", "001_manifest"):
        jsonl(tmp_path / f"{name}.jsonl", {"note_id": name})
    put(tmp_path / "batch.json", {})
    assert sorted(r.segment for r in readers.segments(spark, str(tmp_path)).collect()) == [1, 2, 10]


def test_notes_from_a_table(spark):
    df = spark.createDataFrame([("2", "b", "m"), ("1", "a", "m"), ("3", None, "m")], "rid string, body string, mrn string")
    ids = spark.createDataFrame([("2",), ("3",)], "rid string")
    assert [r.id for r in readers.notes_from_table(df, "rid", "body", limit=1).collect()] == ["1"]
    assert [r.id for r in readers.notes_from_table(df, "rid", "body", ids=ids, limit=1).collect()] == ["2"]
    assert readers.notes_from_table(df, "rid", "body").first().hash is None


def test_tables_replace_what_they_read(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    lake.write_table(spark.range(3), path)
    lake.write_table(spark.read.parquet(path).where("id > 0"), path)
    assert spark.read.parquet(path).count() == 2 and sorted(os.listdir(tmp_path)) == ["t.parquet"]
    new = spark.createDataFrame([("k", "c", 1)], "key_hash string, content_hash string, v int")
    lake.upsert_table(new, str(tmp_path / "u.parquet"))
    lake.upsert_table(new.withColumn("v", F.lit(2)), str(tmp_path / "u.parquet"))
    assert spark.read.parquet(str(tmp_path / "u.parquet")).first().v == 1


def test_sidecars(spark, tmp_path):
    path = put(tmp_path / "in" / "a.csv", "x")
    digest = sidecar.ensure(path)
    assert sidecar.is_fresh(path) and sidecar.ensure(path) == digest
    assert sidecar.verify(spark, str(tmp_path / "in")).count() == 0
    path.write_text("yy")
    put(tmp_path / "in" / "b.csv", "z")
    assert not sidecar.is_fresh(path)
    assert sorted(r.status for r in sidecar.verify(spark, str(tmp_path / "in")).collect()) == ["mismatch", "missing"]
    put(tmp_path / "in" / "a.csv.sha256", digest)
    assert not sidecar.is_fresh(path)


def test_transport(tmp_path):
    a, b = tmp_path / "a", tmp_path / "b"
    put(a / "x" / "1.csv", "1")
    put(a / "2.csv", "2")
    put(a / "2.csv.sha256", "no")
    assert transport.pull(a, b, dry_run=True).copied == ["2.csv", "x/1.csv"] and not b.exists()
    assert transport.pull(a, b).copied == ["2.csv", "x/1.csv"]
    assert transport.pull(a, b).present == ["2.csv", "x/1.csv"]
    put(b / "2.csv", "!")
    put(a / "3.csv", "3")
    with pytest.raises(transport.ConflictError, match="2.csv"):
        transport.pull(a, b)
    assert not (b / "3.csv").exists()
    assert transport.status(b, ["x", "y"]) == {"x": 1, "y": 0}


# --- ingest ---------------------------------------------------------------------------------


def extraction(note, events_, **more):
    return {"note_id": note, "mrn": f"m{note}", "definition_name": "d", "success": True, "events": events_, "source_content_hash": "h", "run_meta": {"system_prompt_hash": "p"}, **more}


@pytest.fixture
def lake_dirs(tmp_path):
    inbox = tmp_path / "inbox"
    put(inbox / "pathology" / "2021-01-01_a.csv", LINES + "r1,2,m1,final,world,2021-01-01\nr1,1,m1,final,hello ,2021-01-01\nr2,1,m2,gross,no,2021-01-01\nr2,2,m2,final,two,2021-01-01\n")
    put(inbox / "pathology" / "2021-02-01_b.csv", "case_num,report_text,pat_mrn_id\nr2,TWO,m2\nr3,three,m3\n")
    batch = inbox / "fc_extractions" / "batch1"
    jsonl(batch / "001.jsonl", extraction("n1", {"a": [{"x": 1}, {"x": 2}]}), extraction("n2", {"a": [{"x": 3}]}), extraction("n3", {}, success=False))
    jsonl(batch / "002.jsonl", extraction("n2", {"a": [{"x": 4}]}))
    put(batch / "batch1.sql", "CREATE TABLE extractions_transformed.counts AS SELECT count(*) AS n FROM extractions_raw.batch1; -- a comment; no statement")
    put(inbox / "cohorts" / "c1.csv", "MRN,grp\n001,a\n2,b\n")
    package = {"definition_name": "d", "batch": "batch1", "generated_at": "g", "patients": [{"mrn": "m", "notes": {}, "events": [{"event_key": "n1::a::1", "event_type": "a", "note_id": "n1", "fields": {}}]}]}
    put(inbox / "fc_reviews" / "batch1.001.review_pkg.json", package)
    jsonl(inbox / "fc_reviews" / "batch1.001.review_log.jsonl", {"event_key": "n1::a::1", "verdict": "approved", "edits": {"x": 9}, "reviewed_at": "2024"})
    runs.write_manifest(inbox / "runs", runs.start("fc_single", "d", run_id="aaaa1111", batch_name="batch1", started_at="2024-01-01T00:00:00"))
    return inbox, tmp_path / "lake"


def test_ingest_everything_twice(spark, lake_dirs):
    inbox, out = lake_dirs
    dry = Ingest(spark, inbox, out, dry_run=True).run()
    assert not out.exists() and not list(inbox.rglob("*.sha256")) and dry[0].counts == {"reports": {"new": 3, "updated": 0, "unchanged": 0}}
    first = {r.folder: r for r in Ingest(spark, inbox, out).run()}
    reports = {r.report_id: r for r in spark.read.parquet(str(out / "pathology" / "reports.parquet")).collect()}
    assert {k: r.report_text for k, r in reports.items()} == {"r1": "hello world", "r2": "TWO", "r3": "three"} and reports["r3"].mrn == "m3"
    rows = {r.record_id: r for r in spark.read.parquet(str(out / "fc_extractions" / "batch1.parquet")).collect()}
    assert {k: r.segment for k, r in rows.items()} == {"n1": 1, "n2": 2} and '"x": 4' in rows["n2"].events_json
    silver = {r.event_key: r for r in spark.read.parquet(str(out / "fc_reviews" / "batch1.parquet")).collect()}
    assert silver["n1::a::1"].x == "9" and silver["n1::a::2"].acceptance_reason == "unflagged_autoaccept" and len(silver) == 3
    cohort = spark.read.parquet(str(out / "cohorts" / "c1.parquet"))
    assert sorted(r.mrn for r in cohort.collect()) == ["001", "2"]
    assert first["fc_extractions"].counts["batch1"]["new"] == 2
    again = {r.folder: r for r in Ingest(spark, inbox, out).run()}
    for folder, name, n in (("pathology", "reports", 3), ("fc_extractions", "batch1", 2), ("fc_reviews", "batch1", 3), ("cohorts", "c1", 2), ("runs", "runs", 1)):
        assert again[folder].counts[name] == {"new": 0, "updated": 0, "unchanged": n}


def test_forgotten_and_orphaned_tables_go(spark, lake_dirs):
    inbox, out = lake_dirs
    Ingest(spark, inbox, out).run(["fc_extractions", "cohorts"])
    tombstone_files.write_event(inbox / "tombstones", "batch", "batch1", "forget", at="2024-01-01T00:00:00")
    (inbox / "cohorts" / "c1.csv").unlink()
    reports = {r.folder: r for r in Ingest(spark, inbox, out).run(["fc_extractions", "cohorts", "tombstones"])}
    assert reports["fc_extractions"].pruned == ["batch1"] and reports["cohorts"].pruned == ["c1"]
    assert not list((out / "fc_extractions").iterdir()) and not list((out / "cohorts").iterdir())
    tombstone_files.write_event(inbox / "tombstones", "batch", "batch1", "revive", at="2024-01-02T00:00:00")
    assert Ingest(spark, inbox, out).run(["fc_extractions"])[0].counts["batch1"]["new"] == 2
    with pytest.raises(ValueError):
        tombstone_files.write_event(inbox / "tombstones", "nothing", "x", "forget")


def test_one_bad_batch_fails_alone(spark, lake_dirs):
    inbox, out = lake_dirs
    put(inbox / "fc_reviews" / "other.001.review_pkg.json", {"patients": [{"events": [{"event_key": "gone"}]}]})
    jsonl(inbox / "fc_reviews" / "other.001.review_log.jsonl", {"event_key": "gone", "verdict": "approved"})
    jsonl(inbox / "fc_extractions" / "other" / "001.jsonl", extraction("n9", {}))
    put(inbox / "fc_extractions" / "other" / "wrong.sql", "SELECT 1")
    with pytest.raises(IngestError, match="other") as e:
        Ingest(spark, inbox, out).run()
    assert (out / "fc_reviews" / "batch1.parquet").exists()
    assert {k for r in e.value.reports for k in r.failures} == {"other", "wrong.sql"}


def test_adjudications_wait_for_their_log(spark, lake_dirs):
    inbox, out = lake_dirs
    item = {"adjudication_key": "k", "event_key": "k", "event_type": "e", "note_id": "n", "status": "different", "comparison": {"L": {"x": 1}, "R": {"x": 2}, "hash": {}}, "left": {"fields": {"x": 1}}, "right": {"fields": {"x": 2}}}
    package = {"round": "r1", "definition_name": "d", "inputs": {"left": {"label": "L", "batch": "b1"}}, "patients": [{"mrn": "m", "notes": {"n": {"note_date": "2020"}}, "events": [item]}]}
    put(inbox / "fc_adjudications" / "r1.adjudication_pkg.json", package)
    assert Ingest(spark, inbox, out).run(["fc_adjudications"])[0].counts == {}
    jsonl(inbox / "fc_adjudications" / "r1.adjudication_log.jsonl", {"adjudication_key": "k", "decision": "right", "reviewed_at": "2024"})
    Ingest(spark, inbox, out).run(["fc_adjudications"])
    row = spark.read.parquet(str(out / "fc_adjudications" / "r1.parquet")).first()
    assert (row.x, row.left_label, row.left_batch, row.round_name, row.note_date, row.mrn) == ("2", "L", "b1", "r1", "2020", "m")


# --- catalog --------------------------------------------------------------------------------


def test_catalog(spark, lake_dirs):
    inbox, out = lake_dirs
    Ingest(spark, inbox, out).run(["pathology", "fc_extractions"])
    folders = {"raw": out / "pathology", "extractions_raw": out / "fc_extractions"}
    spark.range(1).createOrReplaceTempView("passing")  # Spark lists it with every database's tables
    results = catalog.build(spark, folders, strict=True)
    assert results["raw"].loaded == {"reports": 3} and spark.table("extractions_transformed.counts").first().n == 2
    assert {(r.database, r.table, r.n_rows) for r in catalog.info(spark).collect()} == {("raw", "reports", 3), ("extractions_raw", "batch1", 2), ("extractions_transformed", "counts", 1)}
    spark.range(1).write.saveAsTable("raw.stale")
    assert catalog.refresh(spark, out / "pathology", "raw").dropped == ["stale"]
    (out / "fc_extractions" / "batch1.sql").write_text("SELECT * FROM nowhere")
    with pytest.raises(RuntimeError, match="batch1.sql"):
        catalog.build(spark, folders, strict=True)
    assert catalog.statements("a;'x;y' -- c;\n;/* ; */b") == ["a", "'x;y'", "b"]
    assert catalog.parse_errors(spark, "SELECT 1; SELEC 2") and not catalog.parse_errors(spark, "SELECT 1; SELECT 2")
    recs = events.records(readers.segments(spark, str(inbox / "fc_extractions" / "batch1")))
    assert catalog.peek(events.event_table(recs), "p") == "scratch.p" and spark.table("scratch.p").count() == 4
    assert catalog.unpeek(spark) == ["p"] and catalog.count_tables(spark, "scratch").count() == 0
    assert catalog.quoted("a`b", "c") == "`a``b`.`c`"
    catalog.reset(spark)
    assert spark.catalog.dropTempView("passing")


# --- extraction -----------------------------------------------------------------------------


def test_registry():
    assert registry.DEMO.execute("nope", {})["kind"] == "unknown_tool"
    bad = registry.DEMO.execute("record_status", {"status": "maybe"})
    assert not bad["ok"] and "not one of" in bad["error"]
    assert registry.DEMO.execute("record_status", {"status": "present", "x": 1})["value"] == {"status": "present"}
    with pytest.raises(ValueError):
        registry.Registry([registry.Tool("t", (registry.Field("a"),), identity=("b",))])
    schema = registry.field_schema(registry.DEMO)
    assert set(schema) == {"record_measurement", "record_status", "flag_report_for_review"}
    assert [f["control"] for f in schema["record_measurement"]["fields"]] == ["text", "number", "text", "approx_date", "readonly"]
    gate = registry.Tool("choose", (registry.Field("kind", required=True),))
    gated = registry.GatedRegistry(gate, "kind", {"x": [registry.Tool("only_x", ())]})
    assert gated.execute("only_x", {})["kind"] == "unknown_tool" and not gated.execute("choose", {"kind": "y"})["ok"]
    assert gated.execute("choose", {"kind": "x"})["ok"] and gated.execute("only_x", {})["ok"] and gated.fresh().get("only_x") is None
    assert registry.inline_refs({"p": {"$ref": "#/$defs/A"}, "$defs": {"A": {"type": "string"}}}) == {"p": {"type": "string"}}
    inferred = registry.infer_schema([("e", {"a": None, "b": 1}), ("e", {"a": True, "c": {"date": "x", "precision": 1}})])
    assert [(f["name"], f["control"]) for f in inferred["e"]["fields"]] == [("a", "bool"), ("b", "number"), ("c", "approx_date")]
    assert registry.backfill({"e": 1}, {"e": 2, "f": 3}) == {"e": 1, "f": 3}


class Scripted:
    def __init__(self, *replies):
        self.replies = list(replies)

    def reply(self, messages, tools):
        return runner.Reply(self.replies.pop(0) if self.replies else [], 1, 1)


def test_extraction_loop():
    done = ("finish_note_extraction", {})
    run = lambda *replies, **k: runner.extract_note("n", "t", "s", registry.DEMO, Scripted(*replies), runner.Limits(**k))
    out = run([], [("record_status", {"status": "present", "evidence": []}), ("plan_reading", {"steps": ["a"]})], [done])
    assert out["success"] and out["rounds"] == 3 and out["events"] == {"record_status": [{"status": "present"}]} and out["plans"] == {"plan_reading": [{"steps": ["a"]}]}
    bad = [("record_status", {"status": "?"})]
    assert run(bad, bad, [done], retries=2)["success"]
    assert "not one of" in run(bad, bad, bad, retries=2)["error"]
    assert run(rounds=3)["error"] == "not finished in 3 rounds"
    assert runner.tool_calls([{"name": "a", "arguments": '{"x": 1}'}, {"function": {"name": "b", "arguments": "{"}}, {"type": "text"}]) == [("a", {"x": 1}), ("b", {})]
    record = runner.record_of({"id": "n"}, "d", {}, "", lambda: 1 / 0)
    assert not record["success"] and "ZeroDivisionError" in record["error"]


def test_batches_are_incremental(spark, tmp_path):
    notes = spark.createDataFrame([("1", "length is 3 cm", "m", "h1"), ("2", "size 4 mm?", "m", "h2"), ("3", "  ", "m", "h3")], "id string, text string, mrn string, hash string")
    run = lambda df, **k: segments.run_batch(spark, df, tmp_path, "b", "demo", "s", registry.DEMO, "t", **k)
    assert run(notes)["succeeded"] == 2
    assert run(notes)["processed"] == 0
    changed = notes.withColumn("hash", F.when(F.col("id") == "2", "new").otherwise(F.col("hash")))
    assert run(changed) | {"run_id": 0} == {"run_id": 0, "segment": 2, "processed": 1, "succeeded": 1, "categories": {"changed": 1, "new": 1, "skipped": 1}}
    assert run(notes, full=True)["segment"] == 3
    recs = events.records(readers.segments(spark, str(tmp_path / "fc_extractions" / "b")))
    assert recs.count() == 5 and events.event_table(recs).where("kind = 'size'").first().value == "4.0"
    with pytest.raises(ValueError, match="was made with"):
        segments.run_batch(spark, notes, tmp_path, "b", "other", "s", registry.DEMO)
    table = runs.project(spark, str(tmp_path / "runs"))
    assert table.where("status = 'completed'").count() == 4 and table.agg(F.sum("items_succeeded")).first()[0] == 5


def test_notes_of_one_partition_are_spread(spark):
    """A small source file is one partition, but a note's extraction is much work."""
    notes = spark.range(200).select(F.col("id").cast("string").alias("id"), F.lit("size 3 mm").alias("text"), F.lit("m").alias("mrn"), F.lit("h").alias("hash")).coalesce(1)
    out = runner.extract(notes, "demo", "s", registry.DEMO)
    shares = out.groupBy(F.spark_partition_id()).count().collect()
    assert len(shares) == int(spark.conf.get("spark.sql.shuffle.partitions")) and sum(r["count"] for r in shares) == 200
    assert runner.extract(notes, "demo", "s", registry.DEMO, workers=2).select(F.spark_partition_id()).distinct().count() == 2


def test_a_batch_reads_its_history_once(spark, tmp_path, monkeypatch):
    notes = spark.range(20).select(F.col("id").cast("string").alias("id"), F.lit("size 3 mm").alias("text"), F.lit("m").alias("mrn"), F.lit("h").alias("hash"))
    run = lambda df: segments.run_batch(spark, df, tmp_path / "inbox", "b", "demo", "s", registry.DEMO, "t")
    run(notes)
    seen, whole = tmp_path / "seen", segments.delta.batch_history

    def noted(recs):
        def note(batches):
            for batch in batches:
                with seen.open("a") as f:
                    f.write("x" * batch.num_rows)
                yield batch

        history = whole(recs)
        return history.mapInArrow(note, history.schema)

    monkeypatch.setattr(segments.delta, "batch_history", noted)
    changed = notes.withColumn("hash", F.when(F.col("id") == "7", "new").otherwise(F.col("hash")))
    assert run(changed) | {"run_id": 0} == {"run_id": 0, "segment": 2, "processed": 1, "succeeded": 1, "categories": {"changed": 1, "skipped": 19}}
    assert len(seen.read_text()) == 20


def test_heads_are_those_of_records(spark):
    lines = [None, "", "{bad", "[1]", "{}", '{"note_id": 5, "success": 1, "run_meta": 3}', '{"note_id": null, "source_content_hash": "é", "success": "", "run_meta": {"system_prompt_hash": "p", "definition_hash": ""}, "events": {"t": [{}]}}']
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "line_no int, value string")
    kept = lambda recs: sorted(map(str, recs.select("line_no", *events.HEAD.names).collect()))
    assert kept(events.heads(df)) == kept(events.records(df)) and events.heads(df).count() == 3


def test_argument_rules():
    runner.check_arguments("x.jsonl", None)
    for bad in ({"jsonl": "x", "source": "y"}, {"jsonl": None, "source": None}, {"jsonl": "x", "source": None, "where": "1"}, {"jsonl": None, "source": "y", "delta": True, "full": True}, {"jsonl": "x", "source": None, "batch": "a-b"}):
        with pytest.raises(ValueError):
            runner.check_arguments(**bad)
    assert runner.resolve_definition("StudyForm", {"study_form": registry.DEMO}) is registry.DEMO
    with pytest.raises(KeyError):
        runner.resolve_definition("x", {})


# --- runs, streams, command line ------------------------------------------------------------


def test_run_manifests(spark, tmp_path):
    run = runs.start("fc_single", "d", run_id="abcd1234", started_at="2024-01-01T00:00:00")
    runs.write_manifest(tmp_path, run)
    assert runs.complete(tmp_path, "abcd1234", items_processed=3, unknown=1, completed_at="2024-01-01T00:01:00") and not runs.complete(tmp_path, "none")
    put(tmp_path / "old.run.json", {"run_id": "old", "extra": 1})
    rows = {r.run_id: r for r in runs.project(spark, str(tmp_path)).collect()}
    assert rows["abcd1234"].duration_seconds == 60 and rows["abcd1234"].items_processed == 3 and rows["old"].items_processed == 0 and rows["old"].model is None
    with pytest.raises(TypeError):
        runs.start("x", "y", nonsense=1)
    assert set(runs.provenance(tmp_path)) == {"git_commit", "git_branch", "git_dirty"}


def test_streamed_upserts(spark, tmp_path):
    schema, inbox, table = struct("key_hash string, content_hash string, v string"), tmp_path / "in", str(tmp_path / "t")

    def run():
        stream = incremental.file_stream(spark, str(inbox), schema, max_files=1)
        incremental.upsert_stream(stream, table, str(tmp_path / "progress")).awaitTermination()
        return sorted((r.key_hash, r.content_hash, r.v) for r in spark.read.parquet(table).collect())

    put(inbox / "1.csv", "key_hash,content_hash,v\na,1,x\nb,1,x\n")
    assert run() == [("a", "1", "x"), ("b", "1", "x")]
    put(inbox / "2.csv", "key_hash,content_hash,v\na,1,ignored\nb,2,y\nc,1,z\n")
    assert run() == [("a", "1", "x"), ("b", "2", "y"), ("c", "1", "z")]
    assert run() == run()


def test_command_line(spark, tmp_path, capsys):
    root = ["--root", str(tmp_path)]
    assert cli.main([*root, "version"]) == 0 and cli.main([*root, "schemas"]) == 0 and cli.main([*root, "init"]) == 0
    put(tmp_path / "c.csv", "mrn\n1\n")
    assert cli.main([*root, "cohort", "add", "c", "--file", str(tmp_path / "c.csv")]) == 0
    assert cli.main([*root, "cohort", "add", "c", "--file", str(tmp_path / "c.csv")]) == 1
    assert cli.main([*root, "ingest", "cohorts"]) == 0
    assert cli.main([*root, "cohort", "info", "c"]) == 0
    assert '"row_count": 1' in capsys.readouterr().out
    assert cli.main([*root, "forget", "cohort", "c"]) == 0 and cli.main([*root, "ingest", "cohorts"]) == 0
    assert not (tmp_path / "lake" / "cohorts" / "c.parquet").exists()


def test_rounds_from_the_command_line(spark, tmp_path, capsys, monkeypatch):
    """Extract twice, review the flagged notes, adjudicate the two batches: each step reads what the one before wrote."""
    monkeypatch.setattr(spark, "stop", lambda: None)
    inbox, out = tmp_path / "in", tmp_path / "out"
    (tmp_path / "c.json").write_text(json.dumps({"inbox": str(inbox), "lake": str(out)}))
    run = lambda *a: cli.main(["--config", str(tmp_path / "c.json"), *a])
    assert run("init") == 0 and run("config") == 0
    rows = [(f"r{i}", f"size is {i} mm" + "?" * (i % 2), "m") for i in range(6)]
    spark.createDataFrame(rows, "report_id string, report_text string, mrn string").createOrReplaceTempView("notes_v")
    source = spark.table("notes_v").withColumn("content_hash", F.unhex(F.md5("report_text")))
    source.createOrReplaceTempView("notes_v")
    (tmp_path / "ids.csv").write_text("report_id\nr1\nr2\n")
    put(inbox / "cohorts" / "few.csv", "report_id\nr3\nr4\nr5\n")
    assert run("ingest", "cohorts") == 0
    assert run("fc", "run-single", "a", "--source", "notes_v", "--where", "report_id <> 'r0'") == 0
    assert run("fc", "run-single", "b", "--source", "notes_v", "--cohort", "few") == 0
    capsys.readouterr()
    assert run("fc", "run-single", "a", "--source", "notes_v", "--where", "report_id <> 'r0'", "--force-rerun", str(tmp_path / "ids.csv")) == 0
    assert json.loads(capsys.readouterr().out)["categories"] == {"forced": 2, "skipped": 3, "forced_missing": 0}
    with pytest.raises(ValueError, match="keyed by"):
        run("fc", "run-single", "b", "--source", "notes_v", "--cohort", "few", "--id-col", "mrn")
    with pytest.raises(ValueError, match="source table"):
        run("fc", "run-single", "b", "--jsonl", "x", "--where", "true")
    assert run("fc", "review-package", "a", "--only-flagged") == 0
    package = document(inbox / "fc_reviews" / "a.001.review_pkg.json")
    assert package["definition_name"] == "demo" and {e["note_id"] for p in package["patients"] for e in p["events"]} == {"r1", "r3", "r5"}
    assert package["patients"][0]["notes"]["r1"]["note_text"] == "size is 1 mm?"
    keys = [e["event_key"] for p in package["patients"] for e in p["events"]]
    jsonl(inbox / "fc_reviews" / "a.001.review_log.jsonl", *({"event_key": k, "verdict": "approved", "reviewed_at": "2024"} for k in keys))
    assert run("adjudication", "create", "r1", "a", "b") == 0
    round_ = document(inbox / "fc_adjudications" / "r1.adjudication_pkg.json")
    assert round_["summary"] == {"left_records": 7, "right_records": 3, "disagreements": 3, "different": 0, "missing_left": 0, "missing_right": 3}
    items = [e["adjudication_key"] for p in round_["patients"] for e in p["events"]]
    jsonl(inbox / "fc_adjudications" / "r1.adjudication_log.jsonl", *({"adjudication_key": k, "decision": "left", "reviewed_at": "2024"} for k in items))
    assert run("ingest") == 0
    silver = spark.read.parquet(str(out / "fc_reviews" / "a.parquet"))
    assert {(r.note_id, r.acceptance_reason) for r in silver.collect()} == {(f"r{i}", "flagged_reviewed" if i % 2 else "unflagged_autoaccept") for i in range(1, 6)}
    assert spark.read.parquet(str(out / "fc_adjudications" / "r1.parquet")).count() == 3
    assert run("runs", "list", "--type", "fc_single") == 0 and run("status", "--check") == 0


def test_rounds_of_conversation_are_dumped(tmp_path):
    class Slips(runner.FakeBackend):
        seen = ()

        def reply(self, messages, tools):
            self.seen = (*self.seen, [m for m in messages if m["role"] in ("assistant", "tool")])
            if len(self.seen) == 1:
                return runner.Reply([("record_status", {"status": "wrong", "note_id": "n/1"})])
            return super().reply(messages, tools)

    backend = Slips()
    out = runner.extract_note("n/1", "size 3 mm", "s", registry.DEMO, backend, runner.Limits(debug_dir=str(tmp_path)))
    assert out["success"] and out["rounds"] == 2
    assert backend.seen[1] == [{"role": "assistant", "call": {"name": "record_status", "arguments": {"status": "wrong"}}}, {"role": "tool", "name": "record_status", "content": "status: not one of present, absent, unclear"}]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["n_1_r1.json", "n_1_r2.json"]


def test_settings(tmp_path, monkeypatch):
    from lakework.config import BackendSettings, Config, load_config, save_config

    config = Config(lake="l", backends={"b": BackendSettings("chat", "http://h", "m")})
    for name in ("c.json", "c.yaml"):
        assert load_config(save_config(config, tmp_path / name)) == config
    assert load_config(tmp_path / "none.json") == Config()
    (tmp_path / "bad.json").write_text('{"no": 1}')
    with pytest.raises(ValueError, match="unknown settings"):
        load_config(tmp_path / "bad.json")
    with pytest.raises(ValueError, match="type must be"):
        BackendSettings("other")
    monkeypatch.delenv("LAKEWORK_API_KEY", raising=False)
    with pytest.raises(ValueError, match="LAKEWORK_API_KEY"):
        config.backend("b").api_key()
    with pytest.raises(ValueError, match="no backend"):
        config.backend("x")


def test_steps_are_run_once(spark, tmp_path, monkeypatch):
    """What is counted, written and looked through several times is parsed and merged once."""
    from lakework.plans import ingest, rounds

    names, staged = [], ingest.store.staged
    monkeypatch.setattr(ingest.store, "staged", lambda df, name: names.append(name) or staged(df, name))
    folder = tmp_path / "inbox" / "fc_extractions" / "b"
    folder.mkdir(parents=True)
    (folder / "001.jsonl").write_text('{"note_id": "n", "success": true, "events": {"t": [{"v": 1}]}}\n')
    rounds.review_package(spark, tmp_path / "inbox", "b")
    assert names.count("records") == 1
    ingest.Ingest(spark, tmp_path / "inbox", tmp_path / "lake").run(["fc_extractions"])
    assert names.count("extractions") == 1 and spark.read.parquet(str(tmp_path / "lake" / "fc_extractions" / "b.parquet")).count() == 1
