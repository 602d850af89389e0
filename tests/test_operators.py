import json
import random
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakework.operators import adjudicate, cohorts, collate, delta, diff, events, projection, quality, reshape, review, tombstones, upsert, versions
from lakework.schemas import REPORTS, SILVER, conform, get_schema, list_schemas


def rows(df, *names):
    return sorted(tuple(r[n] for n in names or df.columns) for r in df.collect())


def lines_of(spark, *records):
    return spark.createDataFrame([(i + 1, json.dumps(r) if isinstance(r, dict) else r) for i, r in enumerate(records)], "line_no int, value string")


def record(note, events_=None, **more):
    return {"note_id": note, "mrn": f"m{note}", "definition_name": "d", "success": True, "events": events_ or {}, "finish": {"summary": "s"}, "rounds": 1, "input_tokens": 5, "output_tokens": 2, "reasoning_tokens": 0, "run_meta": {"system_prompt_hash": "p"}, **more}


# --- projection, schemas -------------------------------------------------------------------


def test_aliases_shapes_and_conform(spark):
    df = projection.rename_aliases(spark.createDataFrame([("1", "r", "t")], "pat_mrn_id string, case_num string, report_text string"), get_schema("pathology").aliases)
    assert df.columns == ["mrn", "report_id", "report_text"] and projection.is_clean_shape(df)
    kept = projection.rename_aliases(df.withColumn("case_num", F.lit("x")), {"case_num": "report_id"})
    assert kept.columns == ["mrn", "report_id", "report_text", "case_num"]
    fixed = conform(df.withColumns({"ordering_date": F.lit("nope"), "extra": F.lit(1)}), REPORTS)
    assert fixed.columns == [*REPORTS.names, "extra"] and fixed.first().ordering_date is None
    assert "pathology" in list_schemas()
    with pytest.raises(KeyError):
        get_schema("none")


def test_filters(spark):
    df = spark.createDataFrame([("1", "a", True), ("2", " \t", None), ("3", None, False)], "id string, t string, success boolean")
    assert rows(projection.drop_blank(df, "t"), "id") == [("1",)]
    assert rows(projection.filter_notes(df, "t", "id > '1'"), "id") == [("2",)]
    assert rows(projection.successful(df), "id") == [("1",)]
    ids = spark.createDataFrame([(1,), (3,), (3,)], "id int")
    assert rows(projection.filter_ids(df, ids, "id"), "id") == [("1",), ("3",)]
    assert projection.first_present(df, ["x", "t", "id"]) == "t" and projection.first_present(df, ["x"]) is None


# --- collation ------------------------------------------------------------------------------


def test_collation(spark):
    data = [
        ("r1", "10", "m1", "2021-01-02", "final", "third."), ("r1", "2", "m1", "2021-01-02", "final", "second, "), ("r1", "1", "mX", "1999-01-01", " GROSS ", "dropped"),
        ("r1", "1", "m0", "2020-01-01", None, "first "), ("r2", "1", "m2", None, "$micro", "gone"), ("r3", "1", None, "bad", "x", "   "), ("r3", "2", None, "bad", "x", "only"),
    ]
    df = spark.createDataFrame(data, "report_id string, row_id string, mrn string, ordering_date string, external_name string, mult_ln_val_storage string")
    out = {r.report_id: r for r in collate.collate_reports(df).collect()}
    assert set(out) == {"r1", "r3"}
    assert out["r1"].report_text == "first second, third." and out["r1"].mrn == "m0" and out["r1"].ordering_date.isoformat() == "2020-01-01"
    assert out["r3"].report_text == "only" and out["r3"].ordering_date is None
    assert collate.collate_reports(df).columns == REPORTS.names
    assert collate.collate_reports(df.drop("mrn", "external_name", "ordering_date")).count() == 3


# --- upserts --------------------------------------------------------------------------------


def hashed(spark, data):
    return spark.createDataFrame(data, "id string, value string, key_hash string, content_hash string")


def test_upsert(spark):
    old = hashed(spark, [("1", "a", "k1", "c1"), ("2", "b", "k2", "c2")])
    new = hashed(spark, [("1", "changed but same content", "k1", "c1"), ("2", "B", "k2", "c9"), ("3", "c", "k3", "c3"), ("3", "d", "k3", "c4")])
    assert rows(upsert.upsert(old, new), "id", "value") == [("1", "a"), ("2", "B"), ("3", "c"), ("3", "d")]
    assert upsert.upsert_counts(old, new).first().asDict() == {"new": 2, "updated": 1, "unchanged": 1}
    assert upsert.upsert(None, new).count() == 4
    assert upsert.upsert_counts(None, new).first()["new"] == 4
    with pytest.raises(ValueError, match="column sets differ"):
        upsert.upsert(old, new.drop("value"))


def test_replay_equals_the_fold(spark):
    rng = random.Random(3)
    files = [[(f, f"k{k}", rng.choice("abc"), f"v{f}{k}") for k in range(12) if rng.random() < 0.7] for f in range(5)]
    frames = [spark.createDataFrame([r[1:] for r in f], "key_hash string, content_hash string, v string") for f in files]
    folded = None
    for f in frames:
        folded = upsert.upsert(folded, f)
    assert rows(upsert.replay_checked(frames)) == rows(folded)
    twice = [frames[0].union(frames[0]), frames[1]]
    assert rows(upsert.replay_checked(twice)) == rows(upsert.upsert(twice[0], twice[1]))


# --- versions and diffs ---------------------------------------------------------------------


def test_versions(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 10, "y"), ("a", None, "z"), ("b", None, "w"), (None, 1, "n")], "record_id string, segment bigint, v string")
    assert sorted((r.record_id or "", r.v) for r in versions.highest_segment(df).collect()) == [("", "n"), ("a", "y"), ("b", "w")]
    assert rows(versions.highest_segment_rows(df.union(df.where("segment = 10")), "record_id"), "v") == [("y",), ("y",)]
    log = spark.createDataFrame([("k", "2021-02", 1), ("k", "2021-01", 2), ("k", "2021-02", 3), ("q", None, 4), ("q", "", 5)], "key string, reviewed_at string, line_no int")
    assert rows(versions.latest_timestamp(log, ["key"]), "line_no") == [(3,), (5,)]
    assert rows(versions.last_line(log, ["key"]), "line_no") == [(3,), (5,)]


def test_deltas(spark):
    old = hashed(spark, [("1", "a", "k1", "c1"), ("2", "b", "k2", "c2"), ("2", "b", "k2", "c2b")])
    new = hashed(spark, [("1", "a", "k1", "c1"), ("2", "b", "k2", "c2b"), ("3", "c", "k3", "c3"), ("2", "x", "k2", "c7")])
    assert diff.keyed_delta(old, new).first().asDict() == {"new": 1, "updated": 1, "unchanged": 2}
    assert diff.keyed_delta(old.limit(0), new).first().asDict() == {"new": 4, "updated": 0, "unchanged": 0}
    assert diff.keyed_delta(None, new).first()["new"] == 4
    a = spark.createDataFrame([(1, None, "t1"), (2, "x", "t1")], "i int, v string, at string")
    b = spark.createDataFrame([(1, None, "t2"), (2, "y", "t2"), (1, None, "t2")], "i long, v string, at string")
    assert diff.unkeyed_delta(a, b, ["at"]).first().asDict() == {"new": 1, "updated": 0, "unchanged": 2}
    assert diff.identity_delta(a, b.drop("at").withColumn("at", F.lit("t1")).distinct(), "i").first().asDict() == {"new": 0, "updated": 1, "unchanged": 1}
    assert rows(diff.null_safe_semi(a.select("i", "v"), b.select("i", "v"))) == [(1, None)]
    assert {k: v.count() for k, v in diff.key_sets(a, b.where("i = 1"), "i").items()} == {"only_left": 1, "only_right": 0, "both": 1, "either": 2}
    assert diff.union_relaxed(a, b.drop("at")).count() == 5


# --- events and slots -----------------------------------------------------------------------


def test_records_are_lenient(spark):
    recs = events.records(lines_of(spark, record("a"), "{bad", "[1]", "", record("b", success=False)))
    assert rows(recs, "note_id", "success") == [("a", True), ("b", False)]
    tally = events.run_tally(recs).first()
    assert (tally.total, tally.succeeded, tally.failed, tally.success_rate) == (2, 1, 1, 0.5)


def test_records_are_parsed_once(spark):
    """A filter on what was parsed doesn't bring a second copy of the parser, nor leaves a second pass over an event's JSON."""
    recs = events.records(lines_of(spark, record("a", {"t": [{"v": 1.5}, {"w": ["é", None]}]}), "{bad", record("b", success=False)))
    steps = lambda df: df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython")
    assert steps(recs.where("success")) == 1 and recs.where("success").count() == 1
    table = events.event_table(recs.where("success"))
    assert steps(table) == 2 and rows(table.na.fill("-"), "note_id", "v", "w") == [("a", "-", "é;None"), ("a", "1.5", "-")]


def test_package_events_are_made_once(spark):
    """The check for repeated keys doesn't parse the package's events a second time."""
    package = {"definition_name": "d", "patients": [{"mrn": "m", "notes": {}, "events": [{"event_key": "a", "note_id": "n"}, {"event_key": "b", "note_id": "n"}]}]}
    found = review.package_events(spark.createDataFrame([(json.dumps(package),)], "json string"))
    assert found._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1 and rows(found, "event_key") == [("a",), ("b",)]
    package["patients"].append({"mrn": "q", "events": [{"event_key": "b"}]})
    with pytest.raises(Exception, match="repeated event_key"):
        review.package_events(spark.createDataFrame([(json.dumps(package),)], "json string")).collect()


def test_a_batch_is_made_in_slices():
    """The Python objects of a batch of records are those of a slice, with the same array as a result."""
    lines = pa.array([None if i % 9 == 0 else json.dumps({"note_id": str(i), "events": {"t": [{"v": i, "w": "x" * 50}] * 3}}) for i in range(10_001)])
    kind = events._arrow(events.EVENT)
    one = lambda v: events.events_of((events.parse_record(v) or {}).get("events_json"), {})
    peaks, found = [], []
    for step in (20_000, 500):
        tracemalloc.start()
        found.append(events.made(lines, one, kind, step))
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert found[0].equals(found[1]) and found[1].null_count == 0 and peaks[1] < peaks[0] / 5
    for n in (0, 1, 500, 501, 1000):
        assert events.made(lines.slice(3, n), one, kind).equals(pa.array([one(v) for v in lines.slice(3, n).to_pylist()], kind))


def test_records_reach_spark_in_slices(spark, monkeypatch):
    """Parser, events and leaves of a batch all go by slices."""
    sizes, whole = [], pa.array
    recs = events.records(lines_of(spark, *(record(f"n{i}", {"t": [{"v": i}]}) for i in range(1_201))).coalesce(1))
    assert recs.count() == 1_201 and events.explode_events(recs).count() == 1_201 and events.event_table(recs).select("v").distinct().count() == 1_201
    monkeypatch.setattr(events.pa, "array", lambda values, kind=None: (sizes.append(len(values)), whole(values, kind))[1])
    events.made(whole(["{}"] * 1_201), events.parse_head, events._arrow(events.HEAD))
    assert sizes == [500, 500, 201]


def test_wide_rows(spark):
    recs = events.records(lines_of(spark, record("a", {"t": [{"b": 1, "a": "é"}]}), record("b", success=False)))
    out = events.wide(recs, "batch", 3).collect()
    assert len(out) == 1 and out[0].segment == 3 and out[0].batch_name == "batch" and out[0].system_prompt_hash == "p"
    assert out[0].events_json == '{"t": [{"a": "\\u00e9", "b": 1}]}' and out[0].finish_json == '{"summary": "s"}'
    import hashlib

    assert bytes(out[0].content_hash) == hashlib.blake2b((out[0].events_json + out[0].finish_json).encode(), digest_size=16).digest()
    assert events.wide(recs, "batch", 3, only_successful=False).count() == 2


def test_events_and_guards(spark):
    recs = events.records(lines_of(spark, record("a", {"z": [{"v": 1}, 2, {"v": 3}], "x": {"v": 1}, "y": None, "b": [{"v": {"w": [1, 2]}}]})))
    assert rows(events.explode_events(recs), "event_type", "type_order", "position") == [("b", 3, 0), ("z", 0, 0), ("z", 0, 2)]
    flat = events.event_table(recs)
    assert flat.columns == ["note_id", "tool_name", "mrn", "gate_result", "v", "v_w"] and flat.count() == 3
    assert rows(events.run_statistics(recs)) == [("b", 1, 1), ("z", 2, 1)]
    assert events.merge_counters({"n": 1, "by": {"x": 1}, "started_at": "a"}, {"n": 2, "by": {"x": 2, "y": 1}, "started_at": "b"}) == {"n": 3, "by": {"x": 3, "y": 1}, "started_at": "a"}


def test_slot_keys(spark):
    a = record("n", {"m": [{"marker": "p53", "evidence": ["e"]}, {"marker": "p53"}, {"marker": None}], "s": [{"v": 1}, {"v": 2}]})
    found = events.slots(events.records(lines_of(spark, a, a)), {"m": ["marker"]})
    keys = [r.event_key for r in found.orderBy("line_no", "type_order", "position").collect()]
    base = keys[0]
    assert base.startswith("n::m::id-") and keys[1:] == [f"{base}::1", "n::m::3", "n::s::1", "n::s::2", f"{base}::2", f"{base}::3", "n::m::6", "n::s::3", "n::s::4"]
    prints = {r.fingerprint for r in found.where("event_type = 'm'").collect()}
    assert len(prints) == 2  # evidence doesn't count


# --- review ---------------------------------------------------------------------------------


def package(events_, batch="b"):
    return {"definition_name": "d", "batch": batch, "generated_at": "2024", "patients": [{"mrn": "m", "notes": {"n": {"note_date": "2020", "note_type": "t", "department": "p"}}, "events": events_}]}


def review_inputs(spark):
    raw = events.slots(events.records(lines_of(spark, record("n", {"a": [{"x": 1, "evidence": ["q"]}, {"x": 2}, {"x": 3}, {"x": 4}]}))))
    work = spark.createDataFrame([(json.dumps(package([{"event_key": f"n::a::{i}", "event_type": "a", "note_id": "n", "fields": {}} for i in (1, 2, 3)])),)], "json string")
    log = [
        {"event_key": "n::a::1", "verdict": "Approved", "edits": {"x": 9, "when": "2021"}, "reviewed_at": "2024-02", "reviewer": "r"},
        {"event_key": "n::a::1", "verdict": "rejected", "reviewed_at": "2024-01"}, {"event_key": "n::a::2", "verdict": "rejected", "reviewed_at": "2024"}, {"event_key": "unknown", "verdict": "approved"},
        {"event_key": "n::new::1", "verdict": "approved", "is_new_event": True, "event_type": "new", "note_id": "n", "mrn": "m", "edits": {"y": "z"}, "reviewed_at": "2024"},
    ]
    return raw, review.package_events(work), review.review_log(lines_of(spark, *log))


def test_silver(spark):
    placed = review.placed(*review_inputs(spark))
    assert dict(rows(review.silver_counts(placed))) == {"approved": 1, "rejected": 1, "unreviewed": 1, "auto_accepted": 1, "ignored": 1, "added": 1}
    with pytest.raises(ValueError, match="unreviewed"):
        review.check_silver(placed)
    review.check_silver(placed, require_complete=False)
    out = {r.event_key: r for r in review.silver(placed, "d", "b", "2024").collect()}
    assert set(out) == {"n::a::1", "n::a::4", "n::new::1"}
    edited, auto, added = out["n::a::1"], out["n::a::4"], out["n::new::1"]
    assert (edited.x, edited.when, edited.when_precision, edited.acceptance_reason, edited.review_verdict, edited.mrn, edited.note_date) == ("9", "2021-07-15", "year", "flagged_reviewed", "approved", "m", "2020")
    assert edited.original_fields_json == '{"x":1}' and edited.reviewed_fields_json == '{"when":"2021","x":9}'
    assert (auto.acceptance_reason, auto.review_verdict, auto.reviewed_at, auto.mrn) == ("unflagged_autoaccept", "", None, "mn")
    assert (added.acceptance_reason, added.y, added.event_type, added.edits_json) == ("reviewer_added", "z", "new", "{}")
    assert review.silver(placed).columns[: len(SILVER)] == SILVER.names


def test_review_state(spark, tmp_path):
    from lakework.extract.registry import DEMO, field_schema
    from lakework.sources import readers, review_log

    path, schema = tmp_path / "b.001.review_log.jsonl", field_schema(DEMO)
    review_log.append_verdict(path, {"event_key": "n::a::1", "verdict": " Rejected "})
    review_log.append_verdict(path, {"event_key": "n::a::1", "verdict": "approved", "reviewed_at": "9999"})
    review_log.append_verdict(path, {"event_key": "new", "verdict": "approved", "is_new_event": True, "event_type": "a", "note_id": "n", "edits": {"x": 1}})
    for bad in ({"verdict": "approved"}, {"event_key": "k", "verdict": "maybe"}, {"event_key": "k", "verdict": "approved", "edits": []}, {"event_key": "k", "verdict": "approved", "event_type": "record_measurement", "edits": {"on": {"date": "2021-02-30"}}}):
        with pytest.raises(ValueError):
            review_log.append_verdict(path, bad, schema)
    assert review_log.date_problem({"date": "2021-02-28", "precision": 3, "anchor": "MID"}) is None
    work = review.package_events(spark.createDataFrame([(json.dumps(package([{"event_key": f"n::a::{i}", "event_type": "a", "note_id": "n"} for i in (1, 2)])),)], "json string"))
    log = review.review_log(readers.numbered_lines(spark, str(path)))
    assert {(r.event_key, r.verdict, r.added) for r in review.review_state(work, log).collect()} == {("n::a::1", "approved", False), ("n::a::2", None, False), ("new", "approved", True)}


def test_review_faults(spark):
    raw, work, log = review_inputs(spark)
    missing = review.placed(raw.where("event_key <> 'n::a::1'"), work, log)
    with pytest.raises(ValueError, match="missing_raw"):
        review.check_silver(missing, require_complete=False)
    with pytest.raises(Exception, match="line 2"):
        review.review_log(lines_of(spark, {"event_key": "k", "verdict": "approved"}, "{bad")).collect()
    twice = spark.createDataFrame([(json.dumps(package([{"event_key": "k"}, {"event_key": "k"}])),)], "json string")
    with pytest.raises(Exception, match="repeated event_key"):
        review.package_events(twice).collect()
    with pytest.raises(Exception, match="event_key"):
        review.package_events(spark.createDataFrame([(json.dumps(package([{"fields": {}}])),)], "json string")).collect()


def test_selection(spark):
    a = events.records(lines_of(spark, record("1", {"flag_report_for_review": [{"reason": "r"}], "e": [{"x": 1, "y": 1}]}), record("2", {"flag_report_for_review": [], "e": [{"x": 1}, {"x": 2}]}), record("3", {"e": [{"x": 1}]}), record("4", {"e": [{"x": 1}]}, success=False)))
    b = events.records(lines_of(spark, record("1", {"e": [{"x": 1, "y": 2}], "flag_report_for_review": [{}]}), record("2", {"e": [{"x": 2}, {"x": 1}]})))
    assert rows(review.flagged_notes(a)) == [("1",)]
    comparable = review.comparable_fields({"e": {"event_identity_fields": ["x"], "comparison_fields": []}, "f": {}})
    assert comparable == {"e": {"x"}}
    # note 2 has an event type without events, which the other run's note lacks
    assert rows(review.disagreement_notes(a, [b], comparable)) == [("2",), ("3",)]
    assert rows(review.disagreement_notes(a, [b], {"e": ["x", "y"]})) == [("1",), ("2",), ("3",)]
    assert rows(review.disagreement_notes(a, [b])) == [("2",), ("3",)]


def test_worklist(spark):
    recs = events.records(lines_of(spark, record("1", {"e": [{"x": 1}]}), record("2", {"e": [{"x": 2}]}, mrn="  "), record("3", {"e": [{"x": 3}]}, mrn="m1")))
    notes = spark.createDataFrame([("1", "text", "2020", "t", "d")], "note_id string, note_text string, note_date string, note_type string, department string")
    out = {r.patient: r for r in review.worklist(recs, notes).collect()}
    assert set(out) == {"m1", "2"} and len(out["m1"].events) == 2 and out["m1"].notes[0].note.note_text == "text"
    assert review.worklist(recs, scope=spark.createDataFrame([("2",)], "note_id string")).count() == 1


# --- adjudication ---------------------------------------------------------------------------


def test_adjudication(spark):
    identity, comparable = {"m": ["marker"]}, {"m": ["marker", "status"]}
    left = events.slots(events.records(lines_of(spark, record("n", {"m": [{"marker": "a", "status": "pos", "detail": "1"}, {"marker": "b", "status": "pos"}, {"marker": "c", "status": "pos"}]}))), identity)
    right = events.slots(events.records(lines_of(spark, record("n", {"m": [{"marker": "b", "status": "neg"}, {"marker": "a", "status": "pos", "detail": "2"}, {"marker": "d", "status": "neg"}]}))), identity)
    aligned = adjudicate.align(left, right, comparable)
    assert dict(rows(adjudicate.status_counts(aligned))) == {"matched": 1, "different": 1, "missing_left": 1, "missing_right": 1}
    items = adjudicate.disagreements(aligned)
    key = {r.status: r.adjudication_key for r in items.collect()}
    decisions = [
        {"adjudication_key": key["different"], "decision": "right", "reviewed_at": "2"}, {"adjudication_key": key["different"], "decision": "left", "reviewed_at": "1"},
        {"adjudication_key": key["missing_left"], "decision": "custom", "adjudicated_fields": {"marker": "d", "status": "weak"}}, {"adjudication_key": key["missing_right"], "decision": "exclude"},
    ]
    out = {r.adjudication_key: r for r in adjudicate.adjudicated(items, adjudicate.adjudication_log(lines_of(spark, *decisions)), {"round_name": "r1"}).collect()}
    assert set(out) == {key["different"], key["missing_left"]}
    assert out[key["different"]].status == "neg" and out[key["missing_left"]].status == "weak" and out[key["different"]].round_name == "r1"
    wrong = adjudicate.adjudication_log(lines_of(spark, *decisions[:3], {"adjudication_key": key["missing_right"], "decision": "right"}))
    with pytest.raises(Exception, match="missing side"):
        adjudicate.adjudicated(items, wrong).collect()
    with pytest.raises(Exception, match="no decision"):
        adjudicate.adjudicated(items, adjudicate.adjudication_log(lines_of(spark, *decisions[:3]))).collect()
    with pytest.raises(ValueError, match="comparable"):
        adjudicate.align(left, right, {})


# --- incremental ----------------------------------------------------------------------------


def test_categories_follow_the_order_of_rules(spark):
    source = spark.createDataFrame([(i, "h") for i in "abcdefg"] + [("n", None)], "id string, current string")
    history = spark.createDataFrame([("b", "h", "d"), ("c", None, "d"), ("d", "old", "d"), ("e", "h", "x"), ("f", "h", "d"), ("g", None, "d"), ("g", "old", "d"), ("n", "h", "d")], "id string, src string, def string")
    forced = spark.createDataFrame([("f",), ("g",), ("zz",)], "id string")
    found = {r.id: r.category for r in delta.categorise(source, history, "d", forced, True).collect()}
    assert found == {"a": "new", "b": "skipped", "c": "skipped", "d": "changed", "e": "definition_changed", "f": "forced", "g": "forced", "n": "changed"}
    assert {r.category for r in delta.categorise(source, history).where("id = 'e'").collect()} == {"skipped"}
    assert rows(delta.unseen_forced(source, forced)) == [("zz",)]
    done = spark.createDataFrame([("a", "h"), ("b", None)], "id string, src string")
    assert rows(delta.resume(source.withColumnRenamed("current", "hash"), done), "id") == [("c",), ("d",), ("e",), ("f",), ("g",), ("n",)]
    kept = delta.prune_failed(lines_of(spark, record("a"), record("b", success=False), "{bad"))
    assert rows(kept, "line_no") == [(1,), (3,)]


# --- tombstones, cohorts, quality, reshaping -------------------------------------------------


def test_tombstones(spark):
    data = [("e1", "batch", "x", "forget", "2024-01-01T00:00:00"), ("e2", "batch", "x", "revive", "2024-01-02T00:00:00+02:00"), ("e3", "batch", "y", "revive", "2024-01-01T00:00:00"), ("e4", "batch", "y", "forget", "2024-01-01T00:00:00"), ("e5", "cohort", "x", "forget", "bad")]
    log = spark.createDataFrame(data, "event_id string, kind string, target string, action string, at string")
    assert rows(tombstones.active(log)) == [("batch", "y"), ("cohort", "x")]
    assert rows(tombstones.audit(log).where("active"), "event_id") == [("e4",), ("e5",)]
    df = spark.createDataFrame([("x",), ("y",)], "b string")
    assert rows(tombstones.without_forgotten(df, log, "batch", "b")) == [("x",)]
    assert tombstones.reconcile(["a", "b", "c"], ["a", "b"], ["b", "d"]) == {"tombstoned": ["b"], "orphaned": ["c"], "kept": ["a"]}


def test_cohorts(spark):
    assert cohorts.detect_key(["Group", "REPORT_ID", "Mrn"]) == "Mrn"
    with pytest.raises(ValueError):
        cohorts.detect_key(["x"])
    df, key = cohorts.prepare(spark.createDataFrame([(7, "g")], "MRN int, grp string"))
    assert key == "mrn" and df.dtypes == [("mrn", "string"), ("grp", "string")]
    assert cohorts.restrict(spark.createDataFrame([(7,), (8,)], "m int"), df, "mrn", "m").count() == 1
    with pytest.raises(ValueError):
        cohorts.restrict(df, df, "note_id", "mrn")
    meta = cohorts.meta_row(df, "c", key, created_at="2024")
    assert meta["row_count"] == 1 and cohorts.meta_table(df.sparkSession, [meta]).first().columns == ["mrn", "grp"]


def test_quality_checks(spark, tmp_path):
    good, bad = str(tmp_path / "good.parquet"), str(tmp_path / "bad.parquet")
    df = spark.createDataFrame([("1", "k", "c"), (None, "k", "c")], "report_id string, key_hash string, content_hash string")
    df.write.parquet(good)
    (tmp_path / "bad.parquet").write_bytes(b"no parquet")
    found = quality.run_checks(spark, {"good": good, "bad": bad}, {"good": ["report_id", "gone"]}, {"log": lines_of(spark, {"a": 1}, "{", "")}, {"good": df.limit(1)})
    assert {(r.check, r.dataset, r.severity) for r in found.collect()} == {
        ("parquet_readable", "bad", "error"), ("required_columns", "good", "error"), ("null_ids", "good", "error"), ("duplicate_keys", "good", "warning"), ("jsonl_parseable", "log", "error"), ("db_alignment", "good", "warning"),
    }
    assert not quality.passes(found) and quality.passes(found.where("severity = 'warning'"))
    assert quality.table_profile(df, ["report_id"]).first().asDict() == {"n_rows": 2, "duplicate_keys": 1, "null_report_id": 1}
    assert quality.empty_dataset(df.limit(0), "e").count() == 1


def test_reshaping(spark):
    df = spark.createDataFrame([("r1", "a", "2"), ("r1", "b", "1"), ("r2", "a", "3")], "run_id string, k string, v string")
    assert {r.run_id: (r.a, r.b) for r in reshape.pivot_first(df, ["run_id"], "k", "v").collect()} == {"r1": ("2", "1"), "r2": ("3", None)}
    assert [r.v for r in reshape.recent(df, 2, "v").collect()] == ["3", "2"]
    assert reshape.by_prefix(df, "r", "run_id").first().run_id == "r1"
    both = {r.field: r.differs for r in reshape.compare_rows(df.where("v <> '1'"), "r1", "r2", ["k", "v"]).collect()}
    assert both == {"k": False, "v": True}
    ids = spark.createDataFrame([("r2",)], "run_id string")
    assert reshape.notes_page(df, "run_id", ids, 1).first().run_id == "r2"
