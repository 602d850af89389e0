"""Field types, digests and profiles that are kept and merged."""

import json
import random

import pytest
from pyspark.sql import functions as F

from lakework.extract import registry
from lakework.operators import diff, digests, events, fields, flat, profiles

VALUES = (None, 1, 2.5, True, "t", ["a"], {"date": "2024", "precision": 1}, {"date": "2024"})


def test_field_types_merge_as_one(spark):
    """An event type with nine tenths of the events, values of all kinds, over three segments."""
    rng = random.Random(3)
    lines, seen = [], []
    for segment in range(3):
        for n in range(60):
            kind = "hot" if rng.random() < 0.9 else "cold"
            event = {name: rng.choice(VALUES) for name in rng.sample(("a", "b", "c", 'q"'), 3)}
            lines.append((segment, n, json.dumps({"note_id": "n", "success": True, "events": {kind: [event, {}]}})))
            seen += [(kind, event), (kind, {})]
    recs = events.records(spark.createDataFrame(lines, "segment bigint, line_no bigint, value string").repartition(4))
    whole = fields.field_types(recs)
    merged = fields.merge_types([fields.field_types(recs.where(F.col("segment") == k)) for k in range(3)])
    by_name = lambda schema: {k: sorted(v["fields"], key=lambda f: f["name"]) for k, v in schema.items()}
    assert fields.as_schema(merged) == fields.as_schema(whole) and by_name(fields.as_schema(whole)) == by_name(registry.infer_schema(seen))
    names = ("event_type", "field", "n", "n_null", "control")
    assert sorted(merged.select(*names).collect()) == sorted(whole.select(*names).collect())
    one = fields.field_types(recs.limit(0))
    assert fields.as_schema(one) == {}


def keyed(spark, rows):
    return spark.createDataFrame(rows, "key_hash string, content_hash string")


def test_digest_delta(spark, tmp_path):
    rng = random.Random(1)
    old = [(f"k{i}", "a") for i in range(500)]
    for changes in (0, 1, 5, 500):
        new = [(k, "b" if i < changes else c) for i, (k, c) in enumerate(old)] + [(f"n{i}", None) for i in range(min(changes, 7))]
        rng.shuffle(new)
        new = new[: len(new) - min(changes, 3)]
        for name, rows in (("old", old), ("new", new)):
            digests.write_with_digests(keyed(spark, rows), str(tmp_path / name), ["key_hash"], ["key_hash", "content_hash"], buckets=64)
        got = digests.snapshot_delta(spark, str(tmp_path / "old"), str(tmp_path / "new"))
        assert got.collect() == diff.keyed_delta(keyed(spark, old), keyed(spark, new)).collect()
        a, b = (spark.read.parquet(f"{tmp_path / n}.digests") for n in ("old", "new"))
        changed = digests.differing_buckets(a, b)
        want = set(old) ^ set(new)
        buckets = {r[0] for r in keyed(spark, list(want)).select(digests.bucket_of(["key_hash"], 64)).collect()} if want else set()
        assert set(changed) == buckets
        if changes == 1:
            assert len(changed) < 8
            plan = got._jdf.queryExecution().executedPlan().toString()
            assert "PartitionFilters: [isnotnull(digest_bucket" in plan or "PartitionFilters: [digest_bucket" in plan


def test_digests_don_t_depend_on_order_or_parts(spark):
    rows = [(f"k{i % 50}", None if i % 3 else "x") for i in range(300)]
    one = digests.digest_rows(keyed(spark, rows).coalesce(1), ["key_hash"], ["key_hash", "content_hash"], 64)
    many = digests.digest_rows(keyed(spark, rows[::-1]).repartition(7), ["key_hash"], ["key_hash", "content_hash"], 64)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))
    assert digests.digest_rows(keyed(spark, []), ["key_hash"], ["key_hash"], 64).collect() == []
    assert digests.differing_buckets(one, many.where("bucket <> 3 or level > 0")) == []  # the table's digest decides first


def test_profiles_merge(spark):
    rng = random.Random(7)
    rows = [("hot" if i % 10 else "cold", i, rng.gauss(0, 1) if i % 7 else None, rng.choice(("", " ", "a", "b", None)), None) for i in range(5000)]
    df = spark.createDataFrame(rows, "part string, id bigint, x double, t string, none double").repartition(5)
    got = {r.column: r for r in profiles.report(profiles.merge(profiles.profile(df, ["part"]))).collect()}
    once = {r.column: r for r in profiles.report(profiles.profile(df.drop("part"))).collect()}
    for name, i in (("id", 1), ("x", 2), ("t", 3), ("none", 4)):
        values = [r[i] for r in rows if r[i] is not None]
        for r in (got[name], once[name]):
            assert (r.n, r.n_null, r.n_blank) == (5000, 5000 - len(values), sum(isinstance(v, str) and not v.strip() for v in values))
            assert abs(r.n_distinct - len(set(values))) <= 1 + profiles.DISTINCT_ERROR * len(set(values))
            assert (r.least, r.most) == ((str(min(values)), str(max(values))) if values else (None, None))
            for q, v in zip((0.25, 0.5, 0.75), r.quantiles or (), strict=False):
                assert sum(x < v for x in values) / len(values) - profiles.RANK_ERROR <= q <= sum(x <= v for x in values) / len(values) + profiles.RANK_ERROR
    assert got["none"].quantiles is None and got["t"].quantiles is None and len(got["x"].quantiles) == 3


def test_declared_leaves(spark):
    lines = [(json.dumps({"note_id": f"n{i}", "success": True, "mrn": "m", "events": {"hot" if i % 10 else "cold": [{"x": i, "when": "2024", "deep": {"k": ["a", 1]}}, {"y": None}], "none": []}}),) for i in range(30)]
    recs = events.records(spark.createDataFrame(lines, "value string").repartition(3).withColumn("line_no", F.lit(0)))
    names = ["deep_k", "when", "when_precision", "x", "y"]
    got = flat.declared_events(recs, names, strict=True)
    assert got.columns == ["note_id", "mrn", "gate_result", "tool_name", *names]
    assert sorted(map(repr, got.collect())) == sorted(map(repr, events.event_table(recs).select(*got.columns).collect()))
    assert flat.declared_events(recs, ["x"]).where("x is not null").count() == 30
    assert flat.declared_events(recs.limit(0), ["x"]).collect() == []
    with pytest.raises(Exception, match="undeclared"):
        flat.declared_events(recs, ["x"], strict=True).collect()
    with pytest.raises(Exception, match="declared twice"):
        flat.declared_events(recs, ["x", "X"])


def test_declared_leaves_by_batch(spark):
    """Not a call and a conversion per record; the table function yields the same rows in SQL."""
    lines = [(json.dumps({"note_id": f"n{i}", "mrn": "m", "events": {"t": [{"x": i, "d": {"k": "2024"}}, {"y": None}], "none": []}}),) for i in range(20)]
    recs = events.records(spark.createDataFrame(lines, "value string"))
    got = flat.declared_events(recs, ["x", "d_k"], ("note_id",))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "UDTF" not in plan and plan.count("ArrowEvalPython") == 2
    spark.udtf.register("flat_events", F.udtf(flat.FlatEvents, useArrow=True))
    recs.createOrReplaceTempView("flat_recs")
    sql = spark.sql("""SELECT note_id, f.* FROM flat_recs, LATERAL flat_events(events_json, '["x", "d_k"]', false) f""")
    spark_rows = lambda df: sorted(map(repr, df.select(*got.columns).collect()))
    assert spark_rows(got) == spark_rows(sql) and got.count() == 40
