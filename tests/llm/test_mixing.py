import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from lakework.llm import mixing
from tests.llm.conftest import as_rows, with_clashes


def uniform(doc_id, seed="mix"):
    return int(hashlib.md5(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:13], 16) / 2**52


def quantile(u, rate):
    k, total, log_term = 0, 0.0, -rate
    while True:
        total += math.exp(log_term)
        if total > u or k > rate + 9 * math.sqrt(rate) + 20:
            return k
        k += 1
        log_term += math.log(rate) - math.log(k)


def test_copies_equal_a_plain_inversion(docs):
    rows = docs.select("doc_id", "source").collect()
    sizes = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + 1
    weight = {s: math.sqrt(n) for s, n in sizes.items()}
    rate = {s: weight[s] / sum(weight.values()) * len(rows) / n for s, n in sizes.items()}
    want = sorted((r.doc_id, c) for r in rows for c in range(quantile(uniform(r.doc_id), rate[r.source])))
    out = mixing.mix(docs)
    assert sorted((r.doc_id, r.copy) for r in out.collect()) == want
    got = {r.source: r.rate for r in mixing.target_rates(docs).collect()}
    assert got.keys() == rate.keys() and all(abs(got[s] - rate[s]) < 1e-12 for s in rate)


@pytest.mark.parametrize("rate", [1e-6, 0.3, 1.0, 7.5, 60.0, 2000.0])
def test_poisson(spark, rate):
    n = 4000
    df = spark.range(n).select("id", mixing.uniform(F.col("id"), "t").alias("u")).withColumn("k", mixing.poisson(F.col("u"), mixing.poisson_cdf(F.lit(rate))))
    rows = df.collect()
    assert all(abs(r.u - uniform(r.id, "t")) == 0 and r.k == quantile(r.u, rate) for r in rows[:500])
    mean = sum(r.k for r in rows) / n
    assert abs(mean - rate) < 5 * math.sqrt(rate / n) + 1e-3
    assert spark.range(1).select(mixing.poisson(F.lit(0.5), mixing.poisson_cdf(F.lit(0.0))).alias("k")).first().k == 0


def test_weights_are_met(spark):
    rng = random.Random(1)
    df = spark.createDataFrame([(i, "t", "big" if i % 10 else "small") for i in range(20_000)], "doc_id bigint, text string, source string")
    out = mixing.mix(df, {"big": 1.0, "small": 1.0}, epochs=0.5)
    counts = {r.source: r["count"] for r in out.groupBy("source").count().collect()}
    assert all(abs(c - 5000) < 400 for c in counts.values()) and rng
    assert {r.source for r in mixing.mix(df, {"big": 2.0}).select("source").distinct().collect()} == {"big"}
    with pytest.raises(ValueError):
        mixing.mix(df, {"big": -1.0})


def test_shuffle_is_by_hash_and_without_python(docs):
    out = mixing.mix(docs)
    found = out.withColumn("p", F.spark_partition_id()).collect()
    parts = {}
    for r in found:
        parts.setdefault(r.p, []).append(r.shuffle_key)
    assert all(k == sorted(k) for k in parts.values()) and len({r.shuffle_key for r in found}) == len(found)
    assert [r.doc_id for r in found] != sorted(r.doc_id for r in found)
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_rows_without_ids_differ_and_one_id_is_dealt(spark):
    nulls = spark.createDataFrame([(None, f"t{i}", "s") for i in range(400)], "doc_id bigint, text string, source string").repartition(8)
    out = mixing.mix(nulls).collect()
    assert {r.copies for r in out} >= {1, 2, 3} and len({r.shuffle_key for r in out}) == len(out)
    hot = spark.createDataFrame([(7 if i % 10 else i, "t", "s") for i in range(400)], "doc_id bigint, text string, source string").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = mixing.mix(hot, epochs=3.0).withColumn("p", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len({r.p for r in rows if r.doc_id == 7}) > 1 and sum(r.doc_id == 7 for r in rows) % 360 == 0


def test_edges(spark, docs):
    assert mixing.mix(docs.where("doc_id < 0")).count() == 0
    wide = with_clashes(docs)
    out = mixing.mix(wide)
    assert out.columns[: len(wide.columns)] == wide.columns and "_copy" in out.columns
    assert as_rows(out, "doc_id", "_copy") == as_rows(mixing.mix(docs), "doc_id", "copy")
    assert mixing.mix(wide, details=False).columns == wide.columns
    twice = mixing.mix(docs.union(docs), weights={f"src{i}": 1.0 for i in range(7)})
    assert all(n % 2 == 0 for n in (r["count"] for r in twice.groupBy("doc_id", "copy").count().collect()))
    nulls = spark.createDataFrame([(None, None, None)] * 3, "doc_id bigint, text string, source string")
    assert mixing.mix(nulls, epochs=4.0).select("copies").distinct().count() <= 1
    assert as_rows(mixing.mix(docs, max_broadcast_numbers=0), "doc_id", "copy") == as_rows(mixing.mix(docs), "doc_id", "copy")
