import zlib

import numpy as np

import corpus_pipeline
from lakework.llm import mixing, packing, pii
from tests.llm import test_dedup, test_mixing, test_packing, test_quality
from tests.llm.conftest import as_rows, with_clashes


def apply(spark, docs, folder):
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, "").write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    return out


def test_stages_equal_brute_force(spark, docs, texts, tmp_path):
    """Each stage on what its predecessor kept, against the plain versions."""
    out = apply(spark, docs, tmp_path)
    rows = {r.doc_id: r for r in docs.collect()}
    kept = {r.doc_id for r in out["quality"].collect()}
    assert kept <= {i for i, t in enumerate(texts) if not test_quality.brute(t)[-1]}
    clean = {i for i in range(60) if len((texts[i] or "").split()) >= 30}
    assert clean <= kept

    ids = sorted(kept)
    groups = test_dedup.brute([texts[i] for i in ids])
    unique = {ids[k] for k, (_, _, keep) in groups.items() if keep}
    assert {r.doc_id for r in out["near_duplicates"].collect()} == unique

    weights = pii.trained()
    redacted = {r.doc_id: r for r in out["personal_data"].collect()}
    assert redacted.keys() == unique
    assert all(r.text == pii.redact_text(texts[i], weights) and r.n_chars == len(r.text) and r.source == rows[i].source for i, r in redacted.items())

    mixed = [r.doc_id for r in out["mixing"].collect()]
    rate = {r.source: r.rate for r in mixing.target_rates(out["personal_data"]).collect()}
    assert sorted(mixed) == sorted(i for i, r in redacted.items() for _ in range(test_mixing.quantile(test_mixing.uniform(i), rate[r.source])))

    encode = packing.encoder(packing.default_tokenizer())
    pieces = out["packing"].collect()
    want = {}
    for i in mixed:
        want[i] = want.get(i, 0) + len(encode([redacted[i].text])[0]) + 1
    got = {}
    for r in pieces:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == want
    lengths = {}
    for r in pieces:
        lengths[r.sequence_id] = lengths.get(r.sequence_id, 0) + r.length
    assert all(n == 1024 or n & (n - 1) == 0 for n in lengths.values())
    assert zlib and np and test_packing


def test_columns_and_edges(spark, docs, tmp_path):
    wide = with_clashes(docs)
    out = apply(spark, wide, tmp_path / "wide")
    for name in ("quality", "near_duplicates", "personal_data", "mixing"):
        assert out[name].columns == wide.columns
    empty = apply(spark, docs.where("doc_id < 0"), tmp_path / "empty")
    assert all(df.count() == 0 for df in empty.values())
    nulls = spark.createDataFrame([(None, None, None, None, None)] * 3, docs.schema)
    assert apply(spark, nulls, tmp_path / "nulls")["packing"].count() == 0


def test_run(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    a, b = corpus_pipeline.run(spark, str(tmp_path)), corpus_pipeline.run(spark, str(tmp_path))
    names = ("doc_id", "length", "doc_tokens")
    assert a.agg({"length": "sum"}).first() == b.agg({"length": "sum"}).first() and a.columns == b.columns
    assert sum(r[1] for r in as_rows(a, *names)) > 0
