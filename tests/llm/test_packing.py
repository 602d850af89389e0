import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lakework.llm import packing
from tests.llm.conftest import as_rows, with_clashes


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def check(rows, wanted, window=1024):
    """Every id in exactly one piece, pieces in gapless sequences that are full or powers of two."""
    import collections

    sequences, pieces = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
        pieces[r.doc_id].append(r)
    for s in sequences.values():
        s.sort(key=lambda r: r.offset)
        at = 0
        for r in s:
            assert r.offset == at and r.length > 0
            at += r.length
        assert at == window or (at < window and at & (at - 1) == 0)
    assert set(pieces) == set(wanted)
    for doc, found in pieces.items():
        ids = [*wanted[doc], 0]
        found.sort(key=lambda r: r.start)
        at = 0
        for r in found:
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    return sequences


def test_pieces_cover_all_ids_once(docs, texts, reference):
    rows = packing.pack(docs).collect()
    sequences = check(rows, {i: reference(t) for i, t in enumerate(texts)})
    short = [s for s in sequences.values() if sum(r.length for r in s) < 1024]
    assert len(short) <= 10 * docs.rdd.getNumPartitions()


def test_small_shards(docs, texts, reference):
    check(packing.pack(docs.coalesce(1), packing.Packing(shard_docs=7, shard_terms=900)).collect(), {i: reference(t) for i, t in enumerate(texts)})


def test_ids_equal_the_library(reference):
    encode = packing.encoder(packing.default_tokenizer())
    rng = random.Random(1)
    cases = ["", "<|endoftext|>", "a<|endoftext|> b", "x" * 5000, " " * 3000, "\n\t" * 500, "it's 12 ½ 漢字 \U0001f600 é", "don't!!  stop"]
    cases += ["".join(rng.choice(" \n\t'sdaéB1٣!?　\u0085​\r<|>_-") for _ in range(50)) for _ in range(300)]
    assert [list(x) for x in encode(cases)] == [reference(c) for c in cases]


def brute_scores(items, i, p):
    """BM25 of all items for the terms of item i that others have too, one by one."""
    n, mean, out = len(items), np.mean([len(x) for x in items]), []
    terms = {int(t): df for t in set(items[i].tolist()) if (df := sum(t in x for x in items)) > 1}
    for x in items:
        tf = {t: k for t in terms if (k := int((x == t).sum()))}
        out.append(sum(np.log(1 + (n - terms[t] + 0.5) / (terms[t] + 0.5)) * k * (p.k1 + 1) / (k + p.k1 * (1 - p.b + p.b * len(x) / mean)) for t, k in tf.items()))
    return np.array(out)


@pytest.mark.parametrize("dense", [1, 4, 32, 1000])
def test_neighbours_equal_brute_force_bm25(dense):
    """With the production parameters too; ``dense`` only says which terms are rows of the matrix."""
    rng = random.Random(3)
    for vocabulary, longest in ((40, 30), (3000, 300)):
        items = [np.array([int(vocabulary * rng.random() ** 3) for _ in range(rng.randint(1, longest))], "<u4") for _ in range(60)]
        p = packing.Packing(dense=dense)
        index = packing.Index([packing.profile(x) for x in items], p)
        for i in range(60):
            scores = brute_scores(items, i, p)
            got = index.neighbours(i, np.ones(60, bool))
            assert set(got.tolist()) == set(np.flatnonzero(scores).tolist())
            assert np.allclose(index.row(i, np.ones(60, bool)), scores, atol=1e-4) and (np.diff(scores[got]) < 1e-4).all()
            assert 7 not in index.neighbours(i, np.arange(60) != 7)


def test_windows_are_filled_greedily():
    """Each window holds its seed and, one after the other, the best unused item that fits, or else the best one, cut."""
    rng, p = random.Random(21), packing.Packing(window=64)
    items = [np.array([rng.randrange(50) for _ in range(rng.randint(1, 63))], "<u4") for _ in range(80)]
    packer = packing.Packer(p, 0)
    rows = [r for i, x in enumerate(items) for r in packer.add_item(i, 0, x, len(x), packing.profile(x))] + packer.finish()
    left, at, sequence, space = {i: len(x) for i, x in enumerate(items)}, 0, 0, 64
    wanted = []
    while left:
        seed = min(left)
        scores = brute_scores(items, seed, p)
        now, i = sequence, seed
        while True:
            k = min(left[i], space)
            wanted.append((i, len(items[i]) - left[i], k, sequence))
            left[i] -= k
            space -= k
            if not left[i]:
                del left[i]
            if not space:
                sequence, space = sequence + 1, 64
            if sequence != now or not (able := [j for j in left if scores[j] > 0]):
                break
            fits = [j for j in able if left[j] <= space]
            i = max(fits or able, key=lambda j: (round(scores[j], 5), -j))
    full = [w for w in wanted if w[3] < sequence]
    assert [(r[0], r[1], r[2], r[5]) for r in rows][: len(full)] == full and len(full) > 100


def test_related_texts_share_windows():
    rng = random.Random(5)
    topics = [[f"{w}{k}" for w in ("alpha", "beta", "gamma", "delta", "omega", "sigma")] for k in range(6)]
    encode = packing.encoder(packing.default_tokenizer())
    together = {}
    packer, rows = packing.Packer(packing.Packing(window=256), 0), []
    for i in range(120):
        rows += packer.add(i, encode([" ".join(rng.choice(topics[i % 6]) for _ in range(30))])[0])
    rows += packer.finish()
    for doc, _, length, _, _, seq, _ in rows:
        together.setdefault(seq, []).extend([doc % 6] * length)
    same = sum(max(x.count(t) for t in range(6)) for x in together.values()) / sum(map(len, together.values()))
    assert same > 0.7


def test_edges(spark, docs):
    assert packing.pack(docs.where("doc_id < 0")).count() == 0
    assert as_rows(packing.pack(with_clashes(docs))) == as_rows(packing.pack(docs))
    rows = packing.pack(spark.createDataFrame([(1, None), (1, None), (None, "")], "doc_id bigint, text string").coalesce(1)).collect()
    assert sorted((r.doc_id or 0, r.start, r.length, r.doc_tokens) for r in rows) == [(0, 0, 1, 1), (1, 0, 1, 1), (1, 0, 1, 1)]
    assert {sum(r.length for r in rows if r.sequence_id == s) for s in {r.sequence_id for r in rows}} == {2, 1}


def test_copies_in_distant_partitions_share_windows(spark):
    """Each partition has every text once, so copies can only meet in shards of the whole corpus."""
    rng = random.Random(9)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "su", "te", "vor", "zan") for b in ("ber", "dan", "fil", "gor", "hup", "jet")]
    texts = [" ".join(rng.choice(words) for _ in range(30)) for _ in range(140)]
    df = spark.createDataFrame([(i, texts[i % 140]) for i in range(560)], "doc_id bigint, text string").repartitionByRange(4, "doc_id")
    found = {}
    for r in packing.pack(df, packing.Packing(window=256, shard_docs=40)).collect():
        found.setdefault((r.sequence_id, r.doc_id % 140), set()).add(r.doc_id)
    assert len({k for (_, k), ids in found.items() if len(ids) > 1}) > 0.8 * 140


def test_statistics_and_profiles_are_of_whole_documents(docs, texts, reference):
    p = packing.Packing()
    ids = [np.array([*reference(t), 0]) for t in texts]
    cuts = packing.cut_documents(docs.select("doc_id", "text"), p).cache()
    corpus = packing.statistics(cuts)
    assert (corpus.n, corpus.tokens) == (len(ids), sum(map(len, ids)))
    assert {t: n for t, n in enumerate(corpus.df.tolist()) if n} == {int(t): sum(t in x for x in ids) for t in np.unique(np.concatenate(ids))}
    for r in cuts.where("terms is not null and row >= 0").collect():
        assert [x.tolist() for x in np.unique(ids[r.doc_id], return_counts=True)] == [packing.long(x).tolist() for x in (r.terms, r.counts)]
    assert {r.doc_id for r in cuts.where("terms is not null and row >= 0").collect()} == {i for i, x in enumerate(ids) if len(x) > p.window}
    profiles = [packing.profile(x) for x in ids]
    whole, part = packing.Index(profiles, p, corpus), packing.Index(profiles[:20], p, corpus)
    assert np.allclose(part.weight, whole.weight[whole.owner < 20])


def test_numbers_are_packed():
    for x in ([], [0], [65535, 1], [65536, 2**32 - 1]):
        assert packing.long(packing.short(np.array(x, np.int64))).tolist() == x


def test_a_document_of_whole_windows(spark, reference):
    """Nothing is left of it for others' windows, but it counts in the statistics."""
    text = " the" * 2047
    rows = packing.pack(spark.createDataFrame([(1, text), (2, "the end")], "doc_id bigint, text string")).collect()
    check(rows, {1: reference(text), 2: reference("the end")})
    assert sorted(r.length for r in rows if r.doc_id == 1) == [1024, 1024]


def test_long_texts(spark, reference):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(("alpha", "beta", "gamma", "delta", "stone")) + str(rng.randrange(99)) for _ in range(60_000)), "alpha beta"]
    check(packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect(), dict(enumerate(map(reference, texts))))
