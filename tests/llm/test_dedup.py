import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from lakework.llm import components, dedup
from tests.llm.conftest import as_rows, edited, prose, with_clashes


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(texts):
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: (len(s), find(i), find(i) == i) for i, s in enumerate(sets)}


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def test_groups_equal_brute_force(docs, texts):
    assert found(dedup.near_duplicates(docs)) == brute(texts)


def test_chains_of_near_copies_in_several_blocks(spark):
    """A large group whose members mostly aren't similar to each other, in blocks of a few sets."""
    rng = random.Random(4)
    base = prose(rng, 60)
    texts = [edited(rng, base, rng.choice((0.01, 0.03, 0.06, 0.1))) for _ in range(120)] + [prose(rng, 60) for _ in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    wanted = brute(texts)
    assert 1 < len({c for _, c, _ in wanted.values()}) < 120
    assert found(dedup.near_duplicates(df)) == wanted
    assert found(dedup.near_duplicates(df, dedup.HyperMinHash(block_bytes=3000))) == wanted


def test_a_unit_joins_only_what_is_apart():
    sets = [np.arange(100, dtype=np.uint64), np.arange(5, 105, dtype=np.uint64), np.arange(300, 400, dtype=np.uint64), np.arange(10, 110, dtype=np.uint64)]
    table = pa.table({"digest": [b"a", b"b", b"c", b"d"], "component": [b"a", b"b", b"c", b"b"], "s": [s.tobytes() for s in sets]})
    assert dedup._joined(table, 75).to_pylist() == [{"a": b"a", "b": b"b"}]


def test_registers_hold_the_least_hash():
    p = dedup.HyperMinHash()
    rng = np.random.default_rng(3)
    for n in (1, 5, 100, 5000):
        hashes = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        got = dedup.registers(hashes, p)
        for b in range(128):
            own = [int(h) for h in hashes if int(h) >> 57 == b]
            want = 0
            if own:
                bits = format((min(own) << 7) & (2**64 - 1), "064b")
                zeros = min(len(bits) - len(bits.lstrip("0")), 62)
                want = ((zeros + 1) << 10) | int((bits[zeros + 1 :] + "0" * 12)[:10], 2)
            assert got[b] == want
        dense = dedup.densified(got)
        assert (dense > 0).all() and (dense[got > 0] == got[got > 0]).all()


def test_estimate_is_near_the_truth():
    p, rng = dedup.HyperMinHash(), np.random.default_rng(8)
    for share in (0.2, 0.5, 0.75, 0.9):
        errors = []
        for _ in range(40):
            both, a, b = rng.integers(0, 2**64, int(2000 * share), dtype=np.uint64), rng.integers(0, 2**64, int(1000 * (1 - share)), dtype=np.uint64), rng.integers(0, 2**64, int(1000 * (1 - share)), dtype=np.uint64)
            x, y = np.unique(np.concatenate([both, a])), np.unique(np.concatenate([both, b]))
            truth = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
            value, _ = dedup.estimate(dedup.registers(x, p)[None], dedup.registers(y, p)[None], np.array([len(x)]), np.array([len(y)]), p)
            errors.append(value[0] - truth)
        assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.08


def test_prefix_keys_of_small_similar_sets_meet():
    p, rng = dedup.HyperMinHash(), random.Random(2)
    for _ in range(3000):
        u = rng.sample(range(10**6), rng.randint(1, 10))
        a, b = {x for x in u if rng.random() < 0.9}, {x for x in u if rng.random() < 0.9}
        if a and b and 100 * len(a & b) >= 75 * len(a | b):
            key = lambda s: set(dedup.prefix_keys(np.array(sorted(s), np.uint64), p))
            assert key(a) & key(b)


def test_components(spark):
    rng = random.Random(6)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 440)] + [(500, i) for i in range(501, 560)] + [(7, 7), (None, 3)]
    df = spark.createDataFrame(links, "a int, b int")
    import collections

    graph = collections.defaultdict(set)
    for a, b in links:
        if a is not None and a != b:
            graph[a].add(b)
            graph[b].add(a)
    want, seen = {}, set()
    for start in sorted(graph):
        todo = [start] if start not in seen else []
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                want[x] = start
                todo += graph[x]
    assert {r.node: r.root for r in components.connected_components(df).collect()} == want
    assert {r.node: r.root for r in components.connected_components(df, task_links=0).collect()} == want
    assert components.connected_components(df.limit(0)).count() == 0


def test_edges(spark, docs, texts):
    assert dedup.near_duplicates(docs.where("doc_id < 0")).count() == 0
    assert found(dedup.near_duplicates(with_clashes(docs))) == brute(texts)
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "A B C D E F"), (None, "a b c d e f"), (None, None), (3, ""), (4, ""), (1, "quite another text than that")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = as_rows(dedup.near_duplicates(df), "doc_id", "component_id", "kept")
    assert got == sorted([(1, 1, True)] * 3 + [(2, 1, False), (None, 1, False), (None, None, True), (3, 3, True), (4, 4, True)], key=repr)
    wide = with_clashes(df)
    kept = dedup.keep_one(wide)
    assert kept.columns == wide.columns and as_rows(kept, "doc_id") == sorted([(1,)] * 3 + [(None,), (3,), (4,)], key=repr)
    assert dedup.keep_one(docs.where("doc_id < 0")).columns == docs.columns
    assert as_rows(dedup.keep_one(docs, max_broadcast=0), "doc_id") == sorted([(i,) for i, (_, _, k) in brute(texts).items() if k], key=repr)
    assert F is not None
