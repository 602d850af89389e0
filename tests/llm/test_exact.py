import collections
import hashlib
import random

import pytest

from lakework.llm import exact
from tests.llm.conftest import as_rows, with_clashes


def brute(rows):
    """(id, keep_id, group_size, kept, digest) of (id, text) rows."""
    groups = collections.defaultdict(list)
    bare = lambda t: "".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")
    for i, t in rows:
        groups[bare(t)].append((-len(t or ""), i is None, i if i is not None else 0))
    out = []
    for i, t in rows:
        best = min(groups[bare(t)])
        keep = None if best[1] else best[2]
        out.append((i, keep, len(groups[bare(t)]), i == keep and -len(t or "") == best[0], hashlib.sha256(bare(t).encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df, **options):
    return as_rows(exact.exact_duplicates(df, **options), "doc_id", "keep_id", "group_size", "kept", "text_sha256")


TEXTS = [None, "", " ", " ", "\x85", "a b", "ab", "a\tb ", "a\x0bb\x0c\r\n", "a\x1cb", "ab\0", "é", "é", "𝄞 x", "𝄞x", "x" * 70_000, "x " * 70_000, "x" * 70_001, "ab" * 3, "aba", "abab"]


def rows_of(seed, n=400):
    rng = random.Random(seed)
    texts = TEXTS + ["".join(rng.choice("ab \n") for _ in range(rng.randint(0, 9))) for _ in range(n)]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("trie_bytes, max_broadcast", [(exact.TRIE_BYTES, 200_000), (exact.TRIE_BYTES, 0), (100, 200_000)])
def test_equals_brute_force(spark, trie_bytes, max_broadcast):
    """Also where tries spill after some texts."""
    rows = rows_of(3, 150)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert found(df, trie_bytes=trie_bytes, max_broadcast=max_broadcast) == brute(rows)


def test_corpus(spark, docs, texts):
    assert found(docs) == brute(list(enumerate(texts)))


def test_edges(spark):
    rows = [(1, "a"), (1, "a"), (None, "a "), (None, "a "), (2, " b"), (3, "b "), (2, "b"), (None, None), (7, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found(df) == brute(rows)
    assert exact.exact_duplicates(df.limit(0)).collect() == []
    named = spark.createDataFrame([("10", "x"), ("9", "x"), (None, "x")], "doc_id string, text string")
    assert {r.keep_id for r in exact.exact_duplicates(named).collect()} == {"10"}
    out = exact.exact_duplicates(with_clashes(df).withColumn("owner_id", df.text).withColumn("group_size", df.text))
    assert as_rows(out, "doc_id", "keep_id", "_group_size", "_kept", "text_sha256") == brute(rows)


def test_one_text_on_nine_tenths_of_the_rows(spark):
    rows = [(i, "same text" if i % 10 else f"text {i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(16)
    assert found(df) == found(df, max_broadcast=0) == brute(rows)
    assert exact._combined(df.select("doc_id", "text"), exact.TRIE_BYTES).where("n > 1").count() == 16  # one row a task


@pytest.mark.parametrize("seed", range(4))
def test_trie_holds_each_string_once(seed):
    rng = random.Random(seed)
    keys = [bytes(rng.choice((0, 97, 98, 255)) for _ in range(rng.randint(0, 8))) for _ in range(500)] + [b"p" * 9999 + bytes([i % 7]) for i in range(20)]
    trie = exact.Trie()
    for i, key in enumerate(keys):
        trie.find_or_add(key).add(i, 0)
    assert {t.key: (t.n, t.owner) for t in trie.terminals()} == {k: (keys.count(k), keys.index(k)) for k in keys}
    assert trie.bytes == sum(map(len, set(keys)))
    # a closed subtree's texts come back as spilled, others don't
    taken = {t.key for t in trie.spill(closed=True)}
    assert taken and all((trie.find_or_add(k) is None) == (k in taken) for k in keys)


def test_first_difference():
    rng = random.Random(1)
    for _ in range(2000):
        a, b = (bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(2))
        want = next((i for i in range(max(len(a), len(b)) + 1) if a[i : i + 1] != b[i : i + 1]), None)
        assert exact.first_difference(a, b) == want
    long = bytes(100_000)
    assert exact.first_difference(long + b"a", long + b"b") == 100_000 and exact.first_difference(long, long) is None


def test_a_shared_digest_of_different_texts_raises(spark):
    texts = spark.createDataFrame([("d", 1, 1, 1, 1, bytearray(b"x")), ("d", 1, 2, 1, 1, bytearray(b"y"))], exact._texts(spark.createDataFrame([(1,)], "a bigint").schema[0].dataType)).coalesce(1)
    with pytest.raises(Exception, match="share the digest"):
        exact._owned(texts, exact.TRIE_BYTES).collect()
