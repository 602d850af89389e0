import hashlib
import random
import re
from collections import Counter

import pytest

from lakework.llm import repeats
from lakework.llm.rindex import RunLengthIndex
from tests.llm.conftest import with_clashes

COLUMNS = ("n_bytes", "n_removed", "n_spans", "kept_sha256")


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[p : p + length] for d in data for p in range(len(d) - length + 1))
    out = []
    for d in data:
        marks = bytearray(len(d))
        for p in range(len(d) - length + 1):
            if seen[d[p : p + length]] > 1:
                marks[p : p + length] = b"\1" * length
        kept = bytes(c for c, m in zip(d, marks, strict=True) if not m)
        out.append((len(d), sum(marks), len(re.findall(b"\1+", bytes(marks))), hashlib.sha256(kept).hexdigest()))
    return out


def found(df):
    return [tuple(r[c] for c in COLUMNS) for r in sorted(df.collect(), key=lambda r: r.doc_id)]


def test_removal_equals_brute_force(docs, texts):
    assert found(repeats.remove_repeats(docs)) == brute(texts, 200)


@pytest.mark.parametrize("params", [repeats.Repeats(length=40, anchor=8), repeats.Repeats(length=40, anchor=8, shard_bytes=300, max_broadcast=0)])
def test_short_strings_and_small_shards(spark, params):
    """Much more repetition; with tiny shards most anchors are counted string by string, and joins aren't broadcast."""
    rng = random.Random(11)
    pool = ["".join(rng.choice("abcdé ") for _ in range(rng.choice((20, 60, 150)))) for _ in range(8)]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 5))) + "".join(rng.choice("ab") for _ in range(rng.randint(0, 60))) for _ in range(60)] + ["aaaa" * 60, "ab" * 100, None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    assert found(repeats.remove_repeats(df, params)) == brute(texts, 40)


def test_spans_and_what_is_left(docs, texts):
    plain = {r.doc_id: r for r in repeats.remove_repeats(docs).collect()}
    wide = with_clashes(docs)
    left = repeats.without_repeats(wide)
    assert left.columns == [*wide.columns, "_kept"]
    for r in left.select("doc_id", "text", "_kept").collect():
        data, spans = (r.text or "").encode(), plain[r.doc_id].spans
        cut = b"".join(data[a:b] for a, b in zip([0, *(s.end for s in spans)], [*(s.start for s in spans), len(data)], strict=True))
        assert bytes(r._kept) == cut and hashlib.sha256(cut).hexdigest() == plain[r.doc_id].kept_sha256
        assert len(spans) == plain[r.doc_id].n_spans and sum(s.end - s.start for s in spans) == plain[r.doc_id].n_removed


def test_rows_that_repeat_one_text(spark):
    """One id and text in nine tenths of the rows: their equal ranges are one set, not a window's rows."""
    rng = random.Random(6)
    text, other = ("".join(rng.choice("abcdefgh ") for _ in range(900)) for _ in range(2))
    rows = [(1, text)] * 270 + [(i, other[: 300 + i]) for i in range(2, 32)]
    got = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)).collect()
    assert len(got) == 300 and all((r.n_removed, r.n_spans) == (900, 1) for r in got if r.doc_id == 1)
    assert all(r.n_removed == min(r.n_bytes, 330) and r.n_spans == 1 for r in got if r.doc_id > 1)


def test_matching_statistics_equal_brute_force():
    rng = random.Random(5)
    for _ in range(60):
        letters = rng.choice([b"a", b"ab", b"abc\x00\xf4"])
        base = bytes(rng.choice(letters) for _ in range(60))
        strings = []
        for _ in range(rng.randint(1, 7)):
            i = rng.randrange(50)
            strings.append(base[i : i + rng.randint(1, 50)] if rng.random() < 0.6 else base * rng.randint(1, 3) if rng.random() < 0.3 else bytes(rng.choice(letters) for _ in range(rng.randint(1, 40))))
        index = RunLengthIndex(strings)
        suffixes = [s[i:] for s in strings for i in range(len(s) + 1)]

        def common(a, b):
            n = 0
            while n < min(len(a), len(b)) and a[n] == b[n]:
                n += 1
            return n

        want = [max((common(s, t) for j, t in enumerate(suffixes) if j != i), default=0) for i, s in enumerate(suffixes)]
        assert index.matching_statistics().tolist() == want


def test_runs_compress_repetition():
    rng = random.Random(1)
    base = bytes(rng.choice(b"abcdefgh") for _ in range(500))
    index = RunLengthIndex([base] * 50)
    assert len(index.run_heads) < len(index.data) / 10


def test_anchors_are_where_the_text_is():
    """Equal strings of the full length have the same anchor in any context."""
    rng, p = random.Random(9), repeats.Repeats(length=50, anchor=10)
    core = bytes(rng.choice(b"abc") for _ in range(50))
    anchors = set()
    for _ in range(20):
        before = bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 70)))
        value, _, pos, size, _ = repeats.claims_of(before + core + bytes(rng.choice(b"abc") for _ in range(30)), p)
        anchors.add(next(v for v, a, n in zip(value.tolist(), pos.tolist(), size.tolist(), strict=True) if a <= len(before) < a + n))
    assert len(anchors) == 1


def test_edges(spark, docs, texts):
    assert repeats.remove_repeats(docs.where("doc_id < 0")).count() == 0
    assert found(repeats.remove_repeats(with_clashes(docs))) == brute(texts, 200)
    rng = random.Random(3)
    long = "".join(rng.choice("abcdefgh ") for _ in range(300))
    rows = [(1, long), (1, long), (None, long[:250]), (None, None), (2, "")]
    got = sorted(tuple(r[c] for c in COLUMNS[:3]) for r in repeats.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    assert got == [(0, 0, 0), (0, 0, 0), (250, 250, 1), (300, 300, 1), (300, 300, 1)]
    once = spark.createDataFrame([(1, long)], "doc_id bigint, text string")
    assert repeats.remove_repeats(once).first().n_removed == 0
