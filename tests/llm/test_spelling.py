import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from lakework.llm import spelling
from tests.llm.conftest import as_rows, with_clashes


def counted(rows):
    words = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            words[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    return {w: n for w, n in words.items() if len(w) >= 5 and n >= 3}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words, factor=2):
    forms, out = {}, {}
    for w, n in words.items():
        found = [x for x in words if near(w, x)]
        best = min(found, key=lambda x: (-words[x], x), default=None)
        forms[w] = best if best and words[best] >= factor * n else None
        out[w] = len(found)
    rows = []
    for w, n in words.items():
        end = w
        while forms[end]:
            end = forms[end]
        rows.append((w, forms[w], end, n, out[w], words[forms[w]] if forms[w] else None))
    return sorted(rows, key=repr)


NAMES = ("word", "form", "root", "n", "n_near", "form_n")


def sample(seed, kinds=250):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abé") for _ in range(rng.randint(5, 8))) for _ in range(kinds)] + ["x" * k for k in range(3, 13)] + ["Straße", "STRASSE", "strasse", "÷×ÿÀà", "÷×ÿÀ"]
    words += ["q" * 1500, "q" * 1501, "q" * 1502, "q" * 700 + "z" + "q" * 800, "q" * 701 + "z" + "q" * 799]
    return [w for w in words for _ in range(rng.choice((1, 3, 4, 9, 40)))]


@pytest.mark.parametrize("index", [{}, {"shard_bytes": 2000, "group_bytes": 200}, {"shard_bytes": 1, "group_bytes": 0}])
def test_equals_brute_force(spark, index):
    """Also with one shard, many, and groups that are halved down to single positions."""
    rng = random.Random(5)
    words = sample(11, 120)
    rng.shuffle(words)
    rows = [(i, " ".join(words[i::40]) + rng.choice((".", "", "1x"))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert as_rows(spelling.spelling_variants(df, **index), *NAMES) == brute(counted(rows))


def test_corpus(spark, docs, texts):
    assert as_rows(spelling.spelling_variants(docs), *NAMES) == brute(counted(list(enumerate(texts))))


def test_edges(spark):
    rows = [(1, "colour colour color"), (1, "color color colour"), (None, "color color color color color"), (2, None), (3, ""), (4, "co1our 7 ÀÀÀÀÀ·ÀÀÀÀÀ ÀÀÀÀÀĀààààà")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert as_rows(spelling.spelling_variants(df), *NAMES) == brute(counted(rows)) and counted(rows)["color"] == 8
    assert spelling.spelling_variants(df.limit(0)).collect() == []
    assert as_rows(spelling.spelling_variants(with_clashes(df).withColumn("word", df.text)), *NAMES) == brute(counted(rows))


def test_long_chains_and_ties(spark):
    rows = [(f"c{k}", " ".join(["b" * k + "aaaaaa"] * (3 * 2**k))) for k in range(9)] + [("t", "ttttta " * 6 + "tttttb " * 6 + "tttttc " * 3)]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    got = {r.word: r for r in spelling.spelling_variants(df).collect()}
    assert sorted(map(tuple, got.values()), key=repr) == brute(counted(rows))
    assert max(sum(1 for _ in iter_chain(got, w)) for w in got) >= 7 and got["tttttc"].form == "ttttta"


def iter_chain(got, word):
    while got[word].form:
        word = got[word].form
        yield word


def test_one_word_on_nine_tenths_of_the_runs(spark):
    rows = [(i, "the common words " + ("hotword " * 20) + f"rare{'abcdefghij'[i % 10]}s") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    assert as_rows(spelling.spelling_variants(df), *NAMES) == brute(counted(rows))


@pytest.mark.parametrize("n", [1, 2, 7, 64, 300])
def test_wavelet_tree_reports_rectangles(n):
    rng = np.random.default_rng(n)
    values = rng.permutation(n)
    tree = spelling.WaveletTree(values)
    lo, least = rng.integers(0, n + 1, 200), rng.integers(0, n + 1, 200)
    hi, end = rng.integers(0, n + 1, 200), rng.integers(0, n + 1, 200)
    query, value = tree.report(lo, hi, least, end)
    want = {(q, v) for q in range(200) for v in values[lo[q] : hi[q]] if least[q] <= v < end[q]}
    assert len(query) == len(want) and set(zip(query.tolist(), value.tolist(), strict=True)) == {(q, int(v)) for q, v in want}


def test_each_pair_is_reported_once():
    rng = random.Random(3)
    for _ in range(30):
        points = list({"".join(rng.choice("ab") for _ in range(6)) for _ in range(30)})
        shorter = list({"".join(rng.choice("ab") for _ in range(5)) for _ in range(30)})
        words = points + shorter
        rows = [(w, lo, hi) for w in words for lo, hi in ((0, 3), (3, 6))]
        a, b = spelling.near_pairs([w.encode() for w, _, _ in rows], np.array([len(w) == 6 for w, _, _ in rows]), np.array([r[1] for r in rows]), np.array([r[2] for r in rows]), 6)
        got = [(rows[i][0], rows[j][0]) for i, j in zip(a, b, strict=True)]
        assert sorted(got) == sorted((q, x) for q in words for x in points if near(q, x))
