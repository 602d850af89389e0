"""Quote spans against one pattern per quote."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lakework.operators import evidence


def by_patterns(text, quotes):
    found = []
    for q in set(quotes):
        if words := q.split():
            found += [m.span() for m in re.finditer(r"\s+".join(map(re.escape, words)), text, re.IGNORECASE)]
    merged = []
    for a, b in sorted(found):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


@pytest.mark.parametrize("seed", range(5))
def test_spans_of_one_text(seed):
    rng = random.Random(seed)
    for _ in range(200):
        text = "".join(rng.choice("aAbB  \n\té.") for _ in range(rng.randint(0, 40)))
        quotes = ["".join(rng.choice("ab \n.é") for _ in range(rng.randint(0, 5))) for _ in range(rng.randint(0, 6))]
        assert evidence.spans_of(text, quotes) == by_patterns(text, quotes), (text, quotes)


def test_offsets_are_of_the_text_itself():
    text = "İx  \n\n  Margin \t is\nNEGATIVE.  𝄞 end"
    a, b = evidence.spans_of(text, ["margin is  negative", "END"])
    assert text[slice(*a)] == "Margin \t is\nNEGATIVE" and text[slice(*b)] == "end"


@pytest.mark.parametrize("per_pass", [1, 3, 5000])
def test_spans_of_notes(spark, per_pass):
    """A note with nine tenths of the quotes, in one pass and in many."""
    rng = random.Random(1)
    words = [f"w{i}" for i in range(60)]
    notes = [(i, " ".join(rng.choice(words) + rng.choice(("", "\n", " ")) for _ in range(400 if i == 0 else 30))) for i in range(12)] + [(99, None), (None, "w1"), (50, "w1")]
    quotes = [(0 if i % 10 else rng.randint(1, 11), " ".join(rng.choice(words).upper() for _ in range(rng.choice((1, 1, 2))))) for i in range(300)] + [(99, "w1"), (None, "w1"), (1, None), (1, "  "), (77, "w1")]
    a, b = spark.createDataFrame(notes, "note_id int, note_text string"), spark.createDataFrame(quotes, "note_id int, quote string").repartition(4)
    got = sorted(tuple(r) for r in evidence.quote_spans(a, b, per_pass=per_pass).collect())
    want = [(i, *s) for i, t in notes if i is not None and t for s in by_patterns(t, [q for k, q in quotes if k == i and q])]
    assert got == sorted(want)
    assert evidence.quote_spans(a.limit(0), b).collect() == []


def test_spans_of_one_search_are_not_sorted(spark):
    """Only ids with several passes or texts reach a window; nothing is shuffled after the search of the others."""
    notes = [(1, "a b a"), (2, "a b"), (2, "b  c a"), (2, "b a"), (3, "abc"), (4, "x")]
    quotes = [(1, "a"), (1, "A  b"), (2, "a"), (2, "b"), (3, "a"), (3, "b"), (3, "c"), (5, "x")]
    a, b = spark.createDataFrame(notes, "note_id int, note_text string"), spark.createDataFrame(quotes, "note_id int, quote string")
    found = evidence.quote_spans(a, b, per_pass=2)
    assert sorted(map(tuple, found.collect())) == [(1, 0, 3), (1, 4, 5), (2, 0, 1), (2, 2, 3), (2, 5, 6), (3, 0, 3)]
    tree = found._jdf.queryExecution().optimizedPlan().toString().split("Union")[1]
    once = tree[: tree.index("ArrowEvalPython")]
    assert "Window" not in once and "Aggregate" not in once and "Window" in tree
    # ids of another type: "1" and "01" are both 1
    texts = b.select(F.concat(F.lit("0"), F.col("note_id").cast("string")).alias("note_id"), "quote").union(b.select(F.col("note_id").cast("string"), "quote"))
    assert sorted(map(tuple, evidence.quote_spans(a, texts).collect())) == sorted(map(tuple, found.collect()))
