import re

from pyspark.sql import functions as F

from lakework.llm import quality
from tests.llm.conftest import as_rows, with_clashes

BASE = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    hit = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(i, i + 5)} if len(grams) < 1500 else {j for i, g in enumerate(grams) if _counts(grams)[g] > 1 for j in range(i, i + 5)}
    failed = len(words) < 10 or 100 * len(hit) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), failed


def _counts(grams, cache={}):  # noqa: B006
    from collections import Counter

    return cache.setdefault(id(grams), Counter(grams))


def test_base_counts_equal_brute_force(docs, texts):
    got = {r.doc_id: tuple(r[c] for c in BASE[1:]) for r in quality.assess(docs).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}


def test_whitespace_is_ascii_only():
    f = quality.text_features("a\x85b c\x1cd\x0be　f", quality.common_codes(()))
    assert (f["n_words"], f["word_chars"]) == (3, 9)


def test_common_words_are_folded_and_bare():
    common = quality.common_codes(("the", "of", "and", "to", "in"))
    count = lambda t: quality.text_features(t, common)["words"]
    assert count("The THE of, and. (To) in!") == count("the the of and to in") == [2, 1, 1, 1, 1, 0]
    assert count("ünd -- ... the-of the") == [1, 0, 0, 0, 0, 4]
    assert count("the\0 thE\n(of) oof") == [1, 1, 0, 0, 0, 2] and count("-- the") == [1, 0, 0, 0, 0, 1]
    assert count("...") == [0, 0, 0, 0, 0, 1] and count("") == [0] * 6


def test_junk_goes_and_prose_stays(spark, docs, texts):
    junk = spark.createDataFrame([(1000 + i, "### " + "<b>%%</b> |*| $$$ && " * 60 + str(i), "en") for i in range(3)], "doc_id bigint, text string, lang string")
    out = {r.doc_id: r for r in quality.assess(docs.select("doc_id", "text", "lang").union(junk), quality.QualityRules(min_reference_words=1000)).collect()}
    prose = [i for i, t in enumerate(texts) if t and 80 <= len(t.split()) and i < 60]
    assert len(prose) > 10 and all(out[i].kept for i in prose)
    assert not any(out[1000 + i].kept for i in range(3))
    assert all(0 <= r.class_distance <= 1 for r in out.values() if r.class_distance is not None)
    short = [r for r in out.values() if r.n_words < 100]
    assert all(r.word_distance is None for r in short)


def test_distance_against_numpy(spark):
    import numpy as np

    p, q = [1, 0, 3, 6], [4, 4, 0, 2]
    row = spark.range(1).select(quality._distance(F.array(*map(F.lit, p)), F.array(*map(F.lit, q))).alias("d")).first()
    a, b = np.array(p) / sum(p), np.array(q) / sum(q)
    m = (a + b) / 2
    kl = lambda x: sum(v * np.log2(v / w) for v, w in zip(x, m, strict=True) if v)
    assert abs(row.d - np.sqrt((kl(a) + kl(b)) / 2)) < 1e-12
    assert spark.range(1).select(quality._distance(F.array(F.lit(0)), F.array(F.lit(1))).alias("d")).first().d is None


def test_edges(spark, docs):
    empty = docs.where("doc_id < 0")
    assert quality.assess(empty).count() == 0 and quality.filter_documents(empty).columns == docs.columns
    wide = with_clashes(docs)
    assert as_rows(quality.assess(wide), *BASE, "kept") == as_rows(quality.assess(docs), *BASE, "kept")
    kept = quality.filter_documents(wide)
    assert kept.columns == wide.columns
    assert as_rows(kept, "doc_id", "text") == as_rows(quality.assess(docs).where("kept").join(docs, "doc_id"), "doc_id", "text")
    assert quality.assess(docs.union(docs)).count() == 2 * docs.count()
    assert quality.assess(docs.select("doc_id", "text")).count() == docs.count()
    nulls = spark.createDataFrame([(None, None, None)], "doc_id bigint, text string, lang string")
    row = quality.assess(nulls).first()
    assert (row.doc_id, row.n_words, row.base_failed, row.kept) == (None, 0, True, False)


def test_word_salad_with_normal_characters_goes(spark):
    """Junk of ordinary letters and spaces, which only the common words give away."""
    import random

    rng = random.Random(11)
    common, rare = quality.COMMON_WORDS[:21], ["river", "stone", "cloud", "window", "garden", "letter", "music", "paper"]
    prose = [" ".join(rng.choice(common if rng.random() < 0.5 else rare) + (str(rng.randrange(10**4)) if rng.random() < 0.1 else "") for _ in range(rng.randint(150, 600))) for _ in range(200)]
    salad = [" ".join("".join(rng.choice("aeinrstdhlo") for _ in range(rng.randint(2, 7))) for _ in range(300)) for _ in range(8)]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(prose + salad)], "doc_id bigint, text string, lang string")
    out = {r.doc_id: r for r in quality.assess(df).collect()}
    assert not any(r.base_failed for r in out.values())
    assert all(out[200 + i].class_distance <= quality.QualityRules().max_class_distance and out[200 + i].word_distance <= 0.60 for i in range(8))
    assert not any(out[200 + i].kept for i in range(8)) and sum(out[i].kept for i in range(200)) >= 198


def test_a_rare_language_is_not_judged_by_others(spark, texts):
    letters = "абвгдежзиклмно"
    rare = " ".join(letters[i % 14] + letters[i * 5 % 13] + letters[i * i % 11] + letters[i // 14 % 14] for i in range(300))
    english = [(i, t, "en") for i, t in enumerate(texts)]
    df = spark.createDataFrame([*english, (1000, rare, "ru")], "doc_id bigint, text string, lang string")
    row = quality.assess(df).where("doc_id = 1000").first()
    assert not row.base_failed and row.kept and row.class_distance is None and row.word_distance is None
