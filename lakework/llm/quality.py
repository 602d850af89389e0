"""Quality rules by distribution divergence.

Each document's histograms over character classes and over common words are
compared with a reference of its language by the Jensen-Shannon distance.  The
references are sums over the whole corpus, so nothing in them is sampled.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakework.llm.common import arrow_column, fresh, mixed, powers, prefix_hash, small_or_plain, staged, word_bounds

#: Frequent function words of English, German, French and Spanish; a parameter, not learnt.
COMMON_WORDS = (
    "the of and to in a is that for it as was with be by on not are this at "
    "der die das und ist nicht mit ein eine zu von auf den für im "
    "le la les et est un une des de que qui pour dans en du "
    "el los las y es por con una se del al lo su para"
).split()

#: Character classes, in the histogram's order.
CLASSES = ("lower", "upper", "digit", "space", "newline", "stop", "symbol", "other_ascii", "non_ascii")


@dataclass(frozen=True)
class QualityRules:
    """Thresholds of the method.

    Distances lie in [0, 1].  A document is only judged on a histogram if it has
    the least number of items in it; so short documents are never rejected by
    divergence.  Neither is one whose language has no reference: fewer than
    ``min_reference_words`` words in the corpus or, for character classes, five times
    as many characters, which also holds where words aren't spaced.  Its distances are
    null; no other language stands in.

    A word distance is an outlier beyond its language's third quartile and
    ``word_fence`` interquartile ranges, of all documents judged on words that pass
    the base rule.  No cut is below ``least_word_distance``, which clean texts of 100
    words reach by chance, or above ``max_word_distance``.
    """

    max_class_distance: float = 0.30
    max_word_distance: float = 0.50
    least_word_distance: float = 0.25
    word_fence: float = 1.5
    min_chars: int = 200
    min_words: int = 100
    min_reference_words: int = 10_000
    max_broadcast_languages: int = 10_000
    common_words: tuple[str, ...] = tuple(dict.fromkeys(COMMON_WORDS))


FEATURES = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [T.StructField("classes", T.ArrayType(T.LongType())), T.StructField("words", T.ArrayType(T.LongType()))]
)

_SYMBOLS = b"#*$%&|<>"
_STOPS = b".,;:!?'\"()-"
_IS_STOP = np.isin(np.arange(256), list(_STOPS))
_CLASS_BYTES = {
    "lower": bytes(range(97, 123)),
    "upper": bytes(range(65, 91)),
    "digit": bytes(range(48, 58)),
    "space": b" \t\r\x0b\x0c",
    "newline": b"\n",
    "stop": _STOPS,
    "symbol": _SYMBOLS,
}


def _byte_classes() -> list[int]:
    table = [CLASSES.index("other_ascii")] * 128 + [CLASSES.index("non_ascii")] * 128
    for name, members in _CLASS_BYTES.items():
        for b in members:
            table[b] = CLASSES.index(name)
    return table


def _word_hashes(data: bytes) -> np.ndarray:
    start, end = word_bounds(data)
    prefix = prefix_hash(data)
    return mixed((prefix[end] - prefix[start]) * powers(len(prefix))[1][start] + (end - start).astype(np.uint64))


def _short_codes(data: bytes) -> np.ndarray:
    """The words of at most seven bytes in lower case (A-Z) and without stops at their ends, as their bytes and length in one number."""
    start, end = word_bounds(data)
    a = np.frombuffer(data, np.uint8)
    kept = np.flatnonzero(~_IS_STOP[a])
    if not len(start) or not len(kept):
        return np.zeros(0, np.uint64)
    first = kept[np.minimum(np.searchsorted(kept, start), len(kept) - 1)]
    last = kept[np.searchsorted(kept, end) - 1] + 1
    short = (first >= start) & (first < end) & (last > first) & (last - first < 8)
    first, size = first[short], (last - first)[short]
    code = size.astype(np.uint64) << np.uint64(56)
    for i in range(7):
        byte = a[np.minimum(first + i, len(a) - 1)]
        byte = np.where((byte >= 65) & (byte <= 90), byte + np.uint8(32), byte)
        code |= np.where(size > i, byte, np.uint8(0)).astype(np.uint64) << np.uint64(8 * i)
    return code


def common_codes(words: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted codes of the common words, of at most seven bytes each, and each one's place in the histogram."""
    if any(not 0 < len(w.encode()) < 8 or len(_short_codes(w.encode())) != 1 for w in words):
        raise ValueError("common words have one to seven bytes, no spaces, and no stops at their ends")
    codes = np.array([_short_codes(w.encode())[0] for w in words], np.uint64)
    order = np.argsort(codes)
    return codes[order], order


def _repeated_words(word: np.ndarray, size: int = 5) -> int:
    """Words in windows of ``size`` that occur twice or more, by 64-bit hashes of the windows."""
    if len(word) <= size:
        return 0
    window = np.zeros(len(word) - size + 1, np.uint64)
    for i in range(size):
        window = window * np.uint64(0xC2B2AE3D27D4EB4F) + word[i : len(word) - size + 1 + i]
    ordered = np.sort(window)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(window, twice))
    steps = np.zeros(len(word) + 1, np.int64)
    steps[at] += 1
    steps[at + size] -= 1
    return int((np.cumsum(steps) > 0).sum())


def text_features(text: str | None, common: tuple[np.ndarray, np.ndarray]) -> dict:
    """The counts of one whole text; ``common`` is ``common_codes``.  Null counts as empty.

    For the histogram of common words, words are in lower case and bare of stops, so
    that ``The`` and ``the,`` count as ``the``.  The base counts take words as they stand.
    """
    data = (text or "").encode("utf-8", "surrogatepass")
    word = _word_hashes(data)
    per_byte = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    continuation = int(per_byte[128:192].sum())
    blanks = int(per_byte[[32, 9, 10, 11, 12, 13]].sum())
    classes = np.bincount(_BYTE_CLASSES, weights=per_byte, minlength=len(CLASSES)).astype(np.int64)
    classes[CLASSES.index("non_ascii")] -= continuation
    seen, duplicates = set(), 0
    for line in data.split(b"\n"):
        if line in seen:
            duplicates += 1
        elif line.strip():
            seen.add(line)
    codes, places = common
    counts = np.zeros(len(codes) + 1, np.int64)
    if len(codes):
        bare = _short_codes(data)
        at = np.minimum(np.searchsorted(codes, bare), len(codes) - 1)
        counts[:-1] = np.bincount(places[at[codes[at] == bare]], minlength=len(codes))
    counts[-1] = len(word) - counts.sum()
    return {
        "n_words": len(word),
        "word_chars": len(data) - continuation - blanks,
        "n_symbols": int(per_byte[list(_SYMBOLS)].sum()),
        "n_dup_lines": duplicates,
        "n_repeat_words": _repeated_words(word),
        "classes": classes.tolist(),
        "words": counts.tolist(),
    }


_BYTE_CLASSES = _byte_classes()


def _matrix(lists: pa.Array) -> np.ndarray:
    """Lists of one length as rows; zeros for null."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    known = lists.is_valid().to_numpy(zero_copy_only=False)
    if not known.any():
        return np.zeros((len(lists), 0))
    out = np.zeros((len(lists), len(flat) // int(known.sum())))
    out[known] = flat.reshape(-1, out.shape[1])
    return out


def _distances(counts: pa.Array, references: pa.Array) -> pa.Array:
    """Jensen-Shannon distances (base 2) of count arrays; null if one of the two is empty."""
    if not len(counts):
        return pa.array([], pa.float64())
    p, q = _matrix(counts), _matrix(references)
    q = q if q.shape == p.shape else np.zeros_like(p)  # no reference at all
    p_all, q_all = p.sum(axis=1, keepdims=True), q.sum(axis=1, keepdims=True)
    known = ((p_all > 0) & (q_all > 0))[:, 0]
    p /= np.maximum(p_all, 1)
    q /= np.maximum(q_all, 1)
    m = np.maximum((p + q) / 2, 1e-300)
    part = lambda x: np.where(x > 0, x * np.log2(np.maximum(x, 1e-300) / m), 0).sum(axis=1)
    return pa.array(np.sqrt(np.maximum((part(p) + part(q)) / 2, 0)), mask=~known)


_BOTH = T.StructType([T.StructField("words", T.DoubleType()), T.StructField("classes", T.DoubleType())])


@F.arrow_udf(_BOTH)
def _both_distances(words: pa.Array, ref_words: pa.Array, classes: pa.Array, ref_classes: pa.Array) -> pa.Array:
    """Both distances by one Python worker a task."""
    return pa.StructArray.from_arrays([_distances(words, ref_words), _distances(classes, ref_classes)], ["words", "classes"])


@F.arrow_udf(T.DoubleType())
def _distance(counts: pa.Array, references: pa.Array) -> pa.Array:
    return _distances(counts, references)


#: Distances are counted in steps of one part of this, so that quartiles are the same however rows are dealt.
_STEPS = 10_000


def _word_cuts(judged: DataFrame, rules: QualityRules) -> DataFrame:
    """(cut_lang, word_cut) of rows (lang, word_distance), from exact counts of the distances' steps."""
    steps = judged.where(F.col("word_distance").isNotNull()).groupBy("lang", F.floor(F.col("word_distance") * _STEPS).alias("step")).agg(F.count("*").alias("n"))
    upto, all_ = Window.partitionBy("lang").orderBy("step"), Window.partitionBy("lang")
    ranked = steps.withColumns({"below": F.sum("n").over(upto), "total": F.sum("n").over(all_)})
    quartile = lambda k: F.min(F.when(4 * F.col("below") >= k * F.col("total"), F.col("step"))) / _STEPS
    cuts = ranked.groupBy("lang").agg(quartile(1).alias("q1"), quartile(3).alias("q3"))
    fence = F.col("q3") + rules.word_fence * (F.col("q3") - F.col("q1"))
    return cuts.select(F.col("lang").alias("cut_lang"), F.least(F.lit(rules.max_word_distance), F.greatest(F.lit(rules.least_word_distance), fence)).alias("word_cut"))


def assess(docs: DataFrame, rules: QualityRules = QualityRules(), language: str = "lang", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per document: ``keep``'s columns, the base counts, verdicts, distances (to six digits).

    Nulls: a null text counts as empty (so it fails the base rule); a null
    language is a language of its own.  Long texts are counted whole.  Repeated rows
    give repeated results.  An empty table gives an empty result.

    Texts are read once: counts are staged as narrow rows, the references are
    sums of them per language, and at most one row per language is joined back; so
    are the cuts of the word distances.
    """
    common = common_codes(rules.common_words)
    n_words, n_classes = len(rules.common_words) + 1, len(CLASSES)
    lang = F.col(language).cast("string") if language in docs.columns else F.lit(None).cast("string")
    narrow = docs.select(F.struct(*(F.col(c) for c in keep)).alias("id"), lang.alias("lang"), F.col("text").cast("string").alias("text"))
    counted = narrow.select("id", "lang", arrow_column(lambda texts: [text_features(t, common) for t in texts], FEATURES, F.col("text")).alias("f"))
    counted = staged(counted.select("id", "lang", "f.*"), "quality")

    sums = [F.sum(F.col("classes")[i]).alias(f"c{i}") for i in range(n_classes)] + [F.sum(F.col("words")[i]).alias(f"w{i}") for i in range(n_words)]
    per_lang = counted.groupBy("lang").agg(F.sum("n_words").alias("n"), *sums)
    per_lang = staged(per_lang, "quality-reference")
    enough = {"w": F.col("n") >= rules.min_reference_words, "c": sum((F.col(f"c{i}") for i in range(n_classes)), F.lit(0)) >= 5 * rules.min_reference_words}
    pick = lambda k, n: F.when(enough[k], F.array(*(F.col(f"{k}{i}") for i in range(n))))
    references = per_lang.select(F.col("lang").alias("ref_lang"), pick("c", n_classes).alias("ref_classes"), pick("w", n_words).alias("ref_words"))
    references = small_or_plain(references, rules.max_broadcast_languages)

    base_failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    same = F.col("lang").eqNullSafe(F.col("ref_lang"))
    enough_words = F.col("n_words") >= rules.min_words
    sound = counted.where(~base_failed & enough_words).select("lang", "words").join(references, same, "left")
    cuts = staged(_word_cuts(sound.withColumn("word_distance", _distance(F.col("words"), F.col("ref_words"))), rules), "quality-cuts")
    cuts = small_or_plain(cuts, rules.max_broadcast_languages)

    judged = counted.join(references, same, "left").withColumn("d", _both_distances(F.col("words"), F.col("ref_words"), F.col("classes"), F.col("ref_classes")))
    judged = judged.withColumns({"word_distance": F.when(enough_words, F.col("d.words")), "class_all": F.col("d.classes")})
    judged = judged.join(cuts, F.col("lang").eqNullSafe(F.col("cut_lang")), "left")
    chars = F.aggregate("classes", F.lit(0).cast("long"), lambda s, x: s + x)
    judged = judged.withColumns({"class_distance": F.when(chars >= rules.min_chars, F.col("class_all")), "base_failed": base_failed})
    far = lambda name, most: F.coalesce(F.col(name) > most, F.lit(False))
    judged = judged.withColumn("diverges", far("class_distance", rules.max_class_distance) | far("word_distance", F.coalesce("word_cut", F.lit(rules.max_word_distance))))
    ids = [F.col("id")[c].alias(c) for c in keep]
    return judged.select(*ids, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & ~F.col("diverges")).alias("kept"), *(F.round(c, 6).alias(c) for c in ("class_distance", "word_distance")))


def filter_documents(docs: DataFrame, rules: QualityRules = QualityRules(), language: str = "lang") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns and no others.

    The whole row travels beside the narrow counts as one struct, so columns named
    like a count can't clash with it.
    """
    row = fresh(docs, "row")
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias(row), F.col("text"), *([F.col(language)] if language in docs.columns else []))
    kept = assess(packed, rules, language, keep=(row,)).where("kept")
    return kept.select(*(F.col(row)[c].alias(c) for c in docs.columns))
