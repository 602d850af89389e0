"""Spelling variants: words one inserted, deleted or replaced letter apart.

Words are counted over whole texts.  For each edit position the words that share
a word's letters before it are an interval of the words in forward order, and those
that share the letters after it one in reverse order; a wavelet tree over the points
(forward rank, reverse rank) reports who is in both.  Words are dealt by letters
that partners must share, so an index is bounded and no partner is in another one.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakework.llm.common import arrow_schema, small_or_plain, small_slices, staged

RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: Letters are single bytes in this encoding, in code-point order.
LETTERS = "latin-1"
#: One run of so many, by its hash, loses a letter.
DAMAGE = 97

COUNTS = T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])
NEAR = T.StructType([T.StructField("word", T.StringType()), T.StructField("n_near", T.LongType()), T.StructField("form_n", T.LongType()), T.StructField("form", T.StringType())])


def runs(doc_id: str, text: str | None) -> Iterator[tuple[str, int]]:
    """(result, occurrences) of a document's distinct runs of letters, A-Z lower-cased, with the hashed damage."""
    lower = (text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    for run, n in Counter(RUN.findall(lower)).items():
        h = zlib.crc32(f"{doc_id}:{run}".encode())
        if h % DAMAGE == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        yield run, n


def word_counts(docs: DataFrame, id_column: str = "doc_id", text: str = "text", least_letters: int = 5, least_n: int = 3, held: int = 200_000) -> DataFrame:
    """(word, n) of all words; a task sums what it has of ``held`` words at a time before they are shuffled."""
    schema = arrow_schema(COUNTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}

        def flushed():
            words = list(counts)
            out = pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(list(counts.values()), pa.int64())], schema=schema)
            counts.clear()
            return out

        for batch in batches:
            for part in small_slices(*batch.columns):
                for doc_id, body in zip(*(c.to_pylist() for c in part), strict=True):
                    for word, n in runs(doc_id, body):
                        if len(word) >= least_letters:
                            counts[word] = counts.get(word, 0) + n
                    if len(counts) > held:
                        yield flushed()
        if counts:
            yield flushed()

    rows = docs.select(F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit("")).alias("i"), F.col(f"`{text}`").cast("string").alias("t"))
    return rows.mapInArrow(run, COUNTS).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_n)


class WaveletTree:
    """A permutation of 0..n-1, one bit array a level, most significant bit first; queries come in arrays."""

    def __init__(self, values: np.ndarray):
        self.n, self.levels = len(values), []
        self.depth = max(1, int(self.n - 1).bit_length()) if self.n else 0
        values = np.asarray(values, np.int64)
        for bit in range(self.depth - 1, -1, -1):
            ones = (values >> bit & 1).astype(bool)
            zeros_before = np.zeros(self.n + 1, np.int32)
            np.cumsum(~ones, out=zeros_before[1:])
            self.levels.append(zeros_before)
            values = np.concatenate([values[~ones], values[ones]])

    def report(self, lo: np.ndarray, hi: np.ndarray, least: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, value) for all values in [least, end) at places [lo, hi)."""
        query = np.flatnonzero((lo < hi) & (least < end))
        lo, hi, value = lo[query].astype(np.int64), hi[query].astype(np.int64), np.zeros(len(query), np.int64)
        for level, zeros_before in enumerate(self.levels):
            rest = self.depth - level - 1
            zeros = zeros_before[-1]
            lo0, hi0 = zeros_before[lo].astype(np.int64), zeros_before[hi].astype(np.int64)
            query, value = np.concatenate([query, query]), np.concatenate([value << 1, value << 1 | 1])
            lo, hi = np.concatenate([lo0, zeros + lo - lo0]), np.concatenate([hi0, zeros + hi - hi0])
            live = (lo < hi) & (value << rest < end[query]) & ((value + 1) << rest > least[query])
            query, value, lo, hi = query[live], value[live], lo[live], hi[live]
        return query, value


def _ordered(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order, ranks and common prefixes of neighbours (0 at both ends) of a matrix's rows."""
    n, width = letters.shape
    order = np.argsort(np.ascontiguousarray(letters).view(f"S{width}").ravel(), kind="stable")
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    common = np.full(n + 1, -1, np.int64)
    step = max(1, (1 << 22) // width)
    for i in range(1, n, step):
        rows = order[i - 1 : i + step]
        differs = letters[rows[1:]] != letters[rows[:-1]]
        found = differs.argmax(axis=1)
        common[i : i + len(found)] = np.where(differs.any(axis=1), found, width)
    return order, rank, common


def _interval(common: np.ndarray, depth: np.ndarray | int, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ranks [start, end) whose rows share the first ``depth`` letters with those of ``rank``."""
    borders = np.flatnonzero(common < depth)
    at = np.searchsorted(borders, rank, "right")
    return borders[at - 1], borders[at]


def near_pairs(words: list[bytes], is_point: np.ndarray, low: np.ndarray, high: np.ndarray, length: int, step: int = 1 << 17) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row, point's row): words that become points of ``length`` letters by one edit at a position in [low, high).

    Points have ``length`` letters, and their edit replaces one; other rows have one
    letter less, and theirs inserts one.  Both keep the letters before position i and the
    last ``length - 1 - i``.  The position is the first at which the two differ, so that
    each pair is reported once although a letter may be inserted anywhere in a run of it.
    """
    distinct, row_of = np.unique(np.array(words, f"S{length}"), return_inverse=True)
    n = len(distinct)
    letters = distinct.view(np.uint8).reshape(n, length)
    size = np.char.str_len(distinct)
    # back to front: the last letter first, shorter words padded at their end
    place = size[:, None] - 1 - np.arange(length)[None, :]
    backward = np.where(place >= 0, np.take_along_axis(letters, np.maximum(place, 0), 1), 0).astype(np.uint8)
    _, rank, common = _ordered(letters)  # distinct words are in order already
    back_order, back_rank, back_common = _ordered(backward)
    point = np.zeros(n, bool)
    point[row_of[is_point]] = True
    points_before = np.concatenate([[0], np.cumsum(point)])
    back_points_before = np.concatenate([[0], np.cumsum(point[back_order])])
    points_back = back_order[point[back_order]]  # word of each reverse rank among points
    back_place = np.empty(n, np.int64)
    back_place[points_back] = np.arange(len(points_back))
    tree = WaveletTree(back_place[point])
    found = []
    # at other positions than these, no two words differ for the first time
    for i in np.unique(common[1:n]) if n > 1 else ():
        active = np.flatnonzero((low <= i) & (i < high))
        for k in range(0, len(active), step):
            rows = active[k : k + step]
            ranks = rank[row_of[rows]]
            start, end = _interval(common, i, ranks)
            inner_start, inner_end = _interval(common, i + 1, ranks)
            some = np.flatnonzero((start < inner_start) | (inner_end < end))
            if not len(some):
                continue
            least, after = (back_points_before[x] for x in _interval(back_common, length - 1 - i, back_rank[row_of[rows[some]]]))
            for a, b in ((start, inner_start), (inner_end, end)):
                query, value = tree.report(points_before[a[some]], points_before[b[some]], least, after)
                found.append((rows[some[query]], points_back[value]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first_row = np.full(n, -1, np.int64)
    at = np.flatnonzero(is_point)
    first_row[row_of[at]] = at
    return np.concatenate([f[0] for f in found]), first_row[np.concatenate([f[1] for f in found])]


def _best(table: pa.Table) -> pa.Table:
    """For each word of a shard its number of partners there and the best of them."""
    words = np.array([w.encode(LETTERS) for w in table.column("word").to_pylist()], object)
    n, is_point = table.column("n").to_numpy(), table.column("is_point").to_numpy(zero_copy_only=False)
    length, low, high = (table.column(c).to_numpy() for c in ("length", "low", "high"))
    left, right = [], []
    for size in np.unique(length):
        rows = np.flatnonzero(length == size)
        a, b = near_pairs(list(words[rows]), is_point[rows], low[rows], high[rows], int(size))
        a, b = rows[a], rows[b]
        inserted = ~is_point[a]  # what inserting finds for one is what deleting finds for the other
        left += [a, b[inserted]]
        right += [b, a[inserted]]
    schema = arrow_schema(NEAR)
    if not left or not sum(map(len, left)):
        return schema.empty_table()
    left, right = np.concatenate(left), np.concatenate(right)
    names, word_of = np.unique(words, return_inverse=True)  # in code-point order
    who, partner = word_of[left], word_of[right]
    order = np.lexsort((partner, -n[right], who))
    first = np.flatnonzero(np.concatenate([[True], who[order][1:] != who[order][:-1]]))
    counts = np.diff(np.append(first, len(order)))
    best = order[first]
    decode = lambda ids: pa.array([names[i].decode(LETTERS) for i in ids], pa.string())
    return pa.Table.from_arrays([decode(who[best]), pa.array(counts, pa.int64()), pa.array(n[right[best]], pa.int64()), decode(partner[best])], schema=schema)


def _placed(words: DataFrame, ranges: Column) -> DataFrame:
    """A row for each of the ``ranges`` (length, low, high) of a word, with the letters that partners there share."""
    rows = words.select("*", F.explode(ranges).alias("r")).select(*words.columns, "r.*")
    before, after = F.substring(F.col("word"), F.lit(1), F.col("low")), F.expr("right(word, length - high)")
    return rows.withColumn("key", F.xxhash64("length", "low", before, after))


def _ranges(length: Column, low: Column, high: Column) -> Column:
    """The halves of a range of edit positions."""
    middle = F.floor((low + high) / 2).cast("int")
    return F.array(*(F.struct(length.cast("int").alias("length"), a.cast("int").alias("low"), b.cast("int").alias("high")) for a, b in ((low, middle), (middle, high))))


def near_words(words: DataFrame, shard_bytes: int = 8 << 20, group_bytes: int = 2 << 20) -> DataFrame:
    """(word, n_near, form_n, form) of each word that has a partner; ``words`` are (word, n), distinct and staged.

    A word is placed once for each half of the positions of its own length (edits that
    replace a letter) and of one letter more (that insert one), keyed by its letters
    outside that half.  Keys of more than ``group_bytes`` have their positions halved
    again, down to single ones, where a group is an alphabet.  Keys are dealt to shards
    of ``shard_bytes`` on average; a shard is one task's index.
    """
    size = F.length("word")
    own, longer = _ranges(size, F.lit(0), size), _ranges(size + 1, F.lit(0), size + 1)
    both = F.concat(F.transform(own, lambda r: r.withField("is_point", F.lit(True))), F.transform(longer, lambda r: r.withField("is_point", F.lit(False))))
    placed = staged(_placed(words, both), "spelling")
    weight = F.sum(F.length("word") + 24)
    for _ in range(64):  # a range of 2**63 letters is halved so often
        heavy = placed.where("high - low > 1").groupBy("key").agg(weight.alias("w")).where(F.col("w") > group_bytes).select(F.col("key").alias("heavy"))
        heavy = staged(heavy, "spelling-heavy")
        if not heavy.limit(1).count():
            break
        side = small_or_plain(heavy, 1_000_000)
        split = (F.col("high") - F.col("low") > 1) & F.col("heavy").isNotNull()
        marked = placed.join(side, F.col("key") == F.col("heavy"), "left")
        done, rest = marked.where(~split).drop("heavy"), marked.where(split).select("word", "n", F.col("length").alias("l"), F.col("low").alias("a"), F.col("high").alias("b"), F.col("is_point").alias("p"))
        halves = _placed(rest, F.transform(_ranges(F.col("l"), F.col("a"), F.col("b")), lambda r: r.withField("is_point", F.col("p")))).drop("l", "a", "b", "p")
        placed = staged(done.unionByName(halves), "spelling")
    total = placed.agg(weight).first()[0] or 0
    shards = 1 + total // shard_bytes
    dealt = placed.withColumn("shard", F.pmod(F.col("key"), F.lit(shards)))
    found = dealt.select("shard", "word", "n", "length", "low", "high", "is_point").groupBy("shard").applyInArrow(_best, NEAR)
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("form")))
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
    return found.select("word", "n_near", (-F.col("b.less")).alias("form_n"), F.col("b.form").alias("form"))


def roots(forms: DataFrame, max_broadcast: int = 200_000) -> DataFrame:
    """(word, root) of (word, form): the end of each chain of forms.

    Each round doubles the steps taken; counts at least double along a chain, so it
    has fewer than 64 steps and settles in seven rounds.
    """
    now = staged(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while now.where("moved").limit(1).count():
        onward = small_or_plain(now.select(F.col("word").alias("via"), F.col("root").alias("onward")), max_broadcast, "via", "onward")
        joined = now.join(onward, F.col("root") == F.col("via"), "left")
        now = staged(joined.select("word", F.coalesce("onward", "root").alias("root"), F.col("onward").isNotNull().alias("moved")), "roots")
    return now.select("word", "root")


def spelling_variants(docs: DataFrame, id_column: str = "doc_id", text: str = "text", least_letters: int = 5, least_n: int = 3, factor: int = 2, **index) -> DataFrame:
    """(word, form, root, n, n_near, form_n): every word with its number of near words, its form and the end of its chain.

    Words are runs of letters of whole texts, of at least ``least_letters`` letters and
    ``least_n`` occurrences; near words are one inserted, deleted or replaced letter
    apart.  The form is the near word of largest n (of several the smallest in code-point
    order) if it is at least ``factor`` times as frequent, else null, and then the word is its
    own root.  Null texts have no words and a null id counts as empty; rows of one id all
    count.  No words, no rows.  Only the id and the text are read, so extra columns don't
    matter.  A word of any length may be indexed: positions at which no two words differ
    cost nothing.
    """
    words = staged(word_counts(docs, id_column, text, least_letters, least_n), "words")
    near = near_words(words, **index).withColumnRenamed("word", "w")
    large = F.col("form_n") >= factor * F.col("n")
    table = words.join(near, F.col("word") == F.col("w"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(large, F.col("form")).alias("form"), F.when(large, F.col("form_n")).alias("form_n")
    )
    table = staged(table, "spelling-forms")
    ends = roots(table.where("form is not null").select("word", "form")).withColumnRenamed("word", "w")
    return table.join(ends, F.col("word") == F.col("w"), "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
