"""Lexical retrieval packing: windows filled with BM25 neighbours.

Documents are tokenized once, and whole windows are cut from long ones.  What is
left, an item, is staged with the profile (terms and counts) of its whole document.
Document frequencies and the mean length are summed over the whole corpus; then items
are sorted by their rarest terms, so that related ones share a shard, wherever they
stood in the input.  Each shard of bounded size is indexed (an inverted index of token
ids with the corpus's BM25 weights).  The next unused item seeds a window; its unused
neighbours, best first, fill it.  A piece that doesn't fit is cut, so every window is
full.  Items of different shards never meet.
"""

from __future__ import annotations

import functools
import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakework.llm.common import arrow_schema, small_slices, staged


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@dataclass(frozen=True)
class Packing:
    """``tokenizer`` is a path that executors can read (null: the installed vocabulary's).

    ``shard_terms`` bounds the (item, term) pairs of a shard.  Terms in one item of
    ``dense`` or more are rows of a matrix, the others lists of items.
    """

    tokenizer: str | None = None
    window: int = 1024
    separator: int = 0
    shard_docs: int = 4096
    shard_terms: int = 2_000_000
    place_terms: int = 8
    dense: int = 32
    seeds: int = 32
    k1: float = 1.2
    b: float = 0.75


PIECES = T.StructType(
    [T.StructField("doc_id", T.LongType())]
    + [T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
)
#: A whole window (without ids), or an item: a document's ids after its last whole window, numbered by ``row``.
#: ``terms`` and ``counts`` are the profile of a document of several windows; a shorter one's is that of its ids.
#: Each task's last row, number -1, has its documents' frequencies in ``terms`` and ``counts``, their number and tokens.
CUT = T.StructType([*PIECES.fields, T.StructField("row", T.LongType())] + [T.StructField(n, T.BinaryType()) for n in ("ids", "terms", "counts")])
#: Whole windows are numbered from here, so that they differ from the windows that are filled.
WHOLE = 1 << 62


@dataclass(frozen=True)
class Statistics:
    """Of the documents of the whole corpus: their number, their tokens, and in how many of them each token id stands."""

    n: int
    tokens: int
    df: np.ndarray


def _byte_alphabet() -> dict[str, int]:
    """Byte-level BPE writes printable bytes as themselves and the others, in order, as the characters from 256."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


@functools.lru_cache(maxsize=4)
def encoder(path: str):
    """A function from a list of texts to sequences of ids, equal to the ``tokenizers`` library's for this file.

    Where the file is byte-level BPE whose merges are in the order of their ids, a
    faster merge engine runs the same vocabulary; otherwise the library itself does.
    """
    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    alphabet, special = _byte_alphabet(), {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    merges = [m if isinstance(m, str) else " ".join(m) for m in model.get("merges", [])]
    ordered = all(model["vocab"].get(m.replace(" ", "")) == 256 + i for i, m in enumerate(merges))
    plain = spec.get("normalizer") is None and (spec.get("pre_tokenizer") or {}).get("type") == "ByteLevel" and not spec["pre_tokenizer"].get("add_prefix_space", False)
    if not (ordered and plain and model["type"] == "BPE"):
        slow = Tokenizer.from_file(path)
        return lambda texts: [e.ids for e in slow.encode_batch(texts, add_special_tokens=False)]
    ranks = {bytes(alphabet[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    fast = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)

    def encode(texts: list[str]) -> list[list[int]]:
        return [fast.encode_to_numpy(t, allowed_special="all") if any(s in t for s in special) else fast.encode_to_numpy(t, disallowed_special=()) for t in texts]

    return encode


class Index:
    """A BM25 inverted index over one shard's profiles (terms, counts), weighted by ``corpus`` (null: they are all there are).

    Frequent terms' lists are rows of a matrix, so that the scores of several seeds are
    one product; rare terms' lists are added to them.  Nothing is left out.
    """

    def __init__(self, profiles: list[tuple[np.ndarray, np.ndarray]], p: Packing, corpus: Statistics | None = None):
        self.p, self.n = p, len(profiles)
        sizes = np.array([len(t) for t, _ in profiles], np.int64)
        lengths = np.array([c.sum() for _, c in profiles], np.float64)
        owner = np.repeat(np.arange(self.n), sizes)
        counts = np.concatenate([c for _, c in profiles])
        terms, at, df = np.unique(np.concatenate([t for t, _ in profiles]), return_inverse=True, return_counts=True)
        n, all_df = (corpus.n, corpus.df[terms]) if corpus else (self.n, df)
        mean = corpus.tokens / corpus.n if corpus else lengths.mean()
        norm = p.k1 * (1 - p.b + p.b * lengths / max(mean, 1e-9))
        idf = np.log(1 + (n - all_df + 0.5) / (all_df + 0.5))
        self.weight = (counts * (p.k1 + 1) / (counts + norm[owner]) * idf[at]).astype(np.float32)
        self.owner = owner
        # a term of one item finds nobody
        dense, sparse = df >= max(2, self.n // p.dense), (df > 1) & (df < max(2, self.n // p.dense))
        row = np.cumsum(dense) - 1
        mine = dense[at]
        self.matrix = np.zeros((int(dense.sum()), self.n), np.float32)
        self.matrix[row[at[mine]], owner[mine]] = self.weight[mine]
        self.dense_terms, self.dense_starts = row[at[mine]], np.searchsorted(owner[mine], np.arange(self.n + 1))
        mine = sparse[at]
        order = np.argsort(at[mine], kind="stable")
        self.list_owner, self.list_weight = owner[mine][order], self.weight[mine][order]
        first = np.cumsum(np.where(sparse, df, 0)) - np.where(sparse, df, 0)
        self.list_first, self.list_size = first[at[mine]], df[at[mine]]
        self.sparse_starts = np.searchsorted(owner[mine], np.arange(self.n + 1))
        self.known: dict[int, np.ndarray] = {}

    def scores(self, seeds: np.ndarray) -> np.ndarray:
        """A row for each seed: the BM25 scores of all items for the seed's terms."""
        x = np.zeros((len(seeds), len(self.matrix)), np.float32)
        for k, i in enumerate(seeds):
            x[k, self.dense_terms[self.dense_starts[i] : self.dense_starts[i + 1]]] = 1
        out = x @ self.matrix
        spans = [np.arange(self.sparse_starts[i], self.sparse_starts[i + 1]) for i in seeds]
        term, seed = np.concatenate(spans), np.repeat(np.arange(len(seeds)), [len(s) for s in spans])
        size = self.list_size[term]
        place = np.arange(size.sum()) + np.repeat(self.list_first[term] - (np.cumsum(size) - size), size)
        flat = np.repeat(seed, size) * self.n + self.list_owner[place]
        return out + np.bincount(flat, self.list_weight[place], minlength=out.size).astype(np.float32).reshape(out.shape)

    def row(self, i: int, unused: np.ndarray) -> np.ndarray:
        """Item i's scores; those of the next unused items, likely seeds, are computed with them."""
        if i not in self.known:
            seeds = np.concatenate([[i], (i + 1 + np.flatnonzero(unused[i + 1 :][: 8 * self.p.seeds]))[: self.p.seeds - 1]])
            self.known = dict(zip(seeds.tolist(), self.scores(seeds), strict=True))
        return self.known[i]

    def neighbours(self, i: int, unused: np.ndarray) -> np.ndarray:
        """Unused items that share a term with item i, best first (ties: first first), by all its terms."""
        scores = np.where(unused, self.row(i, unused), 0)
        found = np.flatnonzero(scores)
        return found[np.argsort(-scores[found], kind="stable")]


def cut(doc_id, ids: np.ndarray, p: Packing) -> tuple[list[tuple], tuple]:
    """The whole windows of a document's ids (separator included), and what is left, perhaps nothing: (doc_id, start, ids, doc_tokens)."""
    total = len(ids)
    whole = total - total % p.window
    return [(doc_id, a, ids[a : a + p.window], total) for a in range(0, whole, p.window)], (doc_id, whole, ids[whole:], total)


def short(numbers: np.ndarray) -> bytes:
    """Numbers under 2**32 as bytes: their width, then two or four bytes each."""
    return b"\2" + numbers.astype("<u2").tobytes() if numbers.max(initial=0) < 1 << 16 else b"\4" + numbers.astype("<u4").tobytes()


def long(data: bytes) -> np.ndarray:
    """What ``short`` packed."""
    return np.frombuffer(data, "<u2" if data[0] == 2 else "<u4", offset=1).astype("<u4")


def profile(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids in order, and how often each stands."""
    return np.unique(ids, return_counts=True)


class Packer:
    """Packs a stream of documents or items; ``add``, ``add_item`` and ``finish`` return rows of pieces."""

    def __init__(self, p: Packing, first_sequence: int, corpus: Statistics | None = None):
        self.p, self.sequence, self.corpus = p, first_sequence, corpus
        self.items: list[list] = []
        self.profiles: list[tuple[np.ndarray, np.ndarray]] = []
        self.terms = 0
        self.open: list[tuple] = []  # pieces of a window that isn't full yet: (doc_id, start, ids, doc_tokens)
        self.space = p.window
        self.rows: list[tuple] = []

    def add(self, doc_id, ids) -> list[tuple]:
        ids = np.append(np.asarray(ids, "<u4"), np.array([self.p.separator], "<u4"))
        windows, item = cut(doc_id, ids, self.p)
        for piece in windows:
            self._emit([piece])
        if len(item[2]):
            return self.add_item(*item, profile(ids))
        out, self.rows = self.rows, []
        return out

    def add_item(self, doc_id, start: int, ids: np.ndarray, total: int, of: tuple[np.ndarray, np.ndarray]) -> list[tuple]:
        self.items.append([doc_id, start, ids, total])
        self.profiles.append(of)
        self.terms += len(of[0])
        if self.terms >= self.p.shard_terms or len(self.items) >= self.p.shard_docs:
            self._shard()
        out, self.rows = self.rows, []
        return out

    def finish(self) -> list[tuple]:
        self._shard()
        left = self.p.window - self.space
        while left:  # the last window: sequences whose lengths are powers of two need no padding
            size, filled, taken = 1 << (left.bit_length() - 1), 0, []
            while filled < size:
                doc_id, start, ids, total = self.open.pop(0)
                k = min(len(ids), size - filled)
                taken.append((doc_id, start, ids[:k], total))
                if k < len(ids):
                    self.open.insert(0, (doc_id, start + k, ids[k:], total))
                filled += k
            self._emit(taken)
            left -= size
        out, self.rows = self.rows, []
        return out

    def _emit(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, total in pieces:
            self.rows.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes()), total, self.sequence, offset))
            offset += len(ids)
        self.sequence += 1

    def _take(self, piece: tuple) -> None:
        self.open.append(piece)
        self.space -= len(piece[2])
        if not self.space:
            self._emit(self.open)
            self.open, self.space = [], self.p.window

    def _shard(self) -> None:
        items, profiles = self.items, self.profiles
        self.items, self.profiles, self.terms = [], [], 0
        if not items:
            return
        index = Index(profiles, self.p, self.corpus)
        unused, length = np.ones(len(items), bool), np.array([len(x[2]) for x in items])
        at = 0

        def take(i: int) -> None:
            item, k = items[i], min(length[i], self.space)
            piece = (item[0], item[1], item[2][:k], item[3])
            if k == length[i]:
                unused[i] = False
            else:  # the rest stays, under the same entry of the index
                item[1], item[2], length[i] = item[1] + k, item[2][k:], length[i] - k
            self._take(piece)

        while True:
            while at < len(items) and not unused[at]:
                at += 1
            if at == len(items):
                return
            seed, before = at, self.sequence
            take(seed)
            scores = index.row(seed, unused) if self.sequence == before else None
            while self.sequence == before:
                # the best unused neighbour that fits whole, or else the best one, cut
                able = np.where(unused, scores, 0)
                fits = np.where(length <= self.space, able, 0)
                best = int(fits.argmax())
                if not fits[best]:
                    best = int(able.argmax())
                if not able[best]:
                    break
                take(best)


def _batch(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


class _Frequencies:
    """Document frequencies, counted document by document."""

    def __init__(self):
        self.df, self.n, self.tokens = np.zeros(1 << 16, np.int64), 0, 0

    def add(self, ids: np.ndarray) -> None:
        if (top := int(ids.max())) >= len(self.df):
            self.df = np.pad(self.df, (0, top + 1))
        self.df[ids] += 1  # an id that stands several times is counted once by this
        self.n, self.tokens = self.n + 1, self.tokens + len(ids)

    def row(self) -> tuple:
        used = np.flatnonzero(self.df)
        return (None, self.n, self.tokens, None, None, None, None, -1, None, short(used), short(self.df[used]))


def cut_documents(docs: DataFrame, p: Packing) -> DataFrame:
    """Whole windows, items and frequencies (``CUT``) of documents (doc_id, text)."""
    schema = arrow_schema(CUT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, frequencies = encoder(p.tokenizer or default_tokenizer()), _Frequencies()
        row = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in small_slices(*batch.columns):
                rows = []
                for i, text in zip(part[0].to_pylist(), part[1].to_pylist(), strict=True):
                    x = np.append(np.asarray(encode([text or ""])[0], "<u4"), np.array([p.separator], "<u4"))
                    windows, (_, start, left, total) = cut(i, x, p)
                    for _, a, ids, _ in windows:
                        rows.append((i, a, len(ids), zlib.crc32(ids.tobytes()), total, WHOLE + row, 0, row, None, None, None))
                        row += 1
                    frequencies.add(x)
                    if len(left):
                        of = map(short, profile(x)) if windows else (None, None)
                        rows.append((i, start, len(left), None, total, None, None, row, short(left), *of))
                        row += 1
                yield from _batch(rows, schema)
        yield from _batch([frequencies.row()], schema)

    return docs.mapInArrow(run, CUT)


def _ids(column: pa.Array) -> list[np.ndarray]:
    return [long(x) for x in column.to_pylist()]


def _profiles(ids: pa.Array, terms: pa.Array, counts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    return [profile(long(x)) if t is None else (long(t), long(c)) for x, t, c in zip(ids.to_pylist(), terms.to_pylist(), counts.to_pylist(), strict=True)]


def _terms(ids: pa.Array, terms: pa.Array) -> list[np.ndarray]:
    return [np.unique(long(x)) if t is None else long(t) for x, t in zip(ids.to_pylist(), terms.to_pylist(), strict=True)]


def statistics(cuts: DataFrame) -> Statistics:
    """Counts over all documents.  The driver gets one row for each entry of the vocabulary that occurs."""
    pair = T.StructType([T.StructField("term", T.LongType()), T.StructField("df", T.LongType())])
    schema = arrow_schema(pair)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, tokens, terms, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                terms, counts = (long(x).astype(np.int64) for x in (terms, counts))
                yield pa.RecordBatch.from_arrays([pa.array(np.append(terms, [-2, -1])), pa.array(np.append(counts, [n, tokens]))], schema=schema)

    sums = {r.term: r.df for r in cuts.where("row = -1").select("start", "length", "terms", "counts").mapInArrow(run, pair).groupBy("term").agg(F.sum("df").alias("df")).collect()}
    n, tokens = sums.pop(-2, 0), sums.pop(-1, 0)
    df = np.zeros(max(sums, default=-1) + 1, np.int64)
    df[list(sums)] = list(sums.values())
    return Statistics(n, tokens, df)


def place_key(terms: np.ndarray, corpus: Statistics, p: Packing) -> bytes:
    """A document's rarest terms, rarest first, by which items are sorted into shards.

    Terms of fewer documents than an eighth of a shard (or a hundredth of the corpus)
    come last, as they gather too few.  Items that share a hot first term go on by the next.
    """
    df = corpus.df[terms]
    few = df < min(p.shard_docs // 8, corpus.n // 100)
    best = np.lexsort((terms, df, few))[: p.place_terms]
    return np.stack([df[best], terms[best]], axis=1).astype(">u4").tobytes()


def placed(items: DataFrame, corpus: Statistics, p: Packing) -> DataFrame:
    """Items in shard order: partitioned and sorted by ``place_key``; equal items are dealt by their numbers."""
    names = ("doc_id", "start", "doc_tokens", "row", "ids", "terms", "counts")
    keyed = T.StructType([CUT[n] for n in names] + [T.StructField("key", T.BinaryType())])
    schema = arrow_schema(keyed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = pa.array([place_key(t, corpus, p) for t in _terms(*batch.columns[4:6])], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, key], schema=schema)

    return items.select(*names).mapInArrow(run, keyed).repartitionByRange("key", "row").sortWithinPartitions("key", "row")


def pack(docs: DataFrame, params: Packing = Packing(), doc_id: str = "doc_id") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A null or empty text is one token, the separator.  Repeated rows are packed as
    often as they stand.  A null doc_id stays null.  Long texts are tokenized whole;
    their whole windows stand alone, and the rest is placed by the whole text.  Every
    sequence but at most ten of a partition is full; those have powers of two as
    lengths, so nothing is padded.  Items are staged and sorted, so a retried task
    gives the same pieces.
    """
    schema = arrow_schema(PIECES)
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    cuts = staged(cut_documents(texts, params), "packing")
    items = cuts.where(F.col("ids").isNotNull())
    corpus = statistics(cuts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(params, TaskContext.get().partitionId() << 32, corpus)
        for batch in batches:
            rows = []
            for i, start, total, ids, of in zip(*(batch.column(k).to_pylist() for k in range(3)), _ids(batch.column(3)), _profiles(*batch.columns[3:6]), strict=True):
                rows += packer.add_item(i, start, ids, total, of)
            yield from _batch(rows, schema)
        yield from _batch(packer.finish(), schema)

    filled = placed(items, corpus, params).select("doc_id", "start", "doc_tokens", "ids", "terms", "counts").mapInArrow(run, PIECES)
    return filled.union(cuts.where("ids is null and row >= 0").select(*PIECES.names))
