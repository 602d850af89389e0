"""Removal of long repeats by a run-length index.

Every 200-byte string is assigned to the least hash among its 64-byte substrings
(its anchor), so equal strings have the same anchor wherever they stand.  The
consecutive strings of one anchor in a document are a claim.  Claims whose
anchor occurs once in the corpus can't repeat; claims that are equal as a whole
repeat as a whole; only differing claims of one anchor go to shards, each of
which builds a run-length index of bounded size and streams matching statistics.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakework.llm.common import arrow_column, arrow_map, arrow_schema, fresh, prefix_hash, range_hash, small_or_plain, staged, window_hashes
from lakework.llm.rindex import RunLengthIndex, runs


@dataclass(frozen=True)
class Repeats:
    """``shard_bytes`` bounds an index; an anchor with more differing claims than that is refined by longer anchors first.

    ``max_broadcast`` bounds the claims or ranges that a join may broadcast; with some 64
    bytes each, and more for the rows that hold them, that is 50 MB.
    """

    length: int = 200
    anchor: int = 64
    shard_bytes: int = 2_000_000
    max_broadcast: int = 750_000


CLAIMS = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("id", "hash", "anchor", "claim")] + [T.StructField(n, T.IntegerType()) for n in ("pos", "size")] + [T.StructField("multi", T.BooleanType())]
)
SEGMENTS = T.StructType([T.StructField("anchor", T.LongType()), T.StructField("claim", T.LongType()), T.StructField("bytes", T.BinaryType())])
MARKS = T.StructType([T.StructField("anchor", T.LongType()), T.StructField("claim", T.LongType()), T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])
STRINGS = T.StructType([T.StructField(n, T.LongType()) for n in ("anchor", "claim", "x", "y")] + [T.StructField("at", T.IntegerType())])
SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
KEPT = T.StructType([T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")] + [T.StructField("kept_sha256", T.StringType()), T.StructField("spans", SPANS)])
#: Ranges of positions [a, b), merged.
RANGES = T.ArrayType(T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())]))


def _window_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values, by prefix and suffix minima of blocks."""
    n = len(values)
    blocks = np.concatenate([values, np.full(-n % width, np.iinfo(values.dtype).max, values.dtype)]).reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[: n - width + 1], forward[width - 1 : n])


def claims_of(data: bytes, p: Repeats) -> tuple[np.ndarray, ...] | None:
    """(anchor, claim hash, first string's position, number of strings, anchor repeated?) of a text; null if it is short."""
    if len(data) < p.length:
        return None
    prefix = prefix_hash(data)
    values = window_hashes(prefix, p.anchor)
    width = p.length - p.anchor + 1
    least = _window_min(values, width)
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    end = np.append(first[1:], len(least))
    value = least[first]
    # a claim can only repeat within itself if its anchor stands more than once in the text
    ordered = np.sort(values)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    multi = np.isin(value, twice) if len(twice) else np.zeros(len(value), bool)
    return value, range_hash(prefix, first, end - 1 + p.length), first, end - first, multi


def _bytes(text: str | bytes | None) -> bytes:
    return text if isinstance(text, bytes) else (text or "").encode("utf-8", "surrogatepass")


def _claims(rows: DataFrame, p: Repeats) -> DataFrame:
    schema = arrow_schema(CLAIMS)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0
        for id_, hash_, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            found = claims_of(_bytes(text), p)
            if found is not None:
                anchor, claim, pos, size, multi = found
                k = len(anchor)
                parts.append((pa.array([id_] * k, pa.int64()), pa.array(np.full(k, hash_, np.int64)), pa.array(anchor.view(np.int64)), pa.array(claim.view(np.int64)), pa.array(pos.astype(np.int32)), pa.array(size.astype(np.int32)), pa.array(multi)))
                n += k
            if n > 100_000:
                yield _batch(parts, schema)
                parts, n = [], 0
        if parts:
            yield _batch(parts, schema)

    return arrow_map(rows.select("id", "hash", "text"), run, CLAIMS)


def _batch(parts: list[tuple[pa.Array, ...]], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in zip(*parts, strict=True)], schema=schema)


def _segments(rows: DataFrame, wanted: DataFrame, p: Repeats) -> DataFrame:
    """The bytes of each wanted claim, cut from the document that stands for it."""
    by_doc = wanted.groupBy("src.id", "src.hash").agg(F.collect_list(F.struct("anchor", "claim", "src.pos", "src.size")).alias("list"))
    by_doc = by_doc.select(F.col("id").alias("s_id"), F.col("hash").alias("s_hash"), "list")
    by_doc = F.broadcast(by_doc) if wanted.count() <= p.max_broadcast else by_doc
    joined = rows.join(by_doc, F.col("id").eqNullSafe(F.col("s_id")) & (F.col("hash") == F.col("s_hash"))).select("text", "list")
    schema = arrow_schema(SEGMENTS)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for text, claims in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            data = _bytes(text)
            cut = [(c["anchor"], c["claim"], data[c["pos"] : c["pos"] + c["size"] - 1 + p.length]) for c in claims]
            for a in range(0, len(cut), 1000):
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*cut[a : a + 1000], strict=True), schema, strict=True)], schema=schema)

    # repeated rows cut the same claims again; they are dropped where shards are read
    return arrow_map(joined, run, SEGMENTS)


def _index_shard(p: Repeats):
    schema = arrow_schema(MARKS)

    def run(table: pa.Table) -> pa.Table:
        unique = {(a, c): s for a, c, s in zip(*(table.column(n).to_pylist() for n in ("anchor", "claim", "bytes")), strict=True)}
        names = sorted(unique)
        out = []
        for (a, c), marks in zip(names, RunLengthIndex([unique[k] for k in names]).long_matches(p.length), strict=True):
            out += [(a, c, x, y) for x, y in runs(marks)]
        return pa.table([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True) if out else [[]] * 4, schema, strict=True)], schema=schema)

    return run


def _refined_marks(segments: DataFrame, p: Repeats) -> DataFrame:
    """Marks of anchors with very many claims: the claims' own repeats, by anchors nearly as long as the strings.

    Claims that agree around a longer anchor are far fewer; what is still too much
    for a shard is counted string by string.
    """
    segments = segments.dropDuplicates(["anchor", "claim"])
    longer = p.length * 4 // 5
    if p.anchor >= longer:
        return _string_marks(segments, p)
    rows = segments.select(F.col("anchor").alias("id"), F.col("claim").alias("hash"), F.col("bytes").alias("text"))
    ranges = repeated_ranges(rows, replace(p, anchor=longer)).select("m_id", "m_hash", F.explode("ranges").alias("r"))
    return ranges.select(F.col("m_id").alias("anchor"), F.col("m_hash").alias("claim"), "r.a", "r.b")


def _string_marks(segments: DataFrame, p: Repeats) -> DataFrame:
    """Marks of an anchor with very many claims: every string counted by its 128-bit hash, in a distributed aggregation."""
    schema = arrow_schema(STRINGS)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for anchor, claim, data in zip(*(batch.column(n).to_pylist() for n in ("anchor", "claim", "bytes")), strict=True):
            x, at = prefix_hash(data), np.arange(len(data) - p.length + 1)
            y = prefix_hash(data[::-1])
            back = len(data) - at - p.length
            columns = [np.full(len(at), anchor), np.full(len(at), claim), range_hash(x, at, at + p.length).view(np.int64), range_hash(y, back, back + p.length).view(np.int64), at.astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    strings = staged(arrow_map(segments.select("anchor", "claim", "bytes"), run, STRINGS), "strings")
    twice = strings.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("x", "y")
    return strings.join(twice, ["x", "y"]).select("anchor", "claim", F.col("at").alias("a"), (F.col("at") + 1).alias("b"))


def removed_spans(ranges: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Maximal byte runs covered by strings that start in the given ranges."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], b - 1 + length)
        else:
            out.append((a, b - 1 + length))
    return out


def _cut(data: bytes, spans: list[tuple[int, int]]) -> Iterator[bytes]:
    at = 0
    for a, b in spans:
        yield data[at:a]
        at = b
    yield data[at:]


def _kept(text: str | None, ranges: list | None, length: int) -> dict:
    data = _bytes(text)
    spans = removed_spans([(r["a"], r["b"]) for r in ranges or []], length)
    kept = hashlib.sha256()
    for part in _cut(data, spans):
        kept.update(part)
    return {"n_bytes": len(data), "n_removed": sum(b - a for a, b in spans), "n_spans": len(spans), "kept_sha256": kept.hexdigest(), "spans": [{"start": a, "end": b} for a, b in spans]}


def _merged(ranges: list[dict]) -> list[dict]:
    """Ranges in order, touching ones as one, so that a copied text is a single range."""
    out: list[dict] = []
    for r in sorted(ranges, key=lambda r: (r["a"], r["b"])):
        if out and r["a"] <= out[-1]["b"]:
            out[-1]["b"] = max(out[-1]["b"], r["b"])
        else:
            out.append(dict(r))
    return out


def repeated_ranges(rows: DataFrame, p: Repeats) -> DataFrame:
    """(m_id, m_hash, ranges): for each text with repeats, ranges of positions whose next ``length`` bytes occur elsewhere."""
    claims = staged(_claims(rows, p), "claims")
    anchors = claims.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("claim").alias("low"), F.max("claim").alias("high"), F.max("multi").alias("any_multi"))
    alike = (F.col("low") == F.col("high")) & ~F.col("any_multi")
    anchors = anchors.where((F.col("n") > 1) | F.col("any_multi")).select("anchor", alike.alias("alike"))
    # staged, so that nothing stands between the join and its shuffle, and claims of a very common anchor are split
    found = staged(claims.join(staged(anchors, "anchors"), "anchor"), "repeated-claims")
    whole = lambda df: df.select("id", "hash", F.col("pos").alias("a"), (F.col("pos") + F.col("size")).alias("b"))

    differing = found.where(~F.col("alike"))
    kinds = differing.groupBy("anchor", "claim").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "hash", "pos", "size")).alias("src"))
    kinds = staged(kinds, "claim-kinds")
    segments = staged(_segments(rows, kinds, p), "segments")
    # shards by anchor, of about the bytes that an index may have; anchors over that are refined first
    sizes = segments.groupBy("anchor").agg(F.sum(F.length("bytes") + 1).alias("anchor_bytes"))
    sizes = staged(sizes, "anchor-sizes")
    total = sizes.agg(F.sum("anchor_bytes")).first()[0] or 0
    # small anchors are dealt by hash into shards of a quarter's mean size; one over that quarter is a shard of its own
    n_shards = max(1, -(-4 * total // p.shard_bytes))
    large = sizes.where(F.col("anchor_bytes") > p.shard_bytes // 4).select(F.col("anchor").alias("large"), (F.col("anchor_bytes") > p.shard_bytes).alias("big"))
    refined, sized = None, segments.withColumns({"large": F.lit(None).cast("long"), "big": F.lit(False)})
    if not large.isEmpty():
        large = staged(large, "large-anchors")
        sized = segments.join(small_or_plain(large, p.max_broadcast), F.col("anchor") == F.col("large"), "left")
        if not large.where("big").isEmpty():
            refined = _refined_marks(sized.where("big").select(*SEGMENTS.names), p)
    shard = F.when(F.col("large").isNull(), F.pmod(F.xxhash64("anchor"), F.lit(n_shards))).otherwise(F.col("large")).alias("shard")
    normal = sized.where(~F.coalesce("big", F.lit(False))).select(F.col("large").isNotNull().alias("alone"), shard, *SEGMENTS.names)
    marks = normal.groupBy("alone", "shard").applyInArrow(_index_shard(p), MARKS)
    marks = staged(marks if refined is None else marks.union(refined), "marks")
    # claims that occur more than once repeat as a whole, the others where the index says so
    several = kinds.where("n > 1").select("anchor", "claim")
    once = kinds.where("n = 1").join(marks, ["anchor", "claim"]).select("src.id", "src.hash", (F.col("src.pos") + F.col("a")).alias("a"), (F.col("src.pos") + F.col("b")).alias("b"))
    ranges = whole(found.where("alike")).union(whole(differing.join(several, ["anchor", "claim"]))).union(once)
    # repeated rows give equal ranges, which sets drop before they are shuffled
    lists = ranges.groupBy(F.col("id").alias("m_id"), F.col("hash").alias("m_hash")).agg(F.collect_set(F.struct("a", "b")).alias("all"))
    return lists.select("m_id", "m_hash", arrow_column(lambda xs: [_merged(x) for x in xs], RANGES, F.col("all")).alias("ranges"))


def _with_ranges(docs: DataFrame, params: Repeats, doc_id: str, packed: Column | None = None) -> DataFrame:
    """(id, hash, text, ranges), and ``packed`` as ``row``; one row per row of ``docs``."""
    text = F.col("text").cast("string")
    extra = [] if packed is None else [packed.alias("row")]
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.xxhash64(text).alias("hash"), text.alias("text"), *extra)
    ranges = staged(repeated_ranges(rows.select("id", "hash", "text"), params), "ranges")
    n = ranges.agg(F.sum(F.size("ranges") + 2)).first()[0] or 0
    ranges = F.broadcast(ranges) if n <= params.max_broadcast else ranges
    return rows.join(ranges, F.col("id").eqNullSafe(F.col("m_id")) & (F.col("hash") == F.col("m_hash")), "left")


def remove_repeats(docs: DataFrame, params: Repeats = Repeats(), doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans), one row per row of ``docs``.

    A byte is removed if a ``length``-byte string that covers it also starts anywhere
    else in the corpus, in the same text included.  ``spans`` are the maximal removed
    runs, as byte offsets.  A null text counts as empty.  Rows that repeat an id and
    its text are copies of each other: all of them lose what repeats.  Texts under
    ``length`` bytes lose nothing; long ones are searched whole.
    """
    length = params.length
    column = arrow_column(lambda ts, rs: [_kept(t, r, length) for t, r in zip(ts, rs, strict=True)], KEPT, F.col("text"), F.col("ranges"))
    return _with_ranges(docs, params, doc_id).select(F.col("id").alias(doc_id), column.alias("k")).select(doc_id, "k.*")


def without_repeats(docs: DataFrame, params: Repeats = Repeats(), doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with each text's remaining bytes in ``kept``, or another name if ``docs`` has that; all columns, no others.

    Bytes, as a removed run may end within a character.  See ``remove_repeats`` for the cases.
    """
    length = params.length

    def one(text, ranges):
        return b"".join(_cut(_bytes(text), removed_spans([(r["a"], r["b"]) for r in ranges or []], length)))

    column = arrow_column(lambda ts, rs: [one(t, r) for t, r in zip(ts, rs, strict=True)], T.BinaryType(), F.col("text"), F.col("ranges"))
    joined = _with_ranges(docs, params, doc_id, F.struct(*(F.col(f"`{c}`") for c in docs.columns)))
    return joined.select(*(F.col("row")[c].alias(c) for c in docs.columns), column.alias(fresh(docs, "kept")))
