"""Near-duplicate groups by HyperMinHash.

A document's set of 5-word shingles becomes 2**7 registers; each stores the
leading zeros of its bucket's least hash (6 bits) and the bits after them
(10 bits).  Equal bands of four registers make candidates, a collision-corrected
estimate of the Jaccard similarity drops hopeless ones, and the full shingle
sets confirm the rest.  Empty buckets borrow another bucket's register for the
bands, or else the bands of short documents would be single shingles.
"""

from __future__ import annotations

import functools
import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakework.llm.common import arrow_column, fresh, mixed, powers, prefix_hash, small_or_plain, staged, word_bounds
from lakework.llm.components import connected_components


@dataclass(frozen=True)
class HyperMinHash:
    """Parameters.  With 32 bands of 4 a pair at similarity 0.75 is missed some 3 times in 100,000, averaged over set sizes.

    Sets of up to ``small`` shingles, and those that can be similar to one, also get
    prefix-filter keys, so that no pair with such a set is missed.
    ``sketch_bits`` of 128 may differ between sets of at least ``sketch_from``
    shingles: at similarity 0.75 some 16 do, with a standard deviation of 4.5.
    """

    words: int = 5
    bucket_bits: int = 7
    mantissa_bits: int = 10
    rows_per_band: int = 4
    percent: int = 75
    sigmas: float = 5.0
    small: int = 10
    sketch_from: int = 200
    sketch_bits: int = 40
    block_bytes: int = 16_000_000


_SHINGLE = 0xC2B2AE3D27D4EB4F


def shingle_hashes(text: str | None, words: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles.

    ASCII letters are lower-cased; words are runs of anything but space and \\t to
    \\r.  Fewer words than ``words`` make one shingle; none make an empty set.
    """
    data = (text or "").encode("utf-8", "surrogatepass").lower()
    start, end = word_bounds(data)
    if not len(start):
        return np.zeros(0, np.uint64)
    prefix = prefix_hash(data)
    word = mixed((prefix[end] - prefix[start]) * powers(len(prefix))[1][start] + (end - start).astype(np.uint64))
    size = min(words, len(word))
    total = np.full(len(word) - size + 1, size, np.uint64)
    for i in range(size):
        total = total * np.uint64(_SHINGLE) + word[i : len(word) - size + 1 + i]
    return np.unique(mixed(total))


def registers(hashes: np.ndarray, p: HyperMinHash) -> np.ndarray:
    """One 16-bit register a bucket: 1 + leading zeros, then mantissa; 0 for an empty bucket."""
    out = np.zeros(1 << p.bucket_bits, "<u2")
    if len(hashes):
        bucket = (hashes >> np.uint64(64 - p.bucket_bits)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))  # sorted: the least of its bucket
        rest = hashes[first] << np.uint64(p.bucket_bits)
        zeros = np.minimum(63 - np.frexp(np.maximum(rest, np.uint64(1)).astype(np.float64))[1] + 1, 62).astype(np.uint64)
        # frexp may round up to the next power of two; shifting by one bit less then keeps the leading one
        over = (rest << zeros) >> np.uint64(63) == 0
        zeros = np.where(over & (rest > 0), zeros + np.uint64(1), zeros)
        mantissa = ((rest << zeros) << np.uint64(1)) >> np.uint64(64 - p.mantissa_bits)
        out[bucket[first]] = ((zeros + np.uint64(1)) << np.uint64(p.mantissa_bits)) | mantissa
    return out


@functools.cache
def _probes(buckets: int) -> np.ndarray:
    """For each bucket the order in which it looks for a register to borrow."""
    rng = np.random.Generator(np.random.PCG64(20250601))
    return np.stack([np.concatenate([[i], rng.permutation(np.delete(np.arange(buckets), i))]) for i in range(buckets)])


def densified(found: np.ndarray) -> np.ndarray:
    """Registers in which each empty bucket has the value of the first used one in its own order."""
    probes = _probes(len(found))
    return found[probes[np.arange(len(found)), (found > 0)[probes].argmax(axis=1)]]


def prefix_keys(hashes: np.ndarray, p: HyperMinHash) -> list[int]:
    """The least hashes of a small set, or of one that can be similar to a small set: so many that similar sets must share one."""
    n = len(hashes)
    return hashes[: n + (-n * p.percent // 100) + 1].view(np.int64).tolist() if n * p.percent <= 100 * p.small else []


def expected_collisions(n: np.ndarray, m: np.ndarray, p: HyperMinHash) -> np.ndarray:
    """Registers of sets of sizes ``n`` and ``m`` that agree by chance alone.

    The large-set value of the HyperMinHash paper, 0.1699 * 2**(p - r) * 4nm/(n + m)**2;
    for smaller sets it is an upper bound, so the corrected estimate stays careful there.
    """
    ratio = 4.0 * n * m / np.maximum((n + m) ** 2, 1)
    return 0.169919487159739 * 2.0 ** (p.bucket_bits - p.mantissa_bits) * ratio


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray, p: HyperMinHash) -> tuple[np.ndarray, np.ndarray]:
    """Estimated similarities of rows of registers, and their standard deviations at the threshold."""
    used = np.maximum(((a > 0) | (b > 0)).sum(axis=1), 1)
    same = ((a == b) & (a > 0)).sum(axis=1)
    t = p.percent / 100
    return np.clip((same - expected_collisions(n, m, p)) / used, 0, 1), np.sqrt(t * (1 - t) / used)


FEATURES = T.StructType(
    [T.StructField("n_shingles", T.LongType()), T.StructField("digest", T.BinaryType()), T.StructField("registers", T.BinaryType()), T.StructField("used", T.BinaryType())]
    + [T.StructField("s0", T.LongType()), T.StructField("s1", T.LongType()), T.StructField("small", T.ArrayType(T.LongType()))]
)


def features(text: str | None, p: HyperMinHash) -> dict:
    """Set size, set digest, densified registers, which of them are the set's own, a 128-bit sketch, prefix keys."""
    hashes = shingle_hashes(text, p.words)
    if not len(hashes):
        return {"n_shingles": 0}
    found = registers(hashes, p)
    dense = densified(found)
    s0, s1 = np.packbits(dense & 1)[:16].view(">i8").tolist()
    return {"n_shingles": len(hashes), "digest": hashlib.md5(hashes.tobytes()).digest(), "registers": dense.tobytes(), "used": np.packbits(found > 0).tobytes(), "s0": s0, "s1": s1, "small": prefix_keys(hashes, p)}


def _promising(a: Column, used_a: Column, b: Column, used_b: Column, n: Column, m: Column, p: HyperMinHash) -> Column:
    """Can the pair still reach the similarity, by the estimate from the sets' own registers?"""

    @F.arrow_udf(T.BooleanType())
    def apply(a: pa.Array, used_a: pa.Array, b: pa.Array, used_b: pa.Array, n: pa.Array, m: pa.Array) -> pa.Array:
        if not len(a):
            return pa.array([], pa.bool_())

        def rows(x: pa.Array, used: pa.Array) -> np.ndarray:
            own = np.unpackbits(np.frombuffer(b"".join(used.to_pylist()), np.uint8)).reshape(len(x), -1)
            return np.frombuffer(b"".join(x.to_pylist()), "<u2").reshape(len(x), -1) * own

        value, sigma = estimate(rows(a, used_a), rows(b, used_b), n.to_numpy(zero_copy_only=False).astype(float), m.to_numpy(zero_copy_only=False).astype(float), p)
        return pa.array(value + p.sigmas * sigma >= p.percent / 100)

    return apply(a, used_a, b, used_b, n, m)


def _common(a: Column, b: Column) -> Column:
    """The size of the intersection of two sorted sets of hashes."""

    def one(x: bytes, y: bytes) -> int:
        x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        if len(x) > len(y):
            x, y = y, x
        at = np.minimum(np.searchsorted(y, x), len(y) - 1)
        return int((y[at] == x).sum())

    return arrow_column(lambda xs, ys: [one(x, y) for x, y in zip(xs, ys, strict=True)], T.LongType(), a, b)


class _Links:
    """Confirms candidate pairs (a, b) of classes, from the classes' registers and full sets."""

    def __init__(self, docs: DataFrame, classes: DataFrame, p: HyperMinHash):
        self.docs, self.classes, self.p = docs, classes, p

    def sets(self, wanted: DataFrame) -> DataFrame:
        """(w, s): the full sets of classes (w, doc), each computed from one of its documents."""
        size = self.p.words
        wanted = wanted.select("w", F.col("doc.id").alias("w_id"), F.col("doc.hash").alias("w_hash"))
        texts = self.docs.join(wanted, F.col("id").eqNullSafe(F.col("w_id")) & (F.col("hash") == F.col("w_hash")))
        sets = texts.select("w", arrow_column(lambda ts: [shingle_hashes(t, size).tobytes() for t in ts], T.BinaryType(), F.col("text")).alias("s"))
        # repeated rows give equal sets; staged without them, so that nothing stands between a join and its shuffle
        return staged(sets.dropDuplicates(["w"]), "sets")

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        side = lambda k: self.classes.select(F.col("digest").alias(k), F.col("registers").alias(f"r_{k}"), F.col("used").alias(f"u_{k}"), F.col("n_shingles").alias(f"n_{k}"), F.col("doc").alias(f"doc_{k}"))
        p = self.p
        near = pairs.join(side("a"), "a").join(side("b"), "b")
        near = near.where(_promising(F.col("r_a"), F.col("u_a"), F.col("r_b"), F.col("u_b"), F.col("n_a"), F.col("n_b"), p))
        near = staged(near.select("a", "b", "n_a", "n_b", "doc_a", "doc_b"), "candidates")
        sets = self.sets(near.select(F.col("a").alias("w"), F.col("doc_a").alias("doc")).union(near.select("b", "doc_b")).distinct())
        # a leads its bucket and may be in very many pairs: its set comes last, where skewed pairs are split and sets aren't shuffled on
        full = near.select("a", "b", "n_a", "n_b").join(sets.select(F.col("w").alias("b"), F.col("s").alias("s_b")), "b").join(sets.select(F.col("w").alias("a"), F.col("s").alias("s_a")), "a")
        common = full.select("a", "b", "n_a", "n_b", _common(F.col("s_a"), F.col("s_b")).alias("i"))
        return staged(common.where(100 * F.col("i") >= p.percent * (F.col("n_a") + F.col("n_b") - F.col("i"))).select("a", "b"), "confirmed")


def near_duplicates(docs: DataFrame, params: HyperMinHash = HyperMinHash(), doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``.

    A document is kept if its id is the least of its component (``<=>``, so a null id
    whose component has null ids only is kept).  A null or empty text has an empty
    set and is a component of its own.  Rows that repeat an id and its text are all
    kept or all not.  Equal sets are one class, however many documents have it, so
    thousands of copies cost one candidate.  Long texts are shingled whole.

    Candidates come in two passes.  First each bucket's members against its least
    class: linear in the bucket's size, and enough for buckets that hold one group.
    Then, only for buckets that still hold several components, members of different
    components against each other, in blocks of bounded size; nothing is capped.
    """
    rows = _rows(docs, doc_id)
    one = staged(rows.select("id", "hash", arrow_column(lambda ts: [features(t, params) for t in ts], FEATURES, F.col("text")).alias("f")).select("id", "hash", "f.*"), "shingles")
    return _assigned(rows, one, params).select(F.col("id").alias(doc_id), "n_shingles", F.col("component").alias("component_id"), F.col("id").eqNullSafe(F.col("component")).alias("kept"))


def _possible(n: Column, s0: Column, s1: Column, m: Column, t0: Column, t1: Column, p: HyperMinHash) -> Column:
    """What set sizes and sketches allow; cheap enough to be a join's condition, so hopeless pairs are never made."""
    differ = F.bit_count(s0.bitwiseXOR(t0)) + F.bit_count(s1.bitwiseXOR(t1))
    return (100 * F.least(n, m) >= p.percent * F.greatest(n, m)) & ((F.least(n, m) < p.sketch_from) | (differ <= p.sketch_bits))


PAIRS = T.StructType([T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType())])


def _cluster_links(rest: DataFrame, classes: DataFrame, links: _Links, p: HyperMinHash) -> DataFrame:
    """Links between different components (``root``) of classes that met in open buckets (``first``).

    Classes that meet directly or through others form a cluster.  A cluster's sets
    are joined through an inverted index in one task if they fit, else in blocks:
    each pair of blocks is a task, so no task grows with the cluster and no pairs
    of classes are ever rows; only links that join components are.
    """
    clusters = connected_components(rest.select(F.col("first").alias("a"), F.col("digest").alias("b"))).select("node", F.col("root").alias("cluster"))
    nodes = rest.select("digest", F.col("root").alias("component")).distinct().join(clusters, F.col("digest") == F.col("node")).select("digest", "component", "cluster")
    nodes = staged(nodes, "clusters")
    wanted = nodes.join(classes.select(F.col("digest").alias("w"), "doc"), F.col("digest") == F.col("w")).select("w", "doc")
    sets = links.sets(wanted).join(nodes, F.col("w") == F.col("digest")).select("digest", "component", "cluster", "s")
    sets = staged(sets, "cluster-sets")
    sizes = sets.groupBy(F.col("cluster").alias("c")).agg(F.ceil(F.sum(F.length("s")) / p.block_bytes).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int")
    placed = sets.join(sizes, F.col("cluster") == F.col("c")).withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    units = placed.select("cluster", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "digest", "component", "s")
    # dealt by all three columns: rows that are already dealt by cluster would leave a cluster's units to one task
    found = units.repartition("cluster", "low", "high").groupBy("cluster", "low", "high").applyInArrow(lambda t: _joined(t, p.percent), PAIRS)
    return staged(found.distinct(), "cluster-links")


def _joined(table: pa.Table, percent: int) -> pa.Table:
    """Links of one unit between different components, no more than join them."""
    names, components = table.column("digest").to_pylist(), table.column("component").to_pylist()
    sets = [np.frombuffer(s, np.uint64) for s in table.column("s").to_pylist()]
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets), dtype=np.int32), sizes)
    everything = np.concatenate(sets)
    order = np.argsort(everything)
    everything, owner = everything[order], owner[order]
    number = {c: i for i, c in enumerate(dict.fromkeys(components))}
    group = np.array([number[c] for c in components])
    largest = np.bincount(group).argmax()
    out: list[tuple[bytes, bytes]] = []
    # all pairs of different components have a member outside the largest one
    for i in np.flatnonzero(group != largest):
        low, high = np.searchsorted(everything, sets[i]), np.searchsorted(everything, sets[i], "right")
        count = high - low
        at = np.arange(count.sum()) + np.repeat(low - np.concatenate([[0], np.cumsum(count)[:-1]]), count)
        common = np.bincount(owner[at], minlength=len(sets))
        for j in np.flatnonzero((100 * common >= percent * (sizes + sizes[i] - common)) & (group != group[i])):
            if group[j] != group[i]:
                out.append((min(names[i], names[j]), max(names[i], names[j])))
                group[group == group[j]] = group[i]
    return pa.table([pa.array([x[k] for x in out], pa.binary()) for k in (0, 1)], names=["a", "b"])


def _rows(docs: DataFrame, doc_id: str) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("hash"), text.alias("text"))


def _assigned(rows: DataFrame, one: DataFrame, p: HyperMinHash) -> DataFrame:
    classes = one.where("digest is not null").groupBy("digest").agg(F.min(F.struct("id", "hash")).alias("doc"), F.min("id").alias("least"), *(F.first(c).alias(c) for c in FEATURES.names if c != "digest"))
    classes = staged(classes, "classes")
    width, n_bands = 2 * p.rows_per_band, (1 << p.bucket_bits) // p.rows_per_band
    band = lambda i: F.xxhash64(i, F.substring(F.col("registers"), F.lit(1) + i * width, F.lit(width)))
    keys = F.concat(F.transform(F.sequence(F.lit(0), F.lit(n_bands - 1)), band), F.col("small"))
    size = ["n_shingles", "s0", "s1"]
    bands = classes.select("digest", *size, F.explode(keys).alias("key"))
    buckets = bands.groupBy("key").agg(F.min(F.struct("digest", *size)).alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1").select("key", "leader")
    buckets = staged(buckets, "leaders")
    members = staged(bands.join(buckets, "key"), "buckets")

    links = _Links(rows, classes, p)
    led = members.where((F.col("digest") != F.col("leader.digest")) & _possible(*(F.col(c) for c in size), *(F.col(f"leader.{c}") for c in size), p))
    first = staged(led.select(F.col("leader.digest").alias("a"), F.col("digest").alias("b")).distinct(), "pairs")
    confirmed = links.confirmed(first)
    roots = staged(connected_components(confirmed), "roots")

    placed = members.join(roots, F.col("digest") == F.col("node"), "left").select("key", "digest", F.coalesce("root", "digest").alias("root"))
    state = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.min("digest").alias("first"), F.count(F.lit(1)).alias("n"))
    open_buckets = staged(state.where("low <> high and n > 2").select("key", "first"), "open")
    rest = staged(placed.join(open_buckets, "key").select("digest", "root", "first").distinct(), "open-buckets")
    more = _cluster_links(rest, classes, links, p)
    if not more.isEmpty():
        roots = staged(connected_components(confirmed.union(more)), "roots")

    least = staged(classes.join(roots, F.col("digest") == F.col("node"), "left").select("digest", F.coalesce("root", "digest").alias("root"), "least"), "least")
    of_root = staged(least.groupBy(F.col("root").alias("r")).agg(F.min("least").alias("component")), "components")
    component = least.join(of_root, F.col("root") == F.col("r")).select(F.col("digest").alias("c_digest"), "component")
    return one.join(component, F.col("digest") == F.col("c_digest"), "left").select("id", "hash", "n_shingles", F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("component")).alias("component"))


def keep_one(docs: DataFrame, params: HyperMinHash = HyperMinHash(), doc_id: str = "doc_id", max_broadcast: int = 100_000) -> DataFrame:
    """``docs`` without the documents that ``near_duplicates`` doesn't keep; all columns, no others."""
    rows = _rows(docs, doc_id)
    one = staged(rows.select("id", "hash", arrow_column(lambda ts: [features(t, params) for t in ts], FEATURES, F.col("text")).alias("f")).select("id", "hash", "f.*"), "shingles")
    dropped = _assigned(rows, one, params).where(~F.col("id").eqNullSafe(F.col("component"))).select(F.col("id").alias("_d_id"), F.col("hash").alias("_d_hash")).distinct()
    dropped = small_or_plain(staged(dropped, "dropped"), max_broadcast)
    row = fresh(docs, "row")
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias(row))
    kept = packed.join(dropped, F.col(row)[doc_id].eqNullSafe(F.col("_d_id")) & (F.xxhash64(F.col(row)["text"].cast("string")) == F.col("_d_hash")), "left_anti")
    return kept.select(*(F.col(row)[c].alias(c) for c in docs.columns))
