"""Exact duplicates, decided on whole byte strings in Patricia tries.

Texts without their whitespace are dealt to partitions by length and content hash
and inserted into compressed radix tries; a terminal node holds the best owner of
its text and how many rows have it.  Each task that reads documents has a trie of
its own first, so of a text's copies one row per task is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakework.llm.common import arrow_column, arrow_schema, fresh, small_or_plain, small_slices, staged

#: What texts may differ in: [\x20\x09-\x0D].
WHITESPACE = b" \t\n\x0b\x0c\r"

#: Bytes of texts that a task's trie holds before it gives up its largest subtree.
TRIE_BYTES = 48 << 20


def normal_bytes(text: str | None) -> bytes:
    """The text's UTF-8 bytes without whitespace; a null is empty."""
    return (text or "").encode("utf-8", "surrogatepass").translate(None, WHITESPACE)


def first_difference(a: bytes, b: bytes) -> int | None:
    """Where two strings differ first (an end differs from any byte); None if they are equal."""
    if a == b:
        return None
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:  # a[:lo] == b[:lo], and they differ at hi or before
        mid = min((lo + hi) // 2, lo + 4096) if lo + 1 < hi else lo
        if a[lo : mid + 1] == b[lo : mid + 1]:
            lo = mid + 1
        else:
            hi = mid
    return lo


class Terminal:
    """A whole text, its best owner so far (most code points, then smallest id; null ids last), and its rows."""

    __slots__ = ("key", "digest", "rank", "owner", "chars", "n")

    def __init__(self, key: bytes, digest: str | None):
        self.key, self.digest, self.rank, self.owner, self.chars, self.n = key, digest, None, None, 0, 0

    def add(self, owner, chars: int, n: int = 1) -> None:
        rank = (-chars, owner is None, owner)
        if self.n == 0 or rank[:2] < self.rank[:2] or (rank[:2] == self.rank[:2] and owner is not None and owner < self.owner):
            self.rank, self.owner, self.chars = rank, owner, chars
        self.n += n


class _Branch:
    """An inner node: all texts below agree on the bytes before ``at`` and differ there (-1: the text ends)."""

    __slots__ = ("at", "children")

    def __init__(self, at: int, children: dict):
        self.at, self.children = at, children


class _Spilled:
    """Where a subtree was; ``sample`` is one of its texts, and texts that agree with it up to ``depth`` bytes belong to it."""

    __slots__ = ("key", "depth")

    def __init__(self, sample: bytes, depth: int):
        self.key, self.depth = sample, depth


def _symbol(key: bytes, at: int) -> int:
    return key[at] if at < len(key) else -1


class Trie:
    """A compressed radix trie of byte strings; nodes hold the byte they branch at, and only terminals whole strings."""

    def __init__(self):
        self.root, self.bytes = None, 0

    def find_or_add(self, key: bytes, digest: str | None = None) -> Terminal | None:
        """The key's terminal, a new one where it has none, or None if its subtree was spilled."""
        if self.root is None:
            return self._leaf(key, digest, None, None)
        node = self.root
        while type(node) is _Branch:
            node = node.children.get(_symbol(key, node.at)) or next(iter(node.children.values()))
        # every text below the last branch agrees with this one up to there, so one comparison decides
        at = first_difference(key, node.key)
        if type(node) is _Spilled:
            if at is None or at >= node.depth:
                return None
        elif at is None:
            return node
        above, node = None, self.root
        while type(node) is _Branch and node.at < at:
            above, node = node, node.children[_symbol(key, node.at)]
        if type(node) is _Branch and node.at == at:
            return self._leaf(key, digest, node, at)
        other = node
        while type(other) is _Branch:
            other = next(iter(other.children.values()))
        branch = _Branch(at, {_symbol(other.key, at): node})
        if above is None:
            self.root = branch
        else:
            above.children[_symbol(key, above.at)] = branch
        return self._leaf(key, digest, branch, at)

    def _leaf(self, key: bytes, digest: str | None, branch: _Branch | None, at: int | None) -> Terminal:
        leaf = Terminal(key, digest)
        self.bytes += len(key)
        if branch is None:
            self.root = leaf
        else:
            branch.children[_symbol(key, at)] = leaf
        return leaf

    def terminals(self, node=None) -> Iterator[Terminal]:
        stack = [self.root if node is None else node]
        while stack:
            node = stack.pop()
            if type(node) is _Branch:
                stack.extend(node.children.values())
            elif type(node) is Terminal:
                yield node

    def spill(self, closed: bool) -> list[Terminal]:
        """Take the root's subtree of most bytes out and return its terminals.

        ``closed``: the subtree stays away, and its texts get no terminal any more.
        Nothing is taken from a trie of one text, so any text fits.
        """
        if type(self.root) is not _Branch:
            return []
        weight = {s: sum(len(t.key) for t in self.terminals(child)) for s, child in self.root.children.items()}
        symbol = max(weight, key=weight.get)
        taken = list(self.terminals(self.root.children[symbol]))
        if not taken:
            return []
        self.bytes -= weight[symbol]
        if closed:
            self.root.children[symbol] = _Spilled(taken[0].key, self.root.at + 1)
        else:
            del self.root.children[symbol]
            if len(self.root.children) == 1:
                self.root = next(iter(self.root.children.values()))
        return taken


def _texts(id_type: T.DataType) -> T.StructType:
    """Rows between tasks: ``data`` is null where a text is done."""
    return T.StructType([T.StructField("digest", T.StringType()), T.StructField("n_bytes", T.LongType()), T.StructField("owner", id_type), T.StructField("chars", T.LongType()), T.StructField("n", T.LongType()), T.StructField("data", T.BinaryType())])


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 8 << 20, most: int = 10_000) -> Iterator[pa.RecordBatch]:
    """Rows (the last value is bytes or None) in batches of bounded bytes."""
    held, weight = [], 0

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)

    for row in rows:
        held.append(row)
        weight += len(row[-1] or b"")
        if weight >= size or len(held) >= most:
            yield batch()
            held, weight = [], 0
    if held:
        yield batch()


def _combined(docs: DataFrame, trie_bytes: int) -> DataFrame:
    """One row per distinct text of a task that reads documents: the best owner there and the number of rows.

    A full trie emits its largest subtree and goes on without it; copies that come
    later are a row of their own.
    """
    schema = _texts(docs.schema[0].dataType)
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie()

        def rows():
            for batch in batches:
                for part in small_slices(*batch.columns):
                    for owner, text in zip(*(c.to_pylist() for c in part), strict=True):
                        trie.find_or_add(normal_bytes(text)).add(owner, len(text or ""))
                        while trie.bytes > trie_bytes and (taken := trie.spill(closed=False)):
                            yield from map(out, taken)
            yield from map(out, trie.terminals())

        def out(t: Terminal) -> tuple:
            return hashlib.sha256(t.key).hexdigest(), len(t.key), t.owner, t.chars, t.n, t.key

        yield from _batches(rows(), arrow)

    return docs.mapInArrow(run, schema)


def _owned(texts: DataFrame, trie_bytes: int) -> DataFrame:
    """Owners of the texts that several rows have, and the texts of spilled subtrees, whole.

    ``texts`` must be dealt by length and digest.  Two different texts with one
    length and SHA-256 raise: the digest takes the owner back to the rows.
    """
    schema = texts.schema
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, digests = Trie(), set()

        def rows():
            for batch in batches:
                for part in small_slices(*batch.columns):
                    for digest, n_bytes, owner, chars, n, data in zip(*(c.to_pylist() for c in part), strict=True):
                        terminal = trie.find_or_add(data, digest)
                        if terminal is None:
                            yield digest, n_bytes, owner, chars, n, data
                            continue
                        if terminal.n == 0:
                            if digest in digests:
                                raise ValueError(f"different texts share the digest {digest}")
                            digests.add(digest)
                        terminal.add(owner, chars, n)
                        while trie.bytes > trie_bytes and (taken := trie.spill(closed=True)):
                            digests.difference_update(t.digest for t in taken)
                            yield from ((t.digest, len(t.key), t.owner, t.chars, t.n, t.key) for t in taken)
            yield from ((t.digest, len(t.key), t.owner, t.chars, t.n, None) for t in trie.terminals() if t.n > 1)

        yield from _batches(rows(), arrow)

    return texts.mapInArrow(run, schema)


def owners(docs: DataFrame, id_column: str = "doc_id", text: str = "text", trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """(digest, owner, chars, n) of every text that more than one row has.

    Subtrees that didn't fit are dealt again, to as many partitions as their bytes
    need; each round ends all texts but those of the subtrees that it spilled.
    """
    found = _owned(_combined(docs.select(id_column, F.col(text).cast("string").alias("t")), trie_bytes).repartition("n_bytes", "digest"), trie_bytes)
    done = []
    while True:
        found = staged(found, "owners")
        done.append(found.where("data is null"))
        spilled = found.where("data is not null")
        rows, weight = spilled.agg(F.count(F.lit(1)), F.sum("n_bytes")).first()
        if not rows:
            break
        # half full on average; another seed deals the texts of one partition apart
        n = 1 + min(rows, 2 * weight // max(trie_bytes, 1))
        found = _owned(spilled.repartition(n, F.xxhash64("digest", "n_bytes", F.lit(len(done)))), trie_bytes)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("digest", "owner", "chars", "n")


def exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", trie_bytes: int = TRIE_BYTES, max_broadcast: int = 200_000) -> DataFrame:
    """``docs`` with keep_id, group_size, kept and text_sha256, one row per row.

    Texts are equal if they are the same bytes without whitespace; a null counts as
    empty, so nulls, empty and blank texts are one group.  Of a group the row with the
    most code points stays, then the one with the smallest id; a null id comes last.
    Rows that tie in both can't be told apart and all stay.  Ids may be of any type
    that has an order; extra columns are kept, and new ones get a leading ``_`` where
    a name is taken.  No documents, no rows.  A text of any length fits: a trie that
    holds one text never spills.

    Texts that one row has are never joined.  Owners of the others are broadcast while
    they are few, else merged by their digest, where Spark splits a digest that many rows share.
    """
    names = {n: fresh(docs, n) for n in ("keep_id", "group_size", "kept", "text_sha256")}
    own = {n: fresh(docs, f"owner_{n}") for n in ("digest", "id", "chars", "n")}
    found = owners(docs, id_column, text, trie_bytes).toDF(own["digest"], own["id"], own["chars"], own["n"])
    found = small_or_plain(found, max_broadcast, own["digest"])
    body = F.col(f"`{text}`").cast("string")
    digest = arrow_column(lambda texts: [hashlib.sha256(normal_bytes(t)).hexdigest() for t in texts], T.StringType(), body)
    key = F.col(f"`{id_column}`")
    rows = docs.withColumn(names["text_sha256"], digest)
    joined = rows.join(found, F.col(names["text_sha256"]) == F.col(own["digest"]), "left")
    shared = F.col(own["n"]).isNotNull()
    keep_id = F.when(shared, F.col(own["id"])).otherwise(key)
    kept = ~shared | (key.eqNullSafe(F.col(own["id"])) & (F.coalesce(F.length(body), F.lit(0)) == F.col(own["chars"])))
    return joined.select(
        *(rows[f"`{c}`"] for c in docs.columns), keep_id.alias(names["keep_id"]), F.coalesce(F.col(own["n"]), F.lit(1)).cast("long").alias(names["group_size"]), kept.alias(names["kept"]), F.col(names["text_sha256"])
    )
