"""Evidence: where quotes stand in their notes."""

from __future__ import annotations

import bisect
import re
from array import array
from collections.abc import Iterator, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SPACE = re.compile(r"\s+")


class Folded:
    """A text in one letter case with single blanks, and the way back to its own offsets."""

    def __init__(self, text: str):
        lower = text.lower()
        if len(lower) != len(text):  # a letter whose lower case is longer stays as it is
            lower = "".join(low if len(low := c.lower()) == 1 else c for c in text)
        parts, self.at, self.shift, end, size = [], [0], [0], 0, 0
        for m in _SPACE.finditer(lower):
            parts += [lower[end : m.start()], " "]
            size += m.start() - end + 1
            end = m.end()
            if m.end() - m.start() > 1:  # from here on offsets differ by more
                self.at.append(size)
                self.shift.append(end - size)
        self.text = "".join([*parts, lower[end:]])

    def original(self, place: int) -> int:
        """Where the character at ``place`` of the folded text stands in the text itself."""
        return place + self.shift[bisect.bisect_right(self.at, place) - 1]


def folded_quote(quote: str) -> str:
    return Folded(quote).text.strip()


def spans_of(text: str, quotes: Sequence[str]) -> list[tuple[int, int]]:
    """Merged [start, end) spans of all quotes, in one pass over the text by an automaton of them.

    Letter case and the whitespace between words don't matter; blank quotes find
    nothing.  A quote's occurrences don't overlap each other; spans that touch are one.
    """
    wanted = {q for q in map(folded_quote, quotes) if q}
    if not wanted or not text:
        return []
    automaton = ahocorasick.Automaton()
    for q in wanted:
        automaton.add_word(q, q)
    automaton.make_automaton()
    folded, free, found = Folded(text), dict.fromkeys(wanted, 0), []
    for last, q in automaton.iter(folded.text):
        start = last + 1 - len(q)
        if start >= free[q]:
            free[q] = last + 1
            found.append((folded.original(start), folded.original(last) + 1))
    merged: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if merged and a <= merged[-1][1]:
            merged[-1] = merged[-1][0], max(merged[-1][1], b)
        else:
            merged.append((a, b))
    return merged


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def quote_spans(notes: DataFrame, quotes: DataFrame, id_column: str = "note_id", text: str = "note_text", quote: str = "quote", per_pass: int = 5_000) -> DataFrame:
    """(id, start, end) of what ``quotes`` (id, quote) cover in their notes; spans that touch are one row.

    Offsets are code points of the text itself.  Repeated quotes count once.  A note with more than
    ``per_pass`` quotes is searched in several passes, each of a share of them, so no row
    or automaton grows with a note's quotes; the spans of several passes, or of several notes
    with one id, are merged by a window.
    Notes without quotes, null texts, ids and quotes have no spans.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    arrow = to_arrow_type(SPANS)

    @F.arrow_udf(SPANS)
    def located(texts: pa.Array, lists: pa.Array) -> pa.Array:
        ends, starts, stops = array("i", [0]), array("q"), array("q")
        for t, qs in zip(texts, lists, strict=True):
            for a, b in spans_of(t.as_py() or "", qs.as_py() or ()):
                starts.append(a)
                stops.append(b)
            ends.append(len(starts))
        spans = pa.StructArray.from_arrays([pa.array(starts, pa.int64()), pa.array(stops, pa.int64())], fields=list(arrow.value_type))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), spans, type=arrow)

    distinct = quotes.where(F.col(f"`{id_column}`").isNotNull() & (F.trim(F.col(f"`{quote}`")) != "")).select(F.col(f"`{id_column}`").alias("q_id"), F.col(f"`{quote}`").alias("q")).distinct()
    counts = distinct.groupBy(F.col("q_id").alias("c_id")).agg(F.ceil(F.count(F.lit(1)) / per_pass).alias("passes")).where("passes > 1")
    again = notes.groupBy(F.col(f"`{id_column}`").alias("a_id")).agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("a_id")
    share = F.pmod(F.xxhash64("q"), F.coalesce("passes", F.lit(1)))
    lists = distinct.join(counts, F.col("q_id") == F.col("c_id"), "left").groupBy("q_id", share.alias("pass"), F.col("passes").isNotNull().alias("shared")).agg(F.collect_list("q").alias("quotes"))
    mixed = notes.schema[id_column].dataType != quotes.schema[id_column].dataType  # then ids that differ may meet
    lists = lists.join(again, F.col("q_id") == F.col("a_id"), "left").select("q_id", "quotes", (F.lit(mixed) | F.col("shared") | F.col("a_id").isNotNull()).alias("several"))
    texts = notes.select(F.col(f"`{id_column}`").alias("n_id"), F.col(f"`{text}`").alias("t"))
    found = lambda some: texts.join(lists.where(some), F.col("n_id") == F.col("q_id")).select("n_id", F.explode(located("t", "quotes")).alias("s")).select("n_id", "s.start", "s.end")
    # an id's one search gives its spans as they are; only those of several are shuffled and sorted
    spans = found(~F.col("several")).unionByName(merged_spans(found(F.col("several")).distinct(), "n_id"))
    return spans.select(F.col("n_id").alias(id_column), "start", "end")


def merged_spans(spans: DataFrame, key: str) -> DataFrame:
    """(key, start, end) with spans of one key that overlap or touch united."""
    in_order = W.partitionBy(key).orderBy("start", "end")
    reach = F.max("end").over(in_order.rowsBetween(W.unboundedPreceding, -1))
    fresh = spans.withColumn("fresh", F.when(reach >= F.col("start"), 0).otherwise(1))
    island = fresh.withColumn("island", F.sum("fresh").over(in_order.rowsBetween(W.unboundedPreceding, 0)))
    return island.groupBy(key, "island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("island")
