"""Flat event rows with declared leaves: their schema is known before anything is read (H3 to H5)."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from lakework.functions.jsonx import flatten
from lakework.operators.events import members_of


def _schema(names: Sequence[str]) -> T.StructType:
    low = ["tool_name", *(n.lower() for n in names)]
    if len(set(low)) < len(low):
        raise ValueError(f"declared twice: {', '.join(sorted({n for n in low if low.count(n) > 1}))}")
    return T.StructType([T.StructField(n, T.StringType()) for n in ("tool_name", *names)])


def _rows(names: Sequence[str], strict: bool) -> Callable[[str | None], Iterator[tuple]]:
    known = frozenset(names)

    def rows(text: str | None) -> Iterator[tuple]:
        for kind, _, _, event in members_of(text):
            values = flatten(event)
            if strict and (other := sorted(values.keys() - known)):
                raise ValueError(f"{kind}: undeclared {', '.join(other)}")
            yield (kind, *(values.get(n) for n in names))

    return rows


@dataclass
class Declared(AnalyzeResult):
    names: list[str] = field(default_factory=list)
    strict: bool = False


class FlatEvents:
    """For SQL, as a table function: ``(events_json, declared leaves as a JSON list, strict)`` to a row per event.

    The result's columns come from the constant arguments.  A table function is called, and what it
    yields converted, a record at a time: over many records use ``declared_events``.
    """

    @staticmethod
    def analyze(events_json: AnalyzeArgument, leaves: AnalyzeArgument, strict: AnalyzeArgument) -> Declared:
        names = json.loads(leaves.value) if leaves.isConstantExpression and leaves.value else None
        if not isinstance(names, list) or not all(isinstance(n, str) for n in names):
            raise ValueError("the declared leaves must be a constant JSON list of names")
        return Declared(schema=_schema(names), names=names, strict=bool(strict.value))

    def __init__(self, declared: Declared):
        self.rows = _rows(declared.names, declared.strict)

    def eval(self, events_json: str, leaves: str, strict: bool) -> Iterator[tuple]:
        yield from self.rows(events_json)


def declared_events(recs: DataFrame, leaves: Sequence[str], keep: Sequence[str] = ("note_id", "mrn", "gate_result"), strict: bool = False) -> DataFrame:
    """``events.event_table`` for declared leaves; others are left out or, if ``strict``, fail the job.

    A plan has its schema without a pass over the data; events are parsed once, an Arrow batch of records at a time.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kind = T.ArrayType(_schema(leaves))
    arrow, rows, names = to_arrow_type(kind), _rows(tuple(leaves), strict), ("tool_name", *leaves)

    @F.arrow_udf(kind)
    def flat(column: pa.Array) -> pa.Array:
        return pa.array([[dict(zip(names, row, strict=True)) for row in rows(v)] for v in column.to_pylist()], arrow)

    return recs.select(*keep, F.inline(flat("events_json")))
