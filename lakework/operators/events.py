"""Extraction records: JSON lines to wide rows, events, slots and flat tables."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakework.functions.hashing import blake2b_128
from lakework.functions.jsonx import data_fields, flatten, short_hash, stable
from lakework.operators.versions import highest_segment_rows
from lakework.schemas import EXTRACTIONS, conform
from lakework.types import struct

RECORD = struct(
    "note_id string, mrn string, definition_name string, extracted_at string, source_content_hash string, success boolean, gate_result string, error string, "
    "rounds int, input_tokens bigint, output_tokens bigint, reasoning_tokens bigint, system_prompt_hash string, definition_hash string, "
    "events_json string, plans_json string, finish_json string, run_meta_json string"
)
HEAD = struct("note_id string, source_content_hash string, success boolean, definition_hash string")
EVENT = T.ArrayType(struct("event_type string, type_order int, position int, fields_json string, data_json string, fingerprint string, identity string"))


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def made(column: pa.Array, one: Callable[[str | None], object], kind: pa.DataType, step: int = 500) -> pa.Array:
    """``one`` of each text of a batch as an Arrow array, a slice at a time: Python objects are those of ``step`` rows, not of the batch."""
    starts = range(0, max(len(column), 1), step)
    return pa.concat_arrays([pa.array([one(v) for v in column.slice(i, step).to_pylist()], kind) for i in starts])


def _integer(value) -> int:
    try:
        return int(value or 0)
    except (TypeError, ValueError):
        return 0


def _object(line: str | None) -> dict | None:
    try:
        record = json.loads(line) if line else None
    except ValueError:
        return None
    return record if isinstance(record, dict) else None


def _text(value) -> str | None:
    return None if value is None else str(value)


def _meta(record: Mapping) -> Mapping:
    return record.get("run_meta") if isinstance(record.get("run_meta"), dict) else {}


def parse_head(line: str | None) -> dict | None:
    """A record's identity and success alone; null if the line isn't a JSON object."""
    record = _object(line)
    if record is None:
        return None
    meta = _meta(record)
    return {
        **{k: _text(record.get(k)) for k in ("note_id", "source_content_hash")},
        "success": bool(record.get("success", False)),
        # an old record's definition is identified by its prompt
        "definition_hash": _text(meta.get("definition_hash") or meta.get("system_prompt_hash")),
    }


def parse_record(line: str | None) -> dict | None:
    """One record of a JSON line; null if it isn't a JSON object.  Nested values keep Python's default JSON bytes, keys sorted."""
    record = _object(line)
    if record is None:
        return None
    nested = lambda v: stable(v, compact=False) if v else None
    events, meta = record.get("events"), _meta(record)
    return {
        **{k: _text(record.get(k)) for k in ("note_id", "mrn", "definition_name", "extracted_at", "source_content_hash", "gate_result", "error")},
        "success": bool(record.get("success", False)),
        **{k: _integer(record.get(k)) for k in ("rounds", "input_tokens", "output_tokens", "reasoning_tokens")},
        "system_prompt_hash": _text(meta.get("system_prompt_hash")),
        # an old record's definition is identified by its prompt
        "definition_hash": _text(meta.get("definition_hash") or meta.get("system_prompt_hash")),
        # insertion order of event types matters to slots, so it is kept here and sorted where bytes are hashed
        "events_json": json.dumps(events, default=str) if isinstance(events, dict) else "{}",
        "plans_json": nested(record.get("plans")),
        "finish_json": nested(record.get("finish")),
        "run_meta_json": nested(meta),
    }


def _parsed(lines: DataFrame, value: str, one: Callable[[str | None], dict | None], struct_: T.StructType) -> DataFrame:
    """A line is a list of one row or none: a filter on a parsed column would move below it, and
    with it a second copy of the parser and its Python workers.
    """
    kind = T.ArrayType(struct_)

    @F.arrow_udf(kind)
    def parse(column: pa.Array) -> pa.Array:
        return made(column, lambda v: [] if (r := one(v)) is None else [r], _arrow(kind))

    rest = [c for c in lines.columns if c != value]
    return lines.select(*rest, F.inline(parse(F.col(value))))


def records(lines: DataFrame, value: str = "value") -> DataFrame:
    """Parsed records of a table of JSON lines, other columns kept; blank and malformed lines vanish."""
    return _parsed(lines, value, parse_record, RECORD)


def heads(lines: DataFrame, value: str = "value") -> DataFrame:
    """``records`` with the columns alone that a batch's history and tally need; nested values aren't made again."""
    return _parsed(lines, value, parse_head, HEAD)


def wide(recs: DataFrame, batch: str, segment: int | Column | None = None, only_successful: bool = True) -> DataFrame:
    """H1: one row per record in the fixed extraction schema."""

    @F.arrow_udf(T.StringType())
    def sorted_json(column: pa.Array) -> pa.Array:
        return made(column, lambda v: stable(json.loads(v), compact=False), pa.string())

    segment = segment if isinstance(segment, Column) else F.lit(segment)
    out = recs.where("success") if only_successful else recs
    out = out.withColumn("events_json", sorted_json("events_json"))
    content = F.concat(F.col("events_json"), F.coalesce("finish_json", F.lit("")))
    out = out.withColumns(
        {"record_id": F.coalesce("note_id", F.lit("")), "record_kind": F.lit("single_note"), "batch_name": F.lit(batch), "segment": segment.cast("bigint"),
         "definition_name": F.coalesce("definition_name", F.lit("")), "content_hash": blake2b_128(content)}
    )
    return conform(out.withColumn("key_hash", blake2b_128(F.col("record_id"))), EXTRACTIONS, extras=False)


def members_of(text: str | None) -> Iterator[tuple[str, int, int, dict]]:
    """H2: (type, order, position, fields) of a record's events; members that aren't lists of objects are skipped."""
    found = json.loads(text) if text else {}
    for order, (kind, members) in enumerate(found.items() if isinstance(found, dict) else ()):
        for position, event in enumerate(members if isinstance(members, list) else ()):
            if isinstance(event, dict):
                yield str(kind), order, position, event


def events_of(text: str | None, identity: Mapping[str, Sequence[str]]) -> list[dict]:
    """H2: a record's events, in order."""
    out = []
    for kind, order, position, event in members_of(text):
        names = identity.get(kind) or ()
        own = bool(names) and all(event.get(n) is not None for n in names)
        key = "id-" + short_hash({n: event.get(n) for n in names}) if own else None
        data = stable(data_fields(event))
        out.append({"event_type": kind, "type_order": order, "position": position, "fields_json": json.dumps(event, default=str), "data_json": data,
                    "fingerprint": hashlib.sha256(data.encode()).hexdigest()[:12], "identity": key})
    return out


def explode_events(recs: DataFrame, identity: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """H2: a row per event: the record's columns, type, order, position, fields, fingerprint and declared identity."""
    identity = {k: tuple(v) for k, v in (identity or {}).items()}

    @F.arrow_udf(EVENT)
    def found(column: pa.Array) -> pa.Array:
        return made(column, lambda v: events_of(v, identity), _arrow(EVENT))

    rest = [c for c in recs.columns if c not in ("events_json", "plans_json", "finish_json", "run_meta_json")]
    return recs.select(*rest, F.explode(found("events_json")).alias("_e")).select(*rest, "_e.*")


def batch_order(recs: DataFrame) -> DataFrame:
    """Each note's records of its highest segment, ordered by ``line_no`` across segments."""
    last = highest_segment_rows(recs, "note_id", "segment")
    return last.withColumn("line_no", F.struct("segment", "line_no"))


def slots(recs: DataFrame, identity: Mapping[str, Sequence[str]] | None = None, order: str = "line_no") -> DataFrame:
    """H6: events with ``event_key`` = note, type and identity, unique across the batch.

    The identity is a hash of the declared fields if none of them is null, else the
    event's ordinal of its type in the note; repeated keys get ``::1``, ``::2`` in
    batch order.  Windows are per note and type; notes without an id are one note, whose
    numbers run through the batch.
    """
    rows = explode_events(recs, identity).withColumn("note_id", F.coalesce("note_id", F.lit("")))
    in_order = [order, "type_order", "position"]
    rows = rows.withColumn("_n", F.row_number().over(W.partitionBy("note_id", "event_type").orderBy(*in_order)))
    base = F.concat_ws("::", "note_id", "event_type", F.coalesce("identity", F.col("_n").cast("string")))
    rows = rows.withColumn("_base", base)
    again = F.row_number().over(W.partitionBy("note_id", "event_type", "_base").orderBy(*in_order)) - 1
    key = F.when(F.col("_again") == 0, F.col("_base")).otherwise(F.concat_ws("::", "_base", F.col("_again").cast("string")))
    return rows.withColumn("_again", again).withColumn("event_key", key).drop("_n", "_base", "_again", "identity")


def widen(df: DataFrame, column: str, keep: Sequence[str], names: Iterable[str] | None = None) -> DataFrame:
    """H3: a map column's keys as string columns beside ``keep``; a key named like one of ``keep`` is left out.

    Without ``names`` the key set is collected first: one aggregation, bounded by
    the number of field names, not of rows.
    """
    if names is None:
        names = [r[0] for r in df.select(F.explode(F.map_keys(column))).distinct().collect()]
    taken = {k.lower() for k in keep}
    return df.select(*keep, *(F.try_element_at(F.col(column), F.lit(n)).alias(n) for n in sorted(set(names)) if n.lower() not in taken))


def event_table(recs: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    """A flat row per event: note, tool, mrn, gate result, then every leaf as a column."""
    kind = T.ArrayType(T.StructType([T.StructField("tool_name", T.StringType()), T.StructField("_map", T.MapType(T.StringType(), T.StringType()))]))

    @F.arrow_udf(kind)
    def leaves(column: pa.Array) -> pa.Array:
        return made(column, lambda v: [{"tool_name": k, "_map": list(flatten(event).items())} for k, _, _, event in members_of(v)], _arrow(kind))

    rows = recs.select("note_id", "mrn", "gate_result", F.inline(leaves("events_json")))
    return widen(rows, "_map", ["note_id", "tool_name", "mrn", "gate_result"], names)


def run_tally(recs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Records, successes, failures and the success rate."""
    ok = F.count_if(F.coalesce("success", F.lit(False)))
    return recs.groupBy(*by).agg(F.count(F.lit(1)).alias("total"), ok.alias("succeeded"), (F.count(F.lit(1)) - ok).alias("failed"), F.round(F.try_divide(ok, F.count(F.lit(1))), 6).alias("success_rate"))


def run_statistics(recs: DataFrame) -> DataFrame:
    """Events per type, one row each; token sums are plain aggregates of the records."""
    return explode_events(recs).groupBy("event_type").agg(F.count(F.lit(1)).alias("n_events"), F.countDistinct("note_id").alias("n_notes"))


def token_totals(recs: DataFrame) -> DataFrame:
    return recs.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("input_tokens", "output_tokens", "reasoning_tokens", "rounds")))


def merge_counters(*counters: Mapping[str, object]) -> dict[str, object]:
    """Counters added key by key, nested ones too; ``started_at`` and other values stay those of the first that has them."""
    out: dict[str, object] = {}
    for c in counters:
        for k, v in c.items():
            old = out.get(k)
            if isinstance(v, Mapping):
                out[k] = merge_counters(old if isinstance(old, Mapping) else {}, v)
            elif isinstance(v, (int, float)) and not isinstance(v, bool) and isinstance(old, (int, float)):
                out[k] = old + v
            elif old is None:
                out[k] = v
    return out
