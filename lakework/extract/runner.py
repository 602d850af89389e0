"""The extraction loop, one backend per partition."""

from __future__ import annotations

import json
import os
import re
import time
from collections.abc import Callable, Iterator, Mapping
from dataclasses import asdict, dataclass
from typing import Any, Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lakework.extract.registry import GatedRegistry, Registry
from lakework.types import struct

RECORD_LINE = struct("note_id string, hash string, success boolean, line string")


@dataclass
class Reply:
    """A model's answer: tool calls as (name, arguments), and tokens used."""

    calls: list[tuple[str, dict]]
    input_tokens: int = 0
    output_tokens: int = 0
    reasoning_tokens: int = 0


class Backend(Protocol):
    """P5: anything that answers a conversation with tool calls."""

    def reply(self, messages: list[dict], tools: list[dict]) -> Reply: ...


class FakeBackend:
    """A deterministic backend: numbers with units become measurements, question marks flags."""

    _NUMBER = re.compile(r"([a-z]+)\s+(?:is\s+)?(\d+(?:\.\d+)?)\s*(mm|cm|mg|ml)?", re.IGNORECASE)

    def reply(self, messages: list[dict], tools: list[dict]) -> Reply:
        text = next(m["content"] for m in messages if m["role"] == "user")
        calls = [("record_measurement", {"kind": m[1].lower(), "value": float(m[2]), "unit": m[3], "evidence": [m[0].strip()]}) for m in self._NUMBER.finditer(text)]
        if "?" in text:
            calls.append(("flag_report_for_review", {"reason": "a question in the text"}))
        return Reply([*calls, ("finish_note_extraction", {"summary": f"{len(calls)} calls"})], len(text.split()), 10 * len(calls))


@dataclass(frozen=True)
class Limits:
    rounds: int = 12
    retries: int = 3
    wait_seconds: float = 0.0
    debug_dir: str | None = None


def prompt(system: str, note: str) -> list[dict]:
    """P14."""
    return [{"role": "system", "content": system}, {"role": "user", "content": note}]


def tool_calls(items: list[Mapping[str, Any]]) -> list[tuple[str, dict]]:
    """P10: calls of a response in either of two shapes; malformed arguments count as none."""
    out = []
    for item in items:
        body = item.get("function") if isinstance(item.get("function"), Mapping) else item
        name, raw = body.get("name"), body.get("arguments")
        if not name:
            continue
        try:
            arguments = json.loads(raw) if isinstance(raw, str) else raw
        except ValueError:
            arguments = {}
        out.append((name, arguments if isinstance(arguments, dict) else {}))
    return out


def extract_note(note_id: str, text: str, system: str, registry: Registry, backend: Backend, limits: Limits = Limits()) -> dict:
    """Converse until a terminal call; failed calls are reported back and may be retried a few times.

    Every reply's calls and their results become part of the conversation, without the
    note's id, so a backend needs no memory.  With ``debug_dir`` each round is written
    there as JSON.  Returns the record without its envelope: events and plans by type,
    finish, rounds, tokens.
    """
    tools, messages, retries = registry.fresh(), prompt(system, text), 0
    out = {"events": {}, "plans": {}, "finish": None, "rounds": 0, "input_tokens": 0, "output_tokens": 0, "reasoning_tokens": 0, "gate_result": None, "success": False, "error": None}
    for _ in range(limits.rounds):
        reply = backend.reply(messages, tools.api())
        out["rounds"] += 1
        for k in ("input_tokens", "output_tokens", "reasoning_tokens"):
            out[k] += getattr(reply, k)
        asked, results = list(messages), []
        if not reply.calls:
            messages.append({"role": "user", "content": "Call a tool, or finish."})
            _dump(limits.debug_dir, note_id, out["rounds"], asked, reply, results)
            continue
        problems = []
        for name, arguments in reply.calls:
            result = tools.execute(name, {"note_id": note_id, **arguments})
            messages.append({"role": "assistant", "call": {"name": name, "arguments": {k: v for k, v in arguments.items() if k != "note_id"}}})
            messages.append({"role": "tool", "name": name, "content": result["status"] if result["ok"] else result["error"]})
            results.append({"name": name, **result})
            if not result["ok"]:
                problems.append(result["error"])
                continue
            tool = tools.get(name)
            value = {k: v for k, v in result["value"].items() if k != "note_id" and not (k in ("evidence", "review_anchor") and not v)}
            if tool.terminal:
                out["finish"] = value
            else:
                out["plans" if tool.plan else "events"].setdefault(name, []).append(value)
        _dump(limits.debug_dir, note_id, out["rounds"], asked, reply, results)
        if problems:
            retries += 1
            if retries > limits.retries:
                out["error"] = problems[0]
                break
            messages.append({"role": "user", "content": "Correct these calls: " + "; ".join(problems)})
        if out["finish"] is not None:
            out["success"] = True
            break
    else:
        out["error"] = f"not finished in {limits.rounds} rounds"
    if isinstance(tools, GatedRegistry):
        out["gate_result"] = tools.result
    return out


def _dump(folder: str | None, note_id: str, number: int, messages: list[dict], reply: Reply, results: list[dict]) -> None:
    """One round as a JSON file, if asked; a fault in writing it is no fault of the extraction."""
    if folder:
        try:
            os.makedirs(folder, exist_ok=True)
            with open(os.path.join(folder, f"{re.sub(r'[^A-Za-z0-9._-]', '_', note_id)}_r{number}.json"), "w") as f:
                json.dump({"note_id": note_id, "round": number, "request": messages, "response": asdict(reply), "results": results}, f, indent=2, default=str)
        except OSError:
            pass


def record_of(note: Mapping[str, Any], definition: str, run_meta: Mapping[str, Any], at: str, work: Callable[[], dict]) -> dict:
    """A note's record; an exception makes a failed record, not a failed job."""
    head = {"note_id": note["id"], "mrn": note.get("mrn"), "definition_name": definition, "extracted_at": at, "source_content_hash": note.get("hash")}
    try:
        body = work()
    except Exception as e:
        body = {"events": {}, "plans": {}, "finish": None, "rounds": 0, "input_tokens": 0, "output_tokens": 0, "reasoning_tokens": 0, "success": False, "error": f"{type(e).__name__}: {e}"}
    return {**head, **body, "run_meta": dict(run_meta)}


def extract(notes: DataFrame, definition: str, system: str, registry: Registry, make_backend: Callable[[], Backend] = FakeBackend, run_meta: Mapping[str, Any] | None = None, at: str = "", limits: Limits = Limits(), workers: int | None = None) -> DataFrame:
    """(note_id, hash, success, line), a JSON record per note with ``id, text, mrn, hash``.

    One backend per partition.  A note costs much and has few bytes, so notes are dealt by id and hash over
    the session's shuffle partitions (or ``workers``): a small file would be one task's.
    Calls may cost money, so write the result once, with speculation off, and read that;
    what is written is skipped next time (``delta.resume``).  Blank texts are left out.
    """
    from lakework.operators.projection import drop_blank
    from lakework.functions.hashing import sha_prefix

    meta = {"system_prompt_hash": sha_prefix(system), **(run_meta or {})}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        backend = make_backend()
        for batch in batches:
            rows = []
            for note in batch.to_pylist():
                if limits.wait_seconds:
                    time.sleep(limits.wait_seconds)
                record = record_of(note, definition, meta, at, lambda n=note: extract_note(n["id"], n["text"], system, registry, backend, limits))
                rows.append({"note_id": note["id"], "hash": note["hash"], "success": record["success"], "line": json.dumps(record, default=str)})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("note_id", pa.string()), ("hash", pa.string()), ("success", pa.bool_()), ("line", pa.string())]))

    rows = drop_blank(notes.select("id", "text", "mrn", "hash"), "text")
    # by both columns: a shuffle by id alone would be dropped after a join by id, whose partitions are merged by their bytes
    partitions = int(notes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.repartition(workers) if workers else rows.repartition(partitions, "id", "hash")).mapInArrow(run, RECORD_LINE)


def check_arguments(jsonl: str | None, source: str | None, where: str | None = None, cohort: str | None = None, delta: bool = False, full: bool = False, batch: str = "batch") -> None:
    """Which options go together."""
    if bool(jsonl) == bool(source):
        raise ValueError("give either JSON lines or a source table")
    if (where or cohort) and not source:
        raise ValueError("a predicate or cohort needs a source table")
    if delta and (not source or full):
        raise ValueError("incremental options need a source table and no full run")
    if not re.fullmatch(r"[A-Za-z0-9_]+", batch):
        raise ValueError("a batch name has letters, digits and underscores only")


def snake(name: str) -> str:
    """``StudyForm`` and ``study-form`` name the same definition."""
    return re.sub(r"[\s\-]+", "_", re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name)).lower()


def resolve_definition(name: str, known: Mapping[str, Registry]) -> Registry:
    """P13."""
    by_name = {snake(k): v for k, v in known.items()}
    if snake(name) not in by_name:
        raise KeyError(f"no definition {name!r}; known: {', '.join(sorted(by_name))}")
    return by_name[snake(name)]
