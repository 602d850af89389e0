"""Appending to review logs."""

from __future__ import annotations

import fcntl
import json
import os
import re
from collections.abc import Mapping
from datetime import date
from pathlib import Path

from lakework.functions.dates import ANCHORS
from lakework.operators.review import VERDICTS
from lakework.operators.runs import now


def date_problem(value: object) -> str | None:
    """D9 for one edit: what is wrong with an approximate date, if anything."""
    if not isinstance(value, Mapping):
        return "not an approximate date"
    day, precision, anchor = value.get("date"), value.get("precision"), value.get("anchor")
    if day is not None:
        if not isinstance(day, str) or not re.fullmatch(r"\d{4}-\d{2}-\d{2}", day):
            return "a date must be YYYY-MM-DD"
        try:
            date.fromisoformat(day)
        except ValueError:
            return f"no such day: {day}"
    if precision is not None and (isinstance(precision, bool) or precision not in range(4)):
        return "a precision must be 0 to 3"
    if anchor is not None and anchor not in ANCHORS:
        return f"an anchor must be one of {', '.join(ANCHORS)}"
    return None


def append_verdict(path: Path, verdict: Mapping, field_schema: Mapping[str, Mapping] | None = None) -> dict:
    """Append one verdict as a line: checked, stamped, under a lock, flushed to disk before it returns."""
    record = {"reviewed_at": now(), "comment": "", "edits": {}, **verdict}
    record["verdict"] = str(record.get("verdict") or "").strip().lower()
    if not record.get("event_key"):
        raise ValueError("a verdict needs an event_key")
    if record["verdict"] not in VERDICTS:
        raise ValueError(f"a verdict must be one of {', '.join(VERDICTS)}")
    if not isinstance(record["edits"], Mapping):
        raise ValueError("edits must be an object")
    fields = ((field_schema or {}).get(record.get("event_type") or "") or {}).get("fields", [])
    for name in (f["name"] for f in fields if f.get("control") == "approx_date"):
        if record["edits"].get(name) is not None and (problem := date_problem(record["edits"][name])):
            raise ValueError(f"{name}: {problem}")
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open("a") as f:
        fcntl.flock(f, fcntl.LOCK_EX)
        f.write(json.dumps(record, default=str) + "\n")
        f.flush()
        os.fsync(f.fileno())
    return record
