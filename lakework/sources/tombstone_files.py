"""Tombstone events on disk."""

from __future__ import annotations

import uuid
from pathlib import Path

from lakework.operators.runs import now
from lakework.operators.tombstones import ACTIONS, KINDS
from lakework.sources.lake import write_json


def write_event(folder: Path, kind: str, target: str, action: str, reason: str = "", actor: str = "", event_id: str | None = None, at: str | None = None) -> Path:
    """Write an immutable event; unknown kinds and actions, blank targets and existing ids are refused."""
    if kind not in KINDS or action not in ACTIONS:
        raise ValueError(f"kind must be one of {', '.join(KINDS)}, action one of {', '.join(ACTIONS)}")
    if not target.strip() or "/" in target:
        raise ValueError(f"not a target: {target!r}")
    event_id = event_id or uuid.uuid4().hex[:16]
    path = Path(folder) / f"{event_id}.json"
    if path.exists():
        raise FileExistsError(path)
    return write_json(path, {"event_id": event_id, "kind": kind, "target": target, "action": action, "reason": reason, "actor": actor, "at": at or now()})
