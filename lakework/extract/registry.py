"""Tools that an extraction may call."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

CONTROLS = {"boolean": "bool", "integer": "number", "number": "number", "string": "text"}


@dataclass(frozen=True)
class Field:
    """A tool's argument: a JSON type, or ``enum`` options, or an approximate date."""

    name: str
    type: str = "string"
    required: bool = False
    options: tuple[str, ...] = ()
    default: Any = None
    description: str = ""

    def schema(self) -> dict:
        if self.type == "approx_date":
            base: dict = {"type": "object", "properties": {"date": {"type": "string"}, "precision": {"type": "integer"}, "anchor": {"type": "string"}}}
        elif self.type == "list":
            base = {"type": "array", "items": {"type": "string"}}
        else:
            base = {"type": self.type}
        if self.options:
            base["enum"] = list(self.options)
        if self.default is not None:
            base["default"] = self.default
        return base | ({"description": self.description} if self.description else {})

    def problem(self, value: Any) -> str | None:
        if value is None:
            return f"{self.name}: required" if self.required else None
        kinds = {"string": str, "boolean": bool, "integer": int, "number": (int, float), "list": list, "approx_date": dict, "object": dict}
        kind = kinds.get(self.type, object)
        if not isinstance(value, kind) or (isinstance(value, bool) and self.type in ("integer", "number")):
            return f"{self.name}: expected {self.type}"
        if self.options and value not in self.options:
            return f"{self.name}: not one of {', '.join(self.options)}"
        return None


@dataclass(frozen=True)
class Tool:
    """One event type.  ``identity`` and ``comparison`` name the fields that key it and that runs must agree on."""

    name: str
    fields: tuple[Field, ...]
    identity: tuple[str, ...] = ()
    comparison: tuple[str, ...] = ()
    terminal: bool = False
    plan: bool = False
    builtin: bool = False
    description: str = ""
    handler: Callable[[dict], str] | None = None

    def schema(self) -> dict:
        return {"type": "object", "properties": {f.name: f.schema() for f in self.fields}, "required": [f.name for f in self.fields if f.required]}


FINISH = Tool("finish_note_extraction", (Field("summary"),), terminal=True, builtin=True, description="The note is done.")


class Registry:
    """Named tools; plain data, so it travels to executors."""

    def __init__(self, tools: Sequence[Tool] = ()):
        self.tools: dict[str, Tool] = {}
        for t in (*tools, FINISH):
            self.register(t)

    def register(self, tool: Tool) -> Tool:
        names = {f.name for f in tool.fields}
        if unknown := sorted({*tool.identity, *tool.comparison} - names):
            raise ValueError(f"{tool.name}: no such fields: {', '.join(unknown)}")
        if tool.name in self.tools:
            raise ValueError(f"{tool.name} is registered already")
        self.tools[tool.name] = tool
        return tool

    def get(self, name: str) -> Tool | None:
        return self.tools.get(name)

    def names(self) -> list[str]:
        return list(self.tools)

    def api(self) -> list[dict]:
        return [{"type": "function", "name": t.name, "description": t.description, "parameters": t.schema()} for t in self.tools.values()]

    def execute(self, name: str, arguments: Mapping[str, Any]) -> dict:
        """``ok`` with the checked arguments, or a structured error of at most five field problems."""
        tool = self.get(name)
        if tool is None:
            return {"ok": False, "kind": "unknown_tool", "error": f"unknown tool {name!r}"}
        problems = [p for f in tool.fields if (p := f.problem(arguments.get(f.name)))]
        if problems:
            return {"ok": False, "kind": "validation", "error": "; ".join(problems[:5])}
        known = {f.name for f in tool.fields} | {"note_id", "evidence", "review_anchor"}
        value = {f.name: f.default for f in tool.fields if f.default is not None} | {k: v for k, v in arguments.items() if k in known}
        try:
            status = tool.handler(value) if tool.handler else f"recorded {name}"
        except Exception as e:  # a handler's fault is the caller's to see
            return {"ok": False, "kind": "handler", "error": f"{type(e).__name__}: {e}"}
        return {"ok": True, "status": status, "value": value}

    def fresh(self) -> Registry:
        return self


class GatedRegistry(Registry):
    """A first tool whose value chooses the tools of the second phase."""

    def __init__(self, gate: Tool, gate_field: str, phases: Mapping[str, Sequence[Tool]]):
        super().__init__([gate])
        self.gate, self.gate_field, self.phases, self.result = gate, gate_field, dict(phases), None

    def execute(self, name: str, arguments: Mapping[str, Any]) -> dict:
        out = super().execute(name, arguments)
        if name == self.gate.name and out["ok"]:
            chosen = out["value"].get(self.gate_field)
            if chosen not in self.phases:
                return {"ok": False, "kind": "validation", "error": f"{self.gate_field}: no tools for {chosen!r}"}
            self.result = chosen
            for t in self.phases[chosen]:
                self.tools.setdefault(t.name, t)
        return out

    def fresh(self) -> GatedRegistry:
        return GatedRegistry(self.gate, self.gate_field, self.phases)


def inline_refs(schema: Any, defs: Mapping[str, Any] | None = None) -> Any:
    """A JSON schema with its local references replaced by what they name."""
    if isinstance(schema, Mapping):
        defs = {**(defs or {}), **schema.get("$defs", {})}
        if ref := schema.get("$ref"):
            return inline_refs({**defs[ref.rsplit("/", 1)[-1]], **{k: v for k, v in schema.items() if k != "$ref"}}, defs)
        return {k: inline_refs(v, defs) for k, v in schema.items() if k != "$defs"}
    return [inline_refs(v, defs) for v in schema] if isinstance(schema, list) else schema


def _control(f: Field) -> str:
    return "enum" if f.options else "approx_date" if f.type == "approx_date" else CONTROLS.get(f.type, "readonly")


def field_schema(registry: Registry) -> dict[str, dict]:
    """H7: per event type its fields' controls, options and defaults; plans and built-in tools have none."""
    tools = list(registry.tools.values())
    if isinstance(registry, GatedRegistry):
        tools += [t for ts in registry.phases.values() for t in ts]
    return {
        t.name: {
            "fields": [{"name": f.name, "label": f.name.replace("_", " ").title(), "control": _control(f), "required": f.required, "options": list(f.options), "default": f.default} for f in t.fields],
            "event_identity_fields": list(t.identity),
            "comparison_fields": list(t.comparison),
        }
        for t in tools
        if not (t.plan or t.builtin)
    }


def infer_schema(events: Sequence[tuple[str, Mapping[str, Any]]]) -> dict[str, dict]:
    """H8: fields in first-seen order; a field's first value that isn't null decides its control."""

    def control(v: Any) -> str:
        if isinstance(v, Mapping):
            return "approx_date" if {"date", "precision"} <= v.keys() else "readonly"
        return "bool" if isinstance(v, bool) else "number" if isinstance(v, (int, float)) else "text" if isinstance(v, str) else "readonly"

    seen: dict[str, dict[str, Any]] = {}
    for kind, fields in events:
        own = seen.setdefault(kind, {})
        for name, value in fields.items():
            if own.get(name) is None:
                own[name] = value
    return {k: {"fields": [{"name": n, "label": n.replace("_", " ").title(), "control": control(v) if v is not None else "text", "required": False, "options": [], "default": None} for n, v in fs.items()]} for k, fs in seen.items()}


def backfill(declared: Mapping[str, dict], inferred: Mapping[str, dict]) -> dict[str, dict]:
    """H9: declared types, and inferred ones that aren't declared."""
    return {**inferred, **declared}


#: A small definition of our own, for demonstrations and tests.
DEMO = Registry([
    Tool("record_measurement", (Field("kind", required=True), Field("value", "number", required=True), Field("unit"), Field("on", "approx_date"), Field("evidence", "list")), ("kind",), ("value", "unit")),
    Tool("record_status", (Field("status", required=True, options=("present", "absent", "unclear")), Field("evidence", "list")), comparison=("status",)),
    Tool("flag_report_for_review", (Field("reason"),)),
    Tool("plan_reading", (Field("steps", "list"),), plan=True),
])
