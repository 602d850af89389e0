"""Settings of a lake: its folders and named backends (Q4)."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping
from dataclasses import asdict, dataclass, field, fields
from pathlib import Path

BACKEND_TYPES = ("fake", "responses", "chat")


@dataclass(frozen=True)
class BackendSettings:
    """How to reach a model; the key itself is in the environment variable that ``api_key_env`` names."""

    type: str
    url: str | None = None
    model: str | None = None
    api_version: str | None = None
    api_key_env: str = "LAKEWORK_API_KEY"

    def __post_init__(self):
        if self.type not in BACKEND_TYPES:
            raise ValueError(f"a backend's type must be one of {', '.join(BACKEND_TYPES)}, not {self.type!r}")

    def api_key(self) -> str:
        if not (key := os.environ.get(self.api_key_env)):
            raise ValueError(f"no API key: set {self.api_key_env} in the environment or in .env")
        return key


@dataclass(frozen=True)
class Config:
    remote: str = "data/remote"
    lake: str = "data/lake"
    inbox: str = "data/inbox"
    backends: Mapping[str, BackendSettings] = field(default_factory=dict)

    def backend(self, name: str) -> BackendSettings:
        if name not in self.backends:
            raise ValueError(f"no backend {name!r}; there are: {', '.join(self.backends) or 'none'}")
        return self.backends[name]


def _format(path: Path):
    """(load, dump) for a file's suffix: JSON, or YAML where its library is installed."""
    if path.suffix == ".json":
        return json.loads, lambda v: json.dumps(v, indent=2) + "\n"
    try:
        import yaml
    except ImportError:
        raise ValueError(f"{path}: no YAML library; use a .json file") from None
    return yaml.safe_load, lambda v: yaml.safe_dump(v, sort_keys=False)


def load_env(path: Path) -> None:
    """``KEY=value`` lines into the environment; what is set already stays."""
    for line in path.read_text().splitlines() if path.exists() else ():
        key, eq, value = line.strip().removeprefix("export ").partition("=")
        if eq and key and not key.startswith("#"):
            os.environ.setdefault(key.strip(), value.strip().strip("\"'"))


def load_config(path: Path = Path("lakework.yaml")) -> Config:
    """The file's settings over the defaults, with ``.env`` beside it loaded first; unknown settings are an error."""
    load_env(path.parent / ".env")
    if not path.exists():
        return Config()
    found = _format(path)[0](path.read_text()) or {}
    if unknown := sorted(set(found) - {f.name for f in fields(Config)}):
        raise ValueError(f"{path}: unknown settings: {', '.join(unknown)}")
    backends = {name: BackendSettings(**spec) for name, spec in (found.pop("backends", None) or {}).items()}
    return Config(**{k: str(v) for k, v in found.items()}, backends=backends)


def save_config(config: Config, path: Path = Path("lakework.yaml")) -> Path:
    plain = asdict(config)
    plain["backends"] = {k: {n: v for n, v in spec.items() if v is not None} for k, spec in plain["backends"].items()}
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(_format(path)[1](plain))
    return path
