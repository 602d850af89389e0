"""Copies between a remote inbox and the local one (Q1 to Q3)."""

from __future__ import annotations

import shutil
from dataclasses import dataclass, field
from pathlib import Path

from lakework.sources.sidecar import file_sha256

SKIPPED = (".sha256", ".tmp", ".partial")


class ConflictError(RuntimeError):
    """Q2: files that differ on both sides, all of them."""

    def __init__(self, files: list[str]):
        self.files = files
        super().__init__(f"{len(files)} file(s) differ on both sides: {', '.join(files)}")


@dataclass
class Transfer:
    copied: list[str] = field(default_factory=list)
    present: list[str] = field(default_factory=list)


def inventory(folder: Path) -> list[str]:
    """Relative names of a folder's data files, recursively."""
    return sorted(str(p.relative_to(folder)) for p in folder.rglob("*") if p.is_file() and not p.name.endswith(SKIPPED) and not p.name.startswith("."))


def transfer(source: Path, target: Path, dry_run: bool = False) -> Transfer:
    """Q1: copy files that the target lacks.  Conflicts anywhere are found before anything is copied; nothing is overwritten."""
    out, conflicts = Transfer(), []
    for name in inventory(source) if source.exists() else []:
        if not (target / name).exists():
            out.copied.append(name)
        elif (target / name).stat().st_size == (source / name).stat().st_size and file_sha256(target / name) == file_sha256(source / name):
            out.present.append(name)
        else:
            conflicts.append(name)
    if conflicts:
        raise ConflictError(conflicts)
    for name in [] if dry_run else out.copied:
        staging = target / (name + ".partial")
        staging.parent.mkdir(parents=True, exist_ok=True)
        shutil.copy2(source / name, staging)
        staging.replace(target / name)
    return out


def pull(remote: Path, inbox: Path, dry_run: bool = False) -> Transfer:
    return transfer(remote, inbox, dry_run)


def push(inbox: Path, remote: Path, dry_run: bool = False) -> Transfer:
    return transfer(inbox, remote, dry_run)


def status(inbox: Path, folders: list[str]) -> dict[str, int]:
    """Q3: number of data files per dataset folder."""
    return {f: len(inventory(inbox / f)) if (inbox / f).exists() else 0 for f in folders}
