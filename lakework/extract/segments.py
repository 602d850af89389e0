"""Segments of a batch on disk."""

from __future__ import annotations

import json
import shutil
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakework.extract.registry import Registry
from lakework.extract.runner import Backend, FakeBackend, Limits, extract
from lakework.functions.hashing import definition_hash
from lakework.operators import delta, events, runs
from lakework.sources import readers
from lakework.sources.lake import promote, staged, write_json


def next_segment(folder: Path) -> int:
    """One more than the largest."""
    return 1 + max((int(p.stem) for p in folder.glob("*.jsonl") if p.stem.isdigit()), default=0)


def pin(folder: Path, definition: str, source: str, id_column: str) -> None:
    """A batch keeps its definition, source and id; another of them is an error."""
    path, wanted = folder / "batch.json", {"definition": definition, "source": source, "id_column": id_column}
    if path.exists():
        have = {k: json.loads(path.read_text()).get(k) for k in wanted}
        if have != wanted:
            raise ValueError(f"batch {folder.name} was made with {have}, not {wanted}")
    else:
        write_json(path, wanted)


def definition_of(system: str, registry: Registry) -> str:
    """A definition's identity: its prompt and tools, built-in ones left out."""
    return definition_hash(system, {t.name: t.schema() for t in registry.tools.values()}, [t.name for t in registry.tools.values() if t.builtin])


def run_batch(spark: SparkSession, notes: DataFrame, inbox: Path, batch: str, definition: str, system: str, registry: Registry, source: str = "", id_column: str = "id", text_column: str = "",
              make_backend=FakeBackend, full: bool = False, forced: DataFrame | None = None, on_definition_change: bool = False, workers: int | None = None, debug_dir: str | None = None) -> dict:
    """Categorise notes against the batch's history, extract what is new, promote the segment, finish the manifest.

    ``forced`` ids run again; with ``on_definition_change`` so do notes that were
    extracted by another prompt or other tools.  The result counts the notes by category,
    and the forced ids that the source lacks.
    """
    folder = Path(inbox) / "fc_extractions" / batch
    pin(folder, definition, source, id_column)
    identity, counts, todo = definition_of(system, registry), {}, notes
    if not full and any(folder.glob("*.jsonl")):
        history = delta.batch_history(events.heads(readers.segments(spark, str(folder))))
        state = notes.select("id", F.col("hash").alias("current"))
        # counted and joined: the history is parsed once
        placed = staged(delta.categorise(state, history, identity, forced, on_definition_change).select("id", "category"), "categories")
        counts = {r.category: r.n for r in placed.groupBy("category").agg(F.count(F.lit(1)).alias("n")).collect()}
        if forced is not None:
            counts["forced_missing"] = delta.unseen_forced(state, forced).count()
        todo = notes.join(placed.where("category <> 'skipped'").select("id"), "id", "left_semi")
    number = next_segment(folder)
    run = runs.start("fc_single", definition, batch_name=batch, source_table=source, system_prompt=system)
    runs.write_manifest(Path(inbox) / "runs", run)
    staging = folder / f".segment-{run['run_id']}"
    out = extract(todo, definition, system, registry, make_backend, {"run_id": run["run_id"], "definition_hash": identity}, run["started_at"], Limits(debug_dir=debug_dir), workers)
    out.select("line").write.text(str(staging))
    tally = events.run_tally(events.heads(spark.read.text(str(staging)))).first()
    total, ok = (tally.total, tally.succeeded) if tally else (0, 0)
    if total:
        promote(staging, folder / f"{number:03d}.jsonl")
        write_json(folder / f"{number:03d}_manifest.json", {"definition": definition, "definition_hash": identity, "source": source, "id_column": id_column, "text_column": text_column, "batch": batch, "run_id": run["run_id"], "processed": total, "succeeded": ok})
    shutil.rmtree(staging)
    runs.complete(Path(inbox) / "runs", run["run_id"], items_processed=total, items_succeeded=ok, items_failed=total - ok)
    return {"run_id": run["run_id"], "segment": number if total else None, "processed": total, "succeeded": ok, "categories": counts}


__all__ = ["Backend", "definition_of", "next_segment", "pin", "run_batch"]
