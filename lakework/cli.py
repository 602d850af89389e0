"""Command line (T): ``python -m lakework.cli --help``."""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import asdict
from pathlib import Path

from lakework import schemas
from lakework.config import load_config, save_config
from lakework.session import build_session

VERSION = "0.1.0"


def _parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="lakework", description="Document lake: inbox, lake, catalog, extraction, review.")
    top.add_argument("--root", type=Path, help="folder with inbox/ and lake/; without it the settings say where they are")
    top.add_argument("--config", type=Path, default=Path("lakework.yaml"), help="settings file, YAML or JSON")
    sub = top.add_subparsers(dest="command", required=True)

    def command(name: str, help: str, *arguments: tuple) -> argparse.ArgumentParser:
        p = sub.add_parser(name, help=help)
        for flags, options in arguments:
            p.add_argument(*flags, **options)
        return p

    dry, remote = (("--dry-run",), {"action": "store_true"}), (("--remote",), {"type": Path})
    command("init", "make the folders")
    command("pull", "copy new files from a remote inbox", remote, dry)
    command("push", "copy new files to a remote inbox", remote, dry)
    command("ingest", "inbox to lake", (("folder",), {"nargs": "*"}), dry)
    command("build-db", "rebuild the catalog", (("--strict",), {"action": "store_true"}), (("--force",), {"action": "store_true", "help": "drop everything first, scratch tables too"}), (("--yes",), {"action": "store_true", "help": "don't ask before --force"}))
    for name in ("forget", "revive"):
        command(name, f"{name} a target", (("kind",), {}), (("target",), {}), (("--reason",), {"default": ""}), (("--actor",), {"default": ""}))
    command("status", "files and findings", (("--check",), {"action": "store_true"}))
    command("schemas", "registered schemas")
    command("version", "this version")
    flag = {"action": "store_true"}
    command(
        "fc", "extraction: run-single, review-package, list, status, peek, unpeek", (("action",), {"choices": ("run-single", "review-package", "list", "status", "manifest", "peek", "unpeek")}), (("name",), {"nargs": "?"}),
        (("--jsonl",), {}), (("--source",), {}), (("--id-col",), {"default": "report_id"}), (("--text-col",), {"default": "report_text"}), (("--where",), {}), (("--cohort",), {}), (("--id-file",), {"type": Path}), (("--limit",), {"type": int}),
        (("--full",), flag), (("--reextract-on-prompt-change",), flag), (("--force-rerun",), {"type": Path}), (("--workers",), {"type": int}), (("--debug-dir",), {}), (("--segment",), {"default": "001"}), (("--only-flagged",), flag),
    )
    command("cohort", "named key lists", (("action",), {"choices": ("add", "list", "info", "remove")}), (("name",), {"nargs": "?"}), (("--file",), {"type": Path}))
    command("runs", "run history", (("action",), {"choices": ("list", "show", "compare")}), (("ids",), {"nargs": "*"}), (("--limit",), {"type": int, "default": 20}), (("--type",), {}))
    command("db", "refresh one folder's tables", (("action",), {"choices": ("update",)}), (("folder",), {}))
    command("adjudication", "compare two batches", (("action",), {"choices": ("create",)}), (("round",), {}), (("left",), {}), (("right",), {}), (("--labels",), {"nargs": 2, "default": ("left", "right")}))
    command("config", "show the settings, or write them", (("--save",), {"action": "store_true"}))
    return top


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    settings = load_config(args.config)
    inbox, lake = (args.root / "inbox", args.root / "lake") if args.root else (Path(settings.inbox), Path(settings.lake))
    say = lambda x: print(json.dumps(x, indent=2, default=str))
    from lakework.plans.ingest import FOLDERS, Ingest, IngestError

    if args.command == "version":
        print(VERSION)
    elif args.command == "schemas":
        say({n: schemas.get_schema(n).key for n in schemas.list_schemas()})
    elif args.command == "init":
        for f in FOLDERS:
            (inbox / f).mkdir(parents=True, exist_ok=True)
            (lake / f).mkdir(parents=True, exist_ok=True)
    elif args.command in ("pull", "push"):
        from lakework.sources import transport

        remote = args.remote or Path(settings.remote)
        out = transport.pull(remote, inbox, args.dry_run) if args.command == "pull" else transport.push(inbox, remote, args.dry_run)
        say(asdict(out))
    elif args.command in ("forget", "revive"):
        from lakework.sources.tombstone_files import write_event

        print(write_event(inbox / "tombstones", args.kind, args.target, args.command, args.reason, args.actor))
    elif args.command == "config":
        say(asdict(settings))
        if args.save:
            save_config(settings, args.config)
    elif args.command == "cohort" and args.action in ("add", "remove", "list", "info"):
        return _cohort(args, inbox, lake, say)
    else:
        spark = build_session()
        if args.command == "ingest":
            try:
                reports = Ingest(spark, inbox, lake, args.dry_run).run(args.folder or None)
            except IngestError as e:
                say([asdict(r) for r in e.reports])
                return 1
            say([asdict(r) for r in reports])
        else:
            return _spark_command(spark, args, inbox, lake, say)
    return 0


def _cohort(args, inbox: Path, lake: Path, say) -> int:
    import shutil

    if args.action == "add":
        target = inbox / "cohorts" / f"{args.name}.csv"
        if target.exists():
            print(f"{target} exists", file=sys.stderr)
            return 1
        target.parent.mkdir(parents=True, exist_ok=True)
        shutil.copyfile(args.file, target)
    elif args.action == "remove":
        shutil.rmtree(lake / "cohorts" / f"{args.name}.parquet", ignore_errors=True)
        (lake / "cohorts" / f"{args.name}.cohort.json").unlink(missing_ok=True)
    else:
        metas = [json.loads(p.read_text()) for p in sorted((lake / "cohorts").glob("*.cohort.json"))]
        say([m for m in metas if args.action == "list" or m["name"] == args.name])
    return 0


def _spark_command(spark, args, inbox: Path, lake: Path, say) -> int:
    from lakework.operators import events, quality, reshape, runs
    from lakework.plans import catalog
    from lakework.plans.ingest import FOLDERS
    from lakework.sources import readers, transport

    if args.command == "build-db":
        if args.force and not args.yes and input("Drop and rebuild all databases, scratch tables too? [y/N] ").strip().lower() != "y":
            return 0
        say({k: asdict(v) for k, v in catalog.build(spark, {db: lake / f for f, (_, db) in FOLDERS.items()}, args.strict, force=args.force).items()})
    elif args.command == "db":
        say(asdict(catalog.refresh(spark, lake / args.folder, FOLDERS[args.folder][1])))
    elif args.command == "status":
        say(transport.status(inbox, list(FOLDERS)))
        if args.check:
            found = quality.check_lake(spark, inbox, lake, FOLDERS)
            found.show(truncate=False)
            return int(not quality.passes(found))
    elif args.command == "runs":
        table = runs.project(spark, str(inbox / "runs"))
        if args.action == "list":
            reshape.recent(table, args.limit, kind=("run_type", args.type) if args.type else None).select("run_id", "run_type", "name", "status", "started_at").show(args.limit, truncate=False)
        elif args.action == "show":
            say([r.asDict() for r in reshape.by_prefix(table, args.ids[0]).collect()])
        else:
            fields = [c for c in table.columns if c != "run_id"]
            reshape.compare_rows(table, *args.ids[:2], fields).where("differs").show(len(fields), truncate=False)
    elif args.command == "fc":
        folder = inbox / "fc_extractions"
        if args.action == "list":
            say(sorted(p.name for p in folder.iterdir() if p.is_dir()))
        elif args.action == "status":
            events.run_tally(events.records(readers.segments(spark, str(folder / args.name))), ["segment"]).orderBy("segment").show()
        elif args.action == "manifest":
            say(json.loads((folder / args.name / "batch.json").read_text()))
        elif args.action == "unpeek":
            say(catalog.unpeek(spark, args.name))
        elif args.action == "peek":
            print(catalog.peek(events.event_table(events.records(readers.segments(spark, str(folder / args.name)))), args.name))
        elif args.action == "review-package":
            from lakework.extract.registry import DEMO, field_schema
            from lakework.plans import rounds

            print(rounds.review_package(spark, inbox, args.name, args.segment, field_schema(DEMO), args.only_flagged))
        else:
            return _run_single(spark, args, inbox, lake, say)
    elif args.command == "adjudication":
        from lakework.extract.registry import DEMO, field_schema
        from lakework.plans import rounds

        print(rounds.adjudication_package(spark, inbox, args.round, args.left, args.right, field_schema(DEMO), "demo", tuple(args.labels)))
    return 0


def _run_single(spark, args, inbox: Path, lake: Path, say) -> int:
    """Extract a source's notes, as far as the batch doesn't have them."""
    from pyspark.sql import functions as F

    from lakework.extract.registry import DEMO
    from lakework.extract.runner import check_arguments
    from lakework.extract.segments import run_batch
    from lakework.functions.hashing import blake2b_128
    from lakework.operators import cohorts
    from lakework.sources import readers

    check_arguments(args.jsonl, args.source, args.where, args.cohort, bool(args.reextract_on_prompt_change or args.force_rerun), args.full, args.name or "")
    if args.id_file and args.cohort:
        raise ValueError("give either an id file or a cohort")
    ids_of = lambda path: cohorts.prepare(readers.read_csv(spark, str(path)), None)
    ids, key = None, None
    if args.cohort:
        meta = json.loads((lake / "cohorts" / f"{args.cohort}.cohort.json").read_text())
        ids, key = spark.read.parquet(str(lake / "cohorts" / f"{args.cohort}.parquet")), meta["key_column"]
        if key.lower() != args.id_col.lower():
            raise ValueError(f"cohort {args.cohort!r} is keyed by {key!r}, not by {args.id_col!r}")
    elif args.id_file:
        ids, key = ids_of(args.id_file)
    if ids is not None:
        ids = ids.select(F.col(key).alias(args.id_col))
    if args.jsonl:
        notes = readers.notes_from_jsonl(spark, args.jsonl, args.id_col, args.text_col, args.limit)[0]
        notes = notes.select("id", "text", F.lit(None).cast("string").alias("mrn"), F.lower(F.hex(blake2b_128(F.col("text")))).alias("hash"))
    else:
        notes = readers.notes_from_table(spark.table(args.source), args.id_col, args.text_col, args.where, ids, args.limit)
    forced = ids_of(args.force_rerun)[0] if args.force_rerun else None
    if forced is not None:
        forced = forced.select(F.col(ids_of(args.force_rerun)[1]))
    say(run_batch(spark, notes, inbox, args.name, "demo", "Record measurements.", DEMO, args.source or args.jsonl, args.id_col, args.text_col, full=args.full, forced=forced,
                  on_definition_change=args.reextract_on_prompt_change, workers=args.workers, debug_dir=args.debug_dir))
    return 0


if __name__ == "__main__":
    sys.exit(main())
