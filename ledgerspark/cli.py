"""The command line: python -m ledgerspark.cli COMMAND."""

from __future__ import annotations

import argparse
import dataclasses
import json
import os
import sys

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

from . import api, ddl, logs, model, reporters, settings
from .errors import AppError, ValidationError
from .operators.export import export_copy
from .sources import files as S
from .warehouse import Warehouse, label


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="ledgerspark")
    top.add_argument("--warehouse")
    commands = top.add_subparsers(dest="command", required=True)

    def command(under, name: str, *paths: str) -> argparse.ArgumentParser:
        p = under.add_parser(name)
        p.add_argument("--logs", help="folder for logs")
        for x in paths:
            p.add_argument(x)
        return p

    for name in ("inspect", "validate"):
        command(commands, name, "path")
    for name in ("extract", "sanitize"):
        command(commands, name, "path").add_argument("--output")
    command(commands, "doctor").add_argument("--input")
    command(commands, "model")
    p = command(commands, "schema")
    p.add_argument("action", choices=("print", "generate"))
    p.add_argument("--profile")
    p.add_argument("--name")
    p.add_argument("--output", help="folder, the current one by default")
    for name in ("import", "load", "materialize"):
        p = command(commands, name, "path")
        p.add_argument("--dataset")
        p.add_argument("--load-batch-size", type=int, default=500)
        p.add_argument("--materialize-batch-size", type=int, default=50_000)
        p.add_argument("--reconcile-lookups", action="store_true")
        p.add_argument("--batches-a-commit", type=int, default=api.Options.batches_a_commit)
        p.add_argument("--chunks-a-commit", type=int, default=api.Options.chunks_a_commit)
        p.add_argument("--verbose-progress", action="store_true")
        p.add_argument("-f", "--force", action="store_true")
    command(commands, "status").add_argument("plan", type=int)
    p = command(commands, "stream", "path")
    p.add_argument("--dataset", required=True)
    p.add_argument("--checkpoint", required=True)
    p = command(commands, "export")
    p.add_argument("table", choices=(*model.STAGED, *model.LOOKUPS))
    p.add_argument("output")
    under = commands.add_parser("quarantine").add_subparsers(dest="action", required=True)
    for name in ("stats", "list"):
        p = command(under, name)
        for x in ("--dataset", "--category", "--stage"):
            p.add_argument(x)
        for x in ("--retryable", "--terminal"):
            p.add_argument(x, action="store_true")
        if name == "list":
            p.add_argument("--limit", type=int, default=20)
            p.add_argument("--after-id", type=int)
    command(under, "show").add_argument("id", type=int)
    under = commands.add_parser("database").add_subparsers(dest="action", required=True)
    command(under, "test")
    p = command(under, "config")
    p.add_argument("step", choices=("set", "show", "reset"))
    p.add_argument("path", nargs="?", default="")
    p = command(under, "cleanup")
    p.add_argument("scope", choices=("staging", "materialized", "checkpoints", "plans"))
    p.add_argument("--phase", default="all")
    p.add_argument("--dataset")
    p.add_argument("--validated-path")
    p.add_argument("--plan-id", type=int)
    p.add_argument("-f", "--force", action="store_true")
    return top


def confirmed(question: str, force: bool) -> bool:
    return force or input(f"{question} [y/N] ").strip().lower() in ("y", "yes")


def _rows(df) -> list[dict]:
    return [r.asDict(recursive=True) for r in df.collect()]


def _quarantine(w: Warehouse, a):
    if a.action == "show":
        return api.quarantine_show(w, a.id).asDict() | {"payload": api.quarantine_payload(w, a.id)}
    filters = {"dataset": a.dataset, "category": a.category, "stage": a.stage, "retryable": a.retryable, "terminal": a.terminal}
    if a.action == "list":
        return _rows(api.quarantine_list(w, a.limit, a.after_id, **filters))
    return {k: _rows(v) for k, v in api.quarantine_stats(w, **filters).items()}


def _cleanup(w: Warehouse, a):
    if not confirmed(f"Clean {a.scope} of {label(w.path)}?", a.force):
        return {"cancelled": True}
    if a.scope == "staging":
        out = api.clean_staging(w, a.dataset, a.validated_path)
    elif a.scope == "materialized":
        out = api.clean_final(w, a.dataset)
    elif a.scope == "checkpoints":
        out = api.clean_checkpoints(w, a.phase, a.dataset, a.validated_path, a.plan_id)
    else:
        out = api.clean_plans(w, a.validated_path, a.plan_id)
    return dataclasses.asdict(out)


def _import(w: Warehouse, a):
    if not confirmed(f"{a.command} {a.path} into {label(w.path)}?", a.force):
        return {"cancelled": True}

    reporter = reporters.Reporter()

    def told(event: dict) -> None:
        if a.logs:
            logs.append_line(os.path.join(a.logs, "progress.jsonl"), event, command=a.command)
        if a.verbose_progress:
            print(json.dumps(event, default=str), file=sys.stderr)
        elif logs.level_of(event["event"]) != "debug":
            reporter(event)

    options = api.Options(a.dataset, a.load_batch_size, a.materialize_batch_size, a.reconcile_lookups, told, a.batches_a_commit, a.chunks_a_commit)
    try:
        out = {"import": api.run_import, "load": api.load, "materialize": api.materialize}[a.command](w, a.path, options)
    finally:
        reporter.close()
    print(reporters.summary(f"{a.command} of {a.path}", out), file=sys.stderr)
    return out


def _config(a):
    if a.step == "set":
        settings.set_warehouse(a.path)
    elif a.step == "reset":
        settings.reset()
    return settings.read()


def run(a, spark: SparkSession | None):
    """(result, success)"""
    if a.command in ("inspect", "validate", "extract", "import", "load", "sanitize", "stream") and not os.path.isdir(a.path):
        raise ValidationError(f"no folder {a.path}")
    if a.command == "inspect":
        entries = S.inspect(a.path)
        return S.summary(entries) | {"entries": [dataclasses.asdict(e) for e in entries]}, True
    if a.command == "validate":
        found = S.validate(a.path)
        del found["entries"]
        return found, found["ok"]
    if a.command == "extract":
        done = S.extract(a.path, a.output)
        return done, all(x["ok"] for x in done)
    if a.command == "model":
        return [{"dataset": d, "columns": n, "required": r} for d, n, r in model.summary()], True
    if a.command == "schema":
        text = ddl.generate(a.profile)
        if a.action == "print":
            return text, True
        path = os.path.abspath(os.path.join(a.output or os.getcwd(), ddl.file_name(ddl.profile_of(a.profile), a.name)))
        with open(path, "w", encoding="utf-8") as f:
            f.write(text)
        return {"written": path}, True
    if a.command == "database" and a.action == "config":
        return _config(a), True
    spark = spark or SparkSession.builder.appName("ledgerspark").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if a.command == "doctor":
        report = api.doctor(spark, a.input, a.warehouse)
        return report, not any("can't" in x or "not reachable" in x for x in report)
    if a.command == "sanitize":
        return _rows(S.sanitize_tree(spark, a.path, a.output or a.path.rstrip("/") + "-sanitized")), True
    w = Warehouse(spark, settings.warehouse_path(a.warehouse))
    if a.command == "quarantine":
        return _quarantine(w, a), True
    if a.command == "status":
        return _rows(api.plan_status(w, a.plan)), True
    if a.command == "export":
        export_copy(w.read(a.table), a.output)
        return {"written": a.output}, True
    if a.command == "stream":
        return {"batches": api.stream(w, a.path, a.dataset, a.checkpoint)}, True
    if a.command == "database":
        return (w.ping() or "reachable", True) if a.action == "test" else (_cleanup(w, a), True)
    return _import(w, a), True


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = sys.argv[1:] if args is None else args
    a = parser().parse_args(args)
    name = logs.command_label(args[2:] if args and args[0] == "--warehouse" else args)
    try:
        result, ok = run(a, spark)
    except (AppError, LookupError, ValueError, OSError, PySparkException) as e:
        print(f"{e.code if isinstance(e, AppError) else 'UNEXPECTED_ERROR'}: {e}", file=sys.stderr)
        if a.logs:
            logs.write_command(a.logs, name, {"error": str(e)}, "error", str(e))
        return 1
    print(result if isinstance(result, str) else json.dumps(result, indent=2, default=str))
    if a.logs:
        logs.write_command(a.logs, name, result, "success" if ok else "error")
    return 0 if ok else 1


if __name__ == "__main__":
    sys.exit(main())
