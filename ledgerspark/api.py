"""The engine's entry points: load, materialise, import, quarantine questions, cleanup, doctor.

A load goes through a dataset's files in commits of whole batches.  One commit
takes the next rows of the files that are not done, appends the valid ones to
staging and the others to quarantine, and moves the files' checkpoints on, all
of it in one transaction: a load that is cut off between two steps has lost and
doubled nothing, and goes on at its cursor.

Materialisation goes through staging by id, in commits of whole chunks.  A chunk
is keyed and deduplicated into a table of what is to be merged, together with
the cursor; the last commit merges that into the final table at once, since a
snapshot is written whole.  Before, the staged rows are counted against the
checkpoints, unless they are known to be unchanged.
"""

from __future__ import annotations

import datetime
import os
import threading
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from pathlib import Path

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .errors import ServiceError, ValidationError
from .model import KEYS, LAYOUTS, SEEDS, STAGED
from .operators import materialize as M
from .operators import normalize as N
from .operators import quarantine as Q
from .operators.tables import last_wins, upsert
from .plans import planning as PL
from .sources import files as S
from .streaming.load import load_stream
from .warehouse import Warehouse, label

#: Lookups before what refers to them.
LOAD_ORDER = (*[d for d in LAYOUTS if d not in STAGED], *STAGED)
CASCADE = {"companies": ("companies", "simples_options", "partners", "establishments")}
HEARTBEAT_SECONDS = 15
#: Chunks are told of at the first and then every so many.
TELL_CHUNKS = 50

Listener = Callable[[dict], None]


@dataclass
class Options:
    """A commit has batches_a_commit batches of a load, or chunks_a_commit chunks of a materialisation."""

    dataset: str | None = None
    load_batch_size: int = 500
    materialize_batch_size: int = 50_000
    reconcile_lookups: bool = False
    on_progress: Listener | None = None
    batches_a_commit: int = 20_000
    chunks_a_commit: int = 200

    def __post_init__(self):
        if self.dataset is not None and self.dataset not in LAYOUTS:
            raise ValidationError(f"no dataset {self.dataset}")
        if min(self.load_batch_size, self.materialize_batch_size, self.batches_a_commit, self.chunks_a_commit) <= 0:
            raise ValidationError("batch sizes must be positive")

    def tell(self, event: str, **payload) -> None:
        if self.on_progress:
            self.on_progress({"event": event} | payload)


@dataclass
class Plan:
    id: int
    path: str
    files: list[dict]  # as import_plan_files
    datasets: list[str]
    reused: bool = False


@dataclass
class Cleanup:
    scope: str
    warehouse: str
    truncated: list[str] = field(default_factory=list)
    deleted: dict[str, int] = field(default_factory=dict)
    notes: list[str] = field(default_factory=list)


def _now() -> datetime.datetime:
    return datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)


@contextmanager
def heartbeat(options: Options, event: str, seconds: float | None = None, **payload) -> Iterator[None]:
    """Tells the event again and again while what is within goes on."""
    done, began = threading.Event(), time.time()

    def beat() -> None:
        while not done.wait(seconds or HEARTBEAT_SECONDS):
            options.tell(event, seconds=time.time() - began, **payload)

    thread = threading.Thread(target=beat, daemon=True)
    thread.start()
    try:
        yield
    finally:
        done.set()
        thread.join()


def plan_import(w: Warehouse, root: str, options: Options) -> Plan:
    """The saved plan of the same files, sizes, times and batch size, or a new one with the rows of each file."""
    spark, found = w.spark, S.validate(root)
    if options.dataset is None and not found["ok"]:
        raise ValidationError("; ".join(found["errors"]))
    if options.dataset and options.dataset not in found["present"]:
        raise ValidationError(f"no files of {options.dataset} below {root}")
    datasets = [d for d in LOAD_ORDER if d == options.dataset or not options.dataset]
    base, entries = found["path"], [e for e in found["entries"] if e.kind == "file" and e.type in datasets]
    uri = {e.path: Path(base, e.path).as_uri().replace("file://", "file:", 1) for e in entries}  # as Spark names files
    mtime = {e.path: os.stat(os.path.join(base, e.path)).st_mtime for e in entries}
    by = [(d, [(e.path, e.size, mtime[e.path]) for e in entries if e.type == d]) for d in datasets]
    print_ = PL.fingerprint(root, options.load_batch_size, by)
    plans, files = w.control("import_plans"), w.control("import_plan_files")
    saved = max((p for p in plans.rows() if p["source_fingerprint"] == print_), key=lambda p: p["id"], default=None)
    if saved:
        plans.put([{"id": saved["id"], "last_used_at": _now()}], ("id",))
        options.tell("import_plan_reused", plan=saved["id"])
        return Plan(saved["id"], base, PL.in_order([x for x in files.rows() if x["plan_id"] == saved["id"]]), datasets, True)
    options.tell("preparing_progress", files=len(entries))
    counted = {r.file_path: r.rows for r in S.row_counts(S.read_lines(spark, [os.path.join(base, e.path) for e in entries])).collect()}
    with w.transaction() as t:  # the plan and its files, or neither
        new = w.store.counter("import_plans") + 1
        t.count("import_plans", new)
        rows = [
            {"plan_id": new, "dataset": d, "dataset_index": k, "file_index": i, "file_path": uri[p], "display_path": PL.display_path(uri[p]), "file_size": size, "file_mtime": at, "rows": counted.get(uri[p], 0), "batches": -(-counted.get(uri[p], 0) // options.load_batch_size)}
            for k, (d, members) in enumerate(by) for i, (p, size, at) in enumerate(members)
        ]
        files.put(rows, ("plan_id", "dataset", "file_index"))
        times = {"created_at": _now(), "last_used_at": _now()}
        plans.put([{"id": new, "source_fingerprint": print_, "validated_path": os.path.abspath(root), "target_database": label(w.path), "batch_size": options.load_batch_size, "datasets": " ".join(datasets), "status": "planned", "load_status": "pending", "materialization_status": "pending"} | times], ("id",))
    options.tell("import_plan_ready", plan=new, rows=sum(r["rows"] for r in rows))
    return Plan(new, base, rows, datasets)


def set_plan(w: Warehouse, plan_id: int, **changes) -> None:
    w.control("import_plans").put([{"id": plan_id} | changes], ("id",))


def slices(files: list[dict], size: int) -> Iterator[list[tuple[dict, int, int]]]:
    """(file, from, to) by commit: the rows that are not committed yet, in order, at most size a commit."""
    now, room = [], size
    for f in files:
        at = f["rows_committed"]
        while True:
            to = min(f["rows"], at + room)
            now.append((f, at, to))
            room -= to - at
            at = to
            if room == 0:
                yield now
                now, room = [], size
            if at == f["rows"]:
                break
    if now:
        yield now


def load_slice(w: Warehouse, dataset: str, part: list[tuple[dict, int, int]]) -> tuple[int, int]:
    """Rows and quarantined rows of a commit: staging, quarantine and checkpoints change together."""
    spark = w.spark
    target, quarantine = w.table(f"staging_{dataset}" if dataset in STAGED else dataset), w.table("import_quarantine")
    with w.transaction() as t:
        name = f"staged {dataset}"
        first = max(w.store.counter(name), M.state(target.read()).first().last_id if dataset in STAGED else 0)
        before, bounds, at = w.store.counter("quarantined"), [], first
        for f, low, high in part:
            bounds.append((f["file_path"], low, high, at - low))
            at += high - low
        planned = at - first
        good = bad = 0
        offsets: dict[str, int] = {}
        if planned:
            lines = S.numbered(S.read_lines(spark, sorted({b[0] for b in bounds}))).join(F.broadcast(spark.createDataFrame(bounds, "file_path string, low bigint, high bigint, before bigint")), "file_path")
            lines = lines.filter("row_number > low AND row_number <= high")
            rows = N.dataset_rows(lines, dataset).withColumn("staging_id", F.col("before") + F.col("row_number")).persist(StorageLevel.DISK_ONLY)
            try:
                counts = rows.groupBy("file_path").agg(F.count_if(F.col("error").isNull()).alias("good"), F.count_if(F.col("error").isNotNull()).alias("bad"), F.max("next_offset").alias("at")).collect()
                good, bad, offsets = sum(r.good for r in counts), sum(r.bad for r in counts), {r.file_path: r.at for r in counts}
                if good + bad != planned:
                    raise ServiceError(f"{dataset}: {planned} rows planned, {good} staged and {bad} quarantined")
                if dataset in STAGED:
                    target.append(N.valid(rows))
                else:
                    target.replace(upsert(target.read(), last_wins(N.valid(rows), KEYS[dataset], "staging_id"), KEYS[dataset]))
                if bad:  # ids in the order of files and rows; those of valid rows are left out
                    found = N.quarantined(rows, dataset, F.col("file_path"), F.col("row_number"), id_=F.col("staging_id") - first + before, offset=F.col("next_offset"))
                    quarantine.append(found.withColumn("created_at", F.current_timestamp()))
            finally:
                rows.unpersist()
        t.count(name, at)
        t.count("quarantined", before + planned)
        states = []
        for f, _, high in part:
            done = high == f["rows"]
            states.append(_checkpoint(f) | {"byte_offset": f["file_size"] if done else offsets.get(f["file_path"], 0), "rows_committed": high, "status": "completed" if done else "in_progress", "last_error": None})
        w.control("import_checkpoints").put(states, ("dataset", "file_path"))
    return good, bad


def _checkpoint(f: dict) -> dict:
    return {k: f[k] for k in ("dataset", "file_path", "file_size", "file_mtime")}


def load_dataset(w: Warehouse, plan: Plan, dataset: str, options: Options) -> dict:
    """Rows and quarantined rows of the dataset's files that are not loaded yet."""
    w.ensure_shape(f"staging_{dataset}" if dataset in STAGED else dataset, "Staged rows can't be added.")
    state = PL.resumed([f for f in plan.files if f["dataset"] == dataset], w.control("import_checkpoints").rows())
    todo = [f for f in state if not f["done"]]
    result = {"dataset": dataset, "files": len(todo), "resumed": sum(f["rows_committed"] > 0 for f in todo), "rows": 0, "quarantined": 0, "commits": 0}
    if not todo:
        return result
    options.tell("dataset_started", **result)
    began = time.time()
    for part in slices(todo, options.load_batch_size * options.batches_a_commit):
        try:
            good, bad = load_slice(w, dataset, part)
        except Exception as e:
            # what was committed before stays: only status and message change
            known = {(x["dataset"], x["file_path"]): x for x in w.control("import_checkpoints").rows()}
            same = lambda f: known.get((dataset, f["file_path"]), {}) if f["rows_committed"] else {"byte_offset": 0, "rows_committed": 0}
            w.control("import_checkpoints").put([{"byte_offset": 0, "rows_committed": 0} | same(f) | _checkpoint(f) | {"status": "failed", "last_error": str(e)[:1000]} for f, low, _ in part if low == f["rows_committed"]], ("dataset", "file_path"))
            options.tell("file_failed", dataset=dataset, message=str(e)[:1000])
            raise
        result["rows"], result["quarantined"], result["commits"] = result["rows"] + good, result["quarantined"] + bad, result["commits"] + 1
        options.tell("batch_committed", dataset=dataset, batch_rows=good + bad, total_rows=result["rows"], commits=result["commits"])
        if bad:
            options.tell("row_quarantined", dataset=dataset, rows=bad)
    seconds = time.time() - began
    options.tell("dataset_completed", seconds=seconds, rows_per_second=result["rows"] / seconds if seconds else 0.0, **result)
    return result


def load(w: Warehouse, root: str, options: Options | None = None) -> dict:
    """Staged rows of all datasets below root; lookups go to their tables at once."""
    options = options or Options()
    plan = plan_import(w, root, options)
    set_plan(w, plan.id, status="in_progress", load_status="in_progress")
    try:
        done = [load_dataset(w, plan, d, options) for d in plan.datasets]
    except Exception as e:
        set_plan(w, plan.id, status="failed", load_status="failed", last_error=str(e)[:1000])
        raise
    set_plan(w, plan.id, load_status="completed", last_error=None)
    return {"plan": plan.id, "reused": plan.reused, "datasets": done}


def plan_status(w: Warehouse, plan_id: int) -> DataFrame:
    """A plan's files, rows and batches by dataset, what of them is done, and the rows that staging must hold."""
    files, plan = w.read("import_plan_files").filter(F.col("plan_id") == plan_id), next((p for p in w.control("import_plans").rows() if p["id"] == plan_id), None)
    size = plan["batch_size"] if plan else Options.load_batch_size
    rows = PL.hydrated(files, w.read("import_checkpoints"), size)
    expected = PL.expected_staged(rows, Q.quarantined_rows(w.read("import_quarantine"), files, plan_id))
    return PL.plan_totals(files, size).join(PL.hydrated_totals(rows), "dataset").join(expected.select("dataset", F.col("rows").alias("expected")), "dataset")


EMPTY = {"status": "pending", "last_staging_id": 0, "chunks_completed": 0, "rows_materialized": 0, "staged_rows": None, "staged_max_id": None, "lookups_status": "pending", "lookups_rows": None, "lookups_max_id": None, "lookups_added": 0, "last_error": None}


def staged_state(w: Warehouse, plan_id: int, dataset: str, own: dict, options: Options) -> tuple[int, int]:
    """(rows, greatest id) of staging, which must agree with the load's checkpoints."""
    staging = w.read(f"staging_{dataset}")
    if own["status"] == "completed" and own["staged_max_id"]:
        last = staging.agg(F.max("staging_id")).first()[0]
        options.tell("materialization_staging_validation_checked", dataset=dataset, reused=last == own["staged_max_id"])
        if last == own["staged_max_id"]:
            return own["staged_rows"], last
    found = M.state(staging).first()
    status = plan_status(w, plan_id).filter(F.col("dataset") == dataset).first()
    expected, bad = (status.expected, status.rows_done - status.expected) if status else (0, 0)
    options.tell("materialization_staging_validation_completed", dataset=dataset, expected=expected, staged=found.rows, quarantined=bad)
    if not found.rows:
        raise ValidationError(f"staging of {dataset} is empty; {expected} rows are expected. Load it before.")
    if expected > 0 and found.rows != expected:
        raise ValidationError(f"staging of {dataset} holds {found.rows} rows, {expected} are expected by the checkpoints. Load it again or clean the checkpoints.")
    return found.rows, found.last_id


def materialize_dataset(w: Warehouse, plan_id: int, dataset: str, options: Options) -> dict:
    checkpoints, target, merging = w.control("import_materialization_checkpoints"), w.table(dataset), w.table(f"merging_{dataset}")
    own = next((x for x in checkpoints.rows() if x["plan_id"] == plan_id and x["dataset"] == dataset), None)
    own = EMPTY | (own or {"plan_id": plan_id, "dataset": dataset})
    w.ensure_shape(dataset, "The final table can't be written.")
    staged, last = staged_state(w, plan_id, dataset, own, options)
    step = PL.next_state(own["last_staging_id"], last, own["status"], own["rows_materialized"], target.read().count(), dataset)
    if dataset == "partners" and step == "keep" and own["rows_materialized"] and target.read().isEmpty():
        step = "replay"
    result = {"dataset": dataset, "step": step, "last_staging_id": last, "rows": own["rows_materialized"], "chunks": 0, "placeholders": 0}
    if step == "keep":
        return result

    def save(**changes) -> None:
        own.update(changes)
        checkpoints.put([dict(own)], ("plan_id", "dataset"))

    options.tell("materialization_dataset_started", **result)
    began = time.time()
    try:
        with heartbeat(options, "materialization_dataset_heartbeat", dataset=dataset):
            if step in ("replay", "start"):
                with w.transaction():
                    merging.truncate()
                    save(**(EMPTY | {"status": "in_progress"}))
            staging = w.read(f"staging_{dataset}")
            known = own["lookups_status"] == "completed" and (own["lookups_rows"], own["lookups_max_id"]) == (staged, last)
            if options.reconcile_lookups and not known:
                needed = {t: w.read(t) for t in M.REFERENCES.get(dataset, {}).values()}
                with w.transaction():
                    for name, fresh in M.placeholders(staging, dataset, needed).items():
                        if n := fresh.count():
                            w.table(name).replace(needed[name].unionByName(fresh))
                            result["placeholders"] += n
                    save(lookups_status="completed", lookups_rows=staged, lookups_max_id=last, lookups_added=own["lookups_added"] + result["placeholders"])
            size, at = options.materialize_batch_size * options.chunks_a_commit, own["last_staging_id"]
            while at < last:
                to = min(last, at + size)
                with w.transaction():
                    rows = staging.filter((F.col("staging_id") > at) & (F.col("staging_id") <= to))
                    merging.append(M.deduped(M.keyed(rows, dataset), dataset))
                    save(status="in_progress", last_staging_id=to, chunks_completed=own["chunks_completed"] + 1, staged_rows=staged, staged_max_id=last, last_error=None)
                at = to
                result["chunks"] += 1
                if result["chunks"] == 1 or result["chunks"] % TELL_CHUNKS == 0 or at >= last:
                    options.tell("materialization_chunk_completed", dataset=dataset, chunks=result["chunks"], last_staging_id=at)
            with w.transaction():
                target.replace(M.merged(merging.read(), target.read(), dataset))
                result["rows"] = target.read().count()
                merging.truncate()
                save(status="completed", rows_materialized=result["rows"], last_staging_id=last, staged_rows=staged, staged_max_id=last, last_error=None)
    except Exception as e:
        kept = next((x for x in checkpoints.rows() if x["plan_id"] == plan_id and x["dataset"] == dataset), own)
        checkpoints.put([EMPTY | kept | {"status": "failed", "last_error": str(e)[:1000]}], ("plan_id", "dataset"))
        options.tell("materialization_dataset_failed", dataset=dataset, message=str(e)[:1000])
        raise
    options.tell("materialization_dataset_completed", seconds=time.time() - began, **result)
    return result


def materialize(w: Warehouse, root: str, options: Options | None = None) -> dict:
    """Final tables from staging, by the plan of root that was used last."""
    options = options or Options()
    plan = max((p for p in w.control("import_plans").rows() if p["validated_path"] == os.path.abspath(root)), key=lambda p: (p["last_used_at"], p["updated_at"], p["id"]), default=None)
    if plan is None:
        raise ValidationError(f"nothing was loaded from {root}")
    set_plan(w, plan["id"], materialization_status="in_progress")
    try:
        done = [materialize_dataset(w, plan["id"], d, options) for d in STAGED if d in plan["datasets"].split() and options.dataset in (None, d)]
    except Exception as e:
        set_plan(w, plan["id"], status="failed", materialization_status="failed", last_error=str(e)[:1000])
        raise
    set_plan(w, plan["id"], status="completed", materialization_status="completed", last_error=None)
    return {"plan": plan["id"], "datasets": done}


def run_import(w: Warehouse, root: str, options: Options | None = None) -> dict:
    options = options or Options()
    options.tell("import_started", path=root)
    began = time.time()
    try:
        loaded = load(w, root, options)
        final = materialize(w, root, options)
    except Exception as e:
        options.tell("import_failed", message=str(e)[:1000])
        raise
    seconds, rows = time.time() - began, sum(d["rows"] for d in loaded["datasets"])
    out = {"plan": loaded["plan"], "loaded": loaded["datasets"], "materialized": final["datasets"], "rows": rows, "seconds": seconds, "rows_per_second": rows / seconds if rows else 0.0}
    options.tell("import_finished", rows=rows, seconds=seconds)
    return out


def quarantine_stats(w: Warehouse, **filters) -> dict[str, DataFrame]:
    rows = w.read("import_quarantine")
    return {"totals": Q.totals(rows, **filters)} | {by: Q.counts(rows, by, **filters) for by in ("dataset", "error_category", "error_stage")}


def quarantine_list(w: Warehouse, limit: int = 20, after_id: int | None = None, **filters) -> DataFrame:
    return Q.page(w.read("import_quarantine"), limit, after_id, **filters)


def quarantine_show(w: Warehouse, id_: int):
    return Q.shown(w.read("import_quarantine"), id_)


def quarantine_payload(w: Warehouse, id_: int) -> dict | None:
    """What a quarantined row was parsed to, read back from its JSON by the dataset's types."""
    row = quarantine_show(w, id_)
    return Q.payload(w.spark, row.parsed_payload, row.dataset)


def _datasets(dataset: str | None, cascade: bool = False) -> tuple[str, ...]:
    if dataset is None:
        return STAGED
    if dataset not in STAGED:
        raise ValidationError(f"{dataset} has no staged and final table; one of {', '.join(STAGED)} has")
    return CASCADE.get(dataset, (dataset,)) if cascade else (dataset,)


def _plans(w: Warehouse, plan_id: int | None, path: str | None) -> set[int]:
    if plan_id is not None and plan_id <= 0:
        raise ValidationError("the plan's id must be positive")
    return {p["id"] for p in w.control("import_plans").rows() if (plan_id is None or p["id"] == plan_id) and (path is None or plan_id is not None or p["validated_path"] == os.path.abspath(path))}


def _drop_materialization(w: Warehouse, plans: set[int], dataset: str | None) -> int:
    return w.control("import_materialization_checkpoints").drop(lambda x: x["plan_id"] in plans and dataset in (None, x["dataset"]))


def clean_staging(w: Warehouse, dataset: str | None = None, path: str | None = None) -> Cleanup:
    out = Cleanup("staging", label(w.path))
    with w.transaction():
        for d in _datasets(dataset):
            w.table(f"staging_{d}").truncate()
            w.table(f"merging_{d}").truncate()
            out.truncated.append(f"staging_{d}")
        if path:
            out.deleted["materialization checkpoints"] = _drop_materialization(w, _plans(w, None, path), dataset)
            out.notes.append("The materialisation of this path starts over.")
    return out


def clean_final(w: Warehouse, dataset: str | None = None) -> Cleanup:
    out = Cleanup("materialized", label(w.path))
    with w.transaction():
        for d in _datasets(dataset, cascade=True):
            w.table(d).truncate()
            out.truncated.append(d)
    out.notes.append("Materialisation checkpoints were kept.")
    return out


def clean_checkpoints(w: Warehouse, phase: str = "all", dataset: str | None = None, path: str | None = None, plan_id: int | None = None) -> Cleanup:
    if phase not in ("load", "materialization", "all"):
        raise ValidationError(f"no phase {phase}")
    if dataset is not None and dataset not in LAYOUTS:
        raise ValidationError(f"no dataset {dataset}")
    out, plans = Cleanup("checkpoints", label(w.path)), _plans(w, plan_id, path)
    if phase != "materialization":
        out.deleted["load checkpoints"] = w.control("import_checkpoints").drop(lambda x: dataset in (None, x["dataset"]))
    if phase != "load":
        out.deleted["materialization checkpoints"] = _drop_materialization(w, plans, dataset)
        if plan_id is None and path is None:
            out.notes.append("Without a plan or a path, the materialisation checkpoints of all plans went.")
    return out


def clean_plans(w: Warehouse, path: str | None = None, plan_id: int | None = None) -> Cleanup:
    out, gone = Cleanup("plans", label(w.path)), _plans(w, plan_id, path)
    with w.transaction():
        out.deleted["plan files"] = w.control("import_plan_files").drop(lambda x: x["plan_id"] in gone)
        out.deleted["materialization checkpoints"] = _drop_materialization(w, gone, None)
        out.deleted["plans"] = w.control("import_plans").drop(lambda x: x["id"] in gone)
    return out


def doctor(spark: SparkSession, path: str | None = None, warehouse: str | None = None) -> list[str]:
    """What can be reached."""
    from .settings import warehouse_path

    report = [f"Input path {'reachable' if os.path.exists(path) else 'not reachable'}: {path}"] if path else []
    try:
        Warehouse(spark, warehouse_path(warehouse)).ping()
        return [*report, "The warehouse can be used."]
    except Exception as e:  # whatever it is belongs in the report
        return [*report, f"The warehouse can't be used: {e}"]


def seeds(w: Warehouse) -> None:
    """The lookups that are not imported."""
    for name in SEEDS:
        w.table(name).replace(upsert(w.read(name), w.spark.createDataFrame(list(SEEDS[name].items()), w.table(name).schema), ("code",)))


def stream(w: Warehouse, path: str, dataset: str, checkpoint: str, options: Options | None = None) -> int:
    """Loads what is new below path since the last call with this checkpoint; how many batches were taken in.

    A batch's staged and quarantined rows and its number become visible
    together, so one that the stream gives again is left out.
    """
    options = options or Options()
    if dataset not in STAGED:
        raise ValidationError(f"{dataset} is not staged")
    staging, quarantine, name = w.table(f"staging_{dataset}"), w.table("import_quarantine"), f"stream {dataset} {checkpoint}"
    taken = 0

    def take(good: DataFrame, bad: DataFrame, number: int) -> None:
        nonlocal taken
        if w.store.counter(name) > number:
            return
        with w.transaction() as t:
            first = max(w.store.counter(f"staged {dataset}"), M.state(staging.read()).first().last_id)
            before, rows, wrong = w.store.counter("quarantined"), good.count(), bad.count()
            staging.append(M.with_ids(good, "staging_id", first))
            if wrong:
                quarantine.append(M.with_ids(bad, "id", before).withColumn("created_at", F.current_timestamp()))
            t.count(f"staged {dataset}", first + rows)
            t.count("quarantined", before + wrong)
            t.count(name, number + 1)
        taken += 1
        options.tell("batch_committed", dataset=dataset, batch=number, batch_rows=rows, quarantined=wrong)

    load_stream(w.spark, path, dataset, checkpoint, take).awaitTermination()
    return taken
