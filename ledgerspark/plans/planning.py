"""Plans of an import, and what checkpoints make of them."""

from __future__ import annotations

import hashlib
import json
import os
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fingerprint(path: str, batch_size: int, datasets: list[tuple[str, list[tuple[str, int, float]]]]) -> str:
    """SHA-256 over the path, the batch size and each file's path, size and time."""
    iso = lambda t: datetime.fromtimestamp(t, timezone.utc).isoformat(timespec="milliseconds").replace("+00:00", "Z")
    files = [{"dataset": d, "files": [{"relativePath": p, "fileSize": s, "fileMtime": iso(t)} for p, s, t in fs]} for d, fs in datasets]
    body = {"validatedPath": os.path.abspath(path), "batchSize": batch_size, "datasets": files}
    return hashlib.sha256(json.dumps(body, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()


def batches(rows: Column, batch_size: int) -> Column:
    return F.ceil(rows / batch_size).cast("long")


def plan_totals(files: DataFrame, batch_size: int = 500) -> DataFrame:
    """files (dataset, file_path, rows) by dataset: files, rows, batches."""
    return files.groupBy("dataset").agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.sum(batches(F.col("rows"), batch_size)).alias("batches"))


def hydrated(files: DataFrame, checkpoints: DataFrame, batch_size: int = 500) -> DataFrame:
    """Each planned file with its state; a checkpoint counts only if size and time are those of the file."""
    c = checkpoints.select("dataset", "file_path", F.col("file_size").alias("__s"), F.col("file_mtime").alias("__m"), "byte_offset", "rows_committed", "status")
    on = [files[k] == c[k] for k in ("dataset", "file_path")] + [files["file_size"] == c["__s"], files["file_mtime"].eqNullSafe(c["__m"])]
    rows = files.join(c, on, "left").select(*[files[x] for x in files.columns], F.coalesce("byte_offset", F.lit(0)).alias("byte_offset"), F.coalesce("rows_committed", F.lit(0)).alias("rows_committed"), F.coalesce("status", F.lit("pending")).alias("status"))
    done = (F.col("status") == "completed") & (F.col("byte_offset") >= F.col("file_size"))
    return rows.withColumns({"done": done, "resumed": ~done & (F.col("byte_offset") > 0), "batches_done": F.least(batches(F.col("rows"), batch_size), batches(F.col("rows_committed"), batch_size))})


def resumed(files: list[dict], checkpoints: list[dict]) -> list[dict]:
    """hydrated() for an import's own files, on the driver: each file with its cursor and whether it is done."""
    known = {(c["dataset"], c["file_path"], c["file_size"], c["file_mtime"]): c for c in checkpoints}
    out = []
    for f in in_order(files):
        c = known.get((f["dataset"], f["file_path"], f["file_size"], f["file_mtime"]), {"byte_offset": 0, "rows_committed": 0, "status": "pending"})
        done = c["status"] == "completed" and c["byte_offset"] >= f["file_size"]
        out.append(f | {"byte_offset": c["byte_offset"] or 0, "rows_committed": c["rows_committed"] or 0, "status": c["status"], "done": done})
    return out


def in_order(files: list[dict]) -> list[dict]:
    """A plan's files in the order of execution: by dataset, then by file."""
    return sorted(files, key=lambda f: (f["dataset_index"] or 0, f["file_index"]))


def display_path(path: str) -> str:
    """parent > file"""
    parent, name = os.path.split(path)
    return f"{os.path.basename(parent)} > {name}" if os.path.basename(parent) else name


def hydrated_totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("dataset").agg(F.sum("rows_committed").alias("rows_done"), F.sum("batches_done").alias("batches_done"), F.count_if("done").alias("skipped"), F.count_if("resumed").alias("resumed"))


def expected_staged(rows: DataFrame, quarantined: DataFrame) -> DataFrame:
    """Rows that staging must hold by dataset: committed less quarantined, 0 at least."""
    committed = rows.groupBy("dataset").agg(F.sum("rows_committed").alias("c"))
    return committed.join(quarantined.select("dataset", F.col("rows").alias("q")), "dataset", "left").select("dataset", F.greatest(F.lit(0), F.col("c") - F.coalesce("q", F.lit(0))).cast("long").alias("rows"))


def latest(plans: DataFrame, by: list[str]) -> DataFrame:
    """The plan used last, by the columns given."""
    order = F.struct("last_used_at", "updated_at", "id")
    return plans.groupBy(*by).agg(F.max_by(F.struct(*[c for c in plans.columns if c not in by]), order).alias("p")).select(*by, "p.*")


def rate(count: Column, milliseconds: Column, unit: int = 1000) -> Column:
    """count by second (unit 1000) or minute (60000); 0 without either."""
    return F.when((count > 0) & (milliseconds > 0), count / (milliseconds / unit)).otherwise(F.lit(0.0))


def without(rows: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(gone.select(*keys).distinct(), keys, "left_anti")


def delete_plans(plans: DataFrame, files: DataFrame, checkpoints: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Plans that meet the condition go, and their files and materialisation checkpoints."""
    gone = plans.filter(condition).select(F.col("id").alias("plan_id"))
    return plans.filter(~F.coalesce(condition, F.lit(False))), without(files, gone, ["plan_id"]), without(checkpoints, gone, ["plan_id"])


def phase_update(plans: DataFrame, plan_id: int, **changes) -> DataFrame:
    """Only what is given changes."""
    return plans.withColumns({k: F.when(F.col("id") == plan_id, F.lit(v)).otherwise(F.col(k)) for k, v in changes.items() if v is not None})


def next_state(cursor: int, last_staged: int, status: str, expected: int, in_target: int, dataset: str) -> str:
    """What a materialisation does with its checkpoint: replay, resume, keep or start."""
    if cursor > last_staged:
        return "replay"
    if status == "completed":
        if last_staged > cursor:
            return "resume"
        return "replay" if dataset != "partners" and in_target < expected else "keep"
    return "resume" if cursor > 0 else "start"
