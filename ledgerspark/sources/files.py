"""Input trees: what is in them, archives, and lines with their place."""

from __future__ import annotations

import os
import re
import unicodedata
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..errors import ValidationError
from ..functions.parsing import utrim
from ..model import FULL_NAMES, LAYOUTS, SHORT_NAMES


@dataclass(frozen=True)
class Entry:
    path: str
    name: str
    kind: str  # file or directory
    size: int
    type: str


def plain_name(name: str) -> str:
    """Without accents, case, .zip, separators and a number at the end."""
    bare = "".join(c for c in unicodedata.normalize("NFD", name) if not "̀" <= c <= "ͯ").lower().removesuffix(".zip")
    return re.sub(r"\d+$", "", re.sub(r"[\s._\-/\\]+", "", bare))


def dataset_of(path: str) -> str:
    """The dataset that a path names, zip-archive, or unknown. The whole path is tried before the last part."""
    if path.lower().endswith(".zip"):
        return "zip-archive"
    for name in map(plain_name, (path, os.path.basename(path))):
        for alias, dataset in FULL_NAMES.items():
            if name.startswith(alias):
                return dataset
        for alias, dataset in SHORT_NAMES.items():
            if alias in name:
                return dataset
    return "unknown"


def natural(path: str) -> list:
    """A sort key: numbers by value, letters without case and accents."""
    return [int(x) if x.isdigit() else x for x in re.split(r"(\d+)", "".join(c for c in unicodedata.normalize("NFD", path) if not unicodedata.combining(c)).casefold())]


def inspect(root: str) -> list[Entry]:
    out = []
    for folder, folders, files in os.walk(root):
        for name, kind in [(x, "directory") for x in folders] + [(x, "file") for x in files]:
            full = os.path.join(folder, name)
            rel = os.path.relpath(full, root).replace(os.sep, "/")
            out.append(Entry(rel, name, kind, os.path.getsize(full) if kind == "file" else 0, dataset_of(rel)))
    return sorted(out, key=lambda e: natural(e.path))


def input_mode(entries: list[Entry]) -> str:
    zips = sum(e.type == "zip-archive" for e in entries)
    known = sum(e.type in LAYOUTS for e in entries)
    if not entries:
        return "empty"
    if zips and not known:
        return "zip-only"
    return "extracted" if known and not zips else "mixed"


def summary(entries: list[Entry]) -> dict:
    counts: dict[str, int] = {}
    for e in entries:
        counts[e.type] = counts.get(e.type, 0) + 1
    mode = input_mode(entries)
    return {"mode": mode, "counts": counts, "missing": [d for d in LAYOUTS if d not in counts], "next": "extract" if mode in ("zip-only", "mixed") else "validate"}


def selected(root: str) -> tuple[str, list[Entry]]:
    """The folder to validate and its entries: of a mixed tree what was extracted, by paths from there, or else all but archives."""
    entries = inspect(root)
    if input_mode(entries) != "mixed":
        return os.path.abspath(root), entries
    inner = [e for e in entries if e.path == "extracted" or e.path.startswith("extracted/")]
    if inner:
        return os.path.abspath(os.path.join(root, "extracted")), [replace(e, path=e.path.removeprefix("extracted/") if e.path != "extracted" else ".") for e in inner]
    return os.path.abspath(root), [e for e in entries if not e.path.lower().endswith(".zip")]


def validate(root: str) -> dict:
    """ok, errors, warnings, present and missing datasets, the folder and its entries; only files count."""
    path, entries = selected(root)
    files = [e for e in entries if e.kind == "file"]
    unknown = [e.path for e in files if e.type == "unknown"]
    present = [d for d in LAYOUTS if any(e.type == d for e in files)]
    missing = [d for d in LAYOUTS if d not in present]
    errors = [f"Missing dataset: {d}" for d in missing]
    return {"ok": not errors, "errors": errors, "warnings": [f"Unknown file: {x}" for x in unknown[:5]], "present": present, "missing": missing, "next": "sanitize" if not errors else "extract", "path": path, "entries": entries}


def extract(root: str, out: str | None = None) -> list[dict]:
    """Each archive below root into a folder of its name; one that fails does not stop the others."""
    out = out or os.path.join(root, "extracted")
    found = []
    for folder, folders, files in os.walk(root):
        folders[:] = sorted(f for f in folders if f != "extracted")
        found += [os.path.join(folder, f) for f in sorted(files, key=natural) if f.lower().endswith(".zip")]
    results = []
    for path in found:
        to = os.path.join(out, os.path.basename(path)[:-4])
        try:
            with zipfile.ZipFile(path) as z:
                names = z.infolist()
                if any(os.path.isabs(i.filename) or ".." in i.filename.split("/") for i in names):
                    raise zipfile.BadZipFile("a member leaves the folder")
                z.extractall(to)
            results.append({"archive": path, "to": to, "ok": True, "bytes": sum(i.file_size for i in names), "error": None})
        except (zipfile.BadZipFile, OSError) as e:
            results.append({"archive": path, "to": to, "ok": False, "bytes": 0, "error": str(e)})
    return results


def read_lines(spark: SparkSession, path: str | list[str], recursive: bool = False) -> DataFrame:
    """file_path, start (offset of its split), value: lines end at LF only; one CR before it goes; bad bytes become U+FFFD."""
    raw = spark.read.option("lineSep", "\n").option("recursiveFileLookup", str(recursive).lower()).text(path)
    value = F.regexp_replace(F.make_valid_utf8("value"), "\r$", "")
    return raw.select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("start"), F.col("_metadata.file_size").alias("file_size"),
        F.monotonically_increasing_id().alias("at"), F.octet_length("value").alias("bytes"), F.endswith("value", F.lit("\r")).alias("cr"), value.alias("value"),
    )


def numbered(lines: DataFrame, after: int = 0) -> DataFrame:
    """With line_number, row_number (blank lines don't count) and next_offset, for each file by itself.

    after: only lines that start at this offset or later, numbered from there.
    A last line without LF keeps its CR.  The lines of a split are counted
    first; a window then runs over splits, not over all lines of a file, and a
    second one over a split's lines.
    """
    size = F.col("bytes") + 1
    own = Window.partitionBy("file_path", "start").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("file_path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)

    def places(rows: DataFrame, **sums) -> DataFrame:
        parts = rows.groupBy("file_path", "start").agg(*[F.sum(v).alias(k) for k, v in sums.items()])
        parts = parts.select("file_path", "start", *[F.coalesce(F.sum(k).over(before), F.lit(0)).alias(f"{k}0") for k in sums])
        return rows.withColumns({k: F.sum(v).over(own) for k, v in sums.items()}).join(parts, ["file_path", "start"]).withColumns({k: F.col(k) + F.col(f"{k}0") for k in sums}).drop(*[f"{k}0" for k in sums])

    filled = (utrim(F.col("value")) != "").cast("long")
    if after:
        rows = places(places(lines, b=size).filter(F.col("b") - size >= after), n=F.lit(1), f=filled)
    else:
        rows = places(lines, n=F.lit(1), f=filled, b=size)
    end = F.col("b")
    open_end = end > F.col("file_size")
    value = F.when(open_end & F.col("cr"), F.concat("value", F.lit("\r"))).otherwise(F.col("value"))
    return rows.select("file_path", F.col("n").alias("line_number"), F.col("f").alias("row_number"), F.least(end, "file_size").alias("next_offset"), value.alias("value"))


def row_counts(lines: DataFrame) -> DataFrame:
    """Lines that are not blank, by file."""
    return lines.filter(utrim(F.col("value")) != "").groupBy("file_path").agg(F.count(F.lit(1)).alias("rows"))


def opened(path: str):
    """(file system, path in it) of a path or URI, for any store that pyarrow opens."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = re.sub(r"^file:/+", "/", path)
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), os.path.abspath(path))


def _blocks(stream, size: int = 8 << 20) -> Iterator[bytes]:
    while block := stream.read(size):
        yield block


def sanitize_tree(spark: SparkSession, root: str, out: str) -> DataFrame:
    """Every file below root without NUL bytes to the same place below out; path, bytes, removed, changed.

    Each file is streamed by one task in blocks, to a name of the attempt that
    is moved into place at the end.  root and out are folders that all machines
    share.
    """
    store, base = opened(root)
    _, target = opened(out)

    def job(batches):
        import uuid

        import pyarrow as pa

        own, _ = opened(root)
        there, _ = opened(out)
        for batch in batches:
            rows = []
            for path in batch.column(0).to_pylist():
                rel = os.path.relpath(opened(path)[1], base)
                to, size, removed, lines, last = f"{target}/{rel}", 0, 0, 0, b""
                there.create_dir(os.path.dirname(to), recursive=True)
                part = f"{to}.{uuid.uuid4().hex}"
                with own.open_input_stream(opened(path)[1]) as source, there.open_output_stream(part) as sink:
                    for block in _blocks(source):
                        clean = block.replace(b"\0", b"")
                        removed += len(block) - len(clean)
                        size += len(clean)
                        lines += clean.count(b"\n")
                        last = clean[-1:] or last
                        sink.write(clean)
                there.move(part, to)
                rows.append((rel, size, removed, lines + (bool(size) and last != b"\n")))
            columns = list(zip(*rows, strict=True)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), *[pa.array(c, pa.int64()) for c in columns[1:]]], ["path", "bytes", "removed", "lines"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.select("path").mapInArrow(job, "path string, bytes long, removed long, lines long").withColumn("changed", F.col("removed") > 0)
