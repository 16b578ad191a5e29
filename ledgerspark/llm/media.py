"""Media columns: archives of media members, written and read by a Spark data source.

``media_archive`` is a Spark data source in Python.  Writing makes ZIP archives
of stored members, each task its own, a new one after ``archiveBytes``, so that
an archive's directory is of bounded size; the archives count
from the moment the job commits, when a manifest lists them, so tasks that
failed or ran twice leave nothing that is read.  Reading plans partitions as
byte ranges of the archives, from their sizes alone.  A task opens an archive's
directory, takes the members whose offset is in its range, and streams them in
Arrow batches of bounded size.  A member that can't be read, or whose checksum
is wrong, is tried again by its offset, alone, on a fresh handle.

Options: ``path`` (a folder that all machines share, any store that pyarrow
opens), ``archiveBytes`` (134217728), ``partitionBytes`` (33554432), ``batchBytes`` (4194304), ``retries``
(3), ``onFailure`` (``fail``, or ``null``: the member's row without payload).

``media_features`` stores texts as 8-bit greyscale PNG pictures, 576 samples
wide, and computes everything it returns but media_bytes and media_sha256 from
the samples that were read back.

Defined cases: a missing or empty text is one row of 576 bytes 255; a missing
doc_id is returned missing; repeated rows are separate members; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from .common import shared_dir

MEMBERS = "archive string, offset long, name string, payload binary"
WIDTH = 576
SIGNATURE = b"\x89PNG\r\n\x1a\n"


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else fs.FileSystem.from_uri(path.replace("file:", "file://", 1)) if path.startswith("file:") else (fs.LocalFileSystem(), path)


@dataclass
class ByteRange(InputPartition):
    archive: str
    start: int
    end: int


@dataclass
class Archives(WriterCommitMessage):
    """The archives of a task: names and sizes."""

    made: list[tuple[str, int]]


class ArchiveWriter(DataSourceArrowWriter):
    def __init__(self, path: str, archive_bytes: int):
        self.path, self.archive_bytes = path, archive_bytes

    def write(self, iterator):
        """Archives of the rows (name, payload) of this task."""
        store, root = opened(self.path)
        store.create_dir(root, recursive=True)
        made, out, archive, size = [], None, None, 0

        def close():
            archive.close()
            out.close()
            made.append((name, store.get_file_info(f"{root}/{name}").size))

        for batch in iterator:
            for member, payload in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if archive is None:
                    name, size = f"part-{uuid.uuid4().hex}.zip", 0
                    out = store.open_output_stream(f"{root}/{name}")
                    archive = zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True)
                body = payload.as_buffer().to_pybytes()
                archive.writestr(zipfile.ZipInfo(member), body)
                size += len(body) + len(member) + 256
                if size >= self.archive_bytes:
                    close()
                    archive = None
        if archive is not None:
            close()
        return Archives(made)

    def commit(self, messages):
        store, root = opened(self.path)
        store.create_dir(root, recursive=True)
        with store.open_output_stream(f"{root}/_manifest-{uuid.uuid4().hex}.json") as f:
            f.write(json.dumps([x for m in messages if m is not None for x in m.made]).encode())

    def abort(self, messages):
        store, root = opened(self.path)
        for m in messages:
            for name, _ in m.made if m is not None else []:
                store.delete_file(f"{root}/{name}")


class ArchiveReader(DataSourceReader):
    def __init__(self, options):  # their names ignore case
        self.path = options["path"]
        self.partition_bytes = int(options.get("partitionBytes", 32 << 20))
        self.batch_bytes = int(options.get("batchBytes", 4 << 20))
        self.retries = int(options.get("retries", 3))
        self.failing = options.get("onFailure", "fail") == "fail"

    def partitions(self):
        store, root = opened(self.path)
        found = []
        for info in store.get_file_info(fs.FileSelector(root)):
            if info.base_name.startswith("_manifest-"):
                with store.open_input_stream(info.path) as f:
                    found += json.loads(f.read())
        return [ByteRange(name, at, min(at + self.partition_bytes, size)) for name, size in sorted(found) for at in range(0, size, self.partition_bytes)]

    def member(self, handle, info: zipfile.ZipInfo) -> bytes:
        """The member at info's offset; its header may be longer than the directory says."""
        handle.seek(info.header_offset)
        head = handle.read(30)
        if head[:4] != b"PK\3\4":
            raise OSError(f"no member at {info.header_offset}")
        handle.seek(info.header_offset + 30 + sum(struct.unpack("<HH", head[26:30])))
        body = handle.read(info.compress_size)
        if info.compress_type == zipfile.ZIP_DEFLATED:
            body = zlib.decompress(body, -15)
        if len(body) != info.file_size or zlib.crc32(body) != info.CRC:
            raise OSError(f"the member at {info.header_offset} is damaged")
        return body

    def read(self, partition):
        if partition is None:  # no archive at all
            return
        store, root = opened(self.path)
        where = f"{root}/{partition.archive}"
        schema = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("name", pa.string()), ("payload", pa.binary())])
        handle = store.open_input_file(where)
        with zipfile.ZipFile(handle) as archive:
            infos = sorted((x for x in archive.infolist() if partition.start <= x.header_offset < partition.end), key=lambda x: x.header_offset)
        handle = store.open_input_file(where)
        rows, size = [], 0
        for info in infos:
            body = None
            for attempt in range(self.retries + 1):
                try:
                    body = self.member(handle, info)
                    break
                except (OSError, zlib.error, struct.error):
                    if attempt == self.retries and self.failing:
                        raise
                    handle = store.open_input_file(where)
            rows.append((partition.archive, info.header_offset, info.filename, body))
            size += len(body or b"")
            if size >= self.batch_bytes:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


class MediaArchive(DataSource):
    @classmethod
    def name(cls):
        return "media_archive"

    def schema(self):
        return MEMBERS

    def reader(self, schema):
        return ArchiveReader(self.options)

    def writer(self, schema, overwrite):
        return ArchiveWriter(self.options["path"], int(self.options.get("archiveBytes", 128 << 20)))


def _part(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def picture(body: bytes) -> bytes:
    """An 8-bit greyscale PNG, WIDTH wide, of the bytes and as many bytes 255 as fill its last row."""
    height = max(1, -(-len(body) // WIDTH))
    rows = np.full((height, WIDTH + 1), 255, np.uint8)
    rows[:, 0] = 0
    padded = np.full(height * WIDTH, 255, np.uint8)
    padded[: len(body)] = np.frombuffer(body, np.uint8)
    rows[:, 1:] = padded.reshape(height, WIDTH)
    head = struct.pack(">IIBBBBB", WIDTH, height, 8, 0, 0, 0, 0)
    return SIGNATURE + _part(b"IHDR", head) + _part(b"tEXt", b"Length\0%d" % len(body)) + _part(b"IDAT", zlib.compress(rows.tobytes(), 1)) + _part(b"IEND", b"")


def samples(png: bytes) -> tuple[np.ndarray, int]:
    """The samples of a picture, and the length noted in it."""
    if png[:8] != SIGNATURE:
        raise ValueError("not a PNG file")
    at, body, noted, head = 8, [], 0, b""
    while at < len(png):
        n, kind = struct.unpack(">I4s", png[at : at + 8])
        part = png[at + 8 : at + 8 + n]
        if zlib.crc32(kind + part) != struct.unpack(">I", png[at + 8 + n : at + 12 + n])[0]:
            raise ValueError(f"damaged part {kind!r}")
        at += 12 + n
        if kind == b"IHDR":
            head = part
        elif kind == b"tEXt" and part.startswith(b"Length\0"):
            noted = int(part[7:])
        elif kind == b"IDAT":
            body.append(part)
    width, height = struct.unpack(">II", head[:8])
    rows = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8).reshape(height, width + 1)
    return np.ascontiguousarray(rows[:, 1:]).ravel(), noted


def feature(x: np.ndarray) -> str:
    """Size, mean, deviation, entropy in bits and the brightness of 8 equal stretches."""
    count = np.bincount(x, minlength=256)
    total = np.arange(256) @ count
    mean = total / len(x)
    spread = max(0.0, (np.arange(256) ** 2 @ count) / len(x) - mean * mean) ** 0.5
    p = count[count > 0] / len(x)
    tiles = x.reshape(8, -1).sum(axis=1, dtype=np.int64) * 8 // len(x)
    return f"{WIDTH}x{len(x) // WIDTH};mean={mean:.4f};std={spread:.4f};entropy={abs(-(p * np.log2(p)).sum()):.4f};tiles={bytes(tiles.astype(np.uint8)).hex()}"


def _stored(batches):
    n = 0  # members are numbered through, so that no two of a task share a name
    for batch in batches:
        for start in range(0, batch.num_rows, 1024):
            part = batch.slice(start, 1024)
            names = [f"{n + i}-{'' if d is None else d}.png" for i, d in enumerate(part.column(0).to_pylist())]
            n += part.num_rows
            media = [picture(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in part.column(1).cast(pa.large_binary())]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(media, pa.binary())], ["name", "payload"])


FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def _features(batches):
    types = {"long": pa.int64(), "string": pa.string()}
    fields = [x.split() for x in FEATURES.split(", ")]
    for batch in batches:
        rows = []
        for name, media in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x, n = samples(media)
            own = name.split("-", 1)[1].removesuffix(".png")
            body = x.tobytes()
            rows.append((int(own) if own else None, n, len(body), hashlib.sha256(body).hexdigest(), zlib.crc32(body[-32:]), len(media), hashlib.sha256(media).hexdigest(), feature(x)))
        columns = zip(*rows, strict=True) if rows else [[] for _ in fields]
        yield pa.RecordBatch.from_arrays([pa.array(c, types[k]) for c, (_, k) in zip(columns, fields, strict=True)], [n for n, _ in fields])


def media_features(docs: DataFrame, partition_bytes: int = 8 << 20) -> DataFrame:
    """The columns of FEATURES for each row of docs (doc_id, text), by way of archives in the shared folder."""
    spark = docs.sparkSession
    spark.dataSource.register(MediaArchive)
    path = f"{shared_dir(spark)}/media-{uuid.uuid4().hex}"
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts.mapInArrow(_stored, "name string, payload binary").write.format("media_archive").option("path", path).mode("append").save()
    members = spark.read.format("media_archive").option("path", path).option("partitionBytes", partition_bytes).load()
    return members.select("name", "payload").mapInArrow(_features, FEATURES)
