"""Parts that several operators share: word and n-gram hashing, chunks, tables.

Texts are handled as UTF-8 bytes in numpy.  A word is a run of bytes other than
0x20 and 0x09-0x0D; that equals the code-point pattern ``[^\\x20\\x09-\\x0D]+``.
Hashes are 64 bits: a polynomial over the bytes, finished by a mixer.  Two
different strings share a hash with a chance of about 2**-64, which is the only
inexact step of the operators that compare by hash.
"""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
BLOCK = 1 << 16
WORD_JAVA = r"[^\x20\x09-\x0D]+"
NO_ID = np.iinfo(np.int64).max


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; in local mode a temporary one may be set."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        found = tempfile.mkdtemp(prefix="shared-")
        spark.sparkContext.setCheckpointDir(found)
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


#: The folders that this session's tables were written to and that are still there.
MADE: list[str] = []
#: Whether Spark removes an execution's shuffle files when it ends; else they stay until the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written as Parquet to the shared folder and read again: its lineage ends there, and so do its shuffle files."""
    path, conf = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}", df.sparkSession.conf
    was = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path, compression="zstd")
    finally:
        conf.set(CLEANUP, was) if was is not None else conf.unset(CLEANUP)
    MADE.append(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Removes tables that nothing reads any more."""
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        if path in MADE:
            MADE.remove(path)


def chunked(docs: DataFrame, chunk_bytes: int, *more: Column) -> tuple[DataFrame, int]:
    """(chunk, doc_id, text, ...) and the number of chunks, each of about chunk_bytes of text.

    No key decides a chunk: the hash takes the id, the text's length and the
    row's place in its file, so copies, sources, missing ids and rows that repeat
    spread.  The place must not depend on the run, so docs should be a scan of
    files (or a table written before), not the output of a shuffle.
    """
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    total = docs.agg(F.sum(size.cast("long")).alias("b"), F.count(F.lit(1)).alias("n")).first()
    n = max(1, -(-((total["b"] or 0) + 64 * total["n"]) // chunk_bytes))
    chunk = F.pmod(F.xxhash64("doc_id", size, F.monotonically_increasing_id()), F.lit(n)).cast("int").alias("chunk")
    return docs.select(chunk, F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more), n


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(31))) * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(29)
    x *= U64(0x94D049BB133111EB)
    return x ^ (x >> U64(32))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(max(n, 1), U64(base))
    out[0] = 1
    return np.multiply.accumulate(out)


def buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and their n + 1 offsets; a missing text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    a = pc.fill_null(column.cast(pa.large_binary()), b"")
    if not len(a):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(a.buffers()[1], np.int64)[a.offset : a.offset + len(a) + 1]
    data = np.frombuffer(a.buffers()[2], np.uint8) if a.buffers()[2] is not None else np.empty(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case."""
    return data + ((data - np.uint8(65)) < 26).astype(np.uint8) * np.uint8(32)


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each text the index of its first word (n + 1 values)."""
    if not len(data):
        none = np.empty(0, np.int64)
        return none, none, np.zeros(len(off), np.int64)
    inside = (data != 32) & ((data - np.uint8(9)) > 4)
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    full = off[1:] > off[:-1]
    at = off[:-1][full]
    first[at] = inside[at]
    at = off[1:][full] - 1
    last[at] = inside[at]
    s = np.flatnonzero(first)
    return s, np.flatnonzero(last) + 1, np.searchsorted(s, off)


def word_hashes(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """A hash for each word data[s:e]; equal words have equal hashes wherever they stand."""
    out = np.empty(len(s), U64)
    up, down = powers(BASE, BLOCK), powers(BASE_INVERSE, BLOCK)
    i = 0
    while i < len(s):
        j = int(np.searchsorted(e, s[i] + BLOCK, side="right"))
        if j <= i:  # a word longer than a block
            out[i] = xxhash.xxh3_64_intdigest(data[s[i] : e[i]].tobytes())
            i += 1
            continue
        a, n = s[i], int(e[j - 1] - s[i])
        c = np.zeros(n + 1, U64)
        np.cumsum((data[a : a + n].astype(U64) + U64(1)) * up[:n], out=c[1:])
        x, y = s[i:j] - a, e[i:j] - a
        out[i:j] = mix((c[y] - c[x]) * down[x] + (y - x).astype(U64) * U64(0xD6E8FEB86659FD93))
        i = j
    return out


def rolling(h: np.ndarray, k: int) -> np.ndarray:
    """The hash of each k consecutive values of h: len(h) - k + 1 values."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, U64)
    out = np.empty(n, U64)
    size = max(BLOCK, 2 * k)
    up, down = powers(BASE, min(size + k, len(h))), powers(BASE_INVERSE, min(size, n))
    for a in range(0, n, size):
        m = min(size, n - a)
        part = h[a : a + m + k - 1]
        c = np.zeros(len(part) + 1, U64)
        np.cumsum(part * up[: len(part)], out=c[1:])
        out[a : a + m] = mix((c[k : k + m] - c[:m]) * down[:m])
    return out


def anchors(gram: np.ndarray, ok: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Winnowing: for each window of span grams the position of its least one (the last of equals).

    gram: hashes; ok: windows that count, by start.  Returns the starts of these
    windows and the anchor of each.  Equal windows have their anchor at the same
    place, so two equal stretches of span grams always share an anchor.
    """
    starts, picks = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    n = len(gram) - span + 1
    size = max(BLOCK * 4, 4 * span)
    for a in range(0, max(n, 0), size):
        m = min(size, n - a)
        part = gram[a : a + m + span - 1]
        place = np.arange(len(part), dtype=U64)
        x = ((part >> U64(32)) << U64(32)) | (U64(0xFFFFFFFF) - place)
        step = 1
        while step * 2 <= span:
            x = np.minimum(x[:-step], x[step:])
            step *= 2
        if step < span:
            x = np.minimum(x[:m], x[span - step : span - step + m])
        use = np.flatnonzero(ok[a : a + m])
        starts.append(use + a)
        picks.append((U64(0xFFFFFFFF) - (x[use] & U64(0xFFFFFFFF))).astype(np.int64) + a)
        del part, place, x
    return np.concatenate(starts), np.concatenate(picks)


def canonical(table: pa.Table) -> pa.Table:
    """The rows in an order that does not depend on how they arrived (equal rows may swap)."""
    data, off = buffers(table["text"])
    length = np.diff(off)
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(data[a:b]) for a, b in zip(off[:-1], off[1:], strict=True)), U64, len(length))
    ids = pc.fill_null(table["doc_id"], NO_ID).to_numpy()
    return table.take(pa.array(np.lexsort((hashes, length, ids))))


def ids_of(table: pa.Table) -> np.ndarray:
    """doc_id as int64; a missing one is NO_ID."""
    return pc.fill_null(table["doc_id"], NO_ID).to_numpy()


def runs(values: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal values, and the length of values at the end."""
    if not len(values):
        return np.zeros(1, np.int64)
    return np.concatenate(([0], np.flatnonzero(values[1:] != values[:-1]) + 1, [len(values)]))


def segment(h: np.ndarray, n: int) -> np.ndarray:
    """0 <= segment < n, by the upper half of the hash: sorted hashes have sorted segments."""
    return (((h >> U64(32)) * U64(n)) >> U64(32)).astype(np.int64)


def cut(sorted_hashes: np.ndarray, n: int) -> list[tuple[int, int, int]]:
    """(segment, from, to) for each segment that has hashes."""
    s = segment(sorted_hashes, n)
    r = runs(s)
    return [(int(s[a]), int(a), int(b)) for a, b in zip(r[:-1], r[1:], strict=True)]


def packed(a: np.ndarray) -> bytes:
    """Sorted 64-bit values as differences, by byte position: leading zeros then compress away."""
    return raw(np.diff(a, prepend=U64(0)).view(np.uint8).reshape(-1, 8).T)


def unpacked(b: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(8, -1).T).view(U64).ravel())


def raw(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a).tobytes()
