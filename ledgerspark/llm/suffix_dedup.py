"""Suffix-array dedup: maximal repeats of at least ``length`` bytes.

Suffixes are those that start at anchors: winnowed byte n-grams, of which every
string of ``length`` bytes holds one at a place that the string alone decides.
A string that occurs twice therefore occurs twice around one anchor, and the
suffixes of an anchor, sorted, are a stretch of the enhanced suffix array that
can be scanned by itself.

Each segment of anchors sorts its suffixes and takes the common prefix of
neighbours.  A stack scan gives the tree of common-prefix intervals.  In each
interval the suffixes are put in the order of what stands before them, read
backwards, and scanned in the same way: an interval of that scan whose parts
differ in the next byte to the left, and that does not lie in one child of the
prefix interval, is a maximal repeat.  The whole group with every occurrence is
the result, not only those next to each other in the array.

Surroundings end where an anchor's windows end, so that a repeat longer than
these comes out as several that overlap.  ``suffix_repeats`` returns the groups'
occurrences, ``suffix_dedup`` what is left of each text.  How it is spread, and
what becomes of a passage in very many documents, is told in ``repeats``.

Defined cases: a missing text is empty; shorter texts stay whole; overlapping
occurrences in one text count; rows that repeat are separate documents and
remove each other's bytes; a missing doc_id is returned as it is; an empty
table gives an empty result; other columns are ignored.  Zero bytes, white
space runs and any other bytes are text like all else.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from .common import U64, anchors, buffers, canonical, chunked, mix, rolling, runs
from .repeats import AROUND, COVER, SEEN, SHARED, Occurrences, covered, jobs, table_of

PART = 1 << 19
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
REPEATS = "doc_id long, start long, n_bytes long, repeat long"


def _anchored(data: np.ndarray, off: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the texts data[off[i] : off[i + 1]], as positions in data: anchors, the stretches that they stand for, their hashes."""
    found = [(np.empty(0, np.int64),) * 3 + (np.empty(0, U64),)]
    r = runs(off[:-1] // PART)  # some whole texts at a time, and of a long text overlapping parts: they bound the memory
    for i, j in zip(r[:-1], r[1:], strict=True):
        end = int(off[j])
        for a in range(int(off[i]), max(int(off[i]) + 1, end - length + 1), 2 * PART):
            b = min(end, a + 2 * PART + length - 1)
            part, n = data[a:b], b - a - length + 1
            if n <= 0:
                continue
            ends = off[i + 1 : j] - a  # a window over a text's end doesn't count
            ends = ends[(ends > 0) & (ends < len(part))]
            bad = np.zeros(len(part) + 1, np.int32)
            np.add.at(bad, np.maximum(0, ends - length + 1), 1)
            np.add.at(bad, ends, -1)
            whole = np.cumsum(bad[:n]) == 0
            g = rolling(mix(np.arange(1, 257, dtype=U64))[part], gram)
            starts, at = anchors(g, whole, length - gram + 1)
            if len(at):
                k = runs(at)
                found.append((at[k[:-1]] + a, starts[k[:-1]] + a, starts[k[1:] - 1] + length + a, mix(g[at[k[:-1]]])))  # mixed: anchors are least values, all of them small
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _reader(length: int, gram: int):
    def read(chunk: int, table: pa.Table) -> Occurrences:
        data, off = buffers(table["text"])
        return Occurrences(data, *_anchored(data, off, length, gram), None, chunk)

    return read


def _flow(docs: DataFrame, length: int, gram: int, chunk_bytes: int, heavy: int):
    if not 0 < gram <= length < 1 << 15:
        raise ValueError("0 < gram <= length < 32768 is needed")
    texts, n = chunked(docs, chunk_bytes)
    read = _reader(length, gram)
    seen, shared, around, cover = jobs(lambda chunk, table: read(chunk, canonical(table)), length, n, heavy, np.uint8, False)
    by_chunk = texts.groupBy("chunk")
    known = by_chunk.applyInArrow(seen, SEEN).groupBy("seg").applyInArrow(shared, SHARED)
    covers = by_chunk.cogroup(known.groupBy("chunk")).applyInArrow(around, AROUND).groupBy("seg").applyInArrow(cover, COVER)
    return by_chunk.cogroup(covers.groupBy("chunk")), read


def suffix_dedup(docs: DataFrame, length: int = 200, gram: int = 64, chunk_bytes: int = 2 << 20, heavy: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for each row of docs (doc_id, text)."""
    both, read = _flow(docs, length, gram, chunk_bytes, heavy)

    def result(key, table, back):
        table = canonical(table)
        data, off = buffers(table["text"])
        gone = np.zeros(len(data) + 1, np.int32)
        if back.num_rows:
            _, a, b, _ = covered(read(key[0].as_py(), table), back, length)
            np.add.at(gone, a, 1)
            np.add.at(gone, b, -1)
        gone = np.cumsum(gone[:-1]) > 0
        removed, spans, digests = [], [], []
        for x, y in zip(off[:-1], off[1:], strict=True):
            part, cover = data[x:y], gone[x:y]
            n = int(cover.sum())
            removed.append(n)
            spans.append(int(cover[0]) + int((cover[1:] & ~cover[:-1]).sum()) if n else 0)
            digests.append(hashlib.sha256(part[~cover] if n else part).hexdigest())
        return pa.table({"doc_id": table["doc_id"], "n_bytes": pa.array(np.diff(off), pa.int64()), "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(spans, pa.int64()), "kept_sha256": pa.array(digests, pa.string())})

    return both.applyInArrow(result, RESULT)


def suffix_repeats(docs: DataFrame, length: int = 200, gram: int = 64, chunk_bytes: int = 2 << 20, heavy: int = 512) -> DataFrame:
    """doc_id, start, n_bytes, repeat: each occurrence of each maximal repeat (its hash) in docs (doc_id, text), in bytes.

    The repeats are those of anchors' surroundings; each has two occurrences or
    more, and none of them could be longer on either side within these.
    """
    both, read = _flow(docs, length, gram, chunk_bytes, heavy)

    def result(key, table, back):
        table = canonical(table)
        c = read(key[0].as_py(), table)
        _, a, b, _ = covered(c, back, length)
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        keep = np.ones(len(a), bool)
        keep[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        a, b = a[keep], b[keep]
        off = buffers(table["text"])[1]
        row = np.searchsorted(off, a, side="right") - 1
        h = np.fromiter((xxhash.xxh3_64_intdigest(c.sym[x:y]) for x, y in zip(a, b, strict=True)), U64, len(a))
        return table_of({"doc_id": table["doc_id"].take(pa.array(row)).to_pylist(), "start": a - off[row], "n_bytes": b - a, "repeat": h.view(np.int64)}, REPEATS)

    return both.applyInArrow(result, REPEATS)
