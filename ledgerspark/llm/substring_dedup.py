"""Substring dedup by seed and extend.

Seeds are winnowed word n-grams, so that every window of ``window`` consecutive
words holds a seed whose place depends on the window alone.  Documents are
joined on seeds: the words around each seed that more than one document has
(those of the windows it stands for) meet at the seed's segment.  There the
match is extended word by word: to the right by the common start of what begins
with the seed, to the left by the common start of what stands before it, read
backwards.  Both are found between neighbours in sorted order, never for all
pairs.  Matches of ``window`` words and more that can't be extended on either
side without losing a document are kept (``repeats.groups``), with the least
document id of each; a word goes if a kept match over it also occurs in a
document with a smaller id.

How it is spread, and what becomes of a passage in very many documents, is told
in ``repeats``.  Copies inside a chunk are combined before any shuffle.  Nothing
is collected.

Defined cases: a missing text has no words; a missing doc_id precedes nothing
and counts as the largest id, so equal texts without id keep each other; rows
that repeat a doc_id are one document as far as precedence goes (neither
removes from the other); texts shorter than the window stay whole; an empty
table gives an empty result; columns other than doc_id and text are ignored, or
carried along unchanged with ``with_text``.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, anchors, buffers, canonical, chunked, ids_of, mix, rolling, runs, word_hashes, words
from .repeats import AROUND, COVER, SEEN, SHARED, Occurrences, covered, jobs


class _Words:
    """The words of a chunk's texts, and the seeds that they hold."""

    def __init__(self, chunk: int, table: pa.Table, window: int, gram: int):
        self.data, self.off = buffers(table["text"])
        self.s, self.e, self.first = words(self.data, self.off)
        h = word_hashes(self.data, self.s, self.e)
        row = np.repeat(np.arange(table.num_rows), np.diff(self.first))
        n = max(0, len(h) - window + 1)
        g = rolling(h, gram)
        starts, at = anchors(g, row[:n] == row[window - 1 :] if n else np.zeros(0, bool), window - gram + 1)
        r = runs(at) if len(at) else np.zeros(1, np.int64)
        at, low, high = (at[r[:-1]], starts[r[:-1]], starts[r[1:] - 1] + window) if len(at) else (at, at, at)
        # mixed: seeds are least values, all of them small
        self.seeds = Occurrences(h, at, low, high, mix(g[at]) if len(at) else np.empty(0, U64), ids_of(table)[row[at]], chunk)


def substring_dedup(docs: DataFrame, window: int = 50, gram: int = 20, chunk_bytes: int = 4 << 20, with_text: bool = False, heavy: int = 512) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for each row of docs (doc_id, text).

    with_text adds kept_text (the text without the removed words; null stays
    null) and rest (a struct of the other columns).
    """
    if not 0 < gram <= window < 1 << 14:
        raise ValueError("0 < gram <= window < 16384 is needed")
    rest = [F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")] or [F.lit(1).alias("none")]).alias("rest")] if with_text else []
    texts, n = chunked(docs, chunk_bytes, *rest)
    seen, shared, around, cover = jobs(lambda chunk, table: _Words(chunk, canonical(table), window, gram).seeds, window, n, heavy, U64, True)

    def result(key, table, back):
        table = canonical(table)
        w = _Words(key[0].as_py(), table, window, gram)
        gone = np.zeros(len(w.seeds.sym) + 1, np.int32)
        if back.num_rows:
            whose, a, b, least = covered(w.seeds, back, window)
            later = w.seeds.place[whose] > least
            np.add.at(gone, a[later], 1)
            np.add.at(gone, b[later], -1)
        gone = np.cumsum(gone[:-1]) > 0
        removed = np.concatenate(([0], np.cumsum(gone)))
        removed = removed[w.first[1:]] - removed[w.first[:-1]]
        digests, kept_texts = [], []
        for i, lost in enumerate(removed):
            body = w.data[w.off[i] : w.off[i + 1]].tobytes()
            kept = body.split()
            if lost:
                cover = gone[w.first[i] : w.first[i + 1]]
                kept = list(compress(kept, ~cover))
                if with_text:  # a removed run goes with the white space behind it
                    s = np.concatenate((w.s[w.first[i] : w.first[i + 1]] - w.off[i], [len(body)]))
                    body = body[: s[0]] + b"".join(body[s[j] : s[j + 1]] for j in np.flatnonzero(~cover))
            digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            if with_text:
                kept_texts.append(body if table["text"][i].is_valid else None)
        out = {"doc_id": table["doc_id"], "n_words": pa.array(np.diff(w.first), pa.int64()), "n_removed": pa.array(removed, pa.int64()), "kept_sha256": pa.array(digests, pa.string())}
        if with_text:
            out |= {"kept_text": pa.array(kept_texts, pa.binary()), "rest": table["rest"]}
        return pa.table(out)

    by_chunk = texts.groupBy("chunk")
    known = by_chunk.applyInArrow(seen, SEEN).groupBy("seg").applyInArrow(shared, SHARED)
    covers = by_chunk.cogroup(known.groupBy("chunk")).applyInArrow(around, AROUND).groupBy("seg").applyInArrow(cover, COVER)
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    if with_text:
        schema += f", kept_text binary, rest {texts.schema['rest'].dataType.simpleString()}"
    out = by_chunk.cogroup(covers.groupBy("chunk")).applyInArrow(result, schema)
    return out.withColumn("kept_text", F.decode("kept_text", "UTF-8")) if with_text else out
