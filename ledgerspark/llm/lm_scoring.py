"""LM scoring with a log-frequency Bloom filter.

Training counts every n-gram of every training text.  A count c is kept as its
level 1 + floor(log2 c); the n-gram enters the filter once for each level up to
its own, so the level is read back by probing level 1, 2, ... until a probe
misses.  The filter never underrates a level, and overrates one only by false
positives.

The filter is cut into segments by hash, about as many as there are chunks of
texts.  A segment's task gathers the counts of its n-grams from all of the
corpus, makes its part of the filter as large as they need (``bits_an_entry``
for each level of each n-gram, and no less than its part of ``filter_bytes``),
and takes all of them in: the filter grows with the corpus and drops nothing.
It is broadcast nowhere.  Each chunk asks the segments for the levels of its
different n-grams and gets a byte for each.

Probabilities are smoothed by the lower order: with context h,
P(w|h) = (c(hw) + k P(w|h')) / (c(h) + k), down to P(w) = (c(w) + 1) / (N + V + 1).

Counts in the numerator and of the context are estimates (the middle of a
level), so the probabilities of all words after a context sum to 1 but for the
quantisation.

The base score needs exact counts c(w), which the words' segments know and send
with the answers, and N and V, which one aggregate gives.  Nothing of the
vocabulary's size is collected or broadcast, and a chunk sends rows only to
segments that it has n-grams for.

Defined cases: a missing text is empty and scores its end token alone; a
missing doc_id counts as the empty string for the split (crc32 0: training); an
empty table gives an empty result; without training texts all counts are 0;
repeated rows are trained on and scored each; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import U64, buffers, chunked, cut, lowered, mix, packed, raw, runs, unpacked, word_hashes, words
from .repeats import table_of as _table

END, START = U64(0x5851F42D4C957F2D), U64(0x14057B7EF767814F)
LEVELS = 48
PROBES = 4
WORD, GRAM = 0, 1
ASK = "seg int, chunk int, kind int, h binary, c binary"
ANSWER = "chunk int, seg int, kind int, level binary, c binary"
TOTALS = "seg int, h binary, c binary"
PIECE = 4 << 20


def held_out(divisor: int = 7, remainder: int = 2) -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % divisor == remainder


def tokens(column) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all texts' words, an end token behind each text; n + 1 offsets."""
    data, off = buffers(column)
    data = lowered(data)
    s, e, first = words(data, off)
    out = np.empty(len(s) + len(off) - 1, U64)
    place = first + np.arange(len(first))
    out[place[1:] - 1] = END
    is_word = np.ones(len(out), bool)
    is_word[place[1:] - 1] = False
    out[is_word] = word_hashes(data, s, e)
    return out, place


def grams(tok: np.ndarray, place: np.ndarray, order: int):
    """For n = 1 ... order the n-gram that ends in each token, and its context; texts begin with START."""
    first = np.zeros(len(tok), bool)
    first[place[:-1]] = True
    before = np.empty_like(tok)
    before[1:] = tok[:-1]
    before[first] = START
    gram, context = mix(tok), None
    yield gram, context
    last = mix(before)  # the (n - 1)-gram that ends before each token
    for n in range(2, order + 1):
        context = last
        gram = mix(context * U64(0x9E3779B97F4A7C15) + tok + U64(n))
        yield gram, context
        last = np.empty_like(gram)
        last[1:] = gram[:-1]
        last[first] = mix(mix(np.array([START])) + U64(n))[0]


def _summed(h: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(h)
    h = h[order]
    at = runs(h)[:-1]
    return (h[at], np.add.reduceat(c[order], at)) if len(h) else (h, c)


def _counted(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = np.sort(h)
    r = runs(h)
    return (h[r[:-1]], np.diff(r)) if len(h) else (h, np.empty(0, np.int64))


def _start(n: int) -> np.uint64:
    """The n-gram that stands before a text, the context of its first token."""
    start = mix(np.array([START]))
    return start[0] if n == 1 else mix(start + U64(n))[0]


def _place(h: np.ndarray, level: int, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """The word of a segment's filter and the bits in it for an n-gram at a level."""
    z = mix(h + U64(level * 0xC2B2AE3D27D4EB4F & 0xFFFFFFFFFFFFFFFF))
    mask = U64(1) << (z & U64(63))
    for i in range(1, PROBES):
        mask |= U64(1) << ((z >> U64(6 * i)) & U64(63))
    return (((z >> U64(32)) * U64(n_words)) >> U64(32)).astype(np.int64), mask


def levels(c: np.ndarray) -> np.ndarray:
    return np.minimum(1 + np.floor(np.log2(np.maximum(c, 1))).astype(np.int64), LEVELS)


class LogBloom:
    """A segment's filter: an estimate of the level of each n-gram, from its hash."""

    def __init__(self, h: np.ndarray, count: np.ndarray, least_words: int, bits_an_entry: float):
        h, level = h[count > 0], levels(count[count > 0])
        self.bits = np.zeros(max(1, least_words, int(np.ceil(level.sum() * bits_an_entry / 64))), U64)
        for j in range(1, int(level.max(initial=0)) + 1):
            at, mask = _place(h[level >= j], j, len(self.bits))
            np.bitwise_or.at(self.bits, at, mask)

    def levels(self, h: np.ndarray) -> np.ndarray:
        level, alive = np.zeros(len(h), np.uint8), np.arange(len(h))
        for j in range(1, LEVELS + 1):
            at, mask = _place(h[alive], j, len(self.bits))
            alive = alive[(self.bits[at] & mask) == mask]
            if not len(alive):
                break
            level[alive] = j
        return level


def estimate(level: np.ndarray) -> np.ndarray:
    """The count that a level stands for."""
    level = level.astype(np.float64)
    return np.where(level > 0, (2.0**level + 2.0 ** (level - 1) - 1) / 2, 0.0)


def _totals(segments: int):
    """The number of training tokens and of different ones."""

    def pieces(batches):
        found, size = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                found.append(_counted(tokens(part.column(0))[0]))
                size += part.column(0).nbytes
                if size >= PIECE:
                    yield from sent(found)
                    found, size = [], 0
        yield from sent(found)

    def sent(found):
        out: dict[str, list] = {"seg": [], "h": [], "c": []}
        if found:
            h, c = _summed(*(np.concatenate(x) for x in zip(*found, strict=True)))
            for seg, a, b in cut(h, segments):
                for name, value in zip(out, (seg, packed(h[a:b]), raw(c[a:b].astype(np.uint32))), strict=True):
                    out[name].append(value)
        return _table(out, TOTALS).to_batches()

    def summed(table):
        h = np.concatenate([unpacked(x) for x in table["h"].to_pylist()])
        c = np.concatenate([np.frombuffer(x, np.uint32) for x in table["c"].to_pylist()])
        return pa.table({"total": pa.array([int(c.sum(dtype=np.int64))], pa.int64()), "different": pa.array([len(np.unique(h))], pa.int64())})

    return pieces, summed


def _jobs(order: int, smoothing: float, segments: int, filter_bytes: int, bits_an_entry: float, total: int, different: int):
    starts = np.array([_start(n) for n in range(1, order)], U64)

    def parts(table):
        """The chunk in pieces of about 1 MB, to bound the memory."""
        at = np.cumsum(np.diff(buffers(table["text"])[1])) >> 20
        r = runs(at)
        return [table.slice(int(a), int(b - a)) for a, b in zip(r[:-1], r[1:], strict=True) if b > a]

    def ask(key, table):
        found: dict[int, list] = {WORD: [], GRAM: []}
        for part in parts(table):
            tok, place = tokens(part["text"])
            learnt = ~part["held_out"].to_numpy(zero_copy_only=False)
            one = np.repeat(learnt, np.diff(place)).astype(np.int64)
            found[WORD].append(_summed(tok, one))
            found[GRAM] += [_summed(gram, one) for n, (gram, _) in enumerate(grams(tok, place, order), 1) if n > 1]
            found[GRAM].append((starts, np.full(len(starts), int(learnt.sum()))))
        out: dict[str, list] = {"seg": [], "chunk": [], "kind": [], "h": [], "c": []}
        for kind, pieces in found.items():
            h, c = _summed(*(np.concatenate(x) for x in zip(*pieces, strict=True)))
            c = c.astype(np.uint32)
            for seg, a, b in cut(h, segments):
                for name, value in zip(out, (seg, key[0].as_py(), kind, packed(h[a:b]), raw(c[a:b])), strict=True):
                    out[name].append(value)
        return _table(out, ASK)

    def answer(key, table):
        rows = table.to_pylist()
        known = {}
        for kind in (WORD, GRAM):
            own = [x for x in rows if x["kind"] == kind]
            h = np.concatenate([unpacked(x["h"]) for x in own] or [np.empty(0, U64)])
            c = np.concatenate([np.frombuffer(x["c"], np.uint32) for x in own] or [np.empty(0, np.uint32)]).astype(np.int64)
            known[kind] = _summed(h, c)
        names = {kind: mix(h) if kind == WORD else h for kind, (h, _) in known.items()}
        bloom = LogBloom(np.concatenate(list(names.values())), np.concatenate([c for _, c in known.values()]), filter_bytes // 8 // segments, bits_an_entry)
        level = {kind: bloom.levels(h) for kind, h in names.items()}
        out: dict[str, list] = {x.split()[0]: [] for x in ANSWER.split(", ")}
        for x in rows:
            kind = x["kind"]
            at = np.searchsorted(known[kind][0], unpacked(x["h"]))
            exact = raw(known[kind][1][at]) if kind == WORD else None
            for name, value in zip(out, (x["chunk"], key[0].as_py(), kind, raw(level[kind][at]), exact), strict=True):
                out[name].append(value)
        return _table(out, ANSWER)

    def score(key, table, back):
        rows = sorted(back.to_pylist(), key=lambda x: (x["kind"], x["seg"]))
        known_words, known_grams = ([x for x in rows if x["kind"] == kind] for kind in (WORD, GRAM))
        count = np.concatenate([np.frombuffer(x["c"], np.int64) for x in known_words])
        rough, rough_gram = (estimate(np.concatenate([np.frombuffer(x["level"], np.uint8) for x in own] or [np.empty(0, np.uint8)])) for own in (known_words, known_grams))
        pieces = parts(table)
        toks = [tokens(x["text"]) for x in pieces]
        h = _counted(np.concatenate([_counted(t)[0] for t, _ in toks]))[0]
        every = [_counted(gram)[0] for t, place in toks for n, (gram, _) in enumerate(grams(t, place, order), 1) if n > 1]
        gram_h = _counted(np.concatenate([starts, *every]))[0]
        before = rough_gram[np.searchsorted(gram_h, starts)]  # the counts of the contexts at the start of a text
        unit = np.log10(total + different + 1)
        out: list[pa.Table] = []
        for part, (tok, place) in zip(pieces, toks, strict=True):
            at = np.searchsorted(h, tok)
            c, n = count[at], np.diff(place)
            base = np.add.reduceat(np.log10(c + 1.0), place[:-1]) - n * unit
            p = (rough[at] + 1) / (total + different + 1)
            found = grams(tok, place, order)
            next(found)
            known = np.empty_like(rough[at])
            known[1:] = rough[at][:-1]  # the count of the context
            known[place[:-1]] = before[0] if order > 1 else 0
            for m, (gram, _) in enumerate(found, 2):
                here = np.minimum(rough_gram[np.searchsorted(gram_h, gram)], known)
                p = (here + smoothing * p) / (known + smoothing)
                known = np.empty_like(here)
                known[1:] = here[:-1]
                known[place[:-1]] = before[m - 1] if m < order else 0
            out.append(pa.table({
                "doc_id": part["doc_id"], "held_out": part["held_out"], "n_tokens": pa.array(n, pa.int64()),
                "n_known": pa.array(np.add.reduceat((c > 0).astype(np.int64), place[:-1]), pa.int64()),
                "train_tokens": pa.array(np.full(len(n), total), pa.int64()), "base_score": pa.array(base),
                "score": pa.array(np.add.reduceat(np.log10(p), place[:-1])),
            }))
        return pa.concat_tables(out)

    return ask, answer, score


def lm_scores(docs: DataFrame, order: int = 2, filter_bytes: int = 32 << 20, smoothing: float = 256.0, chunk_bytes: int = 4 << 20, bits_an_entry: float = 10.0) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row of docs (doc_id, text); filter_bytes is the filter's least size."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts, n = chunked(docs, chunk_bytes, held_out().alias("held_out"))
    pieces, summed = _totals(n)
    total, different = docs.filter(~held_out()).select("text").mapInArrow(pieces, TOTALS).groupBy("seg").applyInArrow(summed, "total long, different long").agg(F.sum("total"), F.sum("different")).first()
    ask, answer, score = _jobs(order, smoothing, n, filter_bytes, bits_an_entry, total or 0, different or 0)
    by_chunk = texts.groupBy("chunk")
    counts = by_chunk.applyInArrow(ask, ASK).groupBy("seg").applyInArrow(answer, ANSWER)
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return by_chunk.cogroup(counts.groupBy("chunk")).applyInArrow(score, schema)
