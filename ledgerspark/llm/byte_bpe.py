"""Byte-level BPE: encoding and decoding with the ranks of a given vocabulary.

Two tiers.  A pre-token that is in the vocabulary as a whole has its id from a
minimal perfect hash: a displacement for each bucket of keys sends every key
to its own slot, as many slots as keys, and the slot's key is compared, so a
string that is no key is never taken for one.  (A pre-token in the vocabulary
is always merged to itself by tiktoken, too.)  Misses go through a heap of
pairs over a linked list of bytes: the pair of least rank is merged, the first
of equals, until no pair has a rank: O(n log n) for n bytes, so a very long
pre-token is no trap.

Encoded pre-tokens are remembered up to a bound in bytes (two generations of
them; those of over 128 characters for one call only), for as long as a Python
worker is reused.  Nothing is shuffled; the vocabulary (its
size is fixed) is broadcast.

Defined cases: a missing or empty text has no tokens; a missing doc_id is
returned as it is; strings of special tokens are ordinary text; repeated rows
are encoded each; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import heapq

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, mix, runs

RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def read_ranks(path: str) -> list[tuple[bytes, int]]:
    """The lines of a .tiktoken file: token in base64, rank."""
    with open(path, "rb") as f:
        return [(base64.b64decode(a), int(b)) for a, b in (line.split() for line in f if line.strip())]


class PerfectHash:
    """A minimal perfect hash of byte strings: n keys, n slots, 4 bytes of displacement for about 4 keys."""

    def __init__(self, keys: list[bytes], parts: tuple[np.ndarray, np.ndarray] | None = None):
        """parts: shift and order of another object with the same keys, which then need not be found again."""
        self.n, self.buckets = len(keys), max(1, len(keys) // 4)
        self.shift, self.order = parts or self.placed(keys)
        self.keys: list[bytes] = [b""] * self.n
        for slot, key in zip(self.order.tolist(), keys, strict=True):
            self.keys[slot] = key

    def placed(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """A displacement for each bucket, largest buckets first, so that no two keys share a slot."""
        h = self.hashes(keys)
        bucket = (h % U64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        r = runs(bucket[order])
        groups = sorted((order[a:b] for a, b in zip(r[:-1], r[1:], strict=True)), key=len, reverse=True)
        shift = np.zeros(self.buckets, np.int64)
        free, slots = np.ones(max(self.n, 1), bool), np.full(self.n, -1)
        for g in groups:
            if len(g) == 1:
                break
            for first in range(0, 1 << 24, 64):
                at = self.slots(h[g][:, None], np.arange(first, first + 64))
                apart = (np.diff(np.sort(at, axis=0), axis=0) > 0).all(axis=0)
                if (good := np.flatnonzero(free[at].all(axis=0) & apart)).size:
                    break
            else:
                raise ValueError("two keys have the same hash")
            d = int(good[0])
            free[at[:, d]], slots[g], shift[bucket[g[0]]] = False, at[:, d], first + d
        alone = np.array([g[0] for g in groups if len(g) == 1], np.int64)
        slots[alone] = np.flatnonzero(free[: self.n])  # what is left, by number: -1 - slot
        shift[bucket[alone]] = -1 - slots[alone]
        return shift, slots

    @staticmethod
    def hashes(keys: list[bytes]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), U64, len(keys))

    def slots(self, h: np.ndarray, shift) -> np.ndarray:
        shift = np.asarray(shift, np.int64)
        at = (mix(h + shift.astype(U64) * U64(0x9E3779B97F4A7C15)) % U64(self.n)).astype(np.int64)
        return np.where(shift < 0, -1 - shift, at)

    def find(self, keys: list[bytes]) -> list[int]:
        """The slot of each key, -1 for what is no key."""
        if not self.n or not keys:
            return [-1] * len(keys)
        h = self.hashes(keys)
        at = self.slots(h, self.shift[(h % U64(self.buckets)).astype(np.int64)]).tolist()
        return [i if self.keys[i] == k else -1 for i, k in zip(at, keys, strict=True)]


class ByteBPE:
    def __init__(self, ranks: list[tuple[bytes, int]], pattern: str, table: PerfectHash | None = None, remember: int = 112 << 20):
        self.table = table or PerfectHash([k for k, _ in ranks])
        self.id = np.empty(len(ranks), np.int64)
        self.id[self.table.order] = [r for _, r in ranks]
        self.id = self.id.tolist()
        self.rank, self.pattern, self.remember = dict(ranks), pattern, remember
        self.token = {r: k for k, r in ranks}
        self.pair = [self.rank.get(bytes((x, y)), -1) for x in range(256) for y in range(256)]
        self.known: dict[str, str] = {}
        self.older: dict[str, str] = {}
        self.size = 0  # of known, in bytes
        self.passing: list[str] = []  # what is to be forgotten at once
        self.word = {str(r): k for k, r in ranks}  # by the decimal number
        self.find = None

    def merged(self, word: bytes) -> list[int]:
        """The ids of a pre-token that is no token: merges by least rank, first from the left.

        A part is named by its first byte i and linked both ways: end[i] is where it ends and the next begins, before[e]
        where the part that ends at e begins.  A part that is merged away ends at n + 1, and nothing ends there.
        """
        rank, pair, n = self.rank.get, self.pair, len(word)
        end, before = [*range(1, n + 1), -1, -1], list(range(-1, n))
        heap = [(r, i, i + 2) for i, (x, y) in enumerate(zip(word, word[1:], strict=False)) if (r := pair[x << 8 | y]) >= 0]
        heapq.heapify(heap)
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            _, i, stop = pop(heap)
            j = end[i]
            if end[j] != stop:
                continue  # one of the two has been merged meanwhile
            end[i], end[j], before[stop] = stop, n + 1, i
            if stop < n and (r := rank(word[i : end[stop]])) is not None:
                push(heap, (r, i, end[stop]))
            if i and (r := rank(word[before[i] : stop])) is not None:
                push(heap, (r, before[i], stop))
        out, i, rank = [], 0, self.rank
        while i < n:
            out.append(rank[word[i : end[i]]])
            i = end[i]
        return out

    def learn(self, words: set[str]) -> None:
        """The ids of all words, remembered. When there are too many, those not met since the last time are forgotten."""
        missing = words.difference(self.known)
        if not missing:
            return
        if self.size > self.remember:
            self.older, self.known, self.size = self.known, {}, 0
            missing = words
        fresh = []
        for w in missing:
            found = self.older.get(w)
            if found is None:
                fresh.append(w)
            else:
                self.known[w] = found
                self.size += 128 + 2 * len(w)
        raw = [w.encode() for w in fresh]
        for w, b, slot in zip(fresh, raw, self.table.find(raw), strict=True):
            self.known[w] = ids = str(self.id[slot]) if slot >= 0 else ",".join(map(str, self.merged(b)))
            self.size += 112 + 2 * len(w) + len(ids)
        self.passing = [w for w in fresh if len(w) > 128]

    def encode(self, text: str) -> list[int]:
        joined, _ = self.joined(text)
        return [int(x) for x in joined.split(",")] if joined else []

    def joined(self, text: str) -> tuple[str, int]:
        """The ids as decimal numbers with commas between, and how many."""
        if self.find is None:
            self.find = regex.compile(self.pattern).findall
        out, words = [], self.find(text)
        for a in range(0, len(words), 1 << 16):
            part = words[a : a + (1 << 16)]
            self.learn(set(part))
            out.append(",".join(map(self.known.__getitem__, part)))
            for w in self.passing:
                self.size -= 112 + 2 * len(w) + len(self.known.pop(w))
            self.passing = []
        whole = ",".join(out)
        return whole, whole.count(",") + 1 if whole else 0

    def decode(self, ids) -> bytes:
        return b"".join([self.token[i] for i in ids])


#: The last encoder of this Python worker, by its vocabulary and pattern: tasks that follow in the same worker go on with what it remembers.
_ENCODER: dict[str, ByteBPE] = {}


def _encode(model, key: str):
    def job(batches):
        if key not in _ENCODER:
            ranks, pattern, parts = model.value
            _ENCODER.clear()
            _ENCODER[key] = ByteBPE(ranks, pattern, PerfectHash([k for k, _ in ranks], parts))
        bpe = _ENCODER[key]
        collecting = gc.isenabled()
        gc.disable()  # millions of live strings and no cycles: collections would only go over them again and again
        try:
            for batch in batches:
                n_tokens, ids, decoded = [], [], []
                for text in batch.column(1):
                    joined, n = bpe.joined(text.as_py() or "")
                    n_tokens.append(n)
                    ids.append(hashlib.sha256(joined.encode()).hexdigest())
                    # read back from the numbers, not from the pre-tokens
                    decoded.append(hashlib.sha256(b"".join(map(bpe.word.__getitem__, joined.split(","))) if joined else b"").hexdigest())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_tokens, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        finally:
            if collecting:
                gc.enable()

    return job


def byte_bpe(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for each row of docs (doc_id, text)."""
    ranks = read_ranks(path)
    table = PerfectHash([k for k, _ in ranks])
    model = docs.sparkSession.sparkContext.broadcast((ranks, pattern, (table.shift, table.order)))
    key = hashlib.sha256(repr((ranks, pattern)).encode()).hexdigest()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_encode(model, key), RESULT)
