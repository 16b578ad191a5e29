"""Best-fit packing of documents into sequences, with conflicts.

Documents longer than a sequence are cut into pieces of its capacity.  Pieces
are dealt into shards of bounded size by a hash that takes the row's place, so
neither a large source nor a large group of copies nor a row that repeats very
often makes a large shard.  A shard packs its
pieces in falling size.  Its open bins are kept in the order of what is left in
them; each carries one bitmap of the sources and one of the duplicate clusters
that it holds.  A piece goes to the bin with the least sufficient rest whose
bitmaps don't have the piece's bits: the search starts at the piece's size and
goes on to the next larger rest while bins are incompatible; a new bin is
opened only if it finds none.

So no bin holds two documents of one duplicate cluster, nor (unless
``mix_sources`` is off) two of one source.  Clusters are those of a column, by
default of texts that are equal but for letter case and white space.

Defined cases: a missing or word-less text has one row with no bin; a missing
source is a source of its own; a missing doc_id is packed like any other;
repeated rows are separate documents of one cluster; an empty table gives an
empty result; columns other than doc_id, text, source and the cluster are
ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_JAVA, written

PACKED = "doc_id long, piece long, start long, n_tokens long, bin_id long, bin_offset long"


def best_fit(pieces: list[tuple[int, int, int]], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) for each piece (size, source bits, cluster bits), which come in the order they are packed in."""
    rests: list[int] = []  # the rests that open bins have, in order
    bins: dict[int, dict[int, list[list[int]]]] = {}  # by rest and source bitmap: [cluster bitmap, bin]
    out, opened = [], 0
    for size, source, cluster in pieces:
        found = None
        at = bisect_left(rests, size)
        while found is None and at < len(rests):
            rest = rests[at]
            for sources, held in bins[rest].items():
                if sources & source:
                    continue
                k = next((k for k, b in enumerate(held) if not b[0] & cluster), None)
                if k is not None:
                    found = held.pop(k)
                    if not held:
                        del bins[rest][sources]
                    if not bins[rest]:
                        del bins[rest], rests[at]
                    break
            at += 1
        if found is None:
            rest, sources, found, opened = capacity, 0, [0, opened], opened + 1
        out.append((found[1], capacity - rest))
        found[0] |= cluster
        if left := rest - size:
            if left not in bins:
                insort(rests, left)
                bins[left] = {}
            bins[left].setdefault(sources | source, []).append(found)
    return out


def _pack(capacity: int, mix_sources: bool):
    def job(key, table):
        rows = sorted(zip(*(table[c].to_pylist() for c in ("n_tokens", "doc_id", "piece", "start", "source", "cluster")), strict=True), key=lambda x: (-x[0], x[1] is None, x[1] or 0, x[2], x[5], x[4] or ""))
        sources: dict[str | None, int] = {}
        often: dict[int, int] = {}
        for x in rows:
            sources.setdefault(x[4], len(sources))
            often[x[5]] = often.get(x[5], 0) + 1
        clusters = {c: i for i, c in enumerate(c for c, n in often.items() if n > 1)}
        pieces = [(x[0], 1 << sources[x[4]] if mix_sources else 0, 1 << clusters[x[5]] if x[5] in clusters else 0) for x in rows]
        at = best_fit(pieces, capacity)
        base = key[0].as_py() << 24
        columns = [x[1] for x in rows], [x[2] for x in rows], [x[3] for x in rows], [x[0] for x in rows], [base + b for b, _ in at], [o for _, o in at]
        return pa.table({f.split()[0]: pa.array(c, pa.int64()) for f, c in zip(PACKED.split(", "), columns, strict=True)})

    return job


def same_words() -> Column:
    """A cluster: texts that are equal but for letter case and white space."""
    return F.xxhash64(F.array_join(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(f"({WORD_JAVA})")), " "))


def word_count() -> Column:
    return F.size(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"({WORD_JAVA})"))).cast("long")


def best_fit_packing(docs: DataFrame, capacity: int = 2048, mix_sources: bool = True, cluster: Column | None = None, shard_rows: int = 4096, n_words: Column | None = None) -> DataFrame:
    """doc_id, piece, start, n_tokens, bin_id, bin_offset: where each piece of each row of docs (doc_id, text, source) goes.

    With cluster and n_words, the texts' numbers of words, docs needs no text.
    """
    if not 0 < capacity or not 0 < shard_rows < 1 << 24:
        raise ValueError("capacity and 0 < shard_rows < 2**24 are needed")
    words = word_count() if n_words is None else n_words
    sized = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), (same_words() if cluster is None else cluster).cast("long").alias("cluster"), words.alias("n")), "sized")
    pieces = sized.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0), F.ceil(F.col("n") / capacity) - 1))).alias("piece"))
    pieces = pieces.withColumn("start", F.col("piece") * capacity).withColumn("n_tokens", F.least(F.lit(capacity), F.col("n") - F.col("start")))
    total = sized.agg(F.sum(F.greatest(F.lit(1), F.ceil(F.col("n") / capacity)))).first()[0] or 0
    shards = max(1, -(-total // shard_rows))
    dealt = pieces.filter("n_tokens > 0").withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "n", "cluster", F.monotonically_increasing_id()), F.lit(shards)))
    packed = dealt.groupBy("shard").applyInArrow(_pack(capacity, mix_sources), PACKED)
    none = F.lit(None).cast("long")
    return packed.unionByName(sized.filter("n = 0").select("doc_id", F.lit(0).cast("long").alias("piece"), F.lit(0).cast("long").alias("start"), "n", none.alias("bin_id"), none.alias("bin_offset")).withColumnRenamed("n", "n_tokens"))
