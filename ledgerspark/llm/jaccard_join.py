"""N-gram Jaccard join: documents whose sets of word shingles are at least 0.75 similar.

A size-aware heavy-light join.  Sets of at most x shingles are light: they
enumerate the subsets of the size that a similar set must share with them, and
meet in the subsets.  Larger sets are heavy: they meet in the inverted lists of
their rarest shingles (with a quarter of its shingles and one more, a set meets
every set that is similar enough).  x is the value with the least cost: the
subsets to enumerate below it and the list entries to scan above it, both
counted over the whole table.  Sets close to x do both.

The steps:
1. Each batch of documents collapses equal sets and sends its shingles to their
   segments, sorted, 48 bits each.  A segment counts each shingle and answers
   with those that occur twice or more; the others cannot be shared.  A shingle
   that very many of a batch have is sent once, with their number.
2. Equal sets of the whole table become one.  A set that shares less than the
   threshold of its shingles is done.  The rest, a small part of most corpora,
   go on with their shared shingles, rarest first.
3. Lists join sets to candidate groups (connected components, found over edges
   to the first of each list, in each batch first, never over all pairs).
4. In a group of at most a block's size every pair's overlap is counted by
   scanning the group's inverted lists: as pairs in small groups, as matrix
   products in large ones.  Blocks are of bounded size.
5. In a larger group only sets that met are compared: all pairs of a short
   list, and in a longer one each set with the list's first.  A long list whose
   sets are then in one component is done: more links would not change it.  The
   sets of the others go through blocks, each pair of blocks a task.
6. What leaves a task is a spanning forest of its links, never the pairs.  The
   components of the links are the result.

Equality of shingles is that of 48 hash bits in overlaps and of 64 bits in set
sizes; a pair of sets of 300 is miscounted with a chance below 1e-9.

The batches' contents must not depend on the run, so ``docs`` should be a scan
of files (or a table written before), not the output of a shuffle.

Defined cases: without words or text a document has an empty set, links with
nothing and is its own component; with fewer than ``shingle`` words the whole
sequence is its only shingle; copies share a component; a missing doc_id takes
part, but names a component only if nothing else does; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .common import NO_ID, U64, buffers, discard, ids_of, lowered, mix, packed, raw, rolling, runs, unpacked, word_hashes, words, written
from .components import components, local_components
from .repeats import table_of as _table

META = "ids binary, reps binary, sizes binary, digests binary, many binary, carried binary"
KEYS = f"seg int, chunk long, keys binary, hot binary, {META}"
SHARED = f"chunk long, keys binary, hot binary, often binary, {META}"
SETS = "node long, digest binary, rows array<{row}>, least long, n long, shared binary, take int, scan long"
LIST = "seg int, keys binary, nodes binary, sizes binary, ends binary"
EDGE = "a long, b long"
ENTRY = "key long, node long"
MOST_LIGHT = 10
DENSE = 24
BATCH = 8 << 20
OFTEN = 8
SHORT = 16


def shingle_sets(column, k: int) -> list[np.ndarray]:
    """For each text its different shingles, as sorted hashes."""
    data, off = buffers(column)
    data = lowered(data)
    s, e, first = words(data, off)
    h = word_hashes(data, s, e)
    g = rolling(h, k)
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= k:
            x = np.sort(g[a : b - k + 1])
            out.append(x[np.concatenate(([True], x[1:] != x[:-1]))])
        elif b > a:
            out.append(mix(rolling(h[a:b], int(b - a)) + U64(b - a)))
        else:
            out.append(g[:0])
    return out


def _slices(batch, size: int):
    """Pieces of a batch with about size bytes of text each."""
    lengths = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    group = np.cumsum(lengths) // size
    r = runs(group)
    return [batch.slice(int(a), int(b - a)) for a, b in zip(r[:-1], r[1:], strict=True)]


def _pieces(values: np.ndarray, segments: int):
    """(segment, values) of sorted 64-bit values, by their upper half."""
    seg = (((values >> U64(32)) * U64(segments)) >> U64(32)).astype(np.int64)
    r = runs(seg)
    return [(int(seg[a]), values[a:b]) for a, b in zip(r[:-1], r[1:], strict=True) if b > a]


def _stream(batch: pa.RecordBatch) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as writer:
        writer.write_batch(batch)
    return out.getvalue().to_pybytes()


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def _shingles(k: int, segments: int):
    def job(batches):
        at = (TaskContext.get().partitionId() << 20) - 1
        for whole in batches:
            for batch in (part.slice(start, 32768) for part in _slices(whole, BATCH) for start in range(0, part.num_rows, 32768)):
                at += 1
                sets = [x for part in _slices(batch, 1 << 20) for x in shingle_sets(part.column(1), k)]
                seen: dict[bytes, int] = {}
                digests = [xxhash.xxh3_128_digest(x) for x in sets]
                reps = np.fromiter((seen.setdefault(d, i) for i, d in enumerate(digests)), np.int64, len(sets))
                own = [i for i, x in enumerate(sets) if reps[i] == i and len(x)]
                keys = np.concatenate([((sets[i] >> U64(16)) << U64(16)) | U64(i) for i in own] or [np.empty(0, U64)])
                keys.sort()
                r = runs(keys >> U64(16))
                times = np.diff(r) if len(keys) else np.empty(0, np.int64)
                many = np.repeat(times > OFTEN, times)
                hot = ((keys[r[:-1]] >> U64(16)) << U64(16) | times.astype(U64))[times > OFTEN] if len(keys) else keys
                out: dict[str, list] = {x: [] for x in _names(KEYS)}
                meta = raw(ids_of(batch)), raw(reps), raw(np.fromiter(map(len, sets), np.int64, len(sets))), b"".join(digests), packed(keys[many]), _stream(batch.drop_columns(["text"]))
                rows = [(seg, at, packed(x), None, *[None] * 6) for seg, x in _pieces(keys[~many], segments)] + [(seg, at, None, packed(x), *[None] * 6) for seg, x in _pieces(hot, segments)]
                for row in [*rows, (at % segments, at, None, None, *meta)]:
                    for name, value in zip(out, row, strict=True):
                        out[name].append(value)
                yield from _table(out, KEYS).to_batches()

    return job


def _count(table: pa.Table) -> pa.Table:
    rows = table.to_pylist()
    out: dict[str, list] = {x: [] for x in _names(SHARED)}
    for x in rows:
        if x["ids"] is not None:
            for name in out:
                out[name].append(x.get(name))
    rows = [x for x in rows if x["ids"] is None]
    if rows:
        parts = [unpacked(x["keys"] if x["hot"] is None else x["hot"]) for x in rows]
        weight = np.concatenate([np.ones(len(p), np.int64) if x["hot"] is None else (p & U64(0xFFFF)).astype(np.int64) for x, p in zip(rows, parts, strict=True)])
        g = np.concatenate(parts) >> U64(16)
        order = np.argsort(g)
        r = runs(g[order])
        often = np.empty(len(g), np.uint32)
        often[order] = np.repeat(np.minimum(np.add.reduceat(weight[order], r[:-1]), 0xFFFFFFFF), np.diff(r))
        a = 0
        for x, p in zip(rows, parts, strict=True):
            n = often[a : a + len(p)]
            a += len(p)
            hit = n > 1
            if hit.any():
                kind = (packed(p[hit]), None) if x["hot"] is None else (None, packed(p[hit]))
                for name, value in zip(out, (x["chunk"], *kind, raw(n[hit]), *[None] * 6), strict=True):
                    out[name].append(value)
    return _table(out, SHARED)


def _sets(percent: int, row: pa.StructType):
    names = ["node", "digest", "rows", "least", "n", "shared", "take", "scan"]

    def job(key, table):
        rows = table.to_pylist()
        meta = next(x for x in rows if x["ids"] is not None)
        ids, reps, sizes = (np.frombuffer(meta[x], np.int64) for x in ("ids", "reps", "sizes"))
        told = lambda name: [x for x in rows if x[name] is not None and x["ids"] is None]
        keys, often, hot, sums = (np.concatenate([f(x) for x in told(kind)] or [np.empty(0, U64)]) for kind in ("keys", "hot") for f in (lambda x, kind=kind: unpacked(x[kind]), lambda x: np.frombuffer(x["often"], np.uint32).astype(U64)))
        many = unpacked(meta["many"])
        if len(many):  # the shingles that many of the batch have: their sums came once
            order = np.argsort(hot >> U64(16))
            keys, often = np.concatenate((keys, many)), np.concatenate((often, sums[order][np.searchsorted((hot >> U64(16))[order], many >> U64(16))]))
        often = often.astype(np.int64)
        doc, g = (keys & U64(0xFFFF)).astype(np.int64), keys >> U64(16)
        shared = np.bincount(doc, minlength=len(ids))
        alive = (100 * shared >= percent * sizes) & (shared > 0)
        use = alive[doc]
        doc, g, often = doc[use], g[use], often[use]
        order = np.lexsort((g, often, doc))
        doc, g, often = doc[order], g[order], often[order]
        cuts = np.searchsorted(doc, np.arange(len(ids) + 1))
        # of the sizes - ceil(percent %) + 1 rarest shingles, those that nobody shares come first
        take = np.where(alive, np.maximum(0, sizes - (percent * sizes + 99) // 100 + 1 - (sizes - shared)), 0)
        base = key[0].as_py() << 16
        out: dict[str, list] = {x: [] for x in names}
        by_rep = np.argsort(reps, kind="stable")
        r = runs(reps[by_rep])
        carried = pa.ipc.open_stream(meta["carried"]).read_all()
        carried = pa.StructArray.from_arrays([carried[f.name].combine_chunks().cast(f.type) for f in row], fields=[f.with_nullable(True) for f in row]).take(pa.array(by_rep))
        for a, b in zip(r[:-1], r[1:], strict=True):
            i, own = int(reps[by_rep[a]]), ids[by_rep[a:b]]
            x, y, t = cuts[i], cuts[i + 1], int(take[i])
            least = int(own.min())
            values = (base + i, meta["digests"][16 * i : 16 * i + 16] if sizes[i] else None, b - a, None if least == NO_ID else least, int(sizes[i]), raw(g[x:y]) if y > x else None, t, int(often[x : x + t].sum()))
            for name, value in zip(out, values, strict=True):
                out[name].append(value)
        ends = pa.array(np.cumsum([0, *out["rows"]]), pa.int32())
        types = {"digest": pa.binary(), "shared": pa.binary(), "take": pa.int32()}
        return pa.table({name: pa.ListArray.from_arrays(ends, carried) if name == "rows" else pa.array(values, types.get(name, pa.int64())) for name, values in out.items()})

    return job


def overlap(a: int, b: int, percent: int) -> int:
    """How many shingles sets of a and b must share."""
    return -(-percent * (a + b) // (100 + percent))


def partners(n: int, percent: int) -> range:
    """The sizes that a set of n can be similar to."""
    return range(-(-percent * n // 100), 100 * n // percent + 1)


def subsets(h: np.ndarray, n: int, percent: int, most: int) -> list[int]:
    """For each size m of a light partner, a key for each subset of the size that both must share."""
    out, h = [], mix(h).tolist()
    for m in partners(n, percent):
        c = overlap(n, m, percent)
        if 0 < m <= most and c <= len(h):
            mark = (min(n, m) << 32) + (max(n, m) << 16) + c
            out += [(sum(x) * 0x9E3779B97F4A7C15 + mark) & 0xFFFFFFFFFFFFFFFF for x in combinations(h, c)]
    return out


def boundary(stats: dict[int, tuple[int, int]], percent: int) -> int:
    """The x of least cost. stats: by set size the sets and the list entries that they scan."""

    def cost(x: int) -> int:
        total = 0
        for n, (sets, scan) in stats.items():
            if n <= x:
                total += sets * sum(len(list(combinations(range(n), c))) for m in partners(n, percent) if m <= x and (c := overlap(n, m, percent)) <= n)
            if n > x or partners(n, percent)[-1] > x:
                total += scan
        return total

    return min(range(MOST_LIGHT + 1), key=cost)


def _lists(percent: int, most: int, segments: int, whole: bool = False):
    """A batch's list entries and subsets, by key; of equal keys the first node's alone and edges to it, unless the whole lists are asked for."""

    def job(batches):
        for batch in batches:
            keys, nodes, sizes = [np.empty(0, U64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for x in batch.select(["node", "n", "shared", "take"]).to_pylist():
                h, n = np.frombuffer(x["shared"], U64), x["n"]
                found = []  # with a salt for each kind: list entries meet list entries, subsets meet subsets
                if n > most or partners(n, percent)[-1] > most:
                    found.append((0, h[: x["take"]]))
                if n <= most:
                    found.append((1, np.array(subsets(h, n, percent, most), U64)))
                keys += [mix(k + U64(salt)) for salt, k in found]
                nodes += [np.full(len(k), x["node"]) for _, k in found]
                sizes += [np.full(len(k), n) for _, k in found]
            keys, nodes, sizes = np.concatenate(keys), np.concatenate(nodes), np.concatenate(sizes)
            order = np.lexsort((nodes, keys))
            keys, nodes, sizes = keys[order], nodes[order], sizes[order]
            ends = None
            if not whole and len(keys):
                r = runs(keys)
                ends = np.unique(np.stack((nodes, np.repeat(nodes[r[:-1]], np.diff(r))), axis=1), axis=0)
                ends = ends[ends[:, 0] != ends[:, 1]]
                keys, nodes, sizes = keys[r[:-1]], nodes[r[:-1]], sizes[r[:-1]]
            out: dict[str, list] = {x: [] for x in _names(LIST)}
            a = 0
            for seg, part in _pieces(keys, segments):
                b = a + len(part)
                for name, value in zip(out, (seg, raw(part), raw(nodes[a:b]), raw(sizes[a:b]), raw(ends) if ends is not None and not a else None), strict=True):
                    out[name].append(value)
                a = b
            yield from _table(out, LIST).to_batches()

    return job


def _list_runs(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The keys, nodes and sizes of a segment's lists, list by list, and where the lists start."""
    keys, nodes, sizes = (np.concatenate([np.frombuffer(x, kind) for x in table[c].to_pylist()]) for c, kind in (("keys", U64), ("nodes", np.int64), ("sizes", np.int64)))
    order = np.lexsort((nodes, keys))
    return keys[order], nodes[order], sizes[order], runs(keys[order])


def _met(percent: int):
    """Of a segment's lists the pairs to compare: all of a short list, those with the first of a long one."""

    def job(table):
        _, nodes, sizes, r = _list_runs(table)
        length, at = np.repeat(np.diff(r), np.diff(r)), np.arange(len(nodes))
        place = at - np.repeat(r[:-1], np.diff(r))
        a, b = [at[place > 0]], [(at - place)[place > 0]]
        for step in range(1, SHORT):
            i = at[(length <= SHORT) & (place > step)]
            a.append(i)
            b.append(i - step)
        a, b = np.concatenate(a), np.concatenate(b)
        fit = 100 * np.minimum(sizes[a], sizes[b]) >= percent * np.maximum(sizes[a], sizes[b])
        pairs = np.unique(np.stack((nodes[a[fit]], nodes[b[fit]]), axis=1), axis=0)
        return pa.table({"a": pa.array(pairs[:, 0], pa.int64()), "b": pa.array(pairs[:, 1], pa.int64())})

    return job


def _long(table: pa.Table) -> pa.Table:
    """The entries of a segment's long lists."""
    keys, nodes, _, r = _list_runs(table)
    long = np.repeat(np.diff(r), np.diff(r)) > SHORT
    return pa.table({"key": pa.array(keys[long].view(np.int64), pa.int64()), "node": pa.array(nodes[long], pa.int64())})


def _compared(percent: int):
    def job(batches):
        for batch in batches:
            x, y, n, m = batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_numpy(), batch.column(5).to_numpy()
            inter = np.fromiter((len(np.intersect1d(np.frombuffer(a, U64), np.frombuffer(b, U64), assume_unique=True)) for a, b in zip(x, y, strict=True)), np.int64, len(x))
            hit = pa.array(_similar(inter, n + m, percent))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(hit), batch.column(1).filter(hit)], ["a", "b"])

    return job


def _forest(nodes: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.Table:
    """Edges that join the same nodes as the edges (a, b) of positions in nodes, fewer than there are nodes."""
    label = local_components(len(nodes), a, b)
    own = np.flatnonzero(label != np.arange(len(nodes)))
    return pa.table({"a": pa.array(nodes[own], pa.int64()), "b": pa.array(nodes[label[own]], pa.int64())})


def _candidates(table: pa.Table) -> pa.Table:
    keys, nodes, _, r = _list_runs(table)
    ends = np.concatenate([np.frombuffer(x, np.int64).reshape(-1, 2) for x in table["ends"].to_pylist() if x is not None] or [np.empty((0, 2), np.int64)])
    a, b = np.concatenate((nodes, ends[:, 0])), np.concatenate((np.repeat(nodes[r[:-1]], np.diff(r)), ends[:, 1]))
    names = np.unique(np.concatenate((a, b)))
    return _forest(names, np.searchsorted(names, a), np.searchsorted(names, b))


def _ranks(h: np.ndarray) -> tuple[np.ndarray, int]:
    """The position of each value among the different ones; those that occur once are -1."""
    order = np.argsort(h)
    times = np.diff(runs(h[order]))
    place = np.where(times > 1, np.cumsum(times > 1) - 1, -1)
    out = np.empty(len(h), np.int64)
    out[order] = np.repeat(place, times)
    return out, int((times > 1).sum())


def _similar(inter: np.ndarray, total: np.ndarray, percent: int) -> np.ndarray:
    return (100 * inter >= percent * (total - inter)) & (inter > 0)


def _dense(row: np.ndarray, col: np.ndarray, width: int, n: int, split: int) -> np.ndarray:
    """The overlaps of rows below split with all others (with all, if split is n), list by list."""
    left, right = (slice(0, n), slice(0, n)) if split == n else (slice(0, split), slice(split, n))
    out = np.zeros((left.stop - left.start, right.stop - right.start), np.float32)
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    for a in range(0, width, 4096):
        i, j = np.searchsorted(col, (a, a + 4096))
        m = np.zeros((n, min(4096, width - a)), np.float32)
        m[row[i:j], col[i:j] - a] = 1
        out += m[left] @ m[right].T
    return out


def _pairs(row: np.ndarray, col: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """i < j and their overlap, for all rows that share a column; for short lists."""
    order = np.lexsort((row, col))
    row, col = row[order], col[order]
    found, step = [np.empty(0, np.int64)], 1
    while True:
        same = col[step:] == col[:-step]
        if not same.any():
            break
        found.append(row[:-step][same] * n + row[step:][same])
        step += 1
    x = np.sort(np.concatenate(found))
    r = runs(x)
    x = x[r[:-1]] if len(x) else x
    return x // n, x % n, np.diff(r)


def _verify(percent: int):
    def job(key, table):
        nodes, group, part, size = (table[x].to_numpy() for x in ("node", "label", "part", "n"))
        order = np.lexsort((nodes, part, group))
        nodes, group, part, size = (x[order] for x in (nodes, group, part, size))
        sets = table["shared"].to_pylist()
        sets = [np.frombuffer(sets[i], U64) for i in order]
        row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        col, _ = _ranks(np.concatenate(sets))
        row, col = row[col >= 0], col[col >= 0]
        a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        r = runs(group)
        small = np.repeat(np.diff(r) < DENSE, np.diff(r))
        use = small[row]
        i, j, inter = _pairs(row[use], col[use], len(sets))
        hit = _similar(inter, size[i] + size[j], percent) & (group[i] == group[j])
        a.append(i[hit])
        b.append(j[hit])
        for x, y in zip(r[:-1], r[1:], strict=True):
            if y - x >= DENSE:
                lo, hi = np.searchsorted(row, (x, y))
                own, width = _ranks(col[lo:hi].astype(U64))
                keep = own >= 0
                split = int((part[x:y] == part[x]).sum())
                inter = _dense(row[lo:hi][keep] - x, own[keep], width, y - x, split)
                left = size[x : x + split] if split < y - x else size[x:y]
                right = size[x + split : y] if split < y - x else size[x:y]
                i, j = np.nonzero(_similar(inter, left[:, None] + right[None, :], percent))
                a.append(i + x)
                b.append(j + x + (split if split < y - x else 0))
        return _forest(nodes, np.concatenate(a), np.concatenate(b))

    return job


def _blocked(alive: DataFrame, members: DataFrame, percent: int, block_docs: int, block_shingles: int, buckets: int) -> DataFrame:
    """Links among the sets of each group of members (node, label, blocks), in blocks of bounded size."""
    near = members.select("node", "label", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("part"))
    near = alive.select("node", "n", "shared").join(near, "node")
    # a group of one block shares a task with others; of more blocks, each pair has a task
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    name = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("label"), F.lit(buckets))).otherwise(F.xxhash64("label", F.least("part", "other"), F.greatest("part", "other")))
    tasks = near.select("node", "label", "n", "shared", "part", "blocks", other).select(name.alias("task"), "node", "label", "n", "shared", "part")
    return tasks.groupBy("task").applyInArrow(_verify(percent), EDGE)


def _weighed(alive: DataFrame, groups: DataFrame, block_docs: int, block_shingles: int) -> DataFrame:
    """(node, label, blocks) for groups (node, label); from a table without the sets."""
    near = alive.select("node", (F.octet_length("shared").cast("long") / 8).alias("size")).join(groups, "node")
    weight = near.groupBy("label").agg(F.count(F.lit(1)).alias("docs"), F.sum("size").alias("shingles"))
    blocks = F.ceil(F.greatest(F.col("docs") / block_docs, F.col("shingles") / block_shingles)).cast("int")
    return near.select("node", "label").join(weight.select("label", blocks.alias("blocks")), "label").select("node", "label", "blocks")


def _large(big: DataFrame, percent: int, most: int, segments: int, block_docs: int, block_shingles: int, buckets: int) -> DataFrame:
    """Links among the sets big (node, n, shared, take) that met, of groups over a block's size."""
    lists = big.mapInArrow(_lists(percent, most, segments, whole=True), LIST)
    pairs = lists.groupBy("seg").applyInArrow(_met(percent), EDGE).distinct()
    x = big.select(F.col("node").alias("a"), F.col("shared").alias("x"), F.col("n").alias("n"))
    y = big.select(F.col("node").alias("b"), F.col("shared").alias("y"), F.col("n").alias("m"))
    links = written(pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y", "n", "m").mapInArrow(_compared(percent), EDGE), "links")
    entries = lists.groupBy("seg").applyInArrow(_long, ENTRY)
    label = F.coalesce("label", "node")
    entries = entries.join(components(links), "node", "left").select("key", "node", label.alias("label"))
    # a long list is done if its sets are in one component
    open_keys = entries.groupBy("key").agg(F.min("node").alias("first"), F.min("label").alias("x"), F.max("label").alias("y")).filter("x < y").select("key", "first")
    rest = written(entries.join(open_keys, "key").select(F.col("node").alias("a"), F.col("first").alias("b")).distinct(), "rest")
    if rest.limit(1).count():
        members = _weighed(big, components(rest), block_docs, block_shingles)
        links = links.unionByName(_blocked(big, members, percent, block_docs, block_shingles, buckets))
    return links


def similar_groups(docs: DataFrame, shingle: int = 5, percent: int = 75, block_docs: int = 1024, block_shingles: int = 1 << 19, segment_bytes: int = 16 << 20, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of docs (doc_id, text); percent / 100 is the least similarity.

    carry: columns of docs that come along.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *carry)
    row = docs.drop("text").schema
    total = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n = max(1, -(-total // segment_bytes))
    shared = docs.mapInArrow(_shingles(shingle, n), KEYS).groupBy("seg").applyInArrow(_count, SHARED)
    sets = written(shared.groupBy("chunk").applyInArrow(_sets(percent, to_arrow_schema(row)), SETS.format(row=row.simpleString())), "sets")
    # equal sets of all batches are one, named by the least of their nodes
    reps = written(sets.filter("n > 0").groupBy("digest").agg(F.min("node").alias("rep"), F.min("least").alias("least")), "reps")
    alive = written(sets.filter("shared IS NOT NULL").select("node", "n", "shared", "take", "scan").join(reps.select(F.col("rep").alias("node")), "node"), "alive")
    light = {x["n"]: (x["sets"], x["scan"] or 0) for x in alive.filter(f"n <= {MOST_LIGHT}").groupBy("n").agg(F.count(F.lit(1)).alias("sets"), F.sum("scan").alias("scan")).collect()}
    most, size = boundary(light, percent), alive.agg(F.sum(F.octet_length("shared").cast("long") / 8).cast("long")).first()[0] or 0
    segments, buckets = max(1, -(-size // (1 << 22))), max(1, -(-size // block_shingles))
    groups = components(alive.mapInArrow(_lists(percent, most, segments), LIST).groupBy("seg").applyInArrow(_candidates, EDGE))
    members = written(_weighed(alive, groups, block_docs, block_shingles), "members")
    links, spent = _blocked(alive, members.filter("blocks = 1"), percent, block_docs, block_shingles, buckets), []
    if members.filter("blocks > 1").limit(1).count():
        big = written(alive.join(members.filter("blocks > 1").select("node"), "node"), "big")
        spent.append(big)
        links = links.unionByName(_large(big, percent, most, segments, block_docs, block_shingles, buckets))
    links, spent = components(links), [alive, members, *spent]
    named = links.join(reps.select(F.col("rep").alias("node"), "least"), "node")
    of = links.join(named.groupBy("label").agg(F.min("least").alias("component")), "label").select(F.col("node").alias("rep"), "component")
    of = reps.join(of, "rep", "left").select("digest", F.coalesce("component", "least").alias("component"))
    discard(docs.sparkSession, [x.written_to for x in spent])
    out = sets.select("digest", "rows", "n").join(of, "digest", "left").select("n", "component", F.explode("rows").alias("row"))
    out = out.select("row.*", "n", "component")
    return out.select("doc_id", *carry, F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"))
