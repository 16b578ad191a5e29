"""Repeats around shared anchors: what suffix-array dedup and substring dedup have in common.

A text is a string of symbols (bytes, or hashes of words).  Every window of
``length`` symbols has one anchor, a winnowed n-gram whose place depends on the
window alone, and each anchor stands for a run of windows: its surroundings.  A
window that occurs twice therefore occurs twice in surroundings of one anchor.

The steps, each a shuffle of packed rows, one for a chunk of texts and a
segment of hashes:
1. ``seen``: a chunk sends its different anchors, with the least and greatest
   place that has them and the number of different surroundings.
2. ``shared``: it is told which of them occur in more than one place.
3. ``around``: it sends the different surroundings of these, each once.
4. ``cover``: of each anchor the suffixes that start there are sorted (a stretch
   of the enhanced suffix array) and ``groups`` finds the maximal repeats; the
   chunks are told which stretches of which surroundings repeat, and the least
   place that has the repeat.

An anchor with more than ``heavy`` surroundings, different ones in each chunk (a passage in
very many documents has two at its ends) is taken apart: each of its windows
goes to the segment of its own hash.  Suffixes with ``length`` symbols in common
still meet, as one key, which is the interval of that depth; so a segment never
sorts more than ``heavy`` suffixes of an anchor, and a window of a third of all
documents costs its segment one short entry a chunk.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

from .common import U64, cut, mix, packed, raw, runs, segment, unpacked, word_hashes

SEEN = "seg int, chunk int, h binary, low binary, more binary, kinds binary"
SHARED = "chunk int, h binary, heavy binary"
AROUND = "seg int, chunk int, h binary, low binary, more binary, key binary, before binary, size binary, body binary"
COVER = "chunk int, h binary, a binary, b binary, low binary"
NEVER = np.iinfo(np.int64).min
SLICE = 4096
PIECE = 1 << 18


def table_of(columns: dict[str, list], schema: str) -> pa.Table:
    types = {"int": pa.int32(), "binary": pa.binary(), "long": pa.int64(), "string": pa.string()}
    fields = [x.split() for x in schema.split(", ")]
    return pa.table({name: pa.array(columns[name], types[kind]) for name, kind in fields})


def planes(a: np.ndarray) -> bytes:
    """Int64 values by byte position: leading zeros then compress away."""
    return raw(a.astype(np.int64).view(np.uint8).reshape(-1, 8).T)


def unplaned(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(8, -1).T).view(np.int64).ravel()


def lookup(keys: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of x are in the sorted keys, and where."""
    if not len(keys):
        return np.zeros(len(x), bool), np.zeros(len(x), np.int64)
    at = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
    return keys[at] == x, at


def stretches(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All positions start ... start + size - 1, one stretch after the other."""
    return np.repeat(start - np.cumsum(size) + size, size) + np.arange(int(size.sum()))


def joined(parts: list, dtype) -> np.ndarray:
    return np.concatenate([np.frombuffer(x, dtype) for x in parts] or [np.empty(0, dtype)])


class Occurrences:
    """A chunk's symbols and its anchors: where each is, its hash, and the stretch [low, high) of the windows it stands for.

    place: an order value for each anchor, the same for those that don't count
    as different places; if None, all occurrences are places of their own.
    """

    def __init__(self, sym: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray, h: np.ndarray, place: np.ndarray | None, chunk: int):
        self.sym, self.at, self.low, self.high, self.h, self.place, self.chunk = sym, at, low, high, h, place, chunk

    def keys(self, use: np.ndarray) -> np.ndarray:
        """The same for occurrences with the same anchor and the same symbols around it."""
        low, high = self.low[use], self.high[use]
        return mix(word_hashes(self.sym, low, high) ^ mix(self.h[use] + (self.at[use] - low).astype(U64)))

    def windows(self, use: np.ndarray, length: int):
        """(starts, occurrences, hashes) of the windows of these anchors, a piece at a time."""
        size = self.high[use] - self.low[use] - length + 1
        r = runs(np.cumsum(size) // PIECE)
        for a, b in zip(r[:-1], r[1:], strict=True):
            if b > a:
                starts = stretches(self.low[use[a:b]], size[a:b])
                yield starts, np.repeat(use[a:b], size[a:b]), word_hashes(self.sym, starts, starts + length)

    def places(self, use: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least and the greatest place of each run r of use."""
        if len(r) < 2:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        if self.place is None:
            low = np.full(len(r) - 1, 2 * self.chunk)
            return low, low + (np.diff(r) > 1)
        own = self.place[use]
        return np.minimum.reduceat(own, r[:-1]), np.maximum.reduceat(own, r[:-1])


def intervals(lcp: list[int]):
    """(common prefix, first, last) of each interval of the suffix array, inner ones first. lcp[i] is that of i - 1 and i."""
    stack = [(0, 0)]
    for i in range(1, len(lcp) + 1):
        now, left = lcp[i] if i < len(lcp) else 0, i - 1
        while stack[-1][0] > now:
            prefix, left = stack.pop()
            yield prefix, left, i - 1
        if stack[-1][0] < now:
            stack.append((now, left))


def common(a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """For each row the length of the common start, at most most."""
    if not a.shape[1]:
        return np.zeros(len(a), np.int64)
    differ = a != b
    first = differ.argmax(axis=1)
    first[~differ[np.arange(len(a)), first]] = a.shape[1]
    return np.minimum(first, most)


def ordered(rows: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The order of rows padded with zeros; of equal ones the shorter comes first, as zeros may be real."""
    by_size = np.argsort(size, kind="stable")
    if not rows.shape[1]:
        return by_size
    if rows.dtype != np.uint8:
        rows = rows.astype(">u8").view(np.uint8).reshape(len(rows), -1)
    return by_size[np.argsort(np.ascontiguousarray(rows).view(f"S{rows.shape[1]}").ravel()[by_size], kind="stable")]


def groups(h: np.ndarray, before: np.ndarray, size: np.ndarray, start: np.ndarray, sym: np.ndarray, length: int):
    """(members, left, right, cuts): the maximal repeats of at least length symbols among different entries.

    Entry i is an anchor with hash h[i], before[i] symbols from the start of the
    surroundings sym[start[i] : start[i] + size[i]].  The members cuts[g] to
    cuts[g + 1] are those of group g: each has the repeat from left[g] symbols
    before its anchor to right[g] symbols behind the anchor's start.

    An interval of the suffixes' common-prefix tree gives the right end.  Its
    suffixes are put in the order of what stands before them, read backwards, and
    scanned likewise: an interval of that scan has parts that differ in the next
    symbol to the left.  It is a maximal repeat if its parts differ to the right,
    too, that is if they are not all in one child of the prefix interval.
    """
    n, after = len(h), size - before
    none = np.empty(0, np.int64)
    if n < 2:
        return none, none, none, np.zeros(1, np.int64)
    most_after, most_before = int(after.max()), int(before.max())
    place = np.arange(most_after)
    right = np.where(place < after[:, None], sym[np.minimum(start[:, None] + before[:, None] + place, len(sym) - 1)], sym.dtype.type(0))
    place = np.arange(most_before)
    left = np.where(place < before[:, None], sym[np.maximum(start[:, None] + before[:, None] - 1 - place, 0)], sym.dtype.type(0))
    rank = np.unique(h, return_inverse=True)[1]
    order = ordered(right, after)
    order = order[np.argsort(rank[order], kind="stable")]
    right, left, before, after, rank = right[order], left[order], before[order], after[order], rank[order]
    lcp = np.zeros(n, np.int64)
    lcp[1:] = common(right[1:], right[:-1], np.minimum(after[1:], after[:-1]))
    lcp[1:][rank[1:] != rank[:-1]] = 0
    pair = common(left[1:], left[:-1], np.minimum(before[1:], before[:-1]))
    by_left = np.empty(n, np.int64)
    by_left[ordered(left, before)] = np.arange(n)
    found, lefts, rights, pairs = [], [], [], []
    for prefix, i, j in intervals(lcp.tolist()):
        if j == i + 1:
            pairs.append((prefix, i))
            continue
        need = length - prefix
        if int(before[i : j + 1].max()) < need:
            continue
        x = np.argsort(by_left[i : j + 1])
        child = np.concatenate(([0], np.cumsum(lcp[i + 1 : j + 1] == prefix)))[x]
        x += i
        near = common(left[x[1:]], left[x[:-1]], np.minimum(before[x[1:]], before[x[:-1]]))
        near = [0, *np.maximum(near - need + 1, 0).tolist()]
        for extent, a, b in intervals(near):
            part = child[a : b + 1]
            if (part != part[0]).any():
                found.append(x[a : b + 1])
                lefts.append(extent + need - 1)
                rights.append(prefix)
    sizes = np.array([len(x) for x in found], np.int64)
    if pairs:
        prefix, i = np.array(pairs).T
        hit = prefix + pair[i] >= length
        prefix, i = prefix[hit], i[hit]
        found.append(np.stack((i, i + 1), axis=1).ravel())
        sizes = np.concatenate((sizes, np.full(len(i), 2)))
        lefts, rights = np.concatenate((np.array(lefts, np.int64), pair[i])), np.concatenate((np.array(rights, np.int64), prefix))
    members = order[np.concatenate(found)] if found else none
    return members, np.asarray(lefts, np.int64), np.asarray(rights, np.int64), np.concatenate(([0], np.cumsum(sizes)))


def repeats(h, key, before, size, start, low, high, sym, length: int, apart: bool):
    """(entry, from, to, least place): stretches of entries' surroundings that occur in a further place.

    apart: different surroundings are different places in any case.
    """
    order = np.lexsort((key, h))
    new = np.concatenate(([True], (key[order][1:] != key[order][:-1]) | (h[order][1:] != h[order][:-1])))
    r = np.append(np.flatnonzero(new), len(order))
    first, kind = order[r[:-1]], np.empty(len(order), np.int64)
    kind[order] = np.cumsum(new) - 1
    low, high = np.minimum.reduceat(low[order], r[:-1]), np.maximum.reduceat(high[order], r[:-1])
    h, before, size, start = h[first], before[first], size[first], start[first]
    whole = np.flatnonzero(low < high)
    out = [(whole, np.zeros(len(whole), np.int64), size[whole], low[whole])]
    ends = runs(h)[1:]
    a = 0
    while a < len(h):  # whole anchors, about SLICE entries at a time
        b = int(ends[np.searchsorted(ends, min(a + SLICE, len(h)))])
        members, left, right, cuts = groups(h[a:b], before[a:b], size[a:b], start[a:b], sym, length)
        members = members + a
        if len(members):
            least, most = np.minimum.reduceat(low[members], cuts[:-1]), np.maximum.reduceat(high[members], cuts[:-1])
            times = np.diff(cuts)
            use = np.repeat((least < most) | apart, times)
            own = before[members]
            out.append(tuple(x[use] for x in (members, own - np.repeat(left, times), own + np.repeat(right, times), np.repeat(least, times))))
        a = b
    entry, x, y, least = (np.concatenate(c) for c in zip(*out, strict=True))
    order = np.lexsort((least, y, x, entry))  # of the same stretches the one with the least place
    entry, x, y, least = (c[order] for c in (entry, x, y, least))
    keep = np.ones(len(entry), bool)
    keep[1:] = (entry[1:] != entry[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    entry, x, y, least = (c[keep] for c in (entry, x, y, least))
    # from the different surroundings back to the entries
    cuts = np.searchsorted(entry, np.arange(len(first) + 1))
    times = np.diff(cuts)[kind]
    at = stretches(cuts[:-1][kind], times)
    return np.repeat(np.arange(len(kind)), times), x[at], y[at], least[at]


def answered(h: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order of h, the starts of its runs, and for each run the least place if there is another, else NEVER."""
    order = np.argsort(h, kind="stable")
    r = runs(h[order])
    least, most = np.minimum.reduceat(low[order], r[:-1]), np.maximum.reduceat(high[order], r[:-1])
    return order, r, np.where(least < most, least, NEVER)


def _places(rows: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    low = np.concatenate([unplaned(x["low"]) for x in rows])
    return low, low + np.concatenate([unplaned(x["more"]) for x in rows])


def jobs(read: Callable[[int, pa.Table], Occurrences], length: int, segments: int, heavy: int, symbol, first_stays: bool):
    """The four steps. read(chunk, its table) gives the occurrences; first_stays: the least place needs no answer."""

    def seen(key, table):
        c = read(key[0].as_py(), table)
        out = {x.split()[0]: [] for x in SEEN.split(", ")}
        if len(c.h):
            every = np.arange(len(c.h))
            keys = c.keys(every)
            order = np.lexsort((keys, c.h))
            h, keys = c.h[order], keys[order]
            r = runs(h)
            new = np.concatenate(([True], (keys[1:] != keys[:-1]) | (h[1:] != h[:-1]))).astype(np.int64)
            kinds, (low, high), h = np.add.reduceat(new, r[:-1]), c.places(order, r), h[r[:-1]]
            for seg, a, b in cut(h, segments):
                for name, value in zip(out, (seg, c.chunk, packed(h[a:b]), planes(low[a:b]), planes(high[a:b] - low[a:b]), planes(kinds[a:b])), strict=True):
                    out[name].append(value)
        return table_of(out, SEEN)

    def shared(table):
        parts = [unpacked(x) for x in table["h"].to_pylist()]
        h = np.concatenate(parts)
        low, more, kinds = (np.concatenate([unplaned(x) for x in table[c].to_pylist()]) for c in ("low", "more", "kinds"))
        order, r, least = answered(h, low, low + more)
        often, many = np.empty(len(h), bool), np.empty(len(h), bool)
        often[order] = np.repeat(least != NEVER, np.diff(r))
        many[order] = np.repeat(np.add.reduceat(kinds[order], r[:-1]) > heavy, np.diff(r))
        out, a = {"chunk": [], "h": [], "heavy": []}, 0
        for chunk, p in zip(table["chunk"].to_pylist(), parts, strict=True):
            hit = often[a : a + len(p)]
            if hit.any():
                for name, value in zip(out, (chunk, raw(p[hit]), raw(np.packbits(many[a : a + len(p)][hit]))), strict=True):
                    out[name].append(value)
            a += len(p)
        return table_of(out, SHARED)

    def around(key, table, back):
        c = read(key[0].as_py(), table)
        known = joined(back["h"].to_pylist(), U64)
        many = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=len(h) // 8) for x, h in zip(back["heavy"].to_pylist(), back["h"].to_pylist(), strict=True)] or [np.empty(0, np.uint8)]).astype(bool)
        order = np.argsort(known)
        found, at = lookup(known[order], c.h)
        use = np.flatnonzero(found)
        split = many[order][at[use]]
        out = {x.split()[0]: [] for x in AROUND.split(", ")}
        for light in [use[~split]] if len(use) else []:
            keys = c.keys(light)
            order = np.argsort(keys, kind="stable")
            r = runs(keys[order])
            low, high = c.places(light[order], r)
            first, keys = light[order[r[:-1]]], keys[order[r[:-1]]]
            seg = segment(c.h[first], segments)
            by_seg = np.argsort(seg, kind="stable")
            seg, first, keys, low, high = (x[by_seg] for x in (seg, first, keys, low, high))
            size, before = c.high[first] - c.low[first], c.at[first] - c.low[first]
            r = runs(seg)
            for a, b in zip(r[:-1], r[1:], strict=True):
                if b > a:
                    body = c.sym[stretches(c.low[first[a:b]], size[a:b])]
                    values = (int(seg[a]), c.chunk, raw(c.h[first[a:b]]), planes(low[a:b]), planes(high[a:b] - low[a:b]), raw(keys[a:b]), raw(before[a:b].astype(np.uint16)), raw(size[a:b].astype(np.uint16)), raw(body))
                    for name, value in zip(out, values, strict=True):
                        out[name].append(value)
        if split.any():
            anchors = np.unique(c.h[use[split]])  # come back as they are: so the last step knows whose windows to look up
            for name, value in zip(out, (c.chunk % segments, c.chunk, raw(anchors), *[None] * 6), strict=True):
                out[name].append(value)
            whose, h = (np.concatenate(x) for x in list(zip(*c.windows(use[split], length), strict=True))[1:])
            order = np.argsort(h, kind="stable")
            r = runs(h[order])
            (low, high), h = c.places(whose[order], r), h[order[r[:-1]]]
            for seg, a, b in cut(h, segments):
                for name, value in zip(out, (seg, c.chunk, raw(h[a:b]), planes(low[a:b]), planes(high[a:b] - low[a:b]), None, None, None, None), strict=True):
                    out[name].append(value)
        return table_of(out, AROUND)

    def cover(table):
        out = {x.split()[0]: [] for x in COVER.split(", ")}
        rows = table.to_pylist()
        entries, single = [x for x in rows if x["key"] is not None], [x for x in rows if x["key"] is None and x["low"] is not None]
        for x in rows:
            if x["low"] is None:
                for name, value in zip(out, (x["chunk"], x["h"], None, None, None), strict=True):
                    out[name].append(value)
        if entries:
            sizes = [np.frombuffer(x["size"], np.uint16) for x in entries]
            h, key = (joined([x[k] for x in entries], U64) for k in ("h", "key"))
            before, (low, high), size = joined([x["before"] for x in entries], np.uint16).astype(np.int64), _places(entries), np.concatenate(sizes).astype(np.int64)
            entry, a, b, least = repeats(h, key, before, size, np.cumsum(size) - size, low, high, joined([x["body"] for x in entries], symbol), length, not first_stays)
            if first_stays:
                entry, a, b, least = (x[high[entry] > least] for x in (entry, a, b, least))
            cuts = np.searchsorted(entry, np.cumsum([0, *map(len, sizes)]))
            for x, i, j in zip(entries, cuts[:-1], cuts[1:], strict=True):
                if j > i:
                    for name, value in zip(out, (x["chunk"], raw(key[entry[i:j]]), raw(a[i:j].astype(np.uint16)), raw(b[i:j].astype(np.uint16)), planes(least[i:j])), strict=True):
                        out[name].append(value)
        if single:
            parts = [np.frombuffer(x["h"], U64) for x in single]
            h, (low, high) = np.concatenate(parts), _places(single)
            order, r, least = answered(h, low, high)
            own = np.empty(len(h), np.int64)
            own[order] = np.repeat(least, np.diff(r))
            i = 0
            for x, p in zip(single, parts, strict=True):
                hit = (own[i : i + len(p)] != NEVER) & ((not first_stays) | (high[i : i + len(p)] > own[i : i + len(p)]))
                if hit.any():
                    for name, value in zip(out, (x["chunk"], raw(p[hit]), None, None, planes(own[i : i + len(p)][hit])), strict=True):
                        out[name].append(value)
                i += len(p)
        return table_of(out, COVER)

    return seen, shared, around, cover


def covered(c: Occurrences, back: pa.Table, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(occurrence, start, end, least place) of each stretch that a chunk was told repeats, in positions of its symbols."""
    rows = back.to_pylist()
    found = [(np.empty(0, np.int64),) * 4]
    entries, single = [x for x in rows if x["a"] is not None], [x for x in rows if x["a"] is None and x["low"] is not None]
    if entries and len(c.h):
        keys, a, b = joined([x["h"] for x in entries], U64), *(joined([x[k] for x in entries], np.uint16).astype(np.int64) for k in "ab")
        least = np.concatenate([unplaned(x["low"]) for x in entries])
        order = np.argsort(keys, kind="stable")
        keys, a, b, least = keys[order], a[order], b[order], least[order]
        own = c.keys(np.arange(len(c.h)))
        i, j = np.searchsorted(keys, own), np.searchsorted(keys, own, side="right")
        hit = np.flatnonzero(j > i)
        times = (j - i)[hit]
        which, whose = stretches(i[hit], times), np.repeat(hit, times)
        found.append((whose, c.low[whose] + a[which], c.low[whose] + b[which], least[which]))
    if single and len(c.h):
        keys, least = joined([x["h"] for x in single], U64), np.concatenate([unplaned(x["low"]) for x in single])
        order = np.argsort(keys)
        keys, least = keys[order], least[order]
        split = np.sort(joined([x["h"] for x in rows if x["low"] is None], U64))
        for starts, whose, h in c.windows(np.flatnonzero(lookup(split, c.h)[0]), length):
            hit, at = lookup(keys, h)
            found.append((whose[hit], starts[hit], starts[hit] + length, least[at[hit]]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))
