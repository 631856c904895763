"""Passages that documents repeat from one another, by a distributed merge sort of suffixes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, pick

LENGTH = 50
# Level of the compression of what travels.
LEVEL = 3
# Leading bytes by which suffixes are dealt to ranges; also what picks the suffixes to sort.
PREFIX = 12
# Bytes of text that make one sorted run, and suffixes that make one range.
RUN_BYTES = 8 << 20
# Bytes of a run that are hashed at a time.
BLOCK = 256 << 10
RANGE_ITEMS = 400_000
# Bytes of text whose suffixes place the range limits. Only the balance depends on it.
SAMPLE_BYTES = 8 << 20
# Of the sample, beginnings that come to the driver; ranges placed by them, which hashes divide further.
DRAWN, LIMITS = 64 * 1024, 2048
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xBF58476D1CE4E5B9))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _MIX[2]
    return x ^ (x >> np.uint64(32))


def _prefix_hashes(rows: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the first PREFIX bytes of each row."""
    ends = [np.ascontiguousarray(rows[:, at : at + 8]).view("<u8").ravel() for at in (0, PREFIX - 8)]
    return _mixed(ends[0] * _MIX[0] + ends[1] * _MIX[1])


class Segments:
    """Texts laid one after another, or overlapping parts of one long text."""

    def __init__(self):
        self.parts: list[bytes] = []
        self.docs: list[int] = []
        self.ties: list[int] = []
        self.bases: list[int] = []
        self.size = 0

    def add(self, doc: int, tie: int, base: int, part: bytes) -> None:
        self.parts.append(part)
        self.docs.append(doc)
        self.ties.append(tie)
        self.bases.append(base)
        self.size += len(part)


def segments(batches: Iterable[pa.RecordBatch], length: int, run_bytes: int) -> Iterator[Segments]:
    """Texts of (doc_id, tie, text) in groups of about ``run_bytes``; longer texts in parts that overlap by length - 1."""
    group = Segments()
    for batch in batches:
        for doc, tie, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            data = text.encode("utf-8", "surrogatepass")
            for base in range(0, max(1, len(data) - length + 1), run_bytes):
                part = data[base : base + run_bytes + length - 1]
                if len(part) >= length:
                    group.add(doc, tie, base, part)
                if group.size >= run_bytes:
                    yield group
                    group = Segments()
    if group.size:
        yield group


def anchors(group: Segments, length: int) -> tuple[np.ndarray, ...]:
    """(at, first, last, segment, data): the suffixes that stand for all strings of ``length`` bytes.

    Each such string is represented by its least-hashed part of PREFIX bytes,
    the leftmost of equals: equal strings pick the same place. ``at`` is where
    that part starts, ``first`` to ``last`` the consecutive strings that picked it.
    """
    span = length - PREFIX + 1
    data = np.frombuffer(b"".join(group.parts), np.uint8)
    starts = np.cumsum([0, *map(len, group.parts)])
    chosen = np.empty(group.size - length + 1, np.int32)
    for low in range(0, len(chosen), BLOCK):
        high = min(low + BLOCK, len(chosen))
        words = np.ndarray((high - low + length - 8,), "<u8", data[low : high + length - 1].tobytes(), strides=(1,))
        begins = len(words) - PREFIX + 8
        hashed = _mixed(words[:begins] * _MIX[0] + words[PREFIX - 8 : PREFIX - 8 + begins] * _MIX[1])
        least = (hashed & ~np.uint64(0xFFFFFF)) | np.arange(begins, dtype=np.uint64)
        width = 1
        while width * 2 <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < span:
            least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
        chosen[low:high] = (least & np.uint64(0xFFFFFF)).astype(np.int32) + low
    for end in starts[1:-1]:
        chosen[end - length + 1 : end] = -1
    change = np.flatnonzero(chosen[1:] != chosen[:-1]) + 1
    first, last = np.r_[0, change], np.r_[change - 1, len(chosen) - 1]
    used = chosen[first] >= 0
    first, last = first[used], last[used]
    return chosen[first].astype(np.int64), first, last, np.searchsorted(starts, first, "right") - 1, data


def _rows(data: np.ndarray, start: np.ndarray, width: int, sizes: np.ndarray) -> np.ndarray:
    """``width`` bytes from each start, zero from ``sizes`` on."""
    found = np.lib.stride_tricks.sliding_window_view(data, width)[start]
    found[np.arange(width) >= sizes[:, None]] = 0
    return found


class Items:
    """Suffixes of a run: what follows (right) and precedes (left, backwards) each anchor within the strings that picked it."""

    def __init__(self, right, right_size, left, left_size, doc, tie, at):
        self.right, self.right_size, self.left, self.left_size = right, right_size, left, left_size
        self.doc, self.tie, self.at = doc, tie, at

    @classmethod
    def of(cls, group: Segments, length: int) -> Items:
        at, first, last, segment, data = anchors(group, length)
        reach = length - PREFIX
        padded = np.concatenate([np.zeros(reach, np.uint8), data, np.zeros(length, np.uint8)])
        right_size, left_size = last + length - at, at - first
        right = _rows(padded, at + reach, length, right_size)
        # Bytes before the anchor, nearest first.
        left = np.lib.stride_tricks.sliding_window_view(padded, reach)[at][:, ::-1].copy()
        left[np.arange(reach) >= left_size[:, None]] = 0
        base = np.array(group.bases) - np.cumsum([0, *map(len, group.parts)])[:-1]
        return cls(
            right, right_size.astype(np.uint8), left, left_size.astype(np.uint8),
            np.array(group.docs, np.int64)[segment], np.array(group.ties, np.int64)[segment], at + base[segment],
        )

    def __len__(self) -> int:
        return len(self.doc)

    def take(self, rows: np.ndarray) -> Items:
        return Items(*(x[rows] for x in (self.right, self.right_size, self.left, self.left_size, self.doc, self.tie, self.at)))

    def keys(self) -> np.ndarray:
        """Each suffix with its sizes and left side as one sortable value; equal for equal items."""
        whole = np.concatenate([self.right, self.right_size[:, None], self.left_size[:, None], self.left], axis=1)
        return np.ascontiguousarray(whole).view(f"V{whole.shape[1]}").ravel()

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each key."""
        found = np.zeros(len(self), np.uint64)
        for c in (*self.right.T, self.right_size, self.left_size, *self.left.T):
            found = found * _MIX[0] + c
        return _mixed(found)

    def prefixes(self) -> np.ndarray:
        return np.ascontiguousarray(self.right[:, :PREFIX]).view(f"S{PREFIX}").ravel()

    def strings(self, rows: np.ndarray, length: int) -> Items:
        """One item per single string of the given items, each starting at its anchor."""
        counts = (self.right_size[rows].astype(int) + self.left_size[rows]) - length + 1
        row = np.repeat(rows, counts)
        # Bytes before the anchor at which the string starts.
        before = self.left_size[row].astype(int) - (np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts))
        both = np.concatenate([self.left[:, ::-1], self.right], axis=1)
        view = np.lib.stride_tricks.sliding_window_view(both, length, axis=1)
        right = view[row, self.left.shape[1] - before].copy()
        return Items(
            right, np.full(len(row), length, np.uint8), np.zeros((len(row), self.left.shape[1]), np.uint8), np.zeros(len(row), np.uint8),
            self.doc[row], self.tie[row], self.at[row] - before,
        )

    @staticmethod
    def joined(parts: list[Items]) -> Items:
        return Items(*(np.concatenate([getattr(p, n) for p in parts]) for n in ("right", "right_size", "left", "left_size", "doc", "tie", "at")))


def common(right: np.ndarray) -> np.ndarray:
    """Length of the prefix each row shares with the row before; 0 for the first."""
    found = np.zeros(len(right), np.uint8)
    if len(right) > 1:
        differ = right[1:] != right[:-1]
        found[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), right.shape[1])
    return found


def packed(items: Items, counts: np.ndarray, docs: np.ndarray, ties: np.ndarray | None, places: np.ndarray) -> bytes:
    """Sorted items front-coded: per item the length shared with the one before and only the bytes after it."""
    shared = common(items.right)
    column = np.arange(items.right.shape[1])
    rest = items.right[(column >= shared[:, None]) & (column < items.right_size[:, None])]
    left = items.left[np.arange(items.left.shape[1]) < items.left_size[:, None]]
    parts = [np.array([len(items), len(places), len(rest), ties is not None], np.int64), shared, items.right_size, items.left_size, counts.astype(np.uint32), docs]
    parts += [places.astype(np.int64)] + ([ties] if ties is not None else []) + [rest, left]
    return zstandard.ZstdCompressor(level=LEVEL).compress(b"".join(p.tobytes() for p in parts))


class Run:
    """A front-coded run as read back; strings are only rebuilt for the items asked for."""

    def __init__(self, blob: bytes, length: int):
        data = zstandard.ZstdDecompressor().decompress(blob)
        n, places, rest, tied = np.frombuffer(data, np.int64, 4)
        self._data, self._offset = data, 32
        self.shared, self.right_size, self.left_size = (self._next(np.uint8, n) for _ in range(3))
        self.counts, self.docs = self._next(np.uint32, n), self._next(np.int64, n)
        self.places = self._next(np.int64, places)
        self.ties = self._next(np.int64, n) if tied else np.zeros(n, np.int64)
        self._rest, self._left = self._next(np.uint8, rest), self._next(np.uint8, int(self.left_size.sum()))
        sizes = self.right_size.astype(np.int64) - np.minimum(self.shared, self.right_size)
        self._start = np.cumsum(sizes) - sizes
        self._length = length

    def _next(self, kind, n) -> np.ndarray:
        found = np.frombuffer(self._data, kind, n, self._offset)
        self._offset += found.nbytes
        return found

    def right(self, low: int, high: int, rows: np.ndarray | None = None) -> np.ndarray:
        """Bytes low..high-1 of the suffixes."""
        index = np.arange(len(self.shared))
        wanted = index if rows is None else rows
        out = np.zeros((len(wanted), high - low), np.uint8)
        size = self.right_size.astype(np.int64)
        for c in range(low, high):
            # The last row so far that spells this byte itself.
            source = np.maximum.accumulate(np.where(self.shared <= c, index, 0))[wanted]
            inside = size[source] > c
            source = source[inside]
            out[inside, c - low] = self._rest[self._start[source] + c - self.shared[source]]
        return out

    def left(self, rows: np.ndarray) -> np.ndarray:
        reach = self._length - PREFIX
        start = np.cumsum(self.left_size, dtype=np.int64) - self.left_size
        padded = np.concatenate([self._left, np.zeros(reach, np.uint8)])
        return _rows(padded, start[rows], reach, self.left_size[rows])


def merged(runs: list[tuple[list[bytes], list[int]]], length: int) -> tuple[list[int], list[int]]:
    """(order, shared): sorted runs merged by a loser tree that knows common prefixes.

    A run holds its strings and the prefix each shares with the one before.
    Every string in the tree carries the prefix it shares with the last one
    put out. Of two, the one that shares more is the smaller, without a look
    at the bytes; only equals are compared, from the byte after that prefix.
    """
    offsets, total = [], 0
    for strings, _ in runs:
        offsets.append(total)
        total += len(strings)
    width = 1
    while width < len(runs):
        width *= 2
    strings = [r[0] for r in runs] + [[]] * (width - len(runs))
    shares = [r[1] for r in runs] + [[]] * (width - len(runs))
    at = [0] * width
    current = [s[0] if s else None for s in strings]
    share = [0 if s else -1 for s in strings]  # -1: at its end, loses to all

    losers = [0] * width
    winners = [0] * width + list(range(width))

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's prefix is then the one it shares with the winner."""
        p, q = share[a], share[b]
        if p != q:
            return (a, b) if p > q else (b, a)
        if p < 0:
            return a, b
        x, y = current[a], current[b]
        if x[p:] == y[p:]:
            share[b] = length
            return a, b
        while x[p] == y[p]:
            p += 1
        if x[p] < y[p]:
            share[b] = p
            return a, b
        share[a] = p
        return b, a

    for node in range(width - 1, 0, -1):
        winners[node], losers[node] = play(winners[2 * node], winners[2 * node + 1])
    best = winners[1]
    order, found = [0] * total, [0] * total
    for k in range(total):
        i = at[best]
        order[k], found[k] = offsets[best] + i, share[best]
        i += 1
        at[best] = i
        if i < len(strings[best]):
            current[best], share[best] = strings[best][i], shares[best][i]
        else:
            share[best] = -1
        node = (best + width) >> 1
        mine = share[best]
        while node:
            other = losers[node]
            theirs = share[other]
            if mine > theirs:
                node >>= 1
                continue
            if mine == theirs and mine >= 0:
                x, y = current[best], current[other]
                p = mine
                if x[p:] == y[p:]:
                    share[other] = length
                    node >>= 1
                    continue
                while x[p] == y[p]:
                    p += 1
                if x[p] < y[p]:
                    share[other] = p
                    node >>= 1
                    continue
                share[best] = p
            losers[node], best, mine = best, other, theirs
            node >>= 1
    return order, found


def _least_doc(groups: np.ndarray, docs: np.ndarray, n: int) -> np.ndarray:
    least = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(least, groups, docs)
    return least


def removed(runs: list[Run], length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(doc_id, tie, start, stop) arrays: what strings of a smaller document cover, given all runs of one range."""
    counts = [len(r.shared) for r in runs]
    owner = np.repeat(np.arange(len(runs)), counts)
    docs = np.concatenate([r.docs for r in runs])
    # A suffix whose first bytes no other document has needs no place in the order.
    _, prefix = np.unique(np.concatenate([_prefix_hashes(r.right(0, PREFIX)) for r in runs]), return_inverse=True)
    n = prefix.max() + 1
    least, most = np.full(n, np.iinfo(np.int64).max), np.full(n, np.iinfo(np.int64).min)
    np.minimum.at(least, prefix, docs)
    np.maximum.at(most, prefix, docs)
    kept = np.flatnonzero((least != most)[prefix])
    if not len(kept):
        return
    starts = np.cumsum([0, *counts])
    trees, right, left, local = [], [], [], []
    for k, run in enumerate(runs):
        rows = kept[owner[kept] == k] - starts[k]
        if not len(rows):
            continue
        shown = np.concatenate([run.right(0, PREFIX, rows), run.right(PREFIX, length, rows)], axis=1)
        # Prefix shared with the last kept one: the least over all between.
        share = np.zeros(len(rows), np.int64)
        if len(rows) > 1:
            share[1:] = np.minimum.reduceat(run.shared[: rows[-1] + 1], rows[:-1] + 1)
        joined = shown.tobytes()
        trees.append(([joined[i : i + length] for i in range(0, len(joined), length)], share.tolist()))
        left.append(run.left(rows))
        local.append(np.stack([np.full(len(rows), k), rows]))
    order, share = merged(trees, length)
    order, share = np.array(order), np.array(share)
    local = np.concatenate(local, axis=1)[:, order]
    left = np.concatenate(left)[order]
    item = starts[local[0]] + local[1]
    doc = docs[item]
    right_size = np.concatenate([r.right_size for r in runs])[item].astype(int)
    left_size = np.concatenate([r.left_size for r in runs])[item].astype(int)

    # Equal items first: all but those of the least document go whole and need no further look.
    gone_item, gone_first, gone_last = [], [], []
    hashes = np.zeros((left.shape[1] + 1, len(left)), np.uint64)
    for o in range(left.shape[1]):
        hashes[o + 1] = _mixed(hashes[o] * _MIX[0] + left[:, o] + np.uint64(1))
    text = np.cumsum(share < length)
    group = _groups(text, hashes[left_size, np.arange(len(left))], left, left_size, right_size)
    least = _least_doc(group, doc, group.max() + 1)[group]
    whole = doc > least
    gone_item.append(np.flatnonzero(whole))
    gone_first.append(left_size[whole])
    gone_last.append((length - right_size)[whole])
    rest = np.flatnonzero(~whole)
    # Then string by string: ``o`` bytes of a string lie before its anchor.
    dropped_item, dropped_o = [], []
    for o in range(left.shape[1] + 1):
        rows = rest[(left_size[rest] >= o) & (right_size[rest] >= length - o)]
        if len(rows) < 2:
            continue
        level = np.cumsum(share < length - o)[rows]
        alone = np.r_[True, level[1:] != level[:-1]] & np.r_[level[1:] != level[:-1], True]
        rows, level = rows[~alone], level[~alone]
        if not len(rows):
            continue
        group = _groups(level, hashes[o, rows], left[rows], np.full(len(rows), o), None)
        over = doc[rows] > _least_doc(group, doc[rows], group.max() + 1)[group]
        dropped_item.append(rows[over])
        dropped_o.append(np.full(int(over.sum()), o))
    if dropped_item and sum(map(len, dropped_item)):
        rows, o = np.concatenate(dropped_item), np.concatenate(dropped_o)
        sort = np.lexsort((-o, rows))
        rows, o = rows[sort], o[sort]
        new = np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]) | (o[1:] != o[:-1] - 1)])
        gone_item.append(rows[new])
        gone_first.append(o[new])
        gone_last.append(o[np.r_[new[1:] - 1, len(rows) - 1]])
    rows, first, last = np.concatenate(gone_item), np.concatenate(gone_first), np.concatenate(gone_last)
    for k, run in enumerate(runs):
        mine = np.flatnonzero(local[0][rows] == k)
        if not len(mine):
            continue
        row = local[1][rows[mine]]
        times = run.counts[row].astype(int)
        ends = np.cumsum(run.counts, dtype=np.int64)[row]
        each = np.repeat(np.arange(len(row)), times)
        place = run.places[np.repeat(ends - times, times) + np.arange(len(each)) - np.repeat(np.cumsum(times) - times, times)]
        yield run.docs[row][each], run.ties[row][each], place - first[mine][each], place - last[mine][each] + length


def _groups(level: np.ndarray, hashed: np.ndarray, left: np.ndarray, sizes: np.ndarray, more: np.ndarray | None) -> np.ndarray:
    """A number per item, equal for items of one level whose first ``sizes`` left bytes (and ``more``) are equal."""
    key = _mixed(hashed + level.astype(np.uint64) * _MIX[1] + sizes.astype(np.uint64))
    if more is not None:
        key = _mixed(key + more.astype(np.uint64))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    a, b = order[1:][same], order[:-1][same]
    unlike = (left[a] != left[b]) & (np.arange(left.shape[1]) < sizes[a][:, None])
    clash = unlike.any() or (level[a] != level[b]).any() or (sizes[a] != sizes[b]).any() or (more is not None and (more[a] != more[b]).any())
    if clash:
        # Two items under one hash: compare the bytes themselves.
        shown = np.where(np.arange(left.shape[1]) < sizes[:, None], left, 0).astype(np.int64)
        columns = [level[:, None], sizes[:, None], shown] + ([more[:, None]] if more is not None else [])
        return np.unique(np.concatenate(columns, axis=1), axis=0, return_inverse=True)[1].ravel()
    group = np.empty(len(key), np.int64)
    group[order] = np.cumsum(np.r_[True, ~same]) - 1
    return group


def covered(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes that the given spans cover."""
    order = np.argsort(start, kind="stable")
    start, stop = start[order], np.maximum.accumulate(stop[order])
    new = np.r_[True, start[1:] > stop[:-1]]
    return start[new], stop[np.r_[np.flatnonzero(new)[1:] - 1, len(stop) - 1]]


class Ranges:
    """Where suffixes go: by the order of their first bytes, strings of very frequent beginnings by their hash."""

    def __init__(self, limits: np.ndarray, parts: int, hot: np.ndarray):
        self.limits, self.hot = limits, hot
        self.within = max(1, parts // (len(limits) + 1))
        self.parts = (len(limits) + 1) * self.within

    def dealt(self, items: Items, length: int) -> tuple[Items, np.ndarray]:
        """The items to sort and the range of each."""
        hot = np.isin(items.prefixes(), self.hot)
        if not hot.any():
            return items, self._by_prefix(items)
        rest, strings = items.take(np.flatnonzero(~hot)), items.strings(np.flatnonzero(hot), length)
        parts = np.concatenate([self._by_prefix(rest), (strings.hashes() % np.uint64(self.parts)).astype(np.int64)])
        return Items.joined([rest, strings]), parts

    def _by_prefix(self, items: Items) -> np.ndarray:
        prefixes = items.prefixes()
        found = np.searchsorted(self.limits, prefixes, "right") * self.within
        if self.within > 1:
            found += (_prefix_hashes(items.right) % np.uint64(self.within)).astype(np.int64)
        return found


def _spans(docs: np.ndarray, ties: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, ...]:
    """The given spans of bytes with those of a document that touch made one."""
    if not len(docs):
        return docs, ties, start, stop
    order = np.lexsort((start, ties, docs))
    docs, ties, start, stop = docs[order], ties[order], start[order], stop[order]
    text = np.cumsum(np.r_[True, (docs[1:] != docs[:-1]) | (ties[1:] != ties[:-1])]) << 32
    low, high = covered(text + start, text + stop)
    row = np.searchsorted(text + start, low, "left")
    return docs[row], ties[row], low - text[row], high - text[row]


_SPANS = "doc_id long, tie long, start long, stop long"


def _span_batch(*columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "tie", "start", "stop"])


def sorted_runs(batches: Iterable[pa.RecordBatch], ranges: Ranges, length: int, run_bytes: int, tied: bool) -> Iterator[pa.RecordBatch]:
    """(part, run, doc_id, tie, start, stop): front-coded runs per range, and spans that a run itself shows to be repeated.

    Of equal suffixes only those of the least document travel; the others repeat it.
    """
    for group in segments(batches, length, run_bytes):
        items, parts = ranges.dealt(Items.of(group, length), length)
        key = items.keys()
        order = np.argsort(key)
        rank = np.empty(len(order), np.int64)
        key = key[order]
        rank[order] = np.cumsum(np.r_[True, key[1:] != key[:-1]]) - 1
        del key
        least = _least_doc(rank, items.doc, rank.max() + 1)[rank]
        over = items.doc > least
        gone = _spans(items.doc[over], items.tie[over], (items.at - items.left_size)[over], (items.at + items.right_size)[over])
        order = np.lexsort((items.at, items.tie, rank, parts))
        order = order[~over[order]]
        items, rank, parts = items.take(order), rank[order], parts[order]
        new = np.flatnonzero(np.r_[True, (rank[1:] != rank[:-1]) | (items.tie[1:] != items.tie[:-1])])
        counts = np.diff(np.r_[new, len(rank)])
        first = np.flatnonzero(np.r_[True, parts[new][1:] != parts[new][:-1]])
        numbers, blobs = [], []
        for a, b in zip(first, np.r_[first[1:], len(new)], strict=True):
            some = items.take(new[a:b])
            places = items.at[new[a] : new[b] if b < len(new) else len(rank)]
            numbers.append(int(parts[new[a]]))
            blobs.append(packed(some, counts[a:b], some.doc, some.tie if tied else None, places))
        yield pa.RecordBatch.from_pydict({"part": pa.array(numbers, pa.int32()), "run": pa.array(blobs, pa.binary()), "spans": pa.nulls(len(blobs), pa.binary())})
        if len(gone[0]):
            spans = zstandard.ZstdCompressor(level=LEVEL).compress(np.stack(gone).tobytes())
            part = pa.array([group.docs[0] % ranges.parts], pa.int32())
            yield pa.RecordBatch.from_pydict({"part": part, "run": pa.nulls(1, pa.binary()), "spans": pa.array([spans], pa.binary())})


def merged_ranges(batches: Iterable[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Spans of repeated bytes, given all runs of the ranges of a task."""
    runs: dict[int, list[Run]] = {}
    for batch in batches:
        for part, run, spans in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if spans is not None:
                yield _span_batch(*np.frombuffer(zstandard.ZstdDecompressor().decompress(spans), np.int64).reshape(4, -1))
            else:
                runs.setdefault(part, []).append(Run(run, length))
    for part in list(runs):
        for columns in removed(runs.pop(part), length):
            yield _span_batch(*_spans(*columns))


def _sampled(batches: Iterable[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for group in segments(batches, length, RUN_BYTES):
        items = Items.of(group, length)
        prefixes = pa.array(items.prefixes().tolist(), pa.binary())
        yield pa.RecordBatch.from_arrays([prefixes, pa.array(items.hashes().view(np.int64))], ["prefix", "item"])


def place_ranges(texts: DataFrame, total: int, length: int, parts: int, range_items: int) -> Ranges:
    """Range limits and very frequent beginnings, from a sample of whole texts (``SAMPLE_BYTES``, and a 2000th of more)."""
    share = max(min(1.0, SAMPLE_BYTES / max(1, total)), 1 / 2000)
    some = texts.where(F.pmod(F.xxhash64(F.lit("sample"), "doc_id", "tie"), F.lit(1_000_000)) < int(share * 1_000_000) + 1)
    seen = some.mapInArrow(lambda batches: _sampled(batches, length), "prefix binary, item long")
    counts = seen.distinct().groupBy("prefix").agg(F.count("*").alias("n"), F.min(F.xxhash64("item")).alias("h"))
    scratch = Scratch(texts.sparkSession, "beginnings")
    counts = scratch.keep(counts, "counts")
    hot = counts.where(F.col("n") >= max(16, int(range_items / 4 * share))).select("prefix").collect()
    # Beginnings drawn by their hash, a bounded number of them.
    drawn = counts.orderBy("h").limit(DRAWN).select("prefix", "n").collect()
    scratch.drop(counts)
    drawn = sorted((bytes(r.prefix).ljust(PREFIX, b"\0"), r.n) for r in drawn)
    limits = []
    if drawn:
        weight = np.cumsum([n for _, n in drawn])
        wanted = min(parts, LIMITS, max(1, len(drawn) // 8))
        cuts = np.searchsorted(weight, weight[-1] * np.arange(1, wanted) / wanted)
        limits = sorted({drawn[i][0] for i in cuts})
    kind = f"S{PREFIX}"
    return Ranges(np.array(limits, kind), parts, np.array([bytes(r.prefix) for r in hot], kind))


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        ids, sizes, removed_bytes, spans_found, kept = [], [], [], [], []
        for doc, data, starts, stops in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            data = unpack(data)
            low, high = covered(np.array(starts or [], np.int64), np.array(stops or [], np.int64)) if starts else ([], [])
            edges = [0, *(x for pair in zip(low, high, strict=True) for x in pair), len(data)]
            left = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            ids.append(doc)
            sizes.append(len(data))
            removed_bytes.append(len(data) - len(left))
            spans_found.append(len(low))
            kept.append(left)
        columns = [pa.array(x, pa.int64()) for x in (ids, sizes, removed_bytes, spans_found)] + [pa.array(kept, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def _squeezed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=LEVEL).compress
    for batch in batches:
        texts = [pack((t or "").encode("utf-8", "surrogatepass")) for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.binary())], ["doc_id", "tie", "data"])


def repeated_spans(texts: DataFrame, length: int = LENGTH, run_bytes: int = RUN_BYTES, range_items: int = RANGE_ITEMS, tied: bool = False) -> DataFrame:
    """(doc_id, tie, start, stop): spans of UTF-8 bytes covered by strings that a document of smaller id holds too.

    ``texts`` holds (doc_id, tie, text) without NULLs. Spans may overlap.
    """
    spark = texts.sparkSession
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    density = 2 / (length - PREFIX + 2)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(total * density / range_items) + 1)
    ranges = place_ranges(texts, total, length, parts, range_items)
    runs = texts.mapInArrow(
        lambda batches: sorted_runs(batches, ranges, length, run_bytes, tied), "part int, run binary, spans binary"
    )
    return runs.repartitionById(ranges.parts, "part").mapInArrow(lambda batches: merged_ranges(batches, length), _SPANS)


def cut_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, run_bytes: int = RUN_BYTES, range_items: int = RANGE_ITEMS
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): every text without the bytes that it repeats from smaller documents.

    A byte goes if a string of ``length`` bytes covers it that also starts in
    a document with a smaller id; strings are judged on the texts as given and
    never reach over the end of one. ``kept`` is binary, as a cut may fall
    inside a character.

    Every string is represented by one suffix, which starts at the string's
    least-hashed 12 bytes; a suffix serves the consecutive strings that chose
    it and carries the bytes before it. Tasks sort the suffixes of about
    ``run_bytes`` of text, front-code them and deal them to ranges of the
    sorted order; a task per range merges its runs with a loser tree that
    knows the common prefixes and finds the strings that several documents
    hold among neighbours in that order. Of equal suffixes a run sends only
    those of its least document, so copies travel once a run. Suffixes of one
    beginning too frequent for a range are taken apart into their strings,
    which go to ranges by hash.

    NULL texts count as empty. Rows without doc_id keep their text and take
    none from others. Rows of one id never cut each other. An id's rows with
    different texts are told apart by a hash of the text. Other columns are
    left behind.
    """
    if length <= PREFIX:
        raise ValueError(f"strings need more than {PREFIX} bytes")
    narrow = pick(docs, doc_id=doc_id, text=text).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    hashed = narrow.select("doc_id", F.xxhash64("text").alias("tie"))
    shared = hashed.groupBy("doc_id").agg((F.min("tie") != F.max("tie")).alias("several")).agg(F.max("several")).first()[0]
    tied = bool(shared)
    texts = narrow.select("doc_id", (F.xxhash64("text") if tied else F.lit(0).cast("long")).alias("tie"), "text")
    spans = repeated_spans(texts.where("doc_id IS NOT NULL").where(F.octet_length("text") >= length), length, run_bytes, range_items, tied)
    of_doc = spans.groupBy("doc_id", "tie").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    of_doc = of_doc.select(F.col("doc_id").alias("of"), F.col("tie").alias("of_tie"), "spans")
    squeezed = texts.mapInArrow(_squeezed, "doc_id long, tie long, data binary")
    joined = squeezed.join(of_doc, (squeezed["doc_id"] == of_doc["of"]) & (squeezed["tie"] == of_doc["of_tie"]), "left")
    wanted = joined.select("doc_id", "data", F.col("spans.start").alias("start"), F.col("spans.stop").alias("stop"))
    return wanted.mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
