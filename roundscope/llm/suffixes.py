"""Suffixes of one shard in order, with common-prefix lengths, by external induced sorting.

The text is cut at its leftmost-S suffixes (S*). Their substrings are ordered by one round of induction and named;
the string of names is solved by the same means, or directly once it fits into memory; a second round of induction
then orders all suffixes. Both rounds scan suffixes in order and hand each on to its predecessor through disk-backed
priority queues. A queue's entries hold a position and its common-prefix length with the entry before it in the
same first symbol; since a scan hands on in order, entries of one symbol leave as they came. Entries beyond the
memory bound wait in files of the task's scratch folder.

Common-prefix lengths are carried through the induction: two neighbours in a symbol's bucket share one symbol more
than the least length between the two suffixes that induced them. Lengths are counted up to a cap, and suffixes alike
up to the cap may stand in any order.
"""

from __future__ import annotations

import itertools
import os
import sys
from collections.abc import Iterator

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ENTRY = np.dtype([("pos", "<i8"), ("lcp", "<i4")])
CHUNK = 1 << 14
_LOG2 = np.r_[0, np.frexp(np.arange(1, CHUNK + 1))[1] - 1].astype(np.int64)
#: Entries that a queue keeps in memory, and symbols that are solved there.
MEMORY = 4_000_000


class BucketQueue:
    """Entries by symbol, first in first out; past ``memory`` entries they wait in files."""

    def __init__(self, folder: str, memory: int):
        self.folder, self.memory, self.held = folder, memory, 0
        self.slots: dict[int, list] = {}
        self.files = itertools.count()

    def push(self, symbols: np.ndarray, pos: np.ndarray, lcp: np.ndarray) -> None:
        """Add entries whose symbols are ascending."""
        if not len(symbols):
            return
        entries = np.empty(len(pos), ENTRY)
        entries["pos"], entries["lcp"] = pos, lcp
        cuts = np.flatnonzero(symbols[1:] != symbols[:-1]) + 1
        starts = np.r_[0, cuts]
        for symbol, a, b in zip(symbols[starts].tolist(), starts.tolist(), np.r_[cuts, len(symbols)].tolist()):
            self.slots.setdefault(symbol, []).append(entries[a:b])
        self.held += len(pos)
        if self.held > self.memory:
            self._spill()

    def _spill(self) -> None:
        path = os.path.join(self.folder, f"{id(self)}-{next(self.files)}")
        at = 0
        with open(path, "wb") as file:
            for parts in self.slots.values():
                for i, part in enumerate(parts):
                    if isinstance(part, np.ndarray):
                        part.tofile(file)
                        parts[i] = (path, at, len(part))
                        at += len(part)
        self.held = 0

    def read(self, symbol: int, remove: bool = True) -> np.ndarray:
        parts = self.slots.pop(symbol, []) if remove else self.slots.get(symbol, [])
        if remove:
            self.held -= sum(len(p) for p in parts if isinstance(p, np.ndarray))
        found = [p if isinstance(p, np.ndarray) else np.fromfile(p[0], ENTRY, p[2], offset=p[1] * ENTRY.itemsize) for p in parts]
        return np.concatenate(found) if found else np.empty(0, ENTRY)


class Scan:
    """Range minima along a scan of common-prefix lengths.

    ``ends`` and ``lows`` tell the minimum from any past place to now: it is ``lows[k]`` for places up to ``ends[k]``.
    """

    def __init__(self, symbols: int):
        self.last = np.full(symbols, -1, dtype=np.int64)
        self.now = 0
        self.ends, self.lows = np.empty(0, np.int64), np.empty(0, np.int64)

    def induced(self, lcp: np.ndarray, where: np.ndarray, symbols: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
        """For a scanned chunk: the order of its induced entries by symbol, and their common-prefix lengths.

        ``lcp`` are those of the chunk, each to the suffix scanned before it; ``where`` are the places in the chunk
        that induce an entry, and ``symbols`` the entries' first symbols.
        """
        n = len(lcp)
        if len(self.last) <= 1 << 16:
            symbols = symbols.astype(np.uint16)  # sorted by counting
        order = np.argsort(symbols, kind="stable")
        s, at = symbols[order], where[order]
        first = np.r_[True, s[1:] != s[:-1]]
        before = np.where(first, self.last[s], np.r_[0, at[:-1]] + self.now)
        levels = n.bit_length()
        table = np.empty((levels, n), dtype=lcp.dtype)
        table[0] = lcp
        for k in range(1, levels):
            half = 1 << (k - 1)
            np.minimum(table[k - 1, : n - 2 * half + 1], table[k - 1, half : n - half + 1], out=table[k, : n - 2 * half + 1])
        begin = np.maximum(before + 1 - self.now, 0)
        level = _LOG2[at - begin + 1]
        low = np.minimum(table[level, begin], table[level, at - (1 << level) + 1]).astype(np.int64)
        old = (before >= 0) & (before + 1 < self.now)
        if old.any():
            low[old] = np.minimum(low[old], self.lows[np.searchsorted(self.ends, before[old] + 1)])
        out = np.where(before < 0, 0, np.minimum(low + 1, cap))
        self.last[s] = at + self.now  # of repeated symbols the last place stays, since places ascend
        lows = np.minimum.accumulate(lcp[::-1])[::-1]
        change = np.r_[np.flatnonzero(lows[1:] != lows[:-1]), n - 1]
        stay = self.lows < lows[0]
        self.ends = np.r_[self.ends[stay], change + self.now]
        self.lows = np.r_[self.lows[stay], lows[change]]
        self.now += n
        return order, out

    def passed(self, lcp: np.ndarray) -> None:
        self.induced(lcp, np.empty(0, np.int64), np.empty(0, np.int64), 0)


def _run(text: np.ndarray, at: int, cap: int) -> int:
    """How often the symbol at a place is repeated from there, up to the cap."""
    part = text[at : at + cap]
    other = np.flatnonzero(part != part[0])
    return int(other[0]) if len(other) else len(part)


def _seam(text: np.ndarray, a: int, b: int, cap: int) -> int:
    """Common prefix of an L and an S suffix of one first symbol: the shorter of their runs."""
    return min(_run(text, a, cap), _run(text, b, cap), cap)


class Sorter:
    """Induction over one text: unsigned symbols, of which the last is 0 and the only 0."""

    def __init__(self, text: np.ndarray, cap: int, folder: str, memory: int):
        self.text, self.cap, self.folder, self.memory = text, cap, folder, memory
        n = len(text)
        step = np.sign(text[1:].astype(np.int64) - text[:-1]).astype(np.int8)
        # A place equal to its right neighbour has that one's type; the last difference before the end decides.
        place = np.where(step != 0, np.arange(n - 1), n)
        place = np.minimum.accumulate(place[::-1])[::-1]
        self.is_s = np.r_[step[np.minimum(place, n - 2)] > 0, True] if n > 1 else np.ones(1, dtype=bool)
        self.star = np.flatnonzero(self.is_s[1:] & ~self.is_s[:-1]) + 1
        if not len(self.star):
            self.star = np.array([n - 1])
        self.alphabet = np.unique(text).tolist()

    def _hand_on(self, scan: Scan, queue: BucketQueue, pos: np.ndarray, lcp: np.ndarray, to_s: bool) -> None:
        """Scan suffixes in order and queue those predecessors that are of the wanted type."""
        for a in range(0, len(pos), CHUNK):
            p, l = pos[a : a + CHUNK], lcp[a : a + CHUNK].astype(np.int32)
            before = p - 1
            where = np.flatnonzero((before >= 0) & (self.is_s[before] == to_s))
            symbols = self.text[before[where]].astype(np.int64)
            order, lengths = scan.induced(l, where, symbols, self.cap)
            queue.push(symbols[order], before[where][order], lengths)

    def induce(self, seeds: np.ndarray, seed_lcp: np.ndarray) -> tuple[BucketQueue, BucketQueue]:
        """All L suffixes ascending and all S suffixes descending, by symbol, from ordered S* seeds."""
        stores = [BucketQueue(self.folder, self.memory) for _ in range(4)]
        queue, larger, back, smaller = stores
        size = int(self.alphabet[-1]) + 1
        bounds = np.searchsorted(self.text[seeds], self.alphabet, side="left").tolist() + [len(seeds)]
        scan = Scan(size)
        for k, c in enumerate(self.alphabet):
            previous = -1
            while len(found := queue.read(c)):
                larger.push(np.full(len(found), c), found["pos"], found["lcp"])
                self._hand_on(scan, queue, found["pos"], found["lcp"], to_s=False)
                previous = int(found["pos"][-1])
            pos, lcp = seeds[bounds[k] : bounds[k + 1]], seed_lcp[bounds[k] : bounds[k + 1]].copy()
            if len(pos):
                lcp[0] = _seam(self.text, previous, int(pos[0]), self.cap) if previous >= 0 else 0
                self._hand_on(scan, queue, pos, lcp, to_s=False)
        scan = Scan(size)
        for c in reversed(self.alphabet):
            previous = -1
            while len(found := back.read(c)):
                smaller.push(np.full(len(found), c), found["pos"], found["lcp"])
                self._hand_on(scan, back, found["pos"], found["lcp"], to_s=True)
                previous = int(found["pos"][-1])
            found = larger.read(c, remove=False)
            if len(found):
                lcp = np.r_[found["lcp"][:0], found["lcp"][1:], np.int32(0)][::-1].copy()
                lcp[0] = _seam(self.text, int(found["pos"][-1]), previous, self.cap) if previous >= 0 else 0
                self._hand_on(scan, back, found["pos"][::-1], lcp, to_s=True)
        smaller.push(np.zeros(1, np.int64), np.array([len(self.text) - 1]), np.zeros(1, np.int64))
        return larger, smaller

    def merged(self, larger: BucketQueue, smaller: BucketQueue) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(positions, common-prefix lengths with the suffix before) of all suffixes, ascending, bucket by bucket."""
        for c in self.alphabet:
            low, high = larger.read(c), smaller.read(c)[::-1]
            if len(low):
                lcp = low["lcp"].astype(np.int64)
                lcp[0] = 0
                yield low["pos"], lcp
            if len(high):
                seam = _seam(self.text, int(low["pos"][-1]), int(high["pos"][0]), self.cap) if len(low) else 0
                yield high["pos"], np.r_[seam, high["lcp"][:-1].astype(np.int64)]

    def _ordered_stars(self) -> tuple[np.ndarray, np.ndarray]:
        """S* positions in the order of their substrings, and whether each equals the one before."""
        by_symbol = self.star[np.argsort(self.text[self.star], kind="stable")]
        stars = np.zeros(len(self.text), dtype=bool)
        stars[self.star] = True
        found, shared, low = [], [], np.int64(0)
        for pos, lcp in self.merged(*self.induce(by_symbol, np.ones(len(by_symbol), dtype=np.int64))):
            mine = np.flatnonzero(stars[pos])
            if len(mine):
                least = np.minimum.reduceat(lcp[: mine[-1] + 1], np.r_[0, mine[:-1] + 1])
                least[0] = min(low, least[0])
                found.append(pos[mine])
                shared.append(least)
            rest = lcp[mine[-1] + 1 :] if len(mine) else lcp
            low = min(low if not len(mine) else np.int64(self.cap), rest.min() if len(rest) else np.int64(self.cap))
        order, lcp = np.concatenate(found), np.concatenate(shared)
        number = np.searchsorted(self.star, order)
        length = np.r_[self.star[1:], self.star[-1]][number] - order + 1
        same = np.r_[False, (length[1:] == length[:-1]) & (lcp[1:] >= np.minimum(length[1:], self.cap))]
        return number, same

    def suffixes(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        number, same = self._ordered_stars()
        names = np.empty(len(number), dtype=np.int64)
        names[number] = np.cumsum(~same) - 1
        order, lcp = ordered_names(names, self.cap // 2 + 1, self.folder, self.memory)
        a, b = self.star[order[1:]], self.star[order[:-1]]
        have = np.minimum(self.star[order[1:] + lcp[1:]] - a, self.cap)
        active = np.flatnonzero(have < self.cap)
        while len(active):
            alike = self.text[a[active] + have[active]] == self.text[b[active] + have[active]]
            have[active] += alike
            active = active[alike & (have[active] < self.cap)]
        yield from self.merged(*self.induce(self.star[order], np.r_[0, have]))


def ordered_names(names: np.ndarray, depth: int, folder: str, memory: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes of a string of names, and their common-prefix lengths, both up to ``depth`` names."""
    if len(names) > memory and names.max() + 1 < len(names):
        parts = list(Sorter(names.astype(np.uint32), depth, folder, memory).suffixes())
        return np.concatenate([p for p, _ in parts]), np.concatenate([l for _, l in parts])
    # A rank is the number of suffixes that are smaller as far as compared; only those alike are compared further.
    n, span = len(names), 1
    smaller = np.r_[0, np.cumsum(np.bincount(names))]
    rank = smaller[names]
    ranks, open_ = [rank], np.flatnonzero((smaller[names + 1] - rank) > 1)
    while span < depth and len(open_):
        after = np.where(open_ + span < n, rank[np.minimum(open_ + span, n - 1)] + 1, 0)
        key = rank[open_] * (n + 1) + after
        order = np.argsort(key, kind="stable")
        open_, key = open_[order], key[order]
        group = rank[open_]
        place = np.arange(len(open_))
        old = np.maximum.accumulate(np.where(np.r_[True, group[1:] != group[:-1]], place, 0))
        new = np.maximum.accumulate(np.where(np.r_[True, key[1:] != key[:-1]], place, 0))
        rank = rank.copy()
        rank[open_] = group + new - old
        ranks.append(rank)
        shared = np.r_[key[1:] == key[:-1], False]
        open_ = np.sort(open_[shared | np.r_[False, shared[:-1]]])
        span *= 2
    order = np.argsort(rank, kind="stable")
    a, b, lcp = order[1:], order[:-1], np.zeros(max(0, n - 1), dtype=np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        fits = np.maximum(a, b) + lcp < n
        alike = np.zeros(n - 1, dtype=bool)
        alike[fits] = ranks[k][a[fits] + lcp[fits]] == ranks[k][b[fits] + lcp[fits]]
        lcp += alike.astype(np.int64) << k
    return order, np.r_[0, lcp][:n]


def sorted_suffixes(text: np.ndarray, cap: int, folder: str, memory: int = MEMORY) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, common-prefix lengths) of the suffixes of ``text``, ascending; the last symbol is the only 0."""
    return Sorter(text, cap, folder, memory).suffixes()


def repeated_starts(parts: list[bytes], width: int, folder: str, memory: int = MEMORY) -> list[np.ndarray]:
    """For each part, which of its places start ``width`` bytes that also start at another place of any part."""
    lengths = np.array([len(p) for p in parts], dtype=np.int64)
    text = np.ones(int(lengths.sum()) + len(parts) + 1, dtype=np.uint16)
    begins = np.cumsum(np.r_[0, lengths + 1])[:-1]
    for a, p in zip(begins.tolist(), parts):
        text[a : a + len(p)] = np.frombuffer(p, dtype=np.uint8).astype(np.uint16) + 2
    text[-1] = 0
    marked, previous = np.zeros(len(text), dtype=bool), 0
    for pos, lcp in sorted_suffixes(text, width, folder, memory):
        hit = lcp >= width
        marked[pos[hit]] = True
        marked[np.r_[previous, pos[:-1]][hit]] = True
        previous = pos[-1]
    return [marked[a : a + max(0, n - width + 1)] for a, n in zip(begins.tolist(), lengths.tolist())]
