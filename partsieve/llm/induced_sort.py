"""External induced sorting of the suffixes of many strings, with common-prefix values.

Suffixes are split into L (larger than their successor) and S types. The sorted leftmost S suffixes (LMS) induce all
L suffixes in one ascending sweep and these all S suffixes in one descending sweep: whoever leaves the priority queue
puts its predecessor in. Keys only grow during a sweep, so over bytes the queue is one disk-backed first-in-first-out
file a byte, whose blocks numpy handles whole; over the names of the recursion it is a heap that spills sorted runs.
A tuple carries its suffix and the length of the prefix it shares with the tuple before it under the same byte: one more
than the least such length between the two that induced them. LMS substrings are sorted by the same sweeps, named, and
the string of names is sorted by recursion, whose base case (a string of names that fits in memory) doubles prefixes.

Queues keep IN_MEMORY rows and spill the rest to unnamed scratch files of the task, which go when it ends and which
nothing else reads. Texts and flags beyond that size are memory-mapped files of the same kind.
"""

from __future__ import annotations

import heapq
import tempfile
from collections.abc import Iterator

import numpy as np

#: Rows of a queue, and bytes of an array, that stay in memory.
IN_MEMORY = 1 << 20
#: Rows handled at once.
BLOCK = 1 << 17
#: Names of the recursion's base case.
NAMES_IN_MEMORY = 1 << 22


def _array(n: int, dtype) -> np.ndarray:
    """Zeros, in a scratch file if they are many."""
    if n * np.dtype(dtype).itemsize <= 64 * IN_MEMORY:
        return np.zeros(n, dtype)
    return np.memmap(tempfile.TemporaryFile(), dtype, "w+", shape=(n,))


class Queue:
    """Rows (suffix, shared prefix) first in, first out; older rows on disk once there are many. Can be read backwards."""

    def __init__(self):
        self.blocks, self.held, self.file, self.read, self.end = [], 0, None, 0, 0

    def put(self, suffixes: np.ndarray, shared: np.ndarray) -> None:
        self.blocks.append(np.stack([suffixes, shared], 1).astype(np.int64))
        self.held += len(suffixes)
        if self.held > IN_MEMORY:
            self.file = self.file or tempfile.TemporaryFile()
            self.file.seek(self.end * 16)
            for b in self.blocks:
                self.file.write(b.tobytes())
            self.end += self.held
            self.blocks, self.held = [], 0

    def _stored(self, first: int, last: int) -> np.ndarray:
        self.file.seek(first * 16)
        return np.frombuffer(self.file.read((last - first) * 16), np.int64).reshape(-1, 2)

    def take(self) -> np.ndarray | None:
        """The oldest rows, BLOCK of them or all in memory."""
        if self.read < self.end:
            first, self.read = self.read, min(self.end, self.read + BLOCK)
            return self._stored(first, self.read)
        if not self.held:
            return None
        rows = self.blocks[0] if len(self.blocks) == 1 else np.concatenate(self.blocks)
        self.blocks, self.held = [], 0
        return rows

    def backwards(self) -> Iterator[np.ndarray]:
        """All rows, latest first, in blocks."""
        for b in reversed(self.blocks):
            yield b[::-1]
        for last in range(self.end, 0, -BLOCK):
            yield self._stored(max(0, last - BLOCK), last)[::-1]


class NameQueue:
    """The queue over names: a first-in-first-out list a name and a heap of the names; those of the largest names, which are needed last, go to disk when all hold too many rows."""

    def __init__(self):
        self.lists, self.names, self.held, self.file, self.stored = {}, [], 0, None, {}

    def put(self, name: int, i: int) -> None:
        own = self.lists.get(name)
        if own is None:
            if name not in self.stored:
                heapq.heappush(self.names, name)
            own = self.lists[name] = []
        own.append(i)
        self.held += 1
        if self.held > IN_MEMORY:
            self._spill()

    def _spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        for name in sorted(self.lists, reverse=True):
            if self.held <= IN_MEMORY // 2:
                break
            rows = np.array(self.lists.pop(name), np.int64)
            self.stored.setdefault(name, []).append((self.file.seek(0, 2), len(rows)))
            self.file.write(rows.tobytes())
            self.held -= len(rows)

    def least(self) -> int | None:
        """The least name that has rows."""
        while self.names and not (self.names[0] in self.lists or self.names[0] in self.stored):
            heapq.heappop(self.names)
        return self.names[0] if self.names else None

    def take(self, name: int) -> list[int]:
        """All rows of a name so far, oldest first; the name stays known while it is handled."""
        rows = []
        for at, n in self.stored.pop(name, ()):
            self.file.seek(at)
            rows += np.frombuffer(self.file.read(n * 8), np.int64).tolist()
        fresh = self.lists.pop(name, [])
        self.held -= len(fresh)
        return rows + fresh


def _types(t: np.ndarray) -> np.ndarray:
    """Whether each suffix is S type; the last symbol is the least of all."""
    s, after = _array(len(t), bool), True
    s[-1] = True
    for last in range(len(t) - 1, 0, -BLOCK):
        first = max(0, last - BLOCK)
        a, b = t[first:last], t[first + 1 : last + 1]
        differ = np.flatnonzero(a != b)
        at = np.searchsorted(differ, np.arange(len(a)))
        rises = np.append((a < b)[differ], after)
        s[first:last] = rises[at]
        after = bool(s[first])
    return s


def _lms(s: np.ndarray) -> np.ndarray:
    return np.flatnonzero(s[1:] & ~s[:-1]) + 1


def _ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of keys; for each sorted place, where its run of equal keys starts; whether it is alone."""
    order = np.argsort(keys, kind="stable")
    new = np.ones(len(keys) + 1, bool)
    new[1:-1] = np.diff(keys[order]) != 0
    start = np.maximum.accumulate(np.where(new[:-1], np.arange(len(keys)), 0))
    return order, start, new[:-1] & new[1:]


def _sort_in_memory(names: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; only places that still share their rank are looked at again."""
    n, h = len(names), 1
    order, start, alone = _ranked(names)
    rank = np.empty(n, np.int64)
    rank[order] = start
    live = np.sort(order[~alone])
    while len(live):
        old = rank[live]
        after = np.where(live + h < n, rank[np.minimum(live + h, n - 1)] + 1, 0)
        order, start, alone = _ranked(old * (n + 1) + after)
        s = old[order]
        first = np.ones(len(s), bool)
        first[1:] = s[1:] != s[:-1]
        rank[live[order]] = s + start - np.maximum.accumulate(np.where(first, np.arange(len(s)), 0))
        live, h = np.sort(live[order[~alone]]), h * 2
    out = np.empty(n, np.int64)
    out[rank] = np.arange(n)
    return out


def sort_names(names: np.ndarray) -> np.ndarray:
    """Suffix array of numbers whose last is the only least one."""
    if len(names) <= NAMES_IN_MEMORY:
        return _sort_in_memory(names)
    s = _types(names)
    lms = _lms(s)
    t, small = names.tolist(), s.tolist()
    by_piece = [i for i in _sweeps(t, small, lms.tolist()) if i and small[i] and not small[i - 1]]
    ends = dict(zip(lms[:-1].tolist(), (lms[1:] + 1).tolist(), strict=True))
    named, name, last = {}, -1, None
    for i in by_piece:
        piece = t[i : ends[i]] if i in ends else None
        name += piece is None or piece != last
        named[i], last = name, piece
    reduced = np.array([named[i] for i in lms.tolist()])
    return np.array(_sweeps(t, small, lms[sort_names(reduced)].tolist()))


def _sweep_names(t: list[int], small: list[bool], first: list[int], want: bool) -> list[int]:
    """One sweep: first is in order; whoever leaves the queue puts its predecessor in if that has the wanted type (small or
    not). What the queue holds under a name comes before what first holds under it. Returns what left the queue, in order."""
    queue, out, at, n = NameQueue(), [], 0, len(first)
    sign = -1 if want else 1
    while True:
        name = queue.least()
        if at < n and (name is None or sign * t[first[at]] < name):
            name = sign * t[first[at]]
        if name is None:
            return out
        while rows := queue.take(name):
            out += rows
            for i in rows:
                if i and small[i - 1] is want:
                    queue.put(sign * t[i - 1], i - 1)
        while at < n and sign * t[first[at]] == name:
            i = first[at]
            at += 1
            if i and small[i - 1] is want:
                queue.put(sign * t[i - 1], i - 1)


def _sweeps(t: list[int], small: list[bool], seeds: list[int]) -> list[int]:
    """All suffixes in the order that the order of seeds (LMS suffixes) induces."""
    last = len(t) - 1
    seeds = [last, *sorted((i for i in seeds if i != last), key=t.__getitem__)]
    large = _sweep_names(t, small, seeds, want=False)
    down = _sweep_names(t, small, large[::-1], want=True)
    # both lists are ordered; under one name L suffixes come first
    both = np.array(large + [last, *down[::-1]], np.int64)
    names = np.asarray(t, np.int64)[both]
    return both[np.argsort(names, kind="stable")].tolist()


class SuffixSorter:
    """Suffixes of several non-empty byte strings, in order, with shared prefixes up to a cap; prefixes end with their string."""

    def __init__(self, strings: list[bytes], cap: int):
        self.cap = cap
        lengths = np.array([len(x) for x in strings], np.int64)
        self.ends = np.cumsum(lengths + 1) - 1  # where each string's separator stands
        self.n = int(self.ends[-1]) + 1
        self.bytes = _array(self.n + 8, np.uint8)
        self.t = _array(self.n, np.int16)
        for x, e in zip(strings, self.ends.tolist(), strict=True):
            self.bytes[e - len(x) : e] = np.frombuffer(x, np.uint8)
            self.t[e - len(x) : e] = self.bytes[e - len(x) : e].astype(np.int16) + 1
        # separators are 0 in t; the later one is the lesser
        self.small = _types(self.t)
        self.lms = _lms(self.small)

    def _end(self, at: np.ndarray) -> np.ndarray:
        return self.ends[np.searchsorted(self.ends, at)]

    def shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of suffixes, up to the cap, eight bytes a step."""
        most = np.minimum(np.minimum(self._end(a) - a, self._end(b) - b), self.cap)
        out, live = most.copy(), np.arange(len(a))
        words = np.lib.stride_tricks.as_strided(self.bytes[: self.n + 7].view(), (self.n, 8), (1, 1))
        for k in range(0, self.cap, 8):
            live = live[most[live] > k]
            if not len(live):
                break
            differ = words[a[live] + k] != words[b[live] + k]
            apart = differ.any(1)
            out[live[apart]] = np.minimum(most[live[apart]], k + differ[apart].argmax(1))
            live = live[~apart]
        return out

    def _names(self, order: np.ndarray) -> np.ndarray:
        """Names of the LMS substrings, in text order, from the LMS suffixes in the order of their substrings."""
        upto = np.append(self.lms[1:], self.n - 1)
        place = np.searchsorted(self.lms, order)
        length = upto[place] - order + 1
        a, b = order[:-1], order[1:]
        same = (length[:-1] == length[1:]) & (self.t[upto[place][:-1]] > 0) & (self.t[upto[place][1:]] > 0)
        live, k = np.flatnonzero(same), 0
        while len(live):
            equal = self.t[a[live] + k] == self.t[b[live] + k]
            same[live[~equal]] = False
            k += 1
            live = live[equal]
            live = live[length[live] > k]
        names = np.empty(len(order), np.int64)
        names[place] = np.append(0, np.cumsum(~same))
        return names

    def _seeds(self) -> np.ndarray:
        """The LMS suffixes in order."""
        separators = self.ends[::-1]
        inner = self.lms[self.t[self.lms] > 0]
        first = np.concatenate([separators, inner[np.argsort(self.t[inner], kind="stable")]])
        pieces = [separators]
        for _, rows, _ in self._sweep(first, np.zeros(len(first), np.int64), small_only=True):
            at = rows[::-1, 0]
            pieces.append(at[~self.small[at - 1] & (at > 0)])
        order = np.concatenate(pieces[:1] + pieces[:0:-1])
        return self.lms[sort_names(self._names(order))]

    def _feed(self, rows: np.ndarray, queues: list[Queue], run: np.ndarray, small: bool) -> None:
        """The predecessors of rows that are of the type go to the queues of their bytes."""
        at, shared = rows[:, 0], np.append(rows[:, 1], self.cap)
        before = np.maximum(at - 1, 0)
        symbol = np.where((at > 0) & (self.small[before] == small), self.t[before], 0)
        order = np.argsort(symbol, kind="stable")
        sorted_symbols = symbol[order]
        run_now = np.minimum(run, shared[:-1].min(initial=self.cap))
        bounds = np.flatnonzero(np.diff(sorted_symbols, prepend=-1))
        for lo, hi in zip(bounds.tolist(), [*bounds[1:].tolist(), len(order)], strict=True):
            c = int(sorted_symbols[lo])
            if not c:
                continue
            idx = order[lo:hi]
            span = np.empty(2 * len(idx), np.int64)
            span[0], span[2::2], span[1::2] = 0, idx[:-1] + 1, idx + 1
            least = np.minimum.reduceat(shared, span)[::2]
            least[0] = min(least[0], run[c])
            queues[c].put(before[idx], np.minimum(least + 1, self.cap))
            run_now[c] = shared[idx[-1] + 1 :].min()
        run[:] = run_now

    def _run_length(self, at: int) -> int:
        """How often the first byte of a suffix repeats at its start, up to the cap."""
        piece = self.t[at : at + self.cap]
        other = np.flatnonzero(piece != piece[0])
        return int(other[0]) if len(other) else len(piece)

    def _seam(self, large: int, small: int) -> int:
        """The prefix that the last L and the first S suffix of a byte share: the shorter run of that byte."""
        return min(self._run_length(large), self._run_length(small))

    def _sweep(self, seeds: np.ndarray, shared: np.ndarray, small_only: bool = False) -> Iterator[tuple[str, np.ndarray, int]]:
        """Induces all suffixes from the sorted LMS suffixes; yields (kind, rows, seam): per byte, from the last to the
        first, its S suffixes descending and its L suffixes ascending, each with the prefix shared with the row before."""
        symbols = self.t[seeds]
        first = np.searchsorted(symbols, np.arange(258))
        queues, run, large = [Queue() for _ in range(257)], np.full(257, -1, np.int64), [Queue() for _ in range(257)]
        last: list[int] = [-1] * 257
        rows = np.stack([seeds[: first[1]], np.zeros(first[1], np.int64)], 1)
        self._feed(rows, queues, run, small=False)
        for c in range(1, 257):
            while (rows := queues[c].take()) is not None:
                large[c].put(rows[:, 0], rows[:, 1])
                last[c] = int(rows[-1, 0])
                self._feed(rows, queues, run, small=False)
            if first[c] < first[c + 1]:
                rows = np.stack([seeds[first[c] : first[c + 1]], shared[first[c] : first[c + 1]]], 1).astype(np.int64)
                rows[0, 1] = self._seam(last[c], int(rows[0, 0])) if last[c] >= 0 else 0
                self._feed(rows, queues, run, small=False)
        queues, run = [Queue() for _ in range(257)], np.full(257, -1, np.int64)
        for c in range(256, 0, -1):
            least = -1
            while (rows := queues[c].take()) is not None:
                self._feed(rows, queues, run, small=True)
                least = int(rows[-1, 0])
                yield "small", rows, c
            seam, carried = self._seam(last[c], least) if least >= 0 and last[c] >= 0 else 0, None
            if least >= 0 and last[c] >= 0 and not small_only:
                yield "seam", np.array([[least, 0], [last[c], seam]]), c
            carried = seam
            for rows in large[c].backwards():
                # going down, the prefix shared with the row before is what the row before shared with this one
                down = np.stack([rows[:, 0], np.append(carried, rows[:-1, 1])], 1)
                carried = rows[-1, 1]
                self._feed(down, queues, run, small=True)
                if not small_only:
                    yield "large", down, c

    def repeated(self) -> np.ndarray:
        """For each place of the text laid end to end, whether its suffix shares cap bytes with another one."""
        seeds = self._seeds()
        shared = np.append(0, self.shared(seeds[:-1], seeds[1:])) if len(seeds) else np.zeros(0, np.int64)
        out = _array(self.n, bool)
        before = {}
        for kind, rows, c in self._sweep(seeds, shared):
            at, common = rows[:, 0], rows[:, 1]
            hit = common >= self.cap
            out[at[hit]] = True
            out[at[:-1][hit[1:]]] = True
            if hit[0] and (kind, c) in before:
                out[before[kind, c]] = True
            before = {(kind, c): at[-1], **({k: v for k, v in before.items() if k[1] == c})}
            before[kind, c] = at[-1]
        return out
