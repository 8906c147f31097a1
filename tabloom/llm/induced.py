"""External induced sorting of suffixes with common-prefix values.

Suffixes are sorted from the left-most S-type (LMS) ones, whose order comes from a recursion on
the string of their names. Two sweeps then induce the order of all others: a swept suffix yields
the one that starts a sign earlier, which enters a priority queue under its first sign. A queue
holds tuples (position, common prefix with the entry before it) as arrays in order of arrival, one
run per sign, and moves them to disk beyond a number of items. The positions, names and common prefixes
of LMS suffixes are arrays in memory, so memory grows with the text, which callers keep bounded.
Tuples are handled in batches, all of one sign and round at a time.
"""

from __future__ import annotations

import heapq
import os
import tempfile
from collections.abc import Callable, Iterator

import numpy as np

Visit = Callable[[np.ndarray, np.ndarray], None]
NONE = np.int64(1 << 40)


class RunQueue:
    """Priority queue of (position, lcp) batches by integer key; spills to a file."""

    def __init__(self, folder: str, memory: int, descending: bool = False) -> None:
        self.folder, self.memory, self.sign = folder, memory, -1 if descending else 1
        self.runs: dict[int, list] = {}
        self.heap: list[int] = []
        self.held = 0
        self.file = None

    def push(self, key: int, at: np.ndarray, lcp: np.ndarray) -> None:
        if key not in self.runs:
            self.runs[key] = []
            heapq.heappush(self.heap, self.sign * key)
        self.runs[key].append((at, lcp))
        self.held += len(at)
        if self.held > self.memory:
            self.spill()

    def spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile(dir=self.folder)
        self.file.seek(0, os.SEEK_END)
        for run in self.runs.values():
            for k, batch in enumerate(run):
                if len(batch) == 2:
                    place = self.file.tell()
                    self.file.write(batch[0].astype(np.int64).tobytes())
                    self.file.write(batch[1].astype(np.int64).tobytes())
                    run[k] = (place, len(batch[0]), None)
        self.held = 0

    def first(self) -> int | None:
        return self.sign * self.heap[0] if self.heap else None

    def pop(self, key: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The batches under a key, in order of arrival and put together up to an eighth of the
        memory; the key leaves the queue."""
        run = self.runs.pop(key)
        if self.heap[0] == self.sign * key:
            heapq.heappop(self.heap)
        else:
            self.heap.remove(self.sign * key)
            heapq.heapify(self.heap)
        ready: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in run:
            if len(batch) == 3:
                self.file.seek(batch[0])
                raw = np.frombuffer(self.file.read(16 * batch[1]), np.int64)
                batch = raw[: batch[1]], raw[batch[1] :]
            else:
                self.held -= len(batch[0])
            ready.append(batch)
            size += len(batch[0])
            if size >= self.memory // 8:
                yield tuple(map(np.concatenate, zip(*ready, strict=True)))
                ready, size = [], 0
        if ready:
            yield tuple(map(np.concatenate, zip(*ready, strict=True)))

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def s_types(text: np.ndarray, piece: int = 1 << 22) -> np.ndarray:
    """Whether each suffix is smaller than the next one; the last one counts as smaller."""
    out = np.ones(len(text), bool)
    for stop in range(len(text) - 1, 0, -piece):
        start = max(0, stop - piece)
        part = text[start : stop + 1].astype(np.int64)
        step = np.sign(part[1:] - part[:-1])
        where = np.where(step != 0, np.arange(len(step)), len(step))
        follow = np.minimum.accumulate(where[::-1])[::-1]
        known = follow < len(step)
        out[start:stop] = np.where(known, step[np.minimum(follow, len(step) - 1)] > 0, out[stop])
    return out


class Ranges:
    """Minima of ranges of an array."""

    def __init__(self, values: np.ndarray) -> None:
        self.rows = [values]
        while (1 << len(self.rows)) <= len(values):
            last, half = self.rows[-1], 1 << (len(self.rows) - 1)
            self.rows.append(np.minimum(last[:-half], last[half:]))

    def least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Minima of ``low`` to ``high``, both included."""
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        out = np.empty(len(low), self.rows[0].dtype)
        for k in np.unique(level):
            own = np.flatnonzero(level == k)
            row = self.rows[k]
            out[own] = np.minimum(row[low[own]], row[high[own] - (1 << int(k)) + 1])
        return out


class Sweep:
    """Takes suffixes in their order and pushes the ones that start a sign earlier."""

    def __init__(self, text: np.ndarray, small: np.ndarray, want: bool, queue: RunQueue, cap: int) -> None:
        self.text, self.small, self.want, self.queue, self.cap = text, small, want, queue, cap
        self.pending: dict[int, int] = {}
        self.lowest = NONE  # of all common prefixes since the last time that pending was brought up to date
        self.stamp: dict[int, int] = {}
        self.history: list[int] = []

    def take(self, at: np.ndarray, lcp: np.ndarray) -> None:
        step = max(1024, self.queue.memory // 8)
        for k in range(0, len(at), step):
            self._take(at[k : k + step], lcp[k : k + step])

    def _take(self, at: np.ndarray, lcp: np.ndarray) -> None:
        if not self.cap:  # order only
            before = at[at > 0] - 1
            before = before[self.small[before] == self.want]
            self._push(before, np.zeros(len(before), np.int64))
            return
        index = np.flatnonzero(at > 0)
        before = at[index] - 1
        own = self.small[before] == self.want
        index, before = index[own], before[own]
        signs = self.text[before]
        order = np.argsort(signs, kind="stable")
        index, before, signs = index[order], before[order], signs[order]
        head = np.ones(len(index), bool)
        head[1:] = signs[1:] != signs[:-1]
        table = Ranges(lcp)
        if len(index):
            low = np.zeros(len(index), np.int64)
            low[~head] = index[:-1][~head[1:]] + 1
            value = np.minimum(table.least(low, index) + 1, self.cap).astype(np.int64)
            heads = np.flatnonzero(head)
            for k in heads.tolist():
                waiting = self.pending.get(int(signs[k]))
                value[k] = 0 if waiting is None else min(value[k], waiting + 1, self.cap)
        least = int(lcp.min()) if len(lcp) else int(NONE)
        for sign in self.pending:
            self.pending[sign] = min(self.pending[sign], least)
        if len(index):
            stops = np.append(heads[1:], len(index))
            last = index[stops - 1]
            for sign, k in zip(signs[heads].tolist(), last.tolist(), strict=True):
                rest = lcp[k + 1 :]
                self.pending[int(sign)] = int(table.least(np.array([k + 1]), np.array([len(lcp) - 1]))[0]) if len(rest) else int(NONE)
            for a, b in zip(heads.tolist(), stops.tolist(), strict=True):
                self.queue.push(int(signs[a]), before[a:b], value[a:b])

    def _push(self, before: np.ndarray, lcp: np.ndarray) -> None:
        if not len(before):
            return
        signs = self.text[before]
        order = np.argsort(signs, kind="stable")
        before, signs = before[order], signs[order]
        heads = np.flatnonzero(np.append(True, signs[1:] != signs[:-1]))
        for a, b in zip(heads.tolist(), np.append(heads[1:], len(signs)).tolist(), strict=True):
            self.queue.push(int(signs[a]), before[a:b], lcp[a:b])


def run_length(text: np.ndarray, at: int, cap: int) -> int:
    """How often the sign at a position repeats from there, up to ``cap``."""
    part = text[at : at + max(cap, 1)]
    other = np.flatnonzero(part != part[0])
    return int(other[0]) if len(other) else len(part)


def induce(text: np.ndarray, small: np.ndarray, seeds: np.ndarray, seed_lcp: np.ndarray, cap: int, memory: int, folder: str, visit: Visit) -> None:
    """Visit all suffixes but the last one from the largest to the smallest, in batches with the
    common prefix (up to ``cap``) of each with the one visited before it.

    ``seeds`` are the LMS positions in order, ``seed_lcp`` their common prefixes."""
    larger, found = RunQueue(folder, memory), RunQueue(folder, memory, descending=True)
    sweep = Sweep(text, small, False, larger, cap)
    signs = text[seeds]
    heads = np.flatnonzero(np.append(True, signs[1:] != signs[:-1]))
    seeded = {int(signs[a]): (a, b) for a, b in zip(heads.tolist(), np.append(heads[1:], len(seeds)).tolist(), strict=True)}
    waiting = sorted(seeded, reverse=True)
    while waiting or larger.first() is not None:
        sign = min(x for x in (waiting[-1] if waiting else None, larger.first()) if x is not None)
        last = None
        while larger.first() == sign:
            for at, lcp in larger.pop(sign):
                found.push(sign, at, lcp)
                sweep.take(at, lcp)
                last = int(at[-1])
        if waiting and waiting[-1] == sign:
            a, b = seeded[waiting.pop()]
            lcp = seed_lcp[a:b].copy()
            lcp[0] = 0 if last is None else min(run_length(text, last, cap), run_length(text, int(seeds[a]), cap))
            sweep.take(seeds[a:b], lcp)
    smaller = RunQueue(folder, memory, descending=True)
    sweep = Sweep(text, small, True, smaller, cap)
    while found.first() is not None or smaller.first() is not None:
        sign = max(x for x in (found.first(), smaller.first()) if x is not None)
        last = None
        while smaller.first() == sign:
            for at, lcp in smaller.pop(sign):
                visit(at, lcp)
                sweep.take(at, lcp)
                last = int(at[-1])
        if found.first() == sign:
            for at, lcp in backwards(list(found.pop(sign))):
                if last is not None:
                    lcp[0] = min(run_length(text, last, cap), run_length(text, int(at[0]), cap))
                    last = None
                visit(at, lcp)
                sweep.take(at, lcp)
    for queue in (larger, found, smaller):
        queue.close()


def backwards(batches: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Batches in reverse; common prefixes then belong to the entry visited before."""
    carried = 0
    for at, lcp in reversed(batches):
        turned = np.empty(len(at), np.int64)
        turned[0] = carried
        turned[1:] = lcp[:0:-1]
        carried = int(lcp[0])
        yield at[::-1], turned


def lms_names(text: np.ndarray, small: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Ranks of the LMS substrings by signs and types, from 1; the last one is the smallest."""
    width = 2 * int(text.max()) + 2
    bits = max(1, int(width).bit_length())
    per = max(1, 63 // bits)
    stop = np.append(at[1:] + 1, at[-1] + 1)
    size = stop - at
    rank = np.zeros(len(at), np.int64)
    for k in range(int((size.max() - 1) // per), -1, -1):
        own = np.flatnonzero(size > k * per)
        column = np.zeros(len(own), np.int64)
        for j in range(per):
            place = at[own] + k * per + j
            inside = place < stop[own]
            place = np.minimum(place, len(text) - 1)
            value = np.where(inside, 2 * text[place].astype(np.int64) + small[place] + 1, 0)
            column = (column << bits) | value
        rank[own] = ranked(column, rank[own]) + 1
    return rank


def ranked(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Dense ranks, from 0, of the pairs."""
    order = np.lexsort((second, first)) if second.any() else np.argsort(first, kind="stable")
    a, b = first[order], second[order]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(np.append(0, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
    return rank


def doubled(names: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of a string that fits in memory, to ``depth`` signs at least."""
    _, rank = np.unique(names, return_inverse=True)
    step = 1
    order = np.argsort(rank, kind="stable")
    while step < depth and int(rank.max()) + 1 < len(names):
        pair = (rank.astype(np.int64) + 1) << 31
        pair[:-step] |= rank[step:] + 1
        order = np.argsort(pair, kind="stable")
        own = pair[order]
        rank = np.empty(len(names), np.int64)
        rank[order] = np.cumsum(np.append(0, own[1:] != own[:-1]))
        step *= 2
    return order


def ordered(text: np.ndarray, depth: int, memory: int, folder: str) -> np.ndarray:
    """Suffixes in order of their first ``depth`` signs at least; recursion beyond the memory."""
    if len(text) <= memory:
        return doubled(text, depth)
    small, at, order = lms_order(text, depth, memory, folder)
    parts: list[np.ndarray] = [np.array([len(text) - 1])]
    visited: list[np.ndarray] = []
    induce(text, small, at[order], np.zeros(len(at), np.int64), 0, memory, folder, lambda p, _: visited.append(p))
    return np.concatenate(parts + [v[::-1] for v in reversed(visited)])


def lms_order(text: np.ndarray, depth: int, memory: int, folder: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Types, LMS positions, and their order to ``depth`` signs at least. Every LMS substring is
    at least two signs longer than its overlap with the next, so half as many names suffice."""
    small = s_types(text)
    at = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    names = lms_names(text, small, at)
    if int(names.max()) == len(names):
        return small, at, np.argsort(names, kind="stable")
    return small, at, ordered(names, depth // 2 + 2, memory, folder)


def common_prefixes(text: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Lengths of the common prefixes of suffixes ``a`` and ``b``, up to ``cap``, eight at a time."""
    out = np.full(len(a), cap, np.int64)
    live, top = np.arange(len(a)), len(text) - 1
    for k in range(0, cap, 8):
        if not len(live):
            break
        equal = np.ones(len(live), bool)
        for j in range(k, min(k + 8, cap)):
            rest = np.flatnonzero(equal)
            p, q = a[live[rest]] + j, b[live[rest]] + j
            same = (text[np.minimum(p, top)] == text[np.minimum(q, top)]) & (p <= top) & (q <= top)
            out[live[rest[~same]]] = j
            equal[rest[~same]] = False
        live = live[equal]
    return out


def repeated(text: np.ndarray, length: int, memory: int = 1 << 23, folder: str | None = None) -> np.ndarray:
    """Whether the ``length`` signs from each position also start at another position.

    ``text`` ends with a 0 that occurs nowhere else. Its types and this answer take a byte a sign,
    the queues at most ``memory`` tuples each, beyond which they are on disk in ``folder``; LMS
    suffixes, at most half of all, take about a dozen eight-byte values each in memory."""
    out = np.zeros(len(text), bool)
    if len(text) < 2:
        return out
    small, at, order = lms_order(text, length, memory, folder)
    seeds = at[order]
    lcp = np.zeros(len(seeds), np.int64)
    lcp[1:] = common_prefixes(text, seeds[:-1], seeds[1:], length)
    last = -1

    def visit(place: np.ndarray, common: np.ndarray) -> None:
        nonlocal last
        hit = common >= length
        out[place[hit]] = True
        out[place[np.flatnonzero(hit[1:])]] = True
        if hit[0] and last >= 0:
            out[last] = True
        last = int(place[-1])

    induce(text, small, seeds, lcp, length, memory, folder, visit)
    return out
