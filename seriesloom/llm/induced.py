"""Suffix and common-prefix arrays by external induced sorting, vectorised.

The suffixes that begin a rising stretch (LMS suffixes) are named by their
substrings, the string of names is sorted recursively, and the order of all other
suffixes is induced from theirs: scanning the sorted suffixes, the one before each
is pushed to the queue of its first symbol.  A push carries the suffix and its
common prefix with the previous push to that queue: one more than the smallest
common prefix scanned in between.

Pushes reach a queue in sorted order, so the priority queue over (symbol, rank) is
a first-in-first-out run per symbol.  Beyond ``memory`` bytes the runs move to an
unnamed file of the task, which goes with it; they are read back symbol by symbol.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

from .text import Prefix

_FAR = 1 << 30


class Runs:
    """Queues of (suffix, common prefix) pairs, one per symbol, on disk beyond ``memory`` bytes."""

    def __init__(self, memory: int):
        self.memory, self.held = memory, 0
        self.runs: dict[int, list] = {}
        self.file = None

    def push(self, symbol: int, suffix: np.ndarray, lcp: np.ndarray) -> None:
        self.runs.setdefault(symbol, []).append((suffix, lcp))
        self.held += suffix.nbytes + lcp.nbytes
        if self.held > self.memory:
            self.spill()

    def spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for symbol, parts in self.runs.items():
            for i, part in enumerate(parts):
                if isinstance(part[0], np.ndarray):
                    at = self.file.tell()
                    self.file.write(part[0].tobytes())
                    self.file.write(part[1].tobytes())
                    parts[i] = (at, len(part[0]))
        self.held = 0

    def pop(self, symbol: int) -> tuple[np.ndarray, np.ndarray]:
        """Everything pushed to ``symbol`` since it was last popped, in order."""
        parts = []
        for a, b in self.runs.pop(symbol, []):
            if isinstance(a, np.ndarray):
                self.held -= a.nbytes + b.nbytes
            else:
                self.file.seek(a)
                both = np.frombuffer(self.file.read(8 * b), np.int32)
                a, b = both[:b], both[b:]
            parts.append((a, b))
        if not parts:
            return np.empty(0, np.int32), np.empty(0, np.int32)
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def range_min(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """min(values[lo .. hi]) for arrays of inclusive bounds, by a table of minima over powers of two."""
    power = np.frexp((hi - lo + 1).astype(np.float64))[1] - 1
    out = np.empty(len(lo), values.dtype)
    level = values
    for k in range(int(power.max()) + 1 if len(power) else 0):
        if k:
            half = 1 << (k - 1)
            level = np.minimum(level[:-half], level[half:])
        at = np.flatnonzero(power == k)
        out[at] = np.minimum(level[lo[at]], level[hi[at] - (1 << k) + 1])
    return out


class Shard:
    """A string of symbols that ends with its only 0."""

    def __init__(self, symbols: np.ndarray):
        self.t = symbols
        n = len(symbols)
        wide = symbols.astype(np.int32)
        # The end of the run of equal symbols that holds each position decides its type.
        change = np.flatnonzero(np.append(wide[1:] != wide[:-1], True))
        end = np.repeat(change, np.diff(np.insert(change, 0, -1)))
        self.run = (end - np.arange(n) + 1).astype(np.int32)
        self.rising = np.ones(n, bool)
        inner = end < n - 1
        self.rising[inner] = wide[end[inner] + 1] > wide[end[inner]]
        self.lms = np.flatnonzero(self.rising[1:] & ~self.rising[:-1]).astype(np.int32) + 1

    def induce(self, seeds: np.ndarray, lcp: np.ndarray | None, memory: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All suffixes in descending order, each with its common prefix with the one before, from sorted LMS ``seeds``.

        Without ``lcp`` the common prefixes are not followed (all 0).
        """
        t, follow = self.t, lcp is not None
        symbols = int(t.max()) + 1
        queues, falling = Runs(memory), Runs(memory)
        first = t[seeds]
        cuts = np.searchsorted(first, np.arange(symbols + 1))  # seeds come sorted by first symbol
        pending = np.full(symbols, -1, np.int64)

        def push(batch: np.ndarray, prefix: np.ndarray, rising: bool) -> None:
            before = batch - 1
            at = np.flatnonzero((batch > 0) & (self.rising[before] == rising))
            target = t[before[at]]
            order = np.argsort(target, kind="stable")
            at, target = at[order], target[order]
            edge = np.flatnonzero(np.append(True, target[1:] != target[:-1])) if len(at) else np.empty(0, np.int64)
            ends = np.append(edge[1:], len(at))
            if follow:
                lo = np.insert(at[:-1] + 1, 0, 0) if len(at) else at
                lo[edge] = 0
                low = range_min(prefix, lo, at).astype(np.int64)
                low[edge] = np.minimum(low[edge], pending[target[edge]])
                value = (low + 1).astype(np.int32)
                np.minimum(pending, int(prefix.min()), out=pending)
                if len(at):
                    rest = np.append(np.minimum.accumulate(prefix[::-1])[::-1], _FAR)
                    pending[target[edge]] = rest[at[ends - 1] + 1]
            else:
                value = np.zeros(len(at), np.int32)
            suffix = before[at].astype(np.int32)
            for a, b in zip(edge.tolist(), ends.tolist()):
                queues.push(int(target[a]), suffix[a:b], value[a:b])

        def meet(one: np.ndarray, two: np.ndarray) -> int:
            """Common prefix of a falling and a rising suffix of one symbol."""
            return int(min(self.run[one], self.run[two]))

        for c in range(symbols):
            last = None
            while True:
                batch, prefix = queues.pop(c)
                if not len(batch):
                    break
                falling.push(c, batch, prefix)
                push(batch, prefix, False)
                last = batch[-1]
            if cuts[c] < cuts[c + 1]:
                batch = seeds[cuts[c] : cuts[c + 1]]
                prefix = lcp[cuts[c] : cuts[c + 1]].copy() if follow else np.zeros(len(batch), np.int32)
                prefix[0] = meet(last, batch[0]) if last is not None and follow else 0
                push(batch, prefix, False)
        pending[:] = -1
        for c in range(symbols - 1, -1, -1):
            last = None
            while True:
                batch, prefix = queues.pop(c)
                if not len(batch):
                    break
                yield batch, prefix
                push(batch, prefix, True)
                last = batch[-1]
            batch, prefix = falling.pop(c)
            if len(batch):
                batch = batch[::-1]
                turned = np.append(prefix[1:], 0)[::-1].copy()  # of each suffix with the next larger one
                turned[0] = meet(batch[0], last) if last is not None and follow else 0
                yield batch, turned
                push(batch, turned, True)
            if c == 0:
                end = np.array([len(t) - 1], np.int32)
                push(end, np.zeros(1, np.int32), True)
                yield end, np.zeros(1, np.int32)
        queues.close()
        falling.close()


def doubled(names: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of a string of names sorted by their first ``depth`` names or more, by prefix doubling."""
    rank, n, h = names.astype(np.int64), len(names), 1
    order = np.argsort(rank, kind="stable")
    while h < depth:
        key = rank * (n + 1)
        key[: n - h] += rank[h:] + 1 if h < n else 0
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        fresh = np.zeros(n, np.int64)
        fresh[order] = np.cumsum(np.append(False, ranked[1:] != ranked[:-1]))
        rank = fresh
        h *= 2
        if rank[order[-1]] == n - 1:
            break
    return order


def common(t: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Common prefixes of suffixes ``a`` and ``b``, exact below ``depth``, else ``depth`` or more."""
    padded = np.concatenate([t.astype(np.uint64), np.zeros(4, np.uint64)])
    four = padded[:-4] | padded[1:-3] << np.uint64(16) | padded[2:-2] << np.uint64(32) | padded[3:-1] << np.uint64(48)
    out = np.zeros(len(a), np.int32)
    alive = np.arange(len(a))
    done = 0
    while len(alive) and done < depth:
        x, y = a[alive].astype(np.int64) + done, b[alive].astype(np.int64) + done
        inside = np.maximum(x, y) < len(t)
        x, y, alive = x[inside], y[inside], alive[inside]
        differ = four[x] ^ four[y]
        same = differ == 0
        low = differ & (~differ + np.uint64(1))
        bits = np.frexp(np.where(same, 1, low).astype(np.float64))[1] - 1
        out[alive] = done + np.where(same, 4, bits // 16)
        alive = alive[same]
        done += 4
    return out


def sorted_lms(shard: Shard, depth: int, memory: int, base: int) -> np.ndarray:
    """LMS suffixes in order, exact for their first ``depth`` symbols."""
    t, lms = shard.t, shard.lms
    if len(lms) < 2:
        return lms
    start = lms[np.argsort(t[lms], kind="stable")]
    is_lms = np.zeros(len(t), bool)
    is_lms[lms] = True
    parts = [batch[is_lms[batch]] for batch, _ in shard.induce(start, None, memory)]
    order = np.concatenate(parts)[::-1]
    # Equal LMS substrings (up to and with the next LMS position) get equal names.
    place = np.searchsorted(lms, order)
    end = np.append(lms[1:] + 1, len(t))[place]
    if t.dtype.itemsize <= 2:
        prefix = Prefix(np.ascontiguousarray(t.astype("<u2")).view(np.uint8))
        prints = prefix.of(2 * order.astype(np.int64), 2 * end.astype(np.int64))
    else:
        prefix = Prefix(np.ascontiguousarray(t.astype("<u4")).view(np.uint8))
        prints = prefix.of(4 * order.astype(np.int64), 4 * end.astype(np.int64))
    names = np.empty(len(lms), np.int64)
    names[place] = np.cumsum(np.append(False, prints[1:] != prints[:-1]))
    if names.max() + 1 == len(lms):
        return order
    if len(names) <= base:
        return lms[doubled(names, depth)]
    # Names keep room for the end symbol 0; the last LMS position is the end and has name 0.
    reduced = Shard(np.append(names + 1, 0).astype(np.uint32))
    seeds = sorted_lms(reduced, depth, memory, base)
    deeper = np.concatenate([batch for batch, _ in reduced.induce(seeds, None, memory)])[::-1]
    return lms[deeper[deeper < len(lms)]]


def suffixes(symbols: np.ndarray, depth: int, memory: int = 64 << 20, base: int = 1 << 21) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Batches of (suffix, common prefix with the one before) in descending order.

    ``symbols``: unsigned, under 2^16, with 0 at the end only.  Order and common
    prefixes are exact up to ``depth`` symbols.  ``base``: longest string of names
    that is sorted in memory instead of by recursion.
    """
    shard = Shard(symbols)
    seeds = sorted_lms(shard, depth, memory, base)
    prefix = np.zeros(len(seeds), np.int32)
    prefix[1:] = common(symbols, seeds[1:], seeds[:-1], depth)
    yield from shard.induce(seeds, prefix, memory)
