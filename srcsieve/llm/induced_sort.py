"""Suffix order and common prefixes by external induced sorting.

The scheme is that of induced sorting in external memory (Bingmann, Fischer and Osipov,
ALENEX 2013): suffixes at the left ends of rising runs (S*) are sorted through a reduced text, by
recursion; priority queues keyed by the first symbol then induce the order of all falling
suffixes (L) in one ascending sweep and of all rising ones (S) in one descending sweep. Queue
entries carry the suffix and the length of the prefix it shares with the entry before it. A sweep takes
all entries of a symbol at once, as arrays. Queues write sorted runs to disk beyond a
limit, and long arrays are memory-mapped files, so a text may be far larger than memory.

Only the first ``depth`` symbols matter to the caller: shared prefixes are cut there, and suffixes
that agree that far may come in any order.
"""

from __future__ import annotations

import heapq
import os
import tempfile
from collections.abc import Iterator

import numpy as np

#: Entries of a queue held in memory, and entries that a sweep takes at a time.
QUEUE_LIMIT = 1 << 22
CHUNK = 1 << 20
#: A reduced text up to this length is sorted in memory; a longer one by recursion.
MEMORY_LIMIT = 1 << 22


class Scratch:
    """Arrays in memory, or in files of a folder that lives as long as the sort."""

    def __init__(self, memory_limit: int = MEMORY_LIMIT, queue_limit: int = QUEUE_LIMIT) -> None:
        local = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
        self.folder = tempfile.TemporaryDirectory(dir=local if os.path.isdir(local) else None)
        self.memory_limit, self.queue_limit, self.files = memory_limit, queue_limit, 0

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.folder.cleanup()

    def path(self) -> str:
        self.files += 1
        return os.path.join(self.folder.name, str(self.files))

    def zeros(self, n: int, dtype) -> np.ndarray:
        if n <= self.memory_limit:
            return np.zeros(n, dtype)
        return np.memmap(self.path(), dtype, "w+", shape=(n,))


class SuffixQueue:
    """A disk-backed priority queue of ``(symbol, suffix, shared)``; equal symbols keep their order.

    Symbols leave in one direction only, ascending or descending, and may be pushed while they leave.
    """

    def __init__(self, scratch: Scratch, descending: bool = False) -> None:
        self.scratch, self.sign = scratch, -1 if descending else 1
        self.held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        self.symbols: list[int] = []
        self.runs: list[list] = []
        self.size = 0
        self.last: dict[int, int] = {}

    def push(self, symbol: int, suffixes: np.ndarray, shared: np.ndarray) -> None:
        if symbol not in self.held:
            self.held[symbol] = []
            heapq.heappush(self.symbols, self.sign * symbol)
        self.held[symbol].append((suffixes, shared))
        self.last[symbol] = int(suffixes[-1])
        self.size += len(suffixes)
        if self.size > self.scratch.queue_limit:
            self._spill()

    def _spill(self) -> None:
        """Write what is held as one run, sorted by symbol."""
        order = sorted(self.held, key=lambda s: self.sign * s)
        parts = [(s, a, b) for s in order for a, b in self.held[s]]
        keys = np.concatenate([np.full(len(a), self.sign * s, dtype=np.int64) for s, a, _ in parts])
        columns = (keys, np.concatenate([a for _, a, _ in parts]), np.concatenate([b for *_, b in parts]))
        mapped = []
        for column in columns:
            path = self.scratch.path()
            column.tofile(path)
            mapped.append(np.memmap(path, column.dtype, "r"))
        self.runs.append([0, *mapped])
        self.held, self.symbols, self.size = {}, [], 0

    def next_symbol(self) -> int | None:
        heads = [int(keys[at]) for at, keys, *_ in self.runs if at < len(keys)]
        heads += self.symbols[:1]
        return self.sign * min(heads) if heads else None

    def take(self, symbol: int, backwards: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """What is queued under ``symbol`` now, in the order of the pushes, about ``CHUNK`` at a time.

        ``backwards`` gives the last pieces first; each piece keeps its order.
        """
        key, waiting = self.sign * symbol, []
        for run in self.runs:
            at, keys, suffixes, shared = run
            end = at + int(np.searchsorted(keys[at:], key, "right"))
            waiting += [
                (suffixes[i : min(i + CHUNK, end)], shared[i : min(i + CHUNK, end)])
                for i in range(at, end, CHUNK)
            ]
            run[0] = end
        self.runs = [run for run in self.runs if run[0] < len(run[1])]
        held = self.held.pop(symbol, [])
        if held:
            self.symbols.remove(key) if self.symbols[0] != key else heapq.heappop(self.symbols)
            heapq.heapify(self.symbols)
            self.size -= sum(len(a) for a, _ in held)
        parts, batch, size = waiting + held, [], 0
        for part in reversed(parts) if backwards else parts:
            batch.append(part)
            size += len(part[0])
            if size >= CHUNK:
                yield self._joined(batch, backwards)
                batch, size = [], 0
        if batch:
            yield self._joined(batch, backwards)

    @staticmethod
    def _joined(batch: list, backwards: bool) -> tuple[np.ndarray, np.ndarray]:
        suffixes, shared = zip(*(batch[::-1] if backwards else batch))
        return np.concatenate(suffixes), np.concatenate(shared)


def _rising(text: np.ndarray, scratch: Scratch) -> np.ndarray:
    """True for S suffixes: those smaller than the suffix after them. Read from the end in pieces."""
    n = len(text)
    rising = scratch.zeros(n, np.bool_)
    rising[n - 1] = True
    for end in range(n - 1, 0, -CHUNK):
        begin = max(end - CHUNK, 0)
        here, after = text[begin:end], text[begin + 1 : end + 1]
        # An equal symbol takes the type of the place after it, which a backward fill finds.
        known = np.append(here != after, True)
        value = np.append(here < after, rising[end])
        place = np.where(known, np.arange(len(known)), len(known))
        place = np.minimum.accumulate(place[::-1])[::-1]
        rising[begin:end] = value[place[:-1]]
    return rising


def _lms(rising: np.ndarray) -> np.ndarray:
    """S suffixes after an L suffix, in text order; the last is the end of the text."""
    found = [np.zeros(0, dtype=np.int64)]
    for begin in range(1, len(rising), CHUNK):
        end = min(begin + CHUNK, len(rising))
        found.append(np.flatnonzero(rising[begin:end] & ~rising[begin - 1 : end - 1]) + begin)
    return np.concatenate(found)


def _words(text: np.ndarray, at: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The next symbols of each place as one number, places beyond ``length`` as the largest symbol."""
    per_word, bits = (8, 8) if text.dtype == np.uint8 else (2, 32)
    top, n = np.uint64((1 << bits) - 1), len(text)
    word = np.zeros(len(at), dtype=np.uint64)
    for i in range(per_word):
        symbol = text[np.minimum(at + i, n - 1)].astype(np.uint64)
        word = (word << np.uint64(bits)) | np.where(length > i, symbol, top)
    return word


def _names(text: np.ndarray, lms: np.ndarray, depth: int) -> np.ndarray:
    """Order-preserving names of the pieces from each S* to the next, both included.

    A piece that is a prefix of another is the larger one, which padding with the largest symbol
    gives. Equal pieces share a name; names are refined a word at a time while any are tied.
    """
    length = np.append(lms[1:] - lms[:-1] + 1, 1)
    name = np.zeros(len(lms), dtype=np.int64)
    tied, step = np.arange(len(lms)), 8 if text.dtype == np.uint8 else 2
    at = 0
    while len(tied):
        word = _words(text, lms[tied] + at, length[tied] - at)
        order = np.lexsort((word, name[tied]))
        tied, word, group = tied[order], word[order], name[tied][order]
        new_group = np.append(True, group[1:] != group[:-1])
        new_name = new_group | np.append(True, word[1:] != word[:-1])
        places = np.arange(len(tied))
        first = np.maximum.accumulate(np.where(new_group, places, 0))
        name[tied] = group + np.maximum.accumulate(np.where(new_name, places, 0)) - first
        sizes = np.diff(np.append(np.flatnonzero(new_name), len(tied)))
        at += step
        tied = np.sort(tied[np.repeat(sizes, sizes) > 1])
        tied = tied[length[tied] > at]
    _, dense = np.unique(name, return_inverse=True)
    return dense


def _doubling(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of a text in memory, in the order of their first ``depth`` symbols or more.

    A rank is the place of the first suffix of its group in the order; only groups that are
    still tied are sorted again, by the rank of what follows.
    """
    n, reach = len(text), 1
    order = np.argsort(text)
    slots, key = np.arange(n), text[order]
    rank = np.zeros(n, dtype=np.int64)
    while True:
        fresh = np.append(True, key[1:] != key[:-1])
        items = order[slots]
        rank[items] = slots[np.maximum.accumulate(np.where(fresh, np.arange(len(slots)), 0))]
        slots = slots[~(fresh & np.append(fresh[1:], True))]
        if reach >= depth or not len(slots):
            return order
        items = order[slots]
        after = items + reach
        key = rank[items] * (n + 1) + np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        again = np.argsort(key)
        key = key[again]
        order[slots] = items[again]
        reach *= 2


def shared_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Symbols that the suffixes ``a`` and ``b`` share, pairwise, up to ``depth``."""
    n, shared = len(text), np.zeros(len(a), dtype=np.uint16)
    alike, done = np.arange(len(a)), 0
    if text.dtype == np.uint8 and n > 8:  # eight symbols at a time, as long as both suffixes have them
        words = np.ndarray((n - 7,), "<u8", buffer=text.data, strides=(1,))
        ends = []
        for done in range(0, depth, 8):
            inside = np.maximum(a[alike], b[alike]) + done <= n - 8
            ends.append(alike[~inside])
            alike = alike[inside]
            differ = words[a[alike] + done] ^ words[b[alike] + done]
            same = differ == 0
            apart = differ[~same]
            lowest = (apart & (~apart + np.uint64(1))).astype(np.float64)
            shared[alike[~same]] = np.minimum(done + np.log2(lowest).astype(np.int64) // 8, depth)
            alike = alike[same]
            shared[alike] = min(done + 8, depth)
        alike = np.concatenate(ends)
    for at in range(depth if len(alike) else 0):
        inside = np.maximum(a[alike], b[alike]) + at < n
        alike = alike[inside]
        alike = alike[text[a[alike] + at] == text[b[alike] + at]]
        if not len(alike):
            break
        shared[alike] = at + 1
    return shared


class _Sweep:
    """Pushes the suffix before each swept one, if it is of the sought type, with its shared prefix."""

    def __init__(self, text: np.ndarray, rising: np.ndarray, into: SuffixQueue, seek_rising: bool, depth: int) -> None:
        self.text, self.rising, self.into, self.seek, self.depth = text, rising, into, seek_rising, depth

    def one_shared(self, a: int, b: int) -> int:
        room = min(self.depth, len(self.text) - max(a, b))
        differs = np.flatnonzero(self.text[a : a + room] != self.text[b : b + room])
        return int(differs[0]) if len(differs) else room

    def run(self, suffixes: np.ndarray, shared: np.ndarray) -> None:
        """``shared[i]`` is what suffix ``i`` shares with the one before it; entry 0 is not used."""
        place = np.flatnonzero(suffixes > 0)
        before = suffixes[place] - 1
        sought = self.rising[before] == self.seek
        place, before = place[sought], before[sought]
        symbol = self.text[before]
        order = np.argsort(symbol, kind="stable")
        place, before, symbol = place[order], before[order], symbol[order]
        bounds = np.flatnonzero(np.append(True, symbol[1:] != symbol[:-1])) if len(symbol) else []
        for begin, end in zip(bounds, [*bounds[1:], len(symbol)]):
            target, at = int(symbol[begin]), place[begin:end]
            own = np.empty(end - begin, dtype=np.uint16)
            if end - begin > 1:
                least = np.minimum.reduceat(shared[: at[-1] + 1], at[:-1] + 1)
                own[1:] = np.minimum(least + np.uint16(1), self.depth)
            last = self.into.last.get(target)
            own[0] = 0 if last is None else self.one_shared(last, int(before[begin]))
            self.into.push(target, before[begin:end], own)


def sorted_suffixes(text: np.ndarray, depth: int, scratch: Scratch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All suffixes but the last in descending order, as arrays ``(suffixes, shared)``.

    ``text`` ends with its smallest symbol, which stands nowhere else. ``shared[i]`` is the prefix
    that suffix ``i`` shares with the one given before it, up to ``depth``; over a change of
    the first symbol it is 0.
    """
    if len(text) < 2:
        return
    rising = _rising(text, scratch)
    lms = _lms(rising)
    names = _names(text, lms, depth)
    if len(lms) <= scratch.memory_limit:
        order = _doubling(names, depth // 2 + 1)  # a name stands for two symbols or more
    else:
        reduced = scratch.zeros(len(names), np.uint32)
        reduced[:] = names
        parts = [suffixes for suffixes, _ in sorted_suffixes(reduced, depth // 2 + 1, scratch)]
        order = np.concatenate([np.array([len(lms) - 1]), *(part[::-1] for part in parts[::-1])])
    seeds = lms[order]
    seed_shared = np.zeros(len(seeds), dtype=np.uint16)
    seed_shared[1:] = shared_prefix(text, seeds[:-1], seeds[1:], depth)
    first = text[seeds]

    ascending, falling = SuffixQueue(scratch), SuffixQueue(scratch, descending=True)
    sweep = _Sweep(text, rising, ascending, False, depth)
    starts = np.flatnonzero(np.append(True, first[1:] != first[:-1]))
    groups = {int(first[b]): (b, e) for b, e in zip(starts, [*starts[1:], len(seeds)])}
    left = sorted(groups, reverse=True)
    while left or ascending.next_symbol() is not None:
        waiting = ascending.next_symbol()
        symbol = waiting if not left else left[-1] if waiting is None else min(waiting, left[-1])
        while ascending.next_symbol() == symbol:
            for suffixes, shared in ascending.take(symbol):
                falling.push(symbol, suffixes, shared)
                sweep.run(suffixes, shared)
        if left and left[-1] == symbol:
            begin, end = groups[left.pop()]
            for at in range(begin, end, CHUNK):
                sweep.run(seeds[at : min(at + CHUNK, end)], seed_shared[at : min(at + CHUNK, end)])

    descending = SuffixQueue(scratch, descending=True)
    sweep = _Sweep(text, rising, descending, True, depth)
    while True:
        waiting = [s for s in (descending.next_symbol(), falling.next_symbol()) if s is not None]
        if not waiting:
            return
        symbol, last = max(waiting), None
        while descending.next_symbol() == symbol:
            for suffixes, shared in descending.take(symbol):
                last = int(suffixes[-1])
                sweep.run(suffixes, shared)
                yield suffixes, shared
        if falling.next_symbol() == symbol:
            for suffixes, shared in falling.take(symbol, backwards=True):
                suffixes = suffixes[::-1]
                shared = np.append(np.uint16(0), shared[:0:-1])
                if last is not None:
                    shared[0] = sweep.one_shared(last, int(suffixes[0]))
                last = int(suffixes[-1])
                sweep.run(suffixes, shared)
                yield suffixes, shared
