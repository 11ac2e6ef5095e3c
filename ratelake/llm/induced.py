"""External induced suffix sorting with common-prefix values.

The suffixes of a text are of two kinds: smaller than the suffix one place on (S) or
larger (L). Once the S suffixes that follow an L (the seeds) are sorted, one ascending
pass induces all L suffixes from them and one descending pass all S suffixes from those.
A pass takes suffixes from a priority queue ordered by first character and then by the
order of insertion, and puts each one's predecessor back in. The queue carries, besides
the place, the length of the prefix that a suffix shares with the one before it in its
bucket: one more than the least such value passed since the last insertion there.

The seeds are sorted by naming the pieces between them and sorting the string of names,
by the same passes if it is long, directly if it fits into memory. Queues keep a bounded
number of entries in memory and the rest in scratch files of the task, which vanish with
it. All work is done on blocks of suffixes at once.
"""

from __future__ import annotations

import tempfile
from collections import defaultdict
from collections.abc import Iterator

import numpy as np

# Shared prefixes are told apart up to this length only; longer ones may read as any longer value.
DEPTH = 100
# Strings of names up to this length are sorted in memory.
DIRECT = 1 << 22
# Entries that a queue keeps in memory, over all its buckets.
HELD = 1 << 21
BLOCK = 1 << 18

ENTRY = np.dtype([("place", np.int64), ("shared", np.int32)])


class Queue:
    """Buckets of entries by character, first in, first out; full ones go to a scratch file."""

    def __init__(self, held: int = HELD):
        self.held, self.size = held, 0
        self.memory: dict[int, list[np.ndarray]] = defaultdict(list)
        self.spilled: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.file = None

    def put(self, key: int, entries: np.ndarray) -> None:
        self.memory[key].append(entries)
        self.size += len(entries)
        if self.size > self.held:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        for key, blocks in self.memory.items():
            for entries in blocks:
                self.file.seek(0, 2)
                self.spilled[key].append((self.file.tell(), len(entries)))
                self.file.write(entries.tobytes())
        self.memory.clear()
        self.size = 0

    def _read(self, at: tuple[int, int]) -> np.ndarray:
        self.file.seek(at[0])
        return np.frombuffer(self.file.read(at[1] * ENTRY.itemsize), dtype=ENTRY)

    def take(self, key: int) -> Iterator[np.ndarray]:
        """The bucket's entries, in order and for good, those put in meanwhile included.

        What lies there is taken together: many short blocks would cost more than their entries.
        """
        while self.spilled.get(key) or self.memory.get(key):
            if self.spilled.get(key):
                waiting, self.spilled[key] = self.spilled[key], []
                parts, size = [], 0
                for block in waiting:
                    parts.append(self._read(block))
                    size += block[1]
                    if size >= BLOCK:
                        yield np.concatenate(parts)
                        parts, size = [], 0
                if parts:
                    yield np.concatenate(parts)
            else:
                parts = self.memory.pop(key)
                self.size -= sum(map(len, parts))
                yield np.concatenate(parts)

    def blocks(self, key: int, backwards: bool = False) -> Iterator[np.ndarray]:
        """The bucket's blocks, which stay in it."""
        sources = [*self.spilled.get(key, ()), *self.memory.get(key, ())]
        for block in reversed(sources) if backwards else sources:
            yield self._read(block) if isinstance(block, tuple) else block

    def keys(self) -> set[int]:
        return {k for k, v in self.spilled.items() if v} | {k for k, v in self.memory.items() if v}

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


class Text:
    """A string of numbers with the kind of each suffix and the length of the run of its first character."""

    def __init__(self, values: np.ndarray):
        self.values = values
        size = len(values)
        ends = np.flatnonzero(np.append(values[1:] != values[:-1], True)) if size else np.empty(0, dtype=np.int64)
        lengths = np.diff(ends, prepend=-1)
        self.run = np.repeat(ends, lengths) - np.arange(size) + 1
        # A suffix is S if a larger character ends its run; the end of the text is smaller than all.
        after = np.append(values[ends[:-1] + 1] > values[ends[:-1]], False) if size else np.empty(0, dtype=bool)
        self.small = np.repeat(after, lengths)
        self.seeds = np.flatnonzero(self.small[1:] & ~self.small[:-1]) + 1

    def shared(self, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
        """Length of the common prefix of the suffixes at ``a`` and ``b``, up to ``depth``."""
        size, width = len(self.values), 8
        out = np.zeros(len(a), dtype=np.int32)
        if not len(a):
            return out
        # Eight characters at a time by a mixed sum, then one by one where sums differ. A sum
        # that agrees by chance is found out when its characters are compared once more.
        mixed = np.zeros(size + width, dtype=np.uint64)
        padded = np.append(self.values, np.zeros(2 * width, dtype=self.values.dtype)).astype(np.uint64)
        exact = int(self.values.max()) < 256
        for i in range(width):
            mixed = mixed * np.uint64(256 if exact else 0x9E3779B97F4A7C15) + padded[i : i + size + width]
        alive = np.arange(len(a))
        limit = np.minimum(depth, size - np.maximum(a, b))
        for at in range(0, depth, width):
            alive = alive[out[alive] == at]
            x, y = a[alive] + at, b[alive] + at
            inside = at < limit[alive]
            alive, x, y = alive[inside], x[inside], y[inside]
            if not len(alive):
                break
            same = mixed[x] == mixed[y]
            if not exact:
                for i in range(width):
                    same &= padded[x + i] == padded[y + i]
            out[alive[same]] = at + width
            rest, x, y = alive[~same], x[~same], y[~same]
            for i in range(width):
                equal = padded[x + i] == padded[y + i]
                rest, x, y = rest[equal], x[equal], y[equal]
                out[rest] += 1
        return np.minimum(out, limit).astype(np.int32)


def sort_directly(names: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes of ``names`` in the order of their first ``depth`` numbers at least, by doubling."""
    size, width = len(names), 1
    rank = np.unique(names, return_inverse=True)[1].astype(np.int64)
    while width < depth and size and rank.max() < size - 1:
        second = np.full(size, -1, dtype=np.int64)
        second[: max(0, size - width)] = rank[width:]
        _, rank = np.unique((rank + 1) * (size + 2) + second + 1, return_inverse=True)
        width *= 2
    return np.argsort(rank, kind="stable")


def sorted_seeds(text: Text, depth: int, direct: int, held: int) -> np.ndarray:
    """The seeds of the text in suffix order."""
    seeds = text.seeds
    if len(seeds) < 2:
        return seeds
    # A piece reaches to the next seed, that one's character included; after it stands a number
    # above all, because of two pieces that begin alike the longer one is the smaller suffix.
    raw = text.values.astype(">u4")
    mark = b"\xff\xff\xff\xff"
    ends = np.append(seeds[1:] + 1, len(raw))
    last = len(seeds) - 1
    pieces = [raw[s:e].tobytes() + (mark if i < last else b"") for i, (s, e) in enumerate(zip(seeds.tolist(), ends.tolist(), strict=True))]
    order = {piece: n for n, piece in enumerate(sorted(set(pieces)))}
    names = np.fromiter((order[p] for p in pieces), dtype=np.int64, count=len(pieces))
    # A piece has two characters of its own at least.
    if len(names) <= direct:
        return seeds[sort_directly(names, depth // 2 + 1)]
    places = [block["place"] for block, _ in suffixes(names, depth // 2 + 1, direct, held)]
    return seeds[np.concatenate(places)]


class Pass:
    """One inducing pass: what every bucket has passed since its last insertion."""

    def __init__(self, text: Text, queue: Queue, small: bool):
        self.text, self.queue, self.small = text, queue, small
        self.least: dict[int, int] = {}
        self.passed = np.iinfo(np.int32).max

    def see(self, places: np.ndarray, shared: np.ndarray) -> None:
        """Takes a block of suffixes in scanning order and queues those before them."""
        if not len(places):
            return
        values, text = self.text.values, self.text
        before = places - 1
        good = before >= 0
        good[good] &= text.small[before[good]] == self.small
        at = np.flatnonzero(good)
        keys = values[before[at]]
        order = np.argsort(keys, kind="stable")
        groups = np.split(order, np.flatnonzero(np.diff(keys[order])) + 1) if len(order) else []
        whole = int(shared.min())
        met = {}
        for group in groups:
            key, hits = int(keys[group[0]]), at[group]
            # Least value of each stretch that ends with a hit, the first one from the last block on.
            starts = np.append(0, hits[:-1] + 1)
            low = np.minimum.reduceat(shared[: hits[-1] + 1], starts)
            entries = np.empty(len(hits), dtype=ENTRY)
            entries["place"] = before[hits]
            if key in self.least:
                low[0] = min(int(low[0]), self.least[key])
                entries["shared"] = low + 1
            else:
                entries["shared"] = low + 1
                entries["shared"][0] = 0
            self.queue.put(key, entries)
            rest = shared[hits[-1] + 1 :]
            met[key] = int(rest.min()) if len(rest) else np.iinfo(np.int32).max - 1
        for key in self.least:
            if key not in met:
                self.least[key] = min(self.least[key], whole)
        self.least.update(met)


def suffixes(values: np.ndarray, depth: int = DEPTH, direct: int = DIRECT, held: int = HELD) -> Iterator[tuple[np.ndarray, bool]]:
    """Blocks of all suffixes in ascending order, with the prefix shared with the suffix before.

    The order is that of the first ``depth`` characters at least. The second part tells
    whether the block begins a new first character.
    """
    text = Text(values)
    if not len(values):
        return
    seeds = sorted_seeds(text, depth, direct, held)
    seed_shared = np.append(0, text.shared(seeds[:-1], seeds[1:], depth)).astype(np.int32)
    seed_keys = values[seeds]
    large, small = Queue(held), Queue(held)
    done_large, done_small = Queue(held), Queue(held)

    # The last suffix comes before all; it is an L, and induced by the end of the text.
    first = np.zeros(1, dtype=ENTRY)
    first["place"] = len(values) - 1
    ascending = Pass(text, large, small=False)
    large.put(int(values[-1]), first)
    ascending.least[int(values[-1])] = 0
    pending = set(np.unique(seed_keys).tolist())
    key = None
    while True:
        rest = [k for k in large.keys() | pending if key is None or k > key]
        if not rest:
            break
        key = min(rest)
        last = None
        new = True
        for block in large.take(key):
            shared = block["shared"].copy()
            if new:
                shared[0] = 0
                new = False
            done = block.copy()
            done["shared"] = shared
            done_large.put(key, done)
            ascending.see(block["place"], shared)
            last = int(block["place"][-1])
        if key in pending:
            low, high = np.searchsorted(seed_keys, [key, key + 1])
            shared = seed_shared[low:high].copy()
            shared[0] = 0 if last is None else min(text.run[last], text.run[seeds[low]])
            for i in range(low, high, BLOCK):
                ascending.see(seeds[i : min(high, i + BLOCK)], shared[i - low : i - low + BLOCK])
            pending.discard(key)

    # Descending: what stands before an entry in scanning order is the larger suffix.
    descending = Pass(text, small, small=True)
    keys = done_large.keys()
    key = None
    while True:
        rest = [k for k in small.keys() | keys if key is None or k < key]
        if not rest:
            break
        key = max(rest)
        last = None
        for block in small.take(key):
            shared = block["shared"].copy()
            if last is None:
                shared[0] = 0
            done = block.copy()
            done["shared"] = shared
            done_small.put(key, done)
            descending.see(block["place"], shared)
            last = int(block["place"][-1])
        carried = 0
        for block in done_large.blocks(key, backwards=True):
            places = block["place"][::-1]
            shared = np.empty(len(places), dtype=np.int32)
            shared[0] = (0 if last is None else min(text.run[last], text.run[places[0]])) if carried == 0 else carried
            shared[1:] = block["shared"][::-1][:-1]
            carried = int(block["shared"][0])
            descending.see(places, shared)

    for key in sorted(done_large.keys() | done_small.keys()):
        begin, last = True, None
        for block in done_large.blocks(key):
            yield block, begin
            begin, last = False, int(block["place"][-1])
        # The S bucket was filled downwards: each entry has what it shares with the larger one.
        upwards = None
        for block in done_small.blocks(key, backwards=True):
            out = np.empty(len(block), dtype=ENTRY)
            out["place"] = block["place"][::-1]
            out["shared"][1:] = block["shared"][::-1][:-1]
            if upwards is None:
                out["shared"][0] = 0 if last is None else min(text.run[last], text.run[out["place"][0]])
            else:
                out["shared"][0] = upwards
            upwards = int(block["shared"][0])
            yield out, begin
            begin = False
    for queue in (large, small, done_large, done_small):
        queue.close()
