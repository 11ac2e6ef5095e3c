"""Runs of repeating words, found on suffix arrays.

A run is a stretch of words that repeats with its smallest period at least twice and cannot
be made longer on either side. At its right end stands one square (two equal halves) that
cannot be shifted to the right: a branching tandem. For each interval of the array of common
prefixes, of depth d, the suffixes on the smaller side of each division are tested: are suffix
i + d or i - d in the interval too (a look into the inverse array), and do the words behind
the halves differ? Shifting such a square to the left as far as it goes gives the run.

Many documents share one array: words are told apart by document, so no prefix reaches into
another one, and a document's copies do not deepen the sort. No tree is built; an interval is
two numbers.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Shortest run, in words.
LEAST_WORDS = 12
# Words of documents that are sorted together; a longer document is sorted alone.
BLOCK_WORDS = 250_000
# Shifts that all squares make together before each goes on by itself.
TOGETHER = 32
RUNS = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def suffix_array(ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes in order, the inverse of that, and the common prefix of each suffix with the one before.

    ``ranks`` are numbers from 1. Prefixes of doubling length are sorted; in each round only
    suffixes that are still tied. The ranks of all rounds give the common prefixes.
    """
    n = len(ranks)
    order = np.argsort(ranks, kind="stable")
    sorted_ranks = ranks[order]
    fresh = np.r_[True, sorted_ranks[1:] != sorted_ranks[:-1]]
    rank = np.zeros(n + 1, dtype=np.int64)
    # A rank is the first place of its ties, from 1; 0 stands for the end.
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0)) + 1
    levels, width = [rank.astype(np.int32)], 1
    tied = ~(fresh & np.r_[fresh[1:], True])
    places = np.flatnonzero(tied)
    while len(places):
        suffixes = order[places]
        own = rank[suffixes]
        key = own * (n + 1) + rank[np.minimum(suffixes + width, n)]
        by = np.argsort(key, kind="stable")
        suffixes, key = suffixes[by], key[by]
        order[places] = suffixes
        fresh = np.r_[True, key[1:] != key[:-1]]
        starts = np.maximum.accumulate(np.where(fresh, np.arange(len(places)), 0))
        rank = rank.copy()
        rank[suffixes] = places[starts] + 1
        levels.append(rank.astype(np.int32))
        places = places[~(fresh & np.r_[fresh[1:], True])]
        width *= 2
    inverse = np.empty(n, dtype=np.int64)
    inverse[order] = np.arange(n)
    common = np.zeros(n, dtype=np.int64)
    i, j = order[:-1].copy(), order[1:].copy()
    for k in range(len(levels) - 1, -1, -1):
        level = levels[k]
        same = np.flatnonzero((level[np.minimum(i, n)] == level[np.minimum(j, n)]) & (i < n) & (j < n))
        # Equal ranks of a round are equal prefixes of its length.
        common[1:][same] += 1 << k
        i[same] += 1 << k
        j[same] += 1 << k
    return order, inverse, common


def intervals(common: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Divisions of the intervals: place of each, and first and last suffix of its interval.

    A division is a place whose suffix shares a prefix with the one before. Its interval
    reaches as far as prefixes are no shorter; of an interval's equal divisions the left one
    also divides what the later ones divide.
    """
    places = np.flatnonzero(common)
    values = common[places].tolist()
    where = places.tolist()
    low, high = [0] * len(where), [0] * len(where)
    stack: list[int] = []
    block = 0
    for k, (place, value) in enumerate(zip(where, values, strict=True)):
        if k and where[k - 1] != place - 1:
            # Nothing is shared in between: all open intervals end there.
            end = where[k - 1]
            for s in stack:
                high[s] = end
            stack = []
        if not stack:
            # The suffix before shares nothing with its own predecessor.
            block = place - 1
        while stack and values[stack[-1]] > value:
            s = stack.pop()
            high[s] = place - 1
        if stack:
            low[k] = low[stack[-1]] if values[stack[-1]] == value else where[stack[-1]]
        else:
            low[k] = block
        stack.append(k)
    for s in stack:
        high[s] = where[-1]
    return places, np.array(low, dtype=np.int64), np.array(high, dtype=np.int64)


def branching_squares(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and periods of the squares that cannot be shifted to the right."""
    n = len(words)
    order, inverse, common = suffix_array(words)
    places, low, high = intervals(common)
    if not len(places):
        return places, places
    depth = common[places]
    # The place divides its interval in two; the smaller side is tested. For equal divisions the
    # left side ends where the one before it stands, or the pair would be tested twice.
    left_from = low.copy()
    repeated = _equal_divisions(places, low, depth)
    left_from[repeated[0]] = repeated[1]
    left, right = places - left_from, high - places + 1
    starts, sizes = np.where(left <= right, left_from, places), np.minimum(left, right)
    owner = np.repeat(np.arange(len(places)), sizes)
    at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + starts[owner]
    suffix, d = order[at], depth[owner]
    found = []
    for partner, first in ((suffix + d, suffix), (suffix - d, suffix - d)):
        inside = (partner >= 0) & (partner < n)
        rank = inverse[np.clip(partner, 0, n - 1)]
        # On the other side of the division: the words behind the halves differ.
        own_left = at < places[owner]
        inside &= (rank >= low[owner]) & (rank <= high[owner]) & ((rank < places[owner]) != own_left)
        found.append(np.stack([first[inside], d[inside]]))
    squares = np.concatenate(found, axis=1)
    i, p = squares
    behind = i + 2 * p
    differ = (behind >= n) | (words[np.minimum(behind, n - 1)] != words[np.minimum(i + p, n - 1)])
    pairs = np.unique(np.stack([i[differ], p[differ]]), axis=1)
    return pairs[0], pairs[1]


def _equal_divisions(places: np.ndarray, low: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Divisions that follow an equal one of the same interval, and where that one stands."""
    by = np.lexsort((places, depth, low))
    l, d = low[by], depth[by]
    same = np.flatnonzero((l[1:] == l[:-1]) & (d[1:] == d[:-1])) + 1
    return by[same], places[by[same - 1]]


def shifted_left(words: np.ndarray, starts: np.ndarray, periods: np.ndarray) -> np.ndarray:
    """Where the squares come to stand when they are shifted to the left as far as they go."""
    starts = starts.copy()
    going = np.arange(len(starts))
    for _ in range(TOGETHER):
        i = starts[going] - 1
        going = going[(i >= 0) & (words[np.maximum(i, 0)] == words[np.minimum(i + periods[going], len(words) - 1)])]
        if not len(going):
            return starts
        starts[going] -= 1
    for k in going.tolist():
        i, p, step = int(starts[k]), int(periods[k]), 64
        while i:
            step = min(2 * step, i)
            equal = words[i - step : i] == words[i - step + p : i + p]
            breaks = np.flatnonzero(~equal)
            if len(breaks):
                i -= step - int(breaks[-1]) - 1
                break
            i -= step
        starts[k] = i
    return starts


def runs_of(words: np.ndarray, least: int = LEAST_WORDS) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of the runs with at least ``least`` words, in order of start and period.

    ``words`` are numbers from 1, told apart by document. Of squares that end together and
    cover each other only the one with the smallest period gives a run; the periods of the
    others are its multiples.
    """
    if not len(words):
        return []
    starts, periods = branching_squares(words)
    if not len(starts):
        return []
    by = np.lexsort((periods, starts + 2 * periods))
    starts, periods = starts[by], periods[by]
    ends = starts + 2 * periods
    # Runs of one end, smallest period first. A square inside a run that it repeats is no run of its own.
    found: list[tuple[int, int, int]] = []
    single = np.r_[True, ends[1:] != ends[:-1]] & np.r_[ends[1:] != ends[:-1], True]
    alone = np.flatnonzero(single)
    begin = shifted_left(words, starts[alone], periods[alone])
    found += zip(begin.tolist(), (ends[alone] - begin).tolist(), periods[alone].tolist(), strict=True)
    end, held = -1, []
    for k in np.flatnonzero(~single).tolist():
        if ends[k] != end:
            end, held = int(ends[k]), []
        p, s = int(periods[k]), int(starts[k])
        if any(p % q == 0 and s >= b for b, q in held):
            continue
        b = int(shifted_left(words, starts[k : k + 1], periods[k : k + 1])[0])
        held.append((b, p))
        found.append((b, end - b, p))
    return sorted((x for x in found if x[1] >= max(least, 2 * x[2])), key=lambda x: (x[0], x[2], x[1]))


def _block(texts: list[bytes], least: int) -> list[tuple[int, list[tuple[int, int, int]], bytes]]:
    """Word count, runs and collapsed text of each of the documents, sorted together."""
    split = [t.split() for t in texts]
    sizes = [len(w) for w in split]
    number: dict[bytes, int] = defaultdict(count().__next__)
    flat = np.fromiter((i for w in split for i in map(number.__getitem__, w)), dtype=np.int64, count=sum(sizes))
    owner = np.repeat(np.arange(len(split)), sizes)
    key = owner * len(number) + flat
    # Dense numbers from 1 in which words of different documents differ.
    by = np.argsort(key, kind="stable")
    sorted_key = key[by]
    words = np.empty(len(key), dtype=np.int64)
    if len(key):
        words[by] = np.cumsum(np.r_[True, sorted_key[1:] != sorted_key[:-1]])
    upto = np.cumsum(sizes)
    runs: list[list[tuple[int, int, int]]] = [[] for _ in split]
    for start, length, period in runs_of(words, least):
        doc = int(np.searchsorted(upto, start, side="right"))
        runs[doc].append((start - int(upto[doc]) + sizes[doc], length, period))
    out = []
    for words_of, found in zip(split, runs, strict=True):
        kept = words_of
        if found:
            gone = np.zeros(len(words_of), dtype=bool)
            for start, length, period in found:
                gone[start + period : start + length] = True
            kept = [words_of[i] for i in np.flatnonzero(~gone).tolist()]
        out.append((len(words_of), found, b" ".join(kept)))
    return out


def _finder(least: int, block_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

        def block(ids: list, texts: list[bytes]) -> pa.RecordBatch:
            found = _block(texts, least)
            runs = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in f] for _, f, _ in found]
            columns = [
                pa.array(ids, pa.int64()),
                pa.array([n for n, _, _ in found], pa.int64()),
                pa.array(runs, pa.list_(kind)),
                pa.array([c for _, _, c in found], pa.binary()).cast(pa.string()),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])

        for batch in batches:
            ids, texts, held = [], [], 0
            raw = batch.column("text").cast(pa.binary())
            for k, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                text = raw[k].as_py() or b""
                # No text has more words than half its bytes.
                if ids and held + len(text) // 2 > 3 * block_words:
                    yield block(ids, texts)
                    ids, texts, held = [], [], 0
                ids.append(doc_id)
                texts.append(text)
                held += len(text) // 2
            if ids:
                yield block(ids, texts)

    return run


def periodic_runs(docs: DataFrame, least: int = LEAST_WORDS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``) with its runs of repeating words.

    ``runs`` are in order of start and period, starts counted in words from 0; ``collapsed`` is
    the text without the words that a run repeats after its first period, joined by single
    blanks. Words are separated by ASCII white space. A NULL or empty text has no words and no
    runs. Rows that repeat, or have no doc_id, are handled like any other; other columns play
    no part. No rows are moved; memory of a task follows a block or its longest document.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return slim.mapInArrow(_finder(least, block_words), RUNS)
