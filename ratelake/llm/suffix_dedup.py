"""Removal of repeated passages: every byte covered by a 100-byte string that starts earlier.

Equal strings are brought together before they are sorted. Each 100-byte string of a text
belongs to its anchor, the 32 bytes in it with the least hash; equal strings have equal
anchors at the same place. One shuffle brings the runs of strings around an anchor
together, each with a hash of the stretch it covers: equal stretches are reduced to the
first, and anchors left with one stretch are set aside, as no other string can repeat.
Only then are stretches cut out of the texts and dealt by anchor to shards. A shard's
suffixes are sorted by external induced sorting, where equal strings are neighbours that
share at least 100 bytes; all but the earliest of them are removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratelake.llm.common import hash64, once
from ratelake.llm.induced import suffixes
from ratelake.session import materialize

LENGTH = 100
ANCHOR = 32
# Bytes hashed at once, texts longer than that in windows; places in them need PLACE_BITS bits.
PIECE, PLACE_BITS = 1 << 19, 20
# Bytes sorted together; a smaller number makes more and shorter tasks.
SHARD_BYTES = 1 << 18
# An anchor with more different stretches than a task should sort (about 2 MB) is dealt by whole strings instead.
CROWDED = 16_384
# Id lists up to this length (8 bytes each) may be sent to every executor.
BROADCAST_IDS = 1_000_000

_TABLE = np.random.default_rng(97).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
# Stretches have a table and a base of their own.
_STRETCH_TABLE = np.random.default_rng(98).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STRETCH_BASE = 0xC2B2AE3D27D4EB4F


def window_hashes(values: np.ndarray, width: int) -> np.ndarray:
    """A hash of the ``width`` bytes from each place on; ``width`` is a power of two."""
    out, factor, step = _TABLE[values], _BASE, 1
    while step < width:
        tail = out[step:]
        out = out[: len(tail)] * np.uint64(factor) + tail
        factor, step = factor * factor % 2**64, 2 * step
    return _mixed(out)


def _mixed(out: np.ndarray) -> np.ndarray:
    out = (out ^ (out >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(32))


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the stretches' base and of its inverse."""
    both = []
    for base in (_STRETCH_BASE, pow(_STRETCH_BASE, -1, 2**64)):
        factors = np.full(size, base, dtype=np.uint64)
        factors[0] = 1
        both.append(np.multiply.accumulate(factors))
    return both[0], both[1]


def stretch_hashes(values: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each stretch of ``values``, from sums over all bytes before its ends."""
    size = 1 << len(values).bit_length()
    powers, inverse = once(("stretch powers", size), lambda: _powers(size))
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(_STRETCH_TABLE[values] * powers[: len(values)], out=sums[1:])
    return _mixed((sums[ends] - sums[begins]) * inverse[begins] + (ends - begins).astype(np.uint64))


def anchors(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int, width: int) -> tuple[np.ndarray, ...]:
    """``(text, first, count, key, content)`` of the runs of strings that share an anchor.

    ``values`` are the bytes of several texts, from ``starts`` to ``ends``; ``first`` is
    counted from the text's start, and ``content`` is the hash of all bytes of a run's
    strings. Of equal hashes the leftmost is the anchor.
    """
    span = length - width + 1
    none = np.empty(0, dtype=np.int64)
    if len(values) < length or not (ends - starts >= length).any():
        return none, none, none, none, none
    hashes = window_hashes(values, width)
    # The same for every piece, or equal strings of two pieces could choose differently.
    bits = np.uint64(PLACE_BITS)
    ordered = (hashes >> bits << bits) | np.arange(len(hashes), dtype=np.uint64)
    rows = -(-len(ordered) // span)
    grid = np.full(rows * span, np.iinfo(np.uint64).max, dtype=np.uint64)
    grid[: len(ordered)] = ordered
    grid = grid.reshape(rows, span)
    left = np.minimum.accumulate(grid, axis=1).ravel()
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    strings = len(values) - length + 1
    least = np.minimum(right[:strings], left[span - 1 : span - 1 + strings])
    at = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    owner = np.searchsorted(starts, np.arange(strings), side="right") - 1
    inside = np.arange(strings) + length <= ends[owner]
    # A run ends where the anchor or the text changes, or strings would leave the text.
    fresh = np.append(True, (at[1:] != at[:-1]) | (owner[1:] != owner[:-1]) | (inside[1:] != inside[:-1]))
    heads = np.flatnonzero(fresh)
    counts = np.diff(np.append(heads, strings))
    heads, counts = heads[inside[heads]], counts[inside[heads]]
    texts = owner[heads]
    content = stretch_hashes(values, heads, heads + counts + (length - 1))
    return texts, heads - starts[texts], counts, hashes[at[heads]].view(np.int64), content.view(np.int64)


def _runs(batch: pa.RecordBatch, length: int, width: int) -> Iterator[tuple[np.ndarray, ...]]:
    """The anchors of a batch's texts, some of them at a time."""
    texts = batch.column("text").cast(pa.binary())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8) if texts.buffers()[2] is not None else np.empty(0, dtype=np.uint8)
    begin = 0
    while begin < len(texts):
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + PIECE, side="right")) - 1)
        low, high = offsets[begin], offsets[end]
        if end == begin + 1 and high - low > PIECE:
            # One long text goes in windows; each string starts in one of them.
            for at in range(0, int(high - low) - length + 1, PIECE):
                part = data[low + at : min(low + at + PIECE + length - 1, high)]
                found, first, *rest = anchors(part, np.array([0]), np.array([len(part)]), length, width)
                yield found + begin, first + at, *rest
            begin = end
            continue
        starts, ends = offsets[begin:end] - low, offsets[begin + 1 : end + 1] - low
        # Empty texts would hide the text that starts at the same place.
        some = np.flatnonzero(ends > starts)
        if len(some):
            found, *rest = anchors(data[low:high], starts[some], ends[some], length, width)
            yield some[found] + begin, *rest
        begin = end


def _parts(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Batches of few rows, for work that makes Python objects of them."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


PLACES = "doc_id long, tid long, key long, content long, first int, count int, again boolean"


def _again(docs: pa.Array, tids: np.ndarray, first: np.ndarray, keys: np.ndarray, content: np.ndarray) -> np.ndarray:
    """Which rows have an equal stretch at an earlier place among these."""
    again = np.zeros(len(keys), dtype=bool)
    both = _mixed(keys.view(np.uint64)) ^ content.view(np.uint64)
    _, which, times = np.unique(both, return_inverse=True, return_counts=True)
    rows = np.flatnonzero(times[which] > 1)
    if not len(rows):
        return again
    known = np.asarray(docs.is_valid())
    where = [c[rows] for c in (first, tids, np.asarray(docs.fill_null(0)), known)]
    order = np.lexsort((*where, content[rows], keys[rows]))
    where, same = [c[order] for c in where], [c[rows][order] for c in (keys, content)]
    fresh = np.append(True, (same[0][1:] != same[0][:-1]) | (same[1][1:] != same[1][:-1]))
    lead = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    again[rows[order]] = np.any([c != c[lead] for c in where], axis=0)
    return again


def _places(length: int, width: int):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            tids = np.asarray(batch.column("tid"))
            for texts, first, count, keys, content in _runs(batch, length, width):
                docs = ids.take(pa.array(texts))
                again = _again(docs, tids[texts], first, keys, content)
                # What is a copy already needs no comparison: it goes anywhere, so that no task gets all copies of a passage.
                spread = _mixed(tids[texts].view(np.uint64) + first.astype(np.uint64)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        docs,
                        pa.array(tids[texts]),
                        pa.array(np.where(again, spread, keys)),
                        pa.array(content),
                        pa.array(first.astype(np.int32)),
                        pa.array(count.astype(np.int32)),
                        pa.array(again),
                    ],
                    names=["doc_id", "tid", "key", "content", "first", "count", "again"],
                )

    return place


def _cutter(length: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            ids, tids = batch.column("doc_id").to_pylist(), batch.column("tid").to_pylist()
            for doc, tid, text, runs in zip(ids, tids, batch.column("text").to_pylist(), batch.column("runs").to_pylist(), strict=True):
                raw = text.encode()
                rows = [(r["key"], doc, tid, r["first"], r["count"], raw[r["first"] : r["first"] + r["count"] + length - 1]) for r in runs]
                for i in range(0, len(rows), 8192):
                    columns = zip(*rows[i : i + 8192], strict=True)
                    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["key", "doc_id", "tid", "first", "count", "stretch"])

    return cut


def repeated_strings(stretches: list[bytes], counts: np.ndarray, order: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """``(stretch, place)`` of the strings of ``length`` that an earlier one equals.

    The first ``counts`` places of a stretch are strings of it; ``order`` ranks stretches
    by where they stand in the corpus, and in a stretch earlier places come first.
    """
    sizes = np.array([len(s) for s in stretches], dtype=np.int64)
    begins = np.cumsum(sizes) - sizes
    values = np.frombuffer(b"".join(stretches), dtype=np.uint8).astype(np.int64)
    within = np.arange(len(values)) - np.repeat(begins, sizes)
    valid = within < np.repeat(counts, sizes)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    gone: list[np.ndarray] = []
    held = np.empty(0, dtype=np.int64)  # the last class seen, which may go on
    low = 0

    def close(members: np.ndarray, heads: np.ndarray) -> None:
        """Keeps the earliest of each class; ``heads`` marks where one begins."""
        group = np.cumsum(heads) - 1
        rank = np.lexsort((within[members], order[owner[members]], group))
        first = np.append(True, group[rank][1:] != group[rank][:-1])
        gone.append(members[rank[~first]])

    for block, _ in suffixes(values, length):
        places, shared = block["place"], block["shared"]
        at = np.flatnonzero(valid[places])
        if not len(at):
            low = min(low, int(shared.min()))
            continue
        least = np.minimum.reduceat(shared[: at[-1] + 1], np.append(0, at[:-1] + 1))
        least[0] = min(int(least[0]), low)
        members = np.append(held, places[at])
        heads = np.append(np.arange(len(held)) == 0, least < length)
        if len(held) == 0:
            heads[0] = True
        last = int(np.flatnonzero(heads)[-1])
        if last:
            close(members[:last], heads[:last])
        held = members[last:]
        rest = shared[at[-1] + 1 :]
        low = int(rest.min()) if len(rest) else np.iinfo(np.int32).max
    if len(held):
        close(held, np.arange(len(held)) == 0)
    found = np.sort(np.concatenate(gone)) if gone else np.empty(0, dtype=np.int64)
    return owner[found], within[found]


def _may_repeat(stretches: list[bytes], counts: np.ndarray, keys: np.ndarray, length: int, width: int) -> np.ndarray:
    """Whether a stretch shares half a string's reach to the left or right of its anchor with another one.

    A string reaches ``length - width`` bytes beyond its anchor, so at least half of that
    to one side; a stretch that no other equals that far to either side has no repeated string.
    """
    sizes = np.array([len(s) for s in stretches], dtype=np.int64)
    begins = np.cumsum(sizes) - sizes
    values = np.frombuffer(b"".join(stretches), dtype=np.uint8)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    hashes = window_hashes(values, width).view(np.int64)
    hits = np.flatnonzero(hashes == keys[owner[: len(hashes)]])
    hits = hits[hits + width <= (begins + sizes)[owner[hits]]]
    seen = np.bincount(owner[hits], minlength=len(sizes))
    # Where the anchor's bytes stand twice, which of them is the anchor is left open.
    keep = seen != 1
    at = np.zeros(len(sizes), dtype=np.int64)
    at[owner[hits]] = hits
    half = (length - width) // 2
    left = ~keep & (at - begins >= half)
    last = begins + counts - 1
    right = ~keep & (length - width - (at - last) >= half)
    for some, low, high in ((left, at - half, at + width), (right, at, at + width + half)):
        chosen = np.flatnonzero(some)
        if len(chosen):
            marks = stretch_hashes(values, low[chosen], high[chosen])
            _, which, times = np.unique(marks, return_inverse=True, return_counts=True)
            keep[chosen[times[which] > 1]] = True
    return keep


def _sorter(length: int, width: int):
    def sort(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        counts, keys = (np.asarray(rows.column(c).combine_chunks()).astype(np.int64) for c in ("count", "key"))
        rows = rows.filter(pa.array(_may_repeat(rows.column("stretch").to_pylist(), counts, keys, length, width)))
        counts, first, tids = (np.asarray(rows.column(c).combine_chunks()).astype(np.int64) for c in ("count", "first", "tid"))
        docs = np.array([-(2**63) if d is None else d for d in rows.column("doc_id").to_pylist()], dtype=np.int64)
        rank = np.empty(len(docs), dtype=np.int64)
        sequence = np.lexsort((first, tids, docs))
        rank[sequence] = np.arange(len(docs))
        # Rows equal in doc_id and text give the same stretches, which do not repeat each other.
        again = np.flatnonzero((tids[sequence][1:] == tids[sequence][:-1]) & (first[sequence][1:] == first[sequence][:-1])) + 1
        if len(again):
            fresh = np.ones(len(docs), dtype=bool)
            fresh[sequence[again]] = False
            rows, counts, first, tids, rank = rows.filter(pa.array(fresh)), counts[fresh], first[fresh], tids[fresh], rank[fresh]
        owner, place = repeated_strings(rows.column("stretch").to_pylist(), counts, rank, length)
        # Neighbouring strings of a stretch make one range.
        fresh = np.append(True, (owner[1:] != owner[:-1]) | (place[1:] != place[:-1] + 1)) if len(owner) else np.empty(0, dtype=bool)
        heads = np.flatnonzero(fresh)
        ends = np.append(heads[1:], len(owner)) - 1 if len(heads) else heads
        start = first[owner[heads]] + place[heads]
        end = first[owner[ends]] + place[ends] + length
        return pa.table({"tid": pa.array(tids[owner[heads]], pa.int64()), "start": pa.array(start.astype(np.int64)), "end": pa.array(end.astype(np.int64))})

    return sort


def _remover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _parts(batches):
        out: tuple[list, ...] = ([], [], [], [], [])
        for text, ranges in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist(), strict=True):
            raw, kept, at, removed, spans = text.encode(), [], 0, [], 0
            for r in sorted(ranges, key=lambda r: (r["start"], r["end"])):
                if removed and r["start"] <= removed[-1][1]:
                    removed[-1][1] = max(removed[-1][1], r["end"])
                else:
                    removed.append([r["start"], r["end"]])
            for low, high in removed:
                kept.append(raw[at:low])
                at = high
            kept.append(raw[at:])
            left = b"".join(kept)
            spans = [{"start": a, "end": b} for a, b in removed]
            for column, value in zip(out, (len(raw), len(raw) - len(left), len(removed), hashlib.sha256(left).hexdigest(), spans), strict=True):
                column.append(value)
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), span)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>"


def _few(ids: DataFrame) -> DataFrame:
    """The ids, marked for broadcast where their count is proven small."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _cut(docs: DataFrame, runs: DataFrame, length: int) -> DataFrame:
    """The stretches of ``runs (tid, key, first, count)`` out of the texts."""
    runs = materialize(runs.groupBy("tid").agg(F.collect_list(F.struct("key", "first", "count")).alias("runs")), "by-text")
    holders = docs.join(_few(runs.select("tid")), "tid", "left_semi").join(runs, "tid")
    return holders.select("doc_id", "tid", "text", "runs").mapInArrow(_cutter(length), "key long, doc_id long, tid long, first int, count int, stretch binary")


def removed_ranges(docs: DataFrame, length: int = LENGTH, width: int = ANCHOR, shard_bytes: int = SHARD_BYTES, crowded: int = CROWDED) -> DataFrame:
    """``(tid, start, end)`` of the repeated strings of ``docs (doc_id, tid, text)``; ranges may overlap."""
    places = docs.select("doc_id", "tid", "text").mapInArrow(_places(length, width), PLACES)
    same = Window.partitionBy("key", "content").orderBy("doc_id", "tid", "first")
    # Dealt by anchor once: the windows, over stretches and over anchors, need no other order of rows.
    ranked = places.repartition("key").withColumn("rank", F.rank().over(same)).withColumn("row", F.row_number().over(same))
    ranked = ranked.withColumn("different", F.sum(((F.col("row") == 1) & ~F.col("again")).cast("long")).over(Window.partitionBy("key")))
    ranked = ranked.withColumn("again", F.col("again") | (F.col("rank") > 1))
    runs = materialize(ranked.where("again or (row = 1 and different > 1)").drop("content", "row", "rank"), "runs")

    # Equal stretches: all strings of all but the first one go.
    end = F.col("first") + F.col("count") + (length - 1)
    copies = runs.where("again").select("tid", F.col("first").cast("long").alias("start"), end.cast("long").alias("end"))

    # Different stretches at one anchor: sorted together, or string by string where they are very many.
    leads, few = runs.where("not again"), F.col("different") <= crowded
    size = F.when(few, F.col("count") + (length - 1))
    total, many = leads.agg(F.sum(size), F.count(F.when(~few, True))).first()
    if total is None and not many:
        return copies
    shards = max(1, -(-int(total or 0) // shard_bytes))
    dealt = _cut(docs, leads.where(few), length).withColumn("shard", F.pmod(hash64("key"), F.lit(shards)))
    sorted_out = dealt.groupBy("shard").applyInArrow(_sorter(length, width), "tid long, start long, end long")
    if not many:
        return copies.union(sorted_out)

    single = _cut(docs, leads.where(~few), length).select("doc_id", "tid", "first", "stretch", F.explode(F.sequence(F.lit(0), F.col("count") - 1)).alias("at"))
    single = single.select("doc_id", "tid", (F.col("first") + F.col("at")).cast("long").alias("start"), F.md5(F.substring("stretch", F.col("at") + 1, F.lit(length))).alias("string"))
    single = materialize(single, "strings")
    earliest = single.groupBy("string").agg(F.min(F.struct("doc_id", "tid", "start")).alias("lead"))
    late = single.join(earliest, "string").where((F.col("tid") != F.col("lead.tid")) | (F.col("start") != F.col("lead.start")))
    late = late.select("tid", "start", (F.col("start") + length).alias("end"))
    return copies.union(sorted_out).union(late)


def remove_repeats(docs: DataFrame, length: int = LENGTH, width: int = ANCHOR, shard_bytes: int = SHARD_BYTES, crowded: int = CROWDED) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans)``, one row per row of ``docs``.

    Strings are bytes of the UTF-8 text, never across documents; earlier means a smaller
    doc_id (NULL first), or an earlier place in the same document. A NULL text is empty;
    texts below ``length`` bytes lose nothing. Rows equal in doc_id and text are one
    document, reported for each row; rows that share a doc_id with other texts are ordered
    by a hash. Other columns play no part.
    """
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    known = known.withColumn("tid", hash64("doc_id", "text"))
    # Copies of a whole text lose everything; only the first of them is looked at further.
    small = materialize(known.select("doc_id", "tid", F.octet_length("text").alias("size"), F.md5(F.col("text").cast("binary")).alias("whole")), "texts")
    first = small.groupBy("whole", "size").agg(F.min(F.struct("doc_id", "tid")).alias("lead"))
    first = materialize(first, "wholes")
    extra = materialize(small.join(first, ["whole", "size"]).where(F.col("tid") != F.col("lead.tid")).select("tid").distinct(), "copies")
    originals = known.join(_few(extra), "tid", "left_anti").where(F.octet_length("text") >= length)
    ranges = materialize(removed_ranges(originals, length, width, shard_bytes, crowded), "ranges")
    by_text = materialize(ranges.groupBy("tid").agg(F.collect_list(F.struct("start", "end")).alias("ranges")), "by-text")
    touched = _few(by_text.select("tid"))
    cut = known.join(touched, "tid", "left_semi").join(by_text, "tid").select("doc_id", "text", "ranges").mapInArrow(_remover, RESULT)
    size = F.octet_length("text").cast("long")
    copy = F.col("copy").isNotNull() & (size >= length)
    nothing = F.array().cast("array<struct<start:bigint,end:bigint>>")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), size.alias("end")))
    other = known.join(touched, "tid", "left_anti").join(_few(extra).withColumn("copy", F.lit(True)), "tid", "left")
    other = other.select(
        "doc_id",
        size.alias("n_bytes"),
        F.when(copy, size).otherwise(F.lit(0)).cast("long").alias("n_removed"),
        copy.cast("long").alias("n_spans"),
        F.sha2(F.when(copy, F.lit("")).otherwise(F.col("text")), 256).alias("kept_sha256"),
        F.when(copy, whole).otherwise(nothing).alias("spans"),
    )
    return cut.union(other)
