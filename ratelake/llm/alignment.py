"""Alignment of two tokenizers over the same texts, and how often their ids end together.

Tokens are compared by the byte offsets at which they end. The shorter of two ascending lists
of ends drives a galloping search through the longer: steps double from where the end is
expected until it is passed, a binary search follows. All ends of many documents gallop side
by side in flat arrays. Ends found in both lists cut the tokens into groups; differences of
the ranks on the way tell which tokens of the other side a token overlaps.

Two tokens that end together hold the same bytes at their ends, so one is the end of the
other. The id pairs that can ever be linked are therefore known from the vocabularies alone
(each token with those of its endings that the other vocabulary has), and their number does
not grow with the corpus. Counts over the corpus are kept by pair number in one array of
that length; only this array is ever gathered and broadcast.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelake.llm.common import once
from ratelake.llm.pieces import ID, SPACE, PieceEncoder, PieceModel
from ratelake.session import materialize

# Bytes of text aligned together.
CHUNK = 500_000
# The split before the merges that byte-level tokenizers of this form share (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
ALIGNED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_overlaps long, groups_sha256 string, links array<int>"
)


def _byte_letters() -> dict[str, int]:
    """Letters that byte-level vocabularies write bytes with: printable ones as they are, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(others)}


class ByteTokens:
    """Encoding by a byte-level BPE file; special tokens' strings are plain text.

    A file whose ids follow the order of its merges is run by its ranks, which is faster and
    gives the same ids; any other one by its own library.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        letters = _byte_letters()
        special = {t["content"] for t in parts.get("added_tokens", ())}
        vocabulary = parts["model"]["vocab"]
        ranks = {bytes(letters[c] for c in t): i for t, i in vocabulary.items() if t not in special}
        self.bytes_of = [b""] * (max(vocabulary.values()) + 1)
        for token, i in ranks.items():
            self.bytes_of[i] = token
        merges = [m if isinstance(m, list) else m.split(" ") for m in parts["model"].get("merges", ())]
        made = [vocabulary[a + b] for a, b in merges]
        before = parts.get("pre_tokenizer") or {}
        in_order = made == sorted(made) and len(made) + 256 == len(ranks)
        plain = before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True)
        self.encode: Callable[[str], list[int]]
        # Whether the tokens of any text hold exactly its bytes.
        self.exact = False
        if in_order and plain and not parts.get("normalizer") and not parts["model"].get("ignore_merges"):
            import tiktoken

            self.exact = True
            self.encode = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        else:
            from tokenizers import Tokenizer

            own = Tokenizer.from_file(path)
            own.no_truncation()
            own.no_padding()
            own.encode_special_tokens = True
            self.encode = lambda text: own.encode(text, add_special_tokens=False).ids


class Pair:
    """Both tokenizers and the numbers of the id pairs that can be linked."""

    def __init__(self, byte_path: str, piece_path: str):
        self.a = ByteTokens(byte_path)
        self.b = PieceEncoder(PieceModel(piece_path))
        a_bytes, b_bytes = self.a.bytes_of, self.b.model.surface
        self.a_lengths = np.array([len(t) for t in a_bytes], dtype=np.int64)
        self.b_lengths = np.array([len(t) for t in b_bytes], dtype=np.int64)
        self.span = len(b_bytes)
        # Several ids may stand for the same bytes (a letter and its byte).
        a_ids, b_ids = _ids_by_bytes(a_bytes), _ids_by_bytes(b_bytes)
        pairs = set()
        for own, other, flip in ((a_ids, b_ids, False), (b_ids, a_ids, True)):
            for token, ids in own.items():
                for k in range(len(token)):
                    for j in other.get(token[k:], ()):
                        pairs.update(j * self.span + i if flip else i * self.span + j for i in ids)
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.b_of = self.keys % self.span
        # Written forms, each with what may follow: another token of the side, or its end.
        self.written = [f"{i}{sign}" for i in range(len(a_bytes)) for sign in ",|"] + [f"{i}{sign}" for i in range(self.span) for sign in ",;"]

    def numbers(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Numbers of id pairs that end together."""
        return np.searchsorted(self.keys, a.astype(np.int64) * self.span + b)


def _ids_by_bytes(tokens: list[bytes]) -> dict[bytes, list[int]]:
    found: dict[bytes, list[int]] = {}
    for i, t in enumerate(tokens):
        if t:
            found.setdefault(t, []).append(i)
    return found


def _gallop_from(low: np.ndarray, wanted: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Ranks of the wanted values: steps double away from ``low`` until a value is passed, then brackets are halved."""
    n = len(ends)
    forward = ends[low] < wanted
    # Everything before low is below, nothing from high on is.
    low, high = low.copy(), low.copy()
    going, step = np.flatnonzero(forward), 1
    while len(going):
        reach = np.minimum(low[going] + step, n)
        passed = (reach == n) | (ends[np.minimum(reach, n - 1)] >= wanted[going])
        high[going] = reach
        low[going[~passed]] = reach[~passed]
        going, step = going[~passed], 2 * step
    going, step = np.flatnonzero(~forward), 1
    while len(going):
        reach = np.maximum(high[going] - step, 0)
        passed = (reach == 0) | (ends[reach] < wanted[going])
        low[going] = reach
        high[going[~passed]] = reach[~passed]
        going, step = going[~passed], 2 * step
    return _halve(low, high, wanted, ends)


def _halve(low: np.ndarray, high: np.ndarray, wanted: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Binary search of each wanted value between its ``low`` and ``high``."""
    low = low.copy()
    step = 1 << int((high - low).max(initial=0)).bit_length()
    while step > 1:
        step //= 2
        reach = low + (step - 1)
        np.minimum(reach, len(ends) - 1, out=reach)
        below = ends[reach] < wanted
        below &= low + step <= high
        low += step * below
    return low


# Of so many wanted values one gallops; those between two of them only search between their ranks.
STRIDE = 16


def gallop(wanted: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many of the ascending ``ends`` are below each of the ascending ``wanted``."""
    n, m = len(ends), len(wanted)
    if not n or not m:
        return np.zeros(m, dtype=np.int64)
    coarse = np.arange(0, m, STRIDE)
    # The start: where the value would stand if both lists were spread alike.
    ranks = _gallop_from(coarse * n // m, wanted[coarse], ends)
    low = np.repeat(ranks, STRIDE)[:m]
    high = np.repeat(np.r_[ranks[1:], n], STRIDE)[:m]
    # The values behind the last galloping one have no upper rank yet.
    tail = coarse[-1]
    low[tail:] = _gallop_from(np.minimum(low[tail:], n - 1), wanted[tail:], ends)
    low[:tail] = _halve(low[:tail], high[:tail], wanted[:tail], ends)
    return low


def common_ends(short: np.ndarray, ranks: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in both lists of the ends that both have, from the ranks of the shorter list's ends in the longer."""
    if not len(long):
        return ranks, ranks
    hit = np.flatnonzero(long[np.minimum(ranks, len(long) - 1)] == short)
    hit = hit[ranks[hit] < len(long)]
    return hit, ranks[hit]


def overlap_ranges(ranks: np.ndarray, met: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last token of the longer side that each token of the shorter side shares a byte with.

    Both sides cover the same bytes, and ``met`` are the shorter side's tokens that end where
    one of the longer side ends. As many ends lie below a token's end as tokens come before its
    last partner. Its first partner is the one before it had last, or the next one if they met.
    """
    after = ranks.copy()
    after[met] += 1
    return np.r_[0, after[:-1]][: len(ranks)], ranks


def align(pair: Pair, texts: list[str]) -> tuple[list[np.ndarray], list[tuple[int, int, int, int, int]], list[str]]:
    """For each text its links (pair numbers), its counts and its groups as text.

    The counts are tokens of both sides, groups, links and overlapping token pairs. Texts that
    are empty, or that a tokenizer does not give back byte by byte, have no tokens.
    """
    none = np.zeros(0, dtype=np.int32)
    links, counts, groups = [none] * len(texts), [(0, 0, 0, 0, 0)] * len(texts), [""] * len(texts)
    kept, a_all, b_all, sizes = [], [], [], []
    for k, (text, b_ids) in enumerate(zip(texts, pair.b.encode(texts), strict=True)):
        # Piece models as accepted here give back every text but for their own sign of a blank.
        if not text or SPACE in text:
            continue
        want = f" {text}".encode()
        a = pair.a.encode(f" {text}")
        if not pair.a.exact and b"".join(map(pair.a.bytes_of.__getitem__, a)) != want:
            continue
        kept.append(k)
        a_all.append(np.array(a, dtype=np.int64))
        b_all.append(np.frombuffer(b_ids, dtype=ID).astype(np.int64))
        sizes.append(len(want))
    if not kept:
        return links, counts, groups
    # Offsets run on from text to text, so that all of them are searched at once.
    a, b = np.concatenate(a_all), np.concatenate(b_all)
    a_ends, b_ends = np.cumsum(pair.a_lengths[a]), np.cumsum(pair.b_lengths[b])
    flip = len(a) > len(b)
    short, long = (b_ends, a_ends) if flip else (a_ends, b_ends)
    ranks = gallop(short, long)
    met, place = common_ends(short, ranks, long)
    first, last = overlap_ranges(ranks, met)
    in_a, in_b = (place, met) if flip else (met, place)
    numbers = pair.numbers(a[in_a], b[in_b]).astype(np.int32)
    # The written form has the a side of a group before its b side.
    a_last, b_last = np.zeros(len(a), dtype=np.int64), np.zeros(len(b), dtype=np.int64)
    a_last[in_a], b_last[in_b] = 1, 1
    a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
    order = np.empty(len(a) + len(b), dtype=np.int64)
    order[np.arange(len(a)) + np.r_[0, in_b + 1][a_group]] = 2 * a + a_last
    order[np.arange(len(b)) + in_a[b_group] + 1] = 2 * len(pair.a_lengths) + 2 * b + b_last
    upto = np.cumsum(sizes)
    a_upto = np.r_[0, np.searchsorted(a_ends, upto, side="right")]
    b_upto = np.r_[0, np.searchsorted(b_ends, upto, side="right")]
    g_upto = np.r_[0, np.searchsorted(in_a, a_upto[1:])]
    shared = np.r_[0, np.cumsum(last - first + 1)][b_upto if flip else a_upto]
    written = pair.written.__getitem__
    for n, k in enumerate(kept):
        a0, a1, b0, b1, g0, g1 = a_upto[n], a_upto[n + 1], b_upto[n], b_upto[n + 1], g_upto[n], g_upto[n + 1]
        links[k] = np.sort(numbers[g0:g1])
        counts[k] = (int(a1 - a0), int(b1 - b0), int(g1 - g0), int(g1 - g0), int(shared[n + 1] - shared[n]))
        groups[k] = "".join(map(written, order[a0 + b0 : a1 + b1].tolist()))[:-1]
    return links, counts, groups


def _aligner(byte_path: str, piece_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = once(("pair", byte_path, piece_path), lambda: Pair(byte_path, piece_path))

        def chunk(ids: list, texts: list[str]) -> pa.RecordBatch:
            links, counts, groups = align(pair, texts)
            digests = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
            numbers = [pa.array([c[i] for c in counts], pa.int64()) for i in range(5)]
            offsets = np.cumsum([0, *map(len, links)], dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(links), pa.int32()))
            names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_overlaps", "groups_sha256", "links"]
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *numbers, pa.array(digests, pa.string()), lists], names=names)

        for batch in batches:
            ids, texts, held = [], [], 0
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                ids += part.column("doc_id").to_pylist()
                texts += [t or "" for t in part.column("text").to_pylist()]
                held = sum(map(len, texts))
                if held >= CHUNK:
                    yield chunk(ids, texts)
                    ids, texts, held = [], [], 0
            if ids:
                yield chunk(ids, texts)

    return run


def _counter(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            numbers = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            total += np.bincount(numbers, minlength=size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["pair", "n"])

    return run


def _scorer(total, best):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, leads = total.value, best.value
        for batch in batches:
            lists = batch.column("links")
            offsets = lists.offsets.to_numpy()
            numbers = lists.values.to_numpy()[offsets[0] : offsets[-1]]
            upto, lead = np.r_[0, np.cumsum(counts[numbers])], np.r_[0, np.cumsum(leads[numbers], dtype=np.int64)]
            at = offsets - offsets[0]
            kept = [c for c in batch.schema.names if c != "links"]
            scores = [pa.array(np.diff(lead[at])), pa.array(np.diff(upto[at]))]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *scores], names=[*kept, "n_best", "count_sum"])

    return run


def pair_counts(aligned: DataFrame, size: int) -> DataFrame:
    """``(pair, n)``: how many links of all documents each id pair has. Tasks count into one array before the shuffle."""
    partial = aligned.select("links").mapInArrow(_counter(size), "pair long, n long")
    return partial.groupBy("pair").agg(F.sum("n").alias("n"))


def align_tokenizers(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """One row per row of ``docs``: its tokens, groups and links under both tokenizers, and their counts.

    Columns: ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_overlaps`` (token pairs
    that share a byte), ``groups_sha256``, ``n_best`` (links whose id pair is the most frequent
    of its b id in the corpus, ties included) and ``count_sum`` (of the counts of its links).

    NULL and empty texts, and texts that a tokenizer does not give back byte by byte, have zeros
    and an empty digest. Rows that repeat, or have no doc_id, count like any other; other columns
    play no part. The links are written once to the shared folder (sorted pair numbers, a few
    bytes a link). What is broadcast is one count per possible id pair, a number that the two
    vocabularies fix (see the module).
    """
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    aligned = materialize(slim.mapInArrow(_aligner(byte_path, piece_path), ALIGNED), "aligned")
    pair = once(("pair", byte_path, piece_path), lambda: Pair(byte_path, piece_path))
    total = np.zeros(len(pair.keys), dtype=np.int64)
    for row in pair_counts(aligned, len(pair.keys)).toPandas().itertuples(index=False):
        total[row.pair] = row.n
    highest = np.zeros(pair.span, dtype=np.int64)
    np.maximum.at(highest, pair.b_of, total)
    best = (total == highest[pair.b_of]) & (total > 0)
    shared = spark.sparkContext.broadcast(total), spark.sparkContext.broadcast(best)
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in aligned.schema if f.name != "links")
    return aligned.mapInArrow(_scorer(*shared), f"{kept}, n_best long, count_sum long")
