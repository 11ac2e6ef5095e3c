"""Packing token pieces into windows by non-negative least squares.

Tasks pack blocks of documents on their own: no shuffle, and what is left over at the end
of a block is small against the block. In a block, documents longer than the window first
give off whole windows. The histogram of the remaining lengths is then covered by shallow
combinations (one, two or three lengths that fill the window exactly): how often each
combination is used is the non-negative solution that comes nearest to the histogram,
rounded while lengths last. What the rounding leaves over is packed greedily, one piece
after the other, cut where a window ends.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelake.llm.common import once

WINDOW = 2048
END_OF_TEXT = 1
ID = np.dtype("<u4")
# A block ends when it has this many tokens; memory of a task is a small multiple of that.
BLOCK_TOKENS = 16_000_000
ROUNDS = 40
# Pieces of text whose ids a task remembers.
REMEMBERED = 500_000
PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


# Letters and digits below this code point are told apart here as the tokenizer does.
_LATIN = 0x250


def _class_of(kind: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(_LATIN) if unicodedata.category(chr(c))[0] == kind)


class Encoder:
    """Token ids of texts, by a tokenizer whose pieces of text repeat often.

    A tokenizer with word ends that splits its lower-cased text into runs of letters,
    single digits and runs of other characters gives a piece the same ids wherever it
    stands. For texts in Latin script the pieces are found here and encoded when they are
    new; other texts, and other tokenizers, are encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        normal = [n.get("type") for n in (parts.get("normalizer") or {}).get("normalizers", [])]
        splits = [p.get("pattern", {}).get("Regex") for p in (parts.get("pre_tokenizer") or {}).get("pretokenizers", [])]
        # The split and the steps before it that the pieces below follow.
        known = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
        self.by_piece = normal == ["NFC", "Replace", "Lowercase"] and splits[:1] == [known] and parts["model"].get("end_of_word_suffix") == "</w>"
        letters, digits, blanks = _class_of("L"), _class_of("N"), "\t\n\x0b\x0c\r \x85\xa0"
        self.pieces = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{digits}]|[^{blanks}{letters}{digits}]+")
        self.latin = re.compile(f"[\x00-{chr(_LATIN - 1)}]*")
        self.special = [t["content"] for t in parts.get("added_tokens", ())]
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        for token, number in vocabulary.items():
            self.ends[number] = token.endswith("</w>")
        self.known: dict[str, bytes] = {}

    def whole(self, text: str) -> list[int]:
        # The fast form leaves out places in the text, which nobody needs here.
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def learn(self, pieces: list[str]) -> None:
        """Encodes new pieces in one go; each ends with a token that ends a word."""
        ids = np.array(self.whole(" ".join(pieces)), dtype=ID)
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) == len(pieces) and stops[-1] == len(ids):
            raw, cuts = ids.tobytes(), (ID.itemsize * np.append(0, stops)).tolist()
            found = [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        else:
            found = [np.array(self.whole(p), dtype=ID).tobytes() for p in pieces]
        self.known.update(zip(pieces, found, strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The texts' ids, little-endian; pieces that are new in any of them are learnt together."""
        split: list[list[str] | None] = []
        met: set[str] = set()
        for text in texts:
            plain = self.by_piece and self.latin.fullmatch(text) and unicodedata.is_normalized("NFC", text)
            if plain and not any(s in text for s in self.special):
                split.append(self.pieces.findall(text.lower()))
                met.update(split[-1])
            else:
                split.append(None)
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = list(met.difference(self.known))
        if new:
            self.learn(new)
        get = self.known.__getitem__
        return [
            np.array(self.whole(text), dtype=ID).tobytes() if pieces is None else b"".join(map(get, pieces))
            for text, pieces in zip(texts, split, strict=True)
        ]


def combinations(lengths: np.ndarray, window: int) -> np.ndarray:
    """Index triples into ascending ``lengths`` that add up to ``window``; -1 stands for no length."""
    at = np.full(window + 1, -1, dtype=np.int64)
    at[lengths] = np.arange(len(lengths))
    found = []
    if at[window] >= 0:
        found.append(np.array([[at[window], -1, -1]]))
    partner = window - lengths
    second = np.where(partner > 0, at[np.clip(partner, 0, window)], -1)
    pairs = np.flatnonzero((second >= 0) & (lengths <= partner))
    found.append(np.stack([pairs, second[pairs], np.full(len(pairs), -1)], axis=1))
    for i, first in enumerate(lengths):
        if 3 * first > window:
            break
        middle = lengths[i:]
        third = window - first - middle
        middle = middle[third >= middle]
        rest = at[window - first - middle]
        good = np.flatnonzero(rest >= 0)
        found.append(np.stack([np.full(len(good), i), i + good, rest[good]], axis=1))
    return np.concatenate(found)


def least_squares(members: np.ndarray, target: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Counts >= 0 of the combinations (rows of ``members``) whose total use comes nearest to ``target``.

    Accelerated projected gradient steps. The step is the inverse of a bound on the
    curvature: the largest product of a row's members and their combinations.
    """
    size = len(target)
    slots = np.where(members >= 0, members, size)

    def use(x: np.ndarray) -> np.ndarray:
        return np.bincount(slots.ravel(), np.repeat(x, slots.shape[1]), size + 1)[:size]

    x = np.zeros(len(members))
    if not len(members):
        return x
    degree = np.append(use(np.ones(len(members))), 0.0)
    step = 1.0 / degree[slots].sum(axis=1).max()
    goal = np.append(target, 0.0)
    y, t = x, 1.0
    for _ in range(rounds):
        short = goal - np.append(use(y), 0.0)
        short[size] = 0.0
        new = np.maximum(0.0, y + step * short[slots].sum(axis=1))
        t_next = (1.0 + np.sqrt(1.0 + 4.0 * t * t)) / 2.0
        y = new + (t - 1.0) / t_next * (new - x)
        x, t = new, t_next
    return x


def rounded(members: np.ndarray, counts: np.ndarray, stock: np.ndarray) -> list[tuple[list[int], int]]:
    """Whole numbers of each combination, largest first, rounded up while the stock of lengths lasts."""
    # One more place stands for "no length" and never runs out.
    left = np.append(stock, np.iinfo(np.int64).max // 2)
    order = np.argsort(-counts, kind="stable")
    order = order[counts[order] > 1e-9]
    used = []
    for i in range(0, len(order), 1024):
        rows = order[i : i + 1024]
        # Most combinations of a late block lack a length by then.
        for row in rows[(left[members[rows]] > 0).all(axis=1)].tolist():
            parts = [p for p in members[row].tolist() if p >= 0]
            need = {p: parts.count(p) for p in parts}
            times = min(int(np.ceil(counts[row])), *(int(left[p]) // n for p, n in need.items()))
            if times > 0:
                used.append((parts, times))
                for p, n in need.items():
                    left[p] -= n * times
    return used


def place(lengths: np.ndarray, window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(document, start, length, sequence, offset)`` for documents of these token counts.

    Sequences are numbered from 0 and full, but for those of the last, cut-off window:
    it is split into sequences of powers of two, which need no padding.
    """
    pieces, sequence = [], 0
    rest: dict[int, list[tuple[int, int]]] = {}
    for doc, total in enumerate(lengths.tolist()):
        whole = total // window
        for k in range(whole):
            pieces.append((doc, k * window, window, sequence, 0))
            sequence += 1
        if total % window:
            rest.setdefault(total % window, []).append((doc, whole * window))
    sizes = np.array(sorted(rest), dtype=np.int64)
    stock = np.array([len(rest[s]) for s in sizes.tolist()], dtype=np.int64)
    members = combinations(sizes, window) if len(sizes) else np.empty((0, 3), dtype=np.int64)
    for parts, times in rounded(members, least_squares(members, stock.astype(float)), stock):
        for _ in range(times):
            offset = 0
            for p in parts:
                size = int(sizes[p])
                doc, start = rest[size].pop()
                pieces.append((doc, start, size, sequence, offset))
                offset += size
            sequence += 1
    left = [(doc, start, size) for size in sorted(rest, reverse=True) for doc, start in rest[size]]
    total = sum(size for _, _, size in left)
    tail = total % window
    ends = [window] * (total // window) + [1 << b for b in reversed(range(window.bit_length())) if tail >> b & 1]
    room, offset, at = (ends[0] if ends else 0), 0, 0
    for doc, start, size in left:
        while size:
            part = min(size, room - offset)
            pieces.append((doc, start, part, sequence, offset))
            start, size, offset = start + part, size - part, offset + part
            if offset == room:
                at, sequence, offset = at + 1, sequence + 1, 0
                room = ends[at] if at < len(ends) else 0
    return pieces


def _packer(tokenizer_path: str, window: int, block_tokens: int):
    """A function from batches of (doc_id, text) to batches of pieces."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = once(("packing", tokenizer_path), lambda: Encoder(tokenizer_path))
        end = np.array([END_OF_TEXT], dtype=ID).tobytes()
        # The partition's number makes sequence ids unique; a lost task makes the same ones again.
        first = TaskContext.get().partitionId() << 36
        ids, docs, held = [], [], 0

        def block() -> Iterator[pa.RecordBatch]:
            nonlocal first, ids, docs, held
            lengths = np.array([len(x) // ID.itemsize for x in ids], dtype=np.int64)
            pieces = place(lengths, window)
            for i in range(0, len(pieces), 4096):
                part = pieces[i : i + 4096]
                doc, start, length, sequence, offset = (np.array(c, dtype=np.int64) for c in zip(*part, strict=True))
                cut = [ids[d][ID.itemsize * s : ID.itemsize * (s + n)] for d, s, n, _, _ in part]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([docs[d] for d in doc], pa.int64()), pa.array(start), pa.array(length), pa.array(cut, pa.binary()), pa.array(lengths[doc]), pa.array(sequence + first), pa.array(offset)],
                    names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
                )
            first += max((p[3] for p in pieces), default=-1) + 1
            ids, docs, held = [], [], 0

        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                for one in encoder.encode([text or "" for text in part.column("text").to_pylist()]):
                    ids.append(one + end)
                    held += len(ids[-1]) // ID.itemsize
                docs += part.column("doc_id").to_pylist()
                if held >= block_tokens:
                    yield from block()
        if ids:
            yield from block()

    return pack


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per piece of ``docs`` (``doc_id``, ``text``): its token ids and its place.

    A document is its text's ids and the end id; a NULL or empty text is the end id alone.
    Rows that repeat, and rows without doc_id, are packed like any other. ``ids`` are
    little-endian unsigned 32-bit numbers. Other columns play no part.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return slim.mapInArrow(_packer(tokenizer_path, window, block_tokens), PIECES)
