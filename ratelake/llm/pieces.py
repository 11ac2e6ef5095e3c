"""Encoding and decoding by a sentencepiece BPE model, in vectorised merge rounds.

The words of many texts lie behind each other in flat arrays of symbols. In each round every
word finds the least rank among its pairs of neighbours, merges all places of that rank at
once (of places that overlap the left one), and the arrays are compacted. A word without
pairs leaves; the rounds end when none is left.

That equals merging one pair at a time, best rank first and then from the left, unless a
merge makes a pair that is as good or better than the one just merged: it would have come
before the other places of the round. Such words (runs of blanks, mostly) are recognised in
their round and finished one merge after another from a heap.
"""

from __future__ import annotations

import codecs
import heapq
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelake.llm.common import once

# The model's sign for a blank.
SPACE = "▁"
NO_PAIR = np.int32(np.iinfo(np.int32).max)
ID = np.dtype("<u4")
# Words whose ids a task remembers, and the longest of them.
REMEMBERED, LONGEST = 400_000, 64
# Characters of text taken together.
CHUNK = 2_000_000


class PieceModel:
    """The vocabulary of a model file as flat tables.

    Accepted are models as the class needs them: BPE with byte fallback, texts taken as they
    are, with a blank in front, and blanks only at the start of pieces; others are an error.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.begin, self.end, self.unknown = model.bos_id(), model.eos_id(), model.unk_id()
        names = [model.id_to_piece(i) for i in range(size)]
        special = {i for i in range(size) if model.is_control(i) or model.is_unknown(i)}
        bytes_at = {int(n[3:5], 16): i for i, n in enumerate(names) if model.is_byte(i)}
        probe = "  a ｆ\n"
        if len(bytes_at) != 256 or model.decode(model.encode(probe)) != probe or any(model.is_unused(i) for i in range(size)):
            raise ValueError(f"{path} is no piece model with byte fallback that keeps texts as they are")
        self.byte_ids = np.array([bytes_at[b] for b in range(256)], dtype=ID)
        ordinary = {n: i for i, n in enumerate(names) if i not in special and not model.is_byte(i)}
        if any(SPACE in n.lstrip(SPACE) for n in ordinary):
            raise ValueError(f"{path} has pieces that hold more than one word")
        scores = sorted({-model.get_score(i) for i in ordinary.values()})
        rank = {s: r for r, s in enumerate(scores)}

        # What ids stand for, in bytes; the special ones stand for nothing, the unknown one for its sign.
        self.surface = [b"" if i in special else n.replace(SPACE, " ").encode() for i, n in enumerate(names)]
        for b, i in bytes_at.items():
            self.surface[i] = bytes([b])
        self.surface[self.unknown] = " ⁇ ".encode()
        self.special = special - {self.unknown}

        # Symbols: ids, and behind them numbers for characters that only occur inside pieces.
        letters = sorted({c for n in ordinary for c in n})
        symbol = dict(ordinary)
        for c in letters:
            symbol.setdefault(c, size + len(symbol))
        self.size, self.span = size, size + len(symbol) + 1
        self.codes = np.array([ord(c) for c in letters], dtype=np.int64)
        self.symbols = np.array([symbol[c] for c in letters], dtype=np.int32)
        pairs, inner = {}, set()
        for name, number in ordinary.items():
            for k in range(1, len(name)):
                inner.add((ord(name[k - 1]) << 21) | ord(name[k]))
                left, right = symbol.get(name[:k]), symbol.get(name[k:])
                if left is not None and right is not None:
                    pairs[left * self.span + right] = (rank[-model.get_score(number)], number)
        order = sorted(pairs)
        self.pair_keys = np.array(order, dtype=np.int64)
        self.pair_ranks = np.array([pairs[k][0] for k in order], dtype=np.int32)
        self.pair_made = np.array([pairs[k][1] for k in order], dtype=np.int32)
        # Neighbours that stand in some piece; between others no merge can ever reach across.
        self.inner = np.array(sorted(inner), dtype=np.int64)
        self.pairs = pairs

    def letters(self, codes: np.ndarray) -> np.ndarray:
        """Symbols of characters; -1 where no piece holds the character."""
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, self.symbols[at], np.int32(-1))

    def pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and made symbol of neighbours."""
        keys = left.astype(np.int64) * self.span + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        hit = (self.pair_keys[at] == keys) & (left >= 0) & (right >= 0)
        return np.where(hit, self.pair_ranks[at], NO_PAIR), np.where(hit, self.pair_made[at], np.int32(-1))


def _one_by_one(model: PieceModel, symbols: list[int]) -> tuple[list[int], list[int]]:
    """The merges of one stretch from a heap: places and symbols of what is left."""
    n, span, pairs = len(symbols), model.span, model.pairs
    following, previous = list(range(1, n + 1)), list(range(-1, n - 1))
    heap: list[tuple[int, int, int, int, int]] = []

    def offer(i: int) -> None:
        j = following[i]
        if j < n and symbols[i] >= 0 and symbols[j] >= 0:
            found = pairs.get(symbols[i] * span + symbols[j])
            if found:
                heapq.heappush(heap, (found[0], i, symbols[i], symbols[j], found[1]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, left, right, made = heapq.heappop(heap)
        j = following[i]
        # A symbol that was merged away is -2; one that grew differs from the entry.
        if j >= n or symbols[i] != left or symbols[j] != right:
            continue
        symbols[i], symbols[j] = made, -2
        following[i] = following[j]
        if following[i] < n:
            previous[following[i]] = i
        offer(i)
        if previous[i] >= 0:
            offer(previous[i])
    places, i = [], 0
    while i < n:
        places.append(i)
        i = following[i]
    return places, [symbols[i] for i in places]


def merge_rounds(model: PieceModel, symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Final symbols: at a symbol's first character its number, elsewhere -2.

    ``starts`` tells which characters begin a stretch; no merge reaches across.
    """
    final = np.full(len(symbols), -2, dtype=np.int32)
    sym, at, seg = symbols.copy(), np.arange(len(symbols)), np.cumsum(starts) - 1
    ranks, made = np.full(len(sym), NO_PAIR), np.full(len(sym), -1, dtype=np.int32)
    if len(sym) > 1:
        ranks[:-1], made[:-1] = model.pair(sym[:-1], sym[1:])
        ranks[:-1][seg[1:] != seg[:-1]] = NO_PAIR
    while len(sym):
        first = np.flatnonzero(np.r_[True, seg[1:] != seg[:-1]])
        sizes = np.diff(np.r_[first, len(sym)])
        least = np.repeat(np.minimum.reduceat(ranks, first), sizes)
        going = least != NO_PAIR
        if not going.all():
            done = ~going
            final[at[done]] = sym[done]
            sym, at, seg, ranks, made, least = (x[going] for x in (sym, at, seg, ranks, made, least))
            if not len(sym):
                break
        # Places of the least rank; of neighbouring ones every second, from the left.
        place = np.flatnonzero(ranks == least)
        fresh = np.r_[True, np.diff(place) != 1]
        since = np.arange(len(place)) - np.maximum.accumulate(np.where(fresh, np.arange(len(place)), 0))
        place = place[since % 2 == 0]
        grown = made[place]

        # Would a merge make a pair that is due before the places to the right of it?
        limit = least[place]
        right = np.minimum(place + 2, len(sym) - 1)
        beside = (place + 2 < len(sym)) & (seg[right] == seg[place])
        early = beside & (model.pair(grown, sym[right])[0] <= limit)
        left = np.maximum(place - 1, 0)
        behind = np.zeros(len(place), dtype=bool)
        behind[1:] = place[1:] - place[:-1] == 2
        before = np.where(behind, np.r_[np.int32(-1), grown[:-1]], sym[left])
        beside = (place > 0) & (seg[left] == seg[place])
        early |= beside & (model.pair(before, grown)[0] <= limit)
        if early.any():
            apart = np.isin(seg, seg[place[early]])
            edges = np.flatnonzero(np.r_[True, seg[apart][1:] != seg[apart][:-1]])
            for one, where in zip(np.split(sym[apart], edges[1:]), np.split(at[apart], edges[1:]), strict=True):
                kept, numbers = _one_by_one(model, one.tolist())
                final[where[kept]] = numbers
            place_kept = ~apart[place]
            renumber = np.cumsum(~apart) - 1
            place, grown = renumber[place[place_kept]], grown[place_kept]
            sym, at, seg, ranks, made = (x[~apart] for x in (sym, at, seg, ranks, made))
            if not len(sym):
                break

        sym[place] = grown
        stay = np.ones(len(sym), dtype=bool)
        stay[place + 1] = False
        changed = np.zeros(len(sym), dtype=bool)
        changed[place] = True
        sym, at, seg, ranks, made, changed = (x[stay] for x in (sym, at, seg, ranks, made, changed))
        # Pairs that begin with a new symbol or end with one.
        changed[:-1] |= changed[1:].copy()
        look = np.flatnonzero(changed)
        inside = look[look + 1 < len(sym)]
        inside = inside[seg[inside] == seg[inside + 1]]
        ranks[look], made[look] = NO_PAIR, -1
        ranks[inside], made[inside] = model.pair(sym[inside], sym[inside + 1])
    return final


def encode_words(model: PieceModel, words: list[str]) -> list[bytes]:
    """Ids (little-endian, 32 bits) of words, each encoded on its own; blanks stand for the model's sign."""
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").astype(np.int64)
    codes[codes == 0x20] = ord(SPACE)
    ends = np.cumsum(lengths)
    starts = np.zeros(len(codes), dtype=bool)
    starts[(ends - lengths)[lengths > 0]] = True
    if len(codes) > 1:
        keys = (codes[:-1] << 21) | codes[1:]
        at = np.minimum(np.searchsorted(model.inner, keys), len(model.inner) - 1)
        starts[1:] |= model.inner[at] != keys
    final = merge_rounds(model, model.letters(codes), starts)
    place = np.flatnonzero(final != -2)
    number = final[place]
    # A character that is no piece becomes its bytes.
    spelt = (number < 0) | (number >= model.size)
    letters = [chr(c).encode() for c in codes[place[spelt]].tolist()]
    counts = np.ones(len(place), dtype=np.int64)
    counts[spelt] = [len(b) for b in letters]
    ids = np.repeat(number, counts).astype(ID)
    ids[np.repeat(spelt, counts)] = model.byte_ids[np.frombuffer(b"".join(letters), dtype=np.uint8)]
    upto = np.r_[0, np.cumsum(counts)]
    cuts = (4 * upto[np.searchsorted(place, np.r_[0, ends])]).tolist()
    joined = ids.tobytes()
    return [joined[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


class PieceEncoder:
    """Ids of texts. Words that were met before are taken from a bounded memory."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.words = re.compile(" +[^ ]*")
        self.known: dict[str, bytes] = {}

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text, without begin and end."""
        held: list[list[str]] = []
        size = 0
        for text in texts:
            # A text that is not empty gets a blank in front.
            held.append(self.words.findall(" " + text.replace(SPACE, " ")) if text else [])
            size += len(text)
            if size >= CHUNK:
                yield from self._joined(held)
                held, size = [], 0
        yield from self._joined(held)

    def _joined(self, split: list[list[str]]) -> Iterator[bytes]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        met: set[str] = set()
        met.update(*split)
        new = list(met.difference(self.known))
        self.known.update(zip(new, encode_words(self.model, new), strict=True))
        get = self.known.__getitem__
        yield from [b"".join(map(get, words)) for words in split]
        for word in new:
            if len(word) > LONGEST:
                del self.known[word]


def _replace_each(error: UnicodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


def decode(model: PieceModel, ids: bytes) -> str:
    """The text of ids: special ones go, the blank in front goes, bytes that form no character become U+FFFD each."""
    numbers = np.frombuffer(ids, dtype=ID).tolist()
    # Bytes on both sides of a special id form no character together.
    runs: list[list[int]] = [[]]
    if model.special.isdisjoint(numbers):
        runs = [numbers]
    else:
        for i in numbers:
            if i in model.special:
                runs.append([])
            else:
                runs[-1].append(i)
        runs = [r for r in runs if r]
    texts = []
    for run in runs:
        raw = b"".join(map(model.surface.__getitem__, run))
        # Only a piece's blank is the one put in front; the byte of a blank is text.
        if not texts and raw[:1] == b" " and run[0] != model.unknown and run[0] not in model.byte_ids:
            raw = raw[1:]
        try:
            texts.append(raw.decode())
        except UnicodeDecodeError:
            codecs.register_error("each-byte", _replace_each)
            texts.append(raw.decode("utf-8", "each-byte"))
    return "".join(texts)


def _encoder(path: str, ends: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = once(("pieces", path), lambda: PieceEncoder(PieceModel(path)))
        model = encoder.model
        head, tail = (np.array([i], dtype=ID).tobytes() if ends and i >= 0 else b"" for i in (model.begin, model.end))
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                ids = [head + x + tail for x in encoder.encode(t or "" for t in part.column("text").to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return run


def _decoder(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = once(("pieces", path), lambda: PieceEncoder(PieceModel(path))).model
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                texts = [decode(model, x or b"") for x in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("ids"), pa.array(texts, pa.string())], names=["doc_id", "ids", "text"]
                )

    return run


def encode_texts(docs: DataFrame, model_path: str, ends: bool = True) -> DataFrame:
    """``(doc_id, ids)``: the ids of each row's whole text as little-endian unsigned 32-bit numbers.

    ``ends`` adds the begin and end ids. A NULL text is encoded like an empty one; rows that
    repeat, or have no doc_id, are encoded like any other. Other columns play no part.
    No rows are moved; a task holds one batch of rows and its bounded memory of words.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return slim.mapInArrow(_encoder(model_path, ends), "doc_id long, ids binary")


def decode_ids(encoded: DataFrame, model_path: str) -> DataFrame:
    """``(doc_id, ids, text)``: the text that the ids of each row stand for; NULL ids stand for none."""
    slim = encoded.select("doc_id", "ids")
    return slim.mapInArrow(_decoder(model_path), "doc_id long, ids binary, text string")
