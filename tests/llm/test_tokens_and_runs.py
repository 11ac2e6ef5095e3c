"""Piece encoding, alignment of tokenizers, and periodic runs, against plainer forms of them."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from ratelake.llm import alignment, pieces, runs
from ratelake.llm.queries import QUERIES, tokenizer_file, with_periods

SMALL = "/root/testdata/sf0.001"
BYTES, PIECES = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
SCRAPS = ["a", "the", "ing", "er", " ", "  ", "\n", "\t", "é", "漢字", "▁", "\x00", "👍", "𝔘", "�", "12", " 3", "'s", "=", "<s>", "<0x41>", "<|endoftext|>", "ا", "aaa"]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def scraps(seed, n, most=40):
    rng = random.Random(seed)
    return ["".join(rng.choices(SCRAPS, k=rng.randint(0, most))) for _ in range(n)]


def texts():
    return [None, "", " ", "word", " " * 3000, "a" * 3000, "ha" * 2000, "x " * 5000, "漢" * 700, *scraps(1, 60)]


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel(PIECES)


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def test_merge_rounds_equal_the_library(model, library):
    made = scraps(2, 3000) + [t for t in texts() if t]
    got = [np.frombuffer(x, pieces.ID).tolist() for x in pieces.PieceEncoder(model).encode(made)]
    assert got == library.encode(made)


def test_words_with_equal_ranks_are_merged_one_by_one(model, library, monkeypatch):
    used = []
    one_by_one = pieces._one_by_one
    monkeypatch.setattr(pieces, "_one_by_one", lambda m, s: used.append(len(s)) or one_by_one(m, s))
    text = "a" + " " * 77 + "b"
    (ids,) = pieces.PieceEncoder(model).encode([text])
    assert used and np.frombuffer(ids, pieces.ID).tolist() == library.encode(text)


def test_long_words_and_blanks_stay_quick(model):
    rng = random.Random(3)
    long = [" " * 200_000, "a" * 200_000, "".join(rng.choices("abcdefgh", k=200_000))]
    for ids, text in zip(pieces.PieceEncoder(model).encode(long), long, strict=True):
        assert pieces.decode(model, ids) == text


def test_decoding_equals_the_library(model, library):
    rng = random.Random(4)
    odd = [0, 1, 2, 3, 4, 35, 133, 187, 200, 229, 259, 261, 28705, 28744]
    for _ in range(3000):
        ids = [rng.choice([*odd, rng.randrange(model.size)]) for _ in range(rng.randint(0, 7))]
        assert pieces.decode(model, np.array(ids, dtype=pieces.ID).tobytes()) == library.decode(ids), ids


def test_memory_of_words_is_bounded(model, library, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 5)
    monkeypatch.setattr(pieces, "CHUNK", 40)
    made = scraps(5, 200)
    encoder = pieces.PieceEncoder(model)
    assert [np.frombuffer(x, pieces.ID).tolist() for x in encoder.encode(made)] == library.encode(made)
    assert len(encoder.known) < 400


def test_other_models_are_refused(tmp_path):
    with pytest.raises((ValueError, OSError, RuntimeError)):
        pieces.PieceModel(str(tmp_path / "none.model"))


def test_encode_texts_on_rows(documents, cluttered, library):
    rows = [*enumerate(texts()), (0, "again"), (None, "no id"), (0, None)]
    out = pieces.decode_ids(pieces.encode_texts(cluttered(documents(*rows)), PIECES), PIECES).collect()
    assert len(out) == len(rows)
    want = Counter((i, tuple([1, *library.encode(t or ""), 2])) for i, t in rows)
    assert Counter((r.doc_id, tuple(np.frombuffer(bytes(r.ids), pieces.ID).tolist())) for r in out) == want
    assert all(r.text == library.decode(np.frombuffer(bytes(r.ids), pieces.ID).tolist()) for r in out)
    assert pieces.encode_texts(documents(), PIECES).count() == 0


def test_op11_query(spark, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    out = QUERIES["op11_piece_round_trip"](spark, SMALL).collect()
    assert len(out) == len(docs)
    for r in out:
        ids = library.encode(docs[r.doc_id], add_bos=True, add_eos=True)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


# -- alignment ---------------------------------------------------------------


def token_bytes(library):
    """Tokens of both sides with their bytes, from the libraries alone."""
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(BYTES)
    own.encode_special_tokens = True
    letters = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {chr(b): b for b in letters} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in letters)}

    def a(text):
        ids = own.encode(" " + text, add_special_tokens=False).ids
        return [(i, bytes(table[c] for c in own.id_to_token(i))) for i in ids]

    def b(text):
        names = [(i, library.id_to_piece(i)) for i in library.encode(text)]
        return [(i, bytes([int(n[3:5], 16)]) if library.is_byte(i) else n.replace("▁", " ").encode()) for i, n in names]

    return a, b


def aligned_plainly(a, b, text):
    """Links, counts and groups of one text by looking at all pairs of tokens."""
    if not text:
        return [], (0, 0, 0, 0, 0), ""
    left, right = a(text), b(text)
    want = (" " + text).encode()
    if b"".join(x for _, x in left) != want or b"".join(x for _, x in right) != want:
        return [], (0, 0, 0, 0, 0), ""

    def spans(tokens):
        at, out = 0, []
        for i, x in tokens:
            out.append((i, at, at + len(x)))
            at += len(x)
        return out

    left, right = spans(left), spans(right)
    links = [(i, j) for i, _, e in left for j, _, f in right if e == f]
    shared = sum(s < f and r < e for _, s, e in left for _, r, f in right)
    cuts = sorted({e for _, _, e in left} & {f for _, _, f in right})
    groups = [
        ",".join(str(i) for i, _, e in left if low < e <= cut) + "|" + ",".join(str(j) for j, _, f in right if low < f <= cut)
        for low, cut in zip([0, *cuts], cuts, strict=False)
    ]
    return links, (len(left), len(right), len(groups), len(links), shared), ";".join(groups)


@pytest.mark.parametrize("stride", [2, 16])
def test_galloping_equals_binary_search(stride, monkeypatch):
    monkeypatch.setattr(alignment, "STRIDE", stride)
    rng = np.random.default_rng(6)
    for _ in range(400):
        ends = np.unique(rng.integers(0, rng.choice([5, 50, 2000]), rng.integers(0, 120)))
        wanted = np.unique(rng.integers(0, rng.choice([5, 50, 2000]), rng.integers(0, 120)))
        assert (alignment.gallop(wanted, ends) == np.searchsorted(ends, wanted)).all()


def test_alignment_equals_brute_force(library):
    pair = alignment.Pair(BYTES, PIECES)
    a, b = token_bytes(library)
    made = ["", *scraps(7, 500, 25)]
    links, counts, groups = alignment.align(pair, made)
    assert {c[0] == 0 for c in counts} == {True, False}
    for k, text in enumerate(made):
        pairs = sorted((int(pair.keys[x]) // pair.span, int(pair.keys[x]) % pair.span) for x in links[k])
        want = aligned_plainly(a, b, text)
        assert (pairs, counts[k], groups[k]) == (sorted(want[0]), *want[1:]), repr(text)


def test_ranks_give_the_ids_of_the_tokenizer_itself():
    from tokenizers import Tokenizer

    fast, own = alignment.ByteTokens(BYTES), Tokenizer.from_file(BYTES)
    own.encode_special_tokens = True
    assert fast.exact
    for text in scraps(8, 1000):
        assert fast.encode(text) == own.encode(text, add_special_tokens=False).ids


def alignment_rows(rows, library):
    """The whole table by brute force: counts over the corpus, then each row."""
    a, b = token_bytes(library)
    plain = [(i, *aligned_plainly(a, b, t)) for i, t in rows]
    counts = Counter(x for _, links, _, _ in plain for x in links)
    best = defaultdict(int)
    for (_, j), n in counts.items():
        best[j] = max(best[j], n)
    out = []
    for i, links, (n_a, n_b, n_groups, n_links, shared), groups in plain:
        n_best = sum(counts[x] == best[x[1]] for x in links)
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        out.append((i, n_a, n_b, n_groups, n_links, shared, n_best, sum(counts[x] for x in links), digest))
    return sorted(out, key=repr)


NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_overlaps", "n_best", "count_sum", "groups_sha256"]


def test_align_tokenizers_on_rows(documents, cluttered, library):
    rows = [(0, None), (1, ""), (2, "▁"), (3, "the cat"), (3, "the cat"), (None, "the cat sat"), *((9 + k, t) for k, t in enumerate(scraps(9, 60, 20)))]
    out = alignment.align_tokenizers(cluttered(documents(*rows)).repartition(5), BYTES, PIECES)
    assert sorted((tuple(r[c] for c in NAMES) for r in out.collect()), key=repr) == alignment_rows(rows, library)
    assert alignment.align_tokenizers(documents(), BYTES, PIECES).count() == 0
    long = alignment.align_tokenizers(documents((1, "word " * 60_000)), BYTES, PIECES).first()
    assert long.n_groups > 50_000 and long.count_sum > long.n_links


def test_op12_query(spark, library):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("length(text) < 3000")
    out = QUERIES["op12_token_alignment"](spark, SMALL)
    a, b = token_bytes(library)
    want = {r.doc_id: aligned_plainly(a, b, r.text) for r in docs.limit(40).collect()}
    for r in out.where(out.doc_id.isin(list(want))).collect():
        _, counts, groups = want[r.doc_id]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_overlaps) == counts
        assert r.groups_sha256 == (hashlib.sha256(groups.encode()).hexdigest() if groups else "")
    assert out.count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()


# -- periodic runs -----------------------------------------------------------


def runs_plainly(words, least):
    """Runs by comparing the words at every distance."""
    n, out = len(words), []
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            start, end = i, j + p
            if end - start >= max(least, 2 * p) and j > i:
                if not any(all(words[x] == words[x + q] for x in range(start, end - q)) for q in range(1, p)):
                    out.append((start, end - start, p))
            i = j + 1
    return sorted(out, key=lambda x: (x[0], x[2]))


def repeating(rng):
    words = [rng.choice("abcdefghijklmnopqrst"[: rng.choice([1, 2, 3, 5, 20])]) for _ in range(rng.randint(0, 50))]
    if words and rng.random() < 0.5:
        at, p = rng.randrange(len(words)), rng.randint(1, 8)
        words = words[:at] + [words[at + i % min(p, len(words) - at)] for i in range(rng.randint(0, 40))] + words[at:]
    return words


def collapsed(words, found):
    gone = {i for start, length, period in found for i in range(start + period, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@pytest.mark.parametrize("least", [2, 4, 12])
def test_runs_equal_brute_force(least):
    rng = random.Random(least)
    for _ in range(400):
        docs = [repeating(rng) for _ in range(rng.randint(1, 4))]
        for words, (n, found, text) in zip(docs, runs._block([" ".join(w).encode() for w in docs], least), strict=True):
            want = runs_plainly(words, least)
            assert (n, found, text.decode()) == (len(words), want, collapsed(words, want)), words


def test_suffix_arrays_equal_sorting():
    rng = np.random.default_rng(10)
    for _ in range(100):
        words = rng.integers(1, rng.choice([2, 3, 30]), rng.integers(1, 60))
        order, inverse, common = runs.suffix_array(words)
        plain = sorted(range(len(words)), key=lambda i: words[i:].tolist())
        assert order.tolist() == plain and (inverse[order] == np.arange(len(words))).all()
        for k in range(1, len(words)):
            a, b = words[plain[k - 1] :].tolist(), words[plain[k] :].tolist()
            assert common[k] == next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def test_long_runs_stay_quick():
    for words in (["a"] * 60_000, ["a", "b"] * 30_000, [f"w{i % 20_000}" for i in range(60_000)]):
        ((n, found, _),) = runs._block([" ".join(words).encode()], 12)
        assert n == 60_000 and len(found) == 1 and found[0][:2] == (0, 60_000)


def test_periodic_runs_on_rows(documents, cluttered):
    rng = random.Random(11)
    made = [None, "", " \n", "one", "a b " * 8, "x" * 50_000, "nb sp " * 9, " ".join(["the cat sat"] * 3000)]
    rows = [*enumerate(made), (1, "a " * 20), (1, "a " * 20), (None, "b c d " * 6), *((50 + k, " ".join(repeating(rng))) for k in range(60))]
    out = runs.periodic_runs(cluttered(documents(*rows)).repartition(3), block_words=40).collect()
    got = Counter((r.doc_id, r.n_words, tuple(tuple(x) for x in r.runs), r.collapsed) for r in out)
    want = Counter()
    for i, t in rows:
        words = WORD.findall(t or "")
        found = runs_plainly(words, 12) if len(words) < 1000 else [(0, len(words), 3)]
        want[i, len(words), tuple(found), collapsed(words, found)] += 1
    assert got == want
    assert runs.periodic_runs(documents()).count() == 0


def test_op13_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    out = {r.doc_id: r for r in QUERIES["op13_periodic_runs"](spark, SMALL).collect()}
    assert out.keys() == docs.keys()
    planted = 0
    for i, text in docs.items():
        words = WORD.findall(text or "")
        n, h = len(words), zlib.crc32(str(i).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (k - a) % p] for k in range(a, n)]
            planted += 1
        elif n > 1500:
            continue
        want, r = runs_plainly(words, 12), out[i]
        top = min(want, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        assert (r.n_runs, r.start, r.length, r.period) == (len(want), *top)
        assert r.exponent_milli == (1000 * top[1] // top[2] if want else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{x},{p}\n" for s, x, p in want).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, want).encode()).hexdigest()
    assert planted


def test_periods_are_planted_without_reading_other_words(documents):
    rows = with_periods(documents((1, None), (None, "a  b"), (2, ""), (3, " x\ty "))).collect()
    assert {(r.doc_id, r.text) for r in rows} == {(1, None), (None, "a  b"), (2, ""), (3, " x\ty ")}
