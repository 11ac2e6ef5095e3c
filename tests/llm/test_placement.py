"""Packing, sharding, nearest neighbours: every row has its place."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ratelake.llm import nearest, packing, sharding

PATH = public_tokenizers.path("word_bpe_49k.json")


def sequences(pieces):
    """Checks that pieces lie gapless; returns sequence lengths."""
    out = defaultdict(list)
    for _, _, length, sequence, offset in pieces:
        out[sequence].append((offset, length))
    lengths = {}
    for sequence, parts in out.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        lengths[sequence] = at
    return lengths


@pytest.mark.parametrize("n, mean", [(4000, 6.9), (800, 5.5), (30, 6), (1, 9), (0, 1)])
def test_places(n, mean):
    rng = np.random.default_rng(n)
    totals = np.minimum(60_000, rng.lognormal(mean, 1, n).astype(int) + 1)
    pieces = packing.place(totals)
    covered = defaultdict(list)
    for doc, start, length, _, _ in pieces:
        covered[doc].append((start, length))
    for doc, total in enumerate(totals.tolist()):
        at = 0
        for start, length in sorted(covered[doc]):
            assert start == at
            at += length
        assert at == total
    lengths = sequences(pieces)
    assert all(x <= packing.WINDOW and (x == packing.WINDOW or x & (x - 1) == 0) for x in lengths.values())
    # Combinations leave most documents in as few pieces as can be.
    least = sum(-(-int(x) // packing.WINDOW) for x in totals)
    assert len(pieces) - least <= 0.12 * n + 12


def test_combinations_and_least_squares():
    lengths = np.array([1, 2, 3, 5, 8])
    found = {tuple(sorted(int(lengths[i]) for i in row if i >= 0)) for row in packing.combinations(lengths, 8)}
    assert found == {(8,), (3, 5), (1, 2, 5), (2, 3, 3)}
    members = packing.combinations(lengths, 8)
    stock = np.array([4.0, 6.0, 9.0, 10.0, 3.0])
    x = packing.least_squares(members, stock, rounds=3000)
    assert (x >= 0).all()
    use = np.zeros((5, len(members)))
    for k, row in enumerate(members):
        for i in row[row >= 0]:
            use[i, k] += 1
    # At the solution no combination can gain, and those in use have no slope.
    slope = use.T @ (use @ x - stock)
    assert (slope > -1e-3).all() and np.abs(slope[x > 1e-3]).max() < 1e-2


def test_packed_tokens_are_the_texts(documents, cluttered):
    rows = [(1, None), (2, ""), (3, "Hello world, <|endoftext|> is text"), (None, "ünï 漢字 " * 10), (3, "again"), (4, "many words " * 3000)]
    rows += [(i, f"word{i} " * (i % 400)) for i in range(10, 200)]
    pieces = packing.pack(cluttered(documents(*rows)), PATH, block_tokens=5000).collect()
    sequences([(0, 0, p.length, p.sequence_id, p.offset) for p in pieces])
    tokenizer = Tokenizer.from_file(PATH)
    want = Counter((i, tuple([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1])) for i, t in rows)
    by_doc = defaultdict(list)
    for p in pieces:
        assert len(p.ids) == 4 * p.length
        by_doc[p.doc_id].append((p.start, np.frombuffer(bytes(p.ids), dtype="<u4").tolist(), p.doc_tokens))
    for i in {i for i, _ in rows} - {3}:
        ids = [x for _, part, _ in sorted(by_doc[i]) for x in part]
        assert want[i, tuple(ids)] == 1 and len(ids) == by_doc[i][0][2]
    assert sum(p.length for p in pieces) == sum(len(t) for _, t in want)
    assert packing.pack(documents((1, "a")).limit(0), PATH).count() == 0


def test_shards_are_even_and_groups_together(documents, cluttered):
    rows = [(i, f"text {i}") for i in range(700)]
    rows += [(1000 + i, f"copy {i % 40}") for i in range(160)] + [(2000 + i, "hot") for i in range(400)]
    rows += [(None, None), (None, None), (5, ""), (5, "")]
    df = cluttered(documents(*rows))
    placed = sharding.shard(df, shards=8)
    out = placed.collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    assert sorted(slots) == list(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    # The small groups are whole; the hot one fills as few shards as it can, or one or two more.
    where = defaultdict(set)
    for r in out:
        where[r.text_hash].add(r.shard)
    sizes = Counter(r.text_hash for r in out)
    apart = [h for h, n in sizes.items() if n < 100 and len(where[h]) > 1]
    assert len(apart) <= 2
    cut = sharding.cut_links(placed).first()
    assert cut.cut < 0.75 * cut.links


def shards_of(placed):
    """Shards of each text, rows of each text, rows of each shard."""
    out = placed.collect()
    where = defaultdict(set)
    for r in out:
        where[r.text_hash].add(r.shard)
    return where, Counter(r.text_hash for r in out), Counter(r.shard for r in out)


def test_groups_stay_whole_beside_a_hot_text(documents):
    """A text on a third of all rows leaves room for groups that each fit into one shard."""
    texts = ["hot"] * 3300 + [f"large {i % 4}" for i in range(800)] + [f"pair {i % 200}" for i in range(400)]
    texts += [f"text {i}" for i in range(10_000 - len(texts))]
    where, sizes, rows = shards_of(sharding.shard(documents(*enumerate(texts))))
    assert set(rows.values()) == {250} and len(rows) == 40
    assert all(len(where[h]) == 1 for h, n in sizes.items() if n <= 250)
    assert sorted(len(s) for s in where.values())[-1] == 14


def test_groups_without_room_are_split_in_few(documents):
    """Six groups of 60 rows in four shards of 100: two cannot be whole; all rows are linked."""
    texts = [f"group {i % 6}" for i in range(360)] + [f"small {i % 10}" for i in range(40)]
    where, sizes, rows = shards_of(sharding.shard(documents(*enumerate(texts)), shards=4))
    assert sorted(rows.values()) == [100] * 4
    assert sorted(len(where[h]) for h, n in sizes.items() if n == 60)[:4] == [1] * 4
    assert sum(len(s) for s in where.values()) <= 16 + 4


def test_shards_of_few_rows(documents):
    out = sharding.shard(documents((1, "a"), (2, "a"), (3, None)), shards=5).collect()
    assert sorted(r.slot for r in out) == [0, 0, 0] and len({r.shard for r in out}) == 3
    assert sharding.shard(documents((1, "a")).limit(0), shards=5).count() == 0


def brute_nearest(vectors, queries, k):
    out = {}
    for q, v in queries.items():
        near = sorted((float(np.sqrt(((v - w) ** 2).sum())), i) for i, w in vectors.items() if i != q)
        out[q] = near[:k]
    return out


def test_nearest_against_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((20, 16))
    data = {i: (centres[i % 20] + 0.4 * rng.standard_normal(16)).astype(np.float32) for i in range(3000)}
    data |= {i: np.ones(16, dtype=np.float32) for i in range(3000, 4000)}
    rows = [(i, v.tolist(), 1) for i, v in data.items()] + [(0, data[0].tolist(), 1), (3100, data[3100].tolist(), 1)]
    bad = [(9001, None), (9002, [0.0] * 16), (9003, [None] + [1.0] * 15), (9004, [float("nan")] * 16), (9005, [float("inf")] + [1.0] * 15), (9006, [1.0]), (9100, [0.0] * 16), (None, [1.0] * 16)]
    df = spark.createDataFrame(rows + [(i, v, 0) for i, v in bad], "vec_id long, embedding array<float>, label int")
    got = defaultdict(list)
    for r in nearest.nearest(df, df.where("vec_id % 100 = 0"), cell_rows=300).collect():
        got[r.query_id].append((r.rank, r.score, r.vec_id))
    want = brute_nearest({i: v.astype(float) for i, v in data.items()}, {i: v.astype(float) for i, v in data.items() if i % 100 == 0}, 10)
    assert set(got) == set(want)
    hits = 0
    for q, near in want.items():
        mine = sorted(got[q])
        assert [r for r, _, _ in mine] == list(range(1, 11))
        assert [(s, i) for _, s, i in mine] == sorted((s, i) for _, s, i in mine)
        for _, s, i in mine:
            assert s == pytest.approx(float(np.sqrt(((data[q].astype(float) - data[i].astype(float)) ** 2).sum())), abs=1e-12)
        hits += len({i for _, i in near} & {i for _, _, i in mine})
        if q >= 3000:
            assert [i for _, i in near] == [i for _, _, i in mine]
    assert hits >= 0.95 * 10 * len(want)


def test_nearest_of_few_vectors(spark):
    schema = "vec_id long, embedding array<float>, label int"
    df = spark.createDataFrame([(100, [1.0, 2.0], 0), (1, [1.0, 2.0], 0), (2, [4.0, 6.0], 0)], schema)
    got = [tuple(r) for r in nearest.nearest(df, df.where("vec_id % 100 = 0")).orderBy("rank").collect()]
    assert got == [(100, 1, 1, 0.0), (100, 2, 2, 5.0)]
    assert nearest.nearest(df.limit(0), df).count() == 0
    assert nearest.nearest(df, df.where("vec_id < 0")).count() == 0


def test_chi_square_bound():
    rng = np.random.default_rng(1)
    drawn = (rng.standard_normal((200_000, 8)) ** 2).sum(axis=1)
    for beyond in (0.5, 0.1, 0.02):
        assert (drawn > nearest.chi_square_bound(8, beyond)).mean() == pytest.approx(beyond, rel=0.05)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_pieces_give_the_tokenizers_ids(name):
    path = public_tokenizers.path(name)
    plain, encoder = Tokenizer.from_file(path), packing.Encoder(path)
    texts = [
        "", " ", "Hello hello HELLO", "it's WE'LL they've 's'S x'sy ''s", "a1b22c333 ²³¼ ª º", "###&&& a### #a# a#b", "<|endoftext|> <|endoftext|",
        "e\u0301 \u00e9 É Ñandú ß ẞ", "漢字 и буква", "tab\tnbsp\u00a0nel\u0085x\x1cy\x1fz", "İstanbul ſ ŉ ǆ ΣΑΣ", "\x00\x01 ctrl", "word " * 500, "don’t “quote”",
    ]
    for text in texts * 2:
        assert np.frombuffer(encoder.encode([text])[0], packing.ID).tolist() == plain.encode(text, add_special_tokens=False).ids, text
    assert [np.frombuffer(x, packing.ID).tolist() for x in encoder.encode(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
