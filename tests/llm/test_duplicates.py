"""Near-duplicates and the removal of repeated passages, against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratelake.llm import induced, minhash, suffix_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(SMALL))
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def linked(rows):
    """Smallest reachable id of each row, by comparing all pairs."""
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, shingles(t)) for i, t in rows]
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in parent}


def prose(rng, n):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def altered(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**6)}"
    return out


def near_corpus():
    rng = random.Random(4)
    texts = [None, "", "  ", "One two", "one TWO", "É b c d", "é b c d"]
    base = prose(rng, 400)
    # Around one original: close copies, and others too far from each other to be linked.
    texts += [" ".join(altered(rng, base, rng.choice([0, 1, 2, 4, 12, 20]))) for _ in range(120)]
    # A chain, each link close to the next only.
    words = prose(rng, 300)
    for _ in range(12):
        words = altered(rng, words, 4)
        texts.append(" ".join(words).upper())
    shared = prose(rng, 60)
    texts += [" ".join(prose(rng, 80) + shared + prose(rng, 40)) for _ in range(40)]
    texts += [" ".join(prose(rng, 20000))] * 2 + ["same words here again and again"] * 30
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_near_duplicates_equal_brute_force(documents, cluttered):
    rows = near_corpus()
    want = linked(rows)
    got = minhash.near_duplicates(cluttered(documents(*rows))).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: r.component_id for r in got} == want
    texts = dict(rows)
    for r in got:
        assert r.n_shingles == len(shingles(texts[r.doc_id]))
        assert r.kept == (r.doc_id == r.component_id)
    kept = minhash.keep_one(documents(*rows))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_near_duplicates_without_ids_and_rows(documents):
    df = documents((None, "a b c d e f"), (5, "a b c d e f"), (5, "a b c d e f"), (7, "g h"), (7, "a b c d e f"), (9, "g h"))
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(df).collect()), key=repr)
    assert got == sorted([(None, None, True), (5, 5, True), (5, 5, True), (7, 7, True), (7, 5, False), (9, 7, False)], key=repr)
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_far_pairs_of_a_crowd_are_not_compared(documents, monkeypatch):
    """Many look-alikes that are not linked: the pairs compared grow with the rows, not their square."""
    rng = random.Random(8)
    base = prose(rng, 300)
    rows = [(i, " ".join(altered(rng, base, 14))) for i in range(250)]
    seen = []
    confirmed = minhash.confirmed

    def counting(pairs, sets, percent):
        seen.append(pairs.count())
        return confirmed(pairs, sets, percent)

    monkeypatch.setattr(minhash, "confirmed", counting)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(documents(*rows)).collect()}
    assert got == linked(rows)
    assert sum(seen) < 250 * 64


def by_strings(rows, length):
    """What a set of all strings seen so far removes."""
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            w = raw[s : s + length]
            if w in seen:
                gone[s : s + length] = b"\1" * length
            seen.add(w)
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        runs = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out[i] = (len(raw), len(raw) - len(kept), runs, hashlib.sha256(kept).hexdigest())
    return out


def passages():
    rng = random.Random(3)
    words = ["alpha", "bet", "gam", "über", "漢字", "zz"]
    sentence = lambda n: " ".join(rng.choice(words) + str(rng.randrange(100)) for _ in range(n))
    shared = [sentence(30) for _ in range(4)]
    line = "Under the very common line of text that many documents hold, yes."
    rows = [(-3, None), (-2, ""), (-1, "x" * 99)]
    for i in range(120):
        parts = [rng.choice([sentence(rng.randint(1, 40)), rng.choice(shared), shared[0][: rng.randint(50, 150)], line]) for _ in range(rng.randint(1, 4))]
        text = " ".join(parts)
        if rng.random() < 0.1 and i:
            text = rows[rng.randrange(3, len(rows))][1]
        if rng.random() < 0.05:
            text = "ab" * rng.randint(10, 200)
        rows.append((i, text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("options", [{}, {"crowded": 1}, {"shard_bytes": 2000, "crowded": 3}])
def test_repeats_equal_brute_force(documents, cluttered, options):
    rows = passages()
    got = suffix_dedup.remove_repeats(cluttered(documents(*rows)), **options).collect()
    assert len(got) == len(rows)
    want = by_strings(rows, 100)
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id]
        assert sum(s.end - s.start for s in r.spans) == r.n_removed


def test_texts_hashed_in_windows_give_the_same(documents, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 150)
    rows = passages()
    want = by_strings(rows, 100)
    for r in suffix_dedup.remove_repeats(documents(*rows)).collect():
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id]


def test_repeats_edge_cases(documents):
    text = "".join(random.Random(1).choices("abcdefghij", k=300))
    df = documents((None, text), (4, text), (4, text), (8, "q" + text))
    got = sorted(((r.doc_id, r.n_removed) for r in suffix_dedup.remove_repeats(df).collect()), key=repr)
    assert got == sorted([(None, 0), (4, 300), (4, 300), (8, 300)], key=repr)
    assert suffix_dedup.remove_repeats(df.limit(0)).count() == 0
    assert suffix_dedup.remove_repeats(documents((1, "short"), (2, "short"))).where(F.col("n_removed") > 0).count() == 0


def test_copies_of_a_passage_are_not_cut_out_and_spread_over_tasks(documents, monkeypatch):
    rng = random.Random(12)
    words = lambda n: " ".join(f"{rng.randrange(10**9)}" for _ in range(n))
    passage, written = words(120), {}
    rows = [(i, f"{words(20)} {passage} {words(20)}") for i in range(300)]
    real = suffix_dedup.materialize

    def keep(df, label="work"):
        written[label] = real(df, label)
        return written[label]

    monkeypatch.setattr(suffix_dedup, "materialize", keep)
    want = by_strings(rows, 100)
    for r in suffix_dedup.remove_repeats(documents(*rows).repartition(4)).collect():
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id]
    assert not [label for label, df in written.items() if "stretch" in df.columns]
    # Of the copies in one batch all but the first are spread; the passage's ends differ in each text.
    runs = written["runs"].groupBy("key").agg(F.count("*").alias("n"), F.max("different").alias("different"))
    assert runs.count() > 2000 and runs.where("different = 1").agg(F.max("n")).first()[0] <= 4


def sorted_with_shared(values, **options):
    places, shared = [], []
    for block, _ in induced.suffixes(np.array(values, dtype=np.int64), **options):
        places += block["place"].tolist()
        shared += block["shared"].tolist()
    return places, shared


def test_induced_sorting_equals_sorting():
    """With tiny memory, so that names are sorted by recursion and queues go to disk."""
    rng = random.Random(5)
    for _ in range(400):
        n, top = rng.randint(0, 60), rng.choice([1, 2, 3, 5, 200])
        text = [rng.randint(0, top) for _ in range(n)]
        places, shared = sorted_with_shared(text, direct=rng.choice([0, 3, 1 << 22]), held=rng.choice([2, 10, 1 << 21]))
        assert places == sorted(range(n), key=lambda i: text[i:])
        for k in range(1, n):
            a, b = text[places[k - 1] :], text[places[k] :]
            same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert shared[k] == same


def test_queue_keeps_order_on_disk():
    queue = induced.Queue(held=3)
    want = {7: [], 2: []}
    for i in range(40):
        entry = np.zeros(2, dtype=induced.ENTRY)
        entry["place"] = [2 * i, 2 * i + 1]
        queue.put(7 if i % 3 else 2, entry)
        want[7 if i % 3 else 2] += [2 * i, 2 * i + 1]
    assert queue.keys() == {2, 7} and queue.size <= 4
    for key, places in want.items():
        assert [p for b in queue.take(key) for p in b["place"].tolist()] == places
    queue.close()


def test_keep_one_judges_rows_by_their_texts(documents, cluttered):
    a, b, c = ("alpha beta gamma delta epsilon zeta", "one two three four five six", "red green blue white black grey")
    rows = [(3, a), (5, a), (5, b), (7, c), (7, c), (8, ""), (8, None), (None, a), (None, "only here, with no id at all")]
    df = cluttered(documents(*rows))
    out = minhash.keep_one(df)
    assert out.columns == df.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)
    assert got == sorted([(3, a), (5, b), (7, c), (8, ""), (8, None), (None, rows[-1][1])], key=repr)
    plain = minhash.keep_one(cluttered(documents((1, a), (2, b), (4, b))))
    assert sorted(r.doc_id for r in plain.collect()) == [1, 2] and plain.columns == df.columns
