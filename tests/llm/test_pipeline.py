"""The pipeline, stage by stage, against brute force."""

import random
import re
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
from test_duplicates import altered, prose, shingles
from test_text_rules import measures

from ratelake.llm import mixing, quality
from ratelake.session import materialize

FOLDER = "/root/testdata/sf0.001"
PRIVATE = re.compile(r"[\w.%+-]+@[\w.-]+\.[a-z]{2,}|(?<![\w.])\d{13,19}(?!\w)|\+1 \(\d{3}\) \d{3}-\d{4}|(?<![\w])[0-9a-fA-F]{40}(?!\w)")


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "near-duplicates", "pii", "mixing", "packing"]
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(materialize(stage(spark, out[-1], FOLDER), name.replace(" ", "-")))
    raw, good, single, private, mixed, pieces = out
    assert all(x.columns == docs.columns for x in out[:-1])

    # Base rules by brute force; the table's rules by their stated bounds.
    kept = {r.doc_id for r in good.collect()}
    for r in raw.collect():
        m = measures(r.text)
        ok = m["n_words"] >= 50 and 100 * m["n_repeat_words"] <= 50 * m["n_words"]
        if ok:
            lines = [x for x in r.text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
            stops = sum(w.lower() in quality.STOP_WORDS[r.lang] for w in re.findall(r"[^\x20\x09-\x0D]+", r.text))
            ok = 2 <= m["word_chars"] / m["n_words"] <= 12 and m["n_symbols"] <= 0.1 * m["n_words"]
            ok = ok and stops >= 0.03 * m["n_words"] and m["n_dup_lines"] <= 0.5 * len(lines)
        assert (r.doc_id in kept) == ok

    rows = [(r.doc_id, r.text) for r in good.collect()]
    assert sorted(r.doc_id for r in single.collect()) == sorted(set(linked_from_80(rows).values()))

    before = {r.doc_id: r for r in single.collect()}
    for r in private.collect():
        source = before[r.doc_id].text
        for hit in PRIVATE.findall(source):
            assert hit not in r.text
        if not PRIVATE.search(source) and not re.search(r"\d", source):
            assert r.text == source
        assert r.n_chars == len(r.text)

    copies = {r.doc_id: r.mix["copies"] for r in mixing.choose(private).collect()}
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({i: n for i, n in copies.items() if n})

    ids = defaultdict(int)
    for p in pieces.collect():
        ids[p.doc_id] += p.length
        assert np.frombuffer(bytes(p.ids), dtype="<u4").size == p.length
    assert set(ids) == {i for i, n in copies.items() if n}


def linked_from_80(rows):
    """Smallest reachable id of each row over pairs that overlap in 80 %, by comparing all pairs."""
    root = {i: i for i, _ in rows}
    sets = [(i, shingles(t)) for i, t in rows]
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = root[i], root[j]
                root = {n: min(x, y) if r in (x, y) else r for n, r in root.items()}
    return root


def test_near_duplicates_are_linked_from_80(documents, spark):
    rng = random.Random(12)
    rows = []
    for edits in (7, 8, 9, 10, 11, 12) * 4:
        base = prose(rng, 400)
        rows += [(len(rows), " ".join(base)), (len(rows) + 1, " ".join(altered(rng, base, edits)))]
    sets = [shingles(t) for _, t in rows]
    alike = [100 * len(a & b) / len(a | b) for a, b in zip(sets[::2], sets[1::2], strict=True)]
    assert sum(80 <= x < 85 for x in alike) >= 5 and min(alike) < 80
    kept = corpus_pipeline.near_duplicates(spark, documents(*rows), FOLDER)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(linked_from_80(rows).values()))


def test_near_duplicates_of_the_documents_are_linked_from_80(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = corpus_pipeline.near_duplicates(spark, docs, FOLDER)
    want = linked_from_80([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_run_gives_the_same(spark):
    first = corpus_pipeline.run(spark, FOLDER).select("doc_id", "start", "length", "doc_tokens").collect()
    assert sum(r.length for r in first) > 0
    assert corpus_pipeline.ORACLE_SQL is None
