"""Quality rules and the mixture."""

import re
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from ratelake.llm import mixing, quality
from ratelake.llm.common import components, rank_in_groups, split_words
from ratelake.llm.queries import ORACLES, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if counts[w] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


TEXTS = [
    None,
    "",
    " \t\n",
    "one",
    "a b a b a b a b",
    "a a a a",
    "the cat sat\nthe cat sat\n\n \nthe cat sat \nü ß 漢字",
    " ".join(["the quick brown fox"] * 30),
    "x#y | z & <b> 100% $5 *\x0b\x0cq",
    "nb sp stays one word",
    " ".join(f"w{i}" for i in range(60)),
    "the and of " * 20000,
]


def test_measures_equal_brute_force(documents, cluttered):
    rows = [(i, t, "en") for i, t in enumerate(TEXTS)] + [(0, None, "en")]
    out = quality.judge(cluttered(documents(*rows))).select("doc_id", "text", "quality").collect()
    assert len(out) == len(rows)
    for r in out:
        want = measures(r.text)
        assert {k: r.quality[k] for k in want} == want, r.text and r.text[:40]
        failed = want["n_words"] < 50 or 100 * want["n_repeat_words"] > 50 * want["n_words"]
        assert r.quality.base_failed == failed
        assert r.quality.kept == (not failed and not r.quality.broken)


def test_rules_and_unknown_languages(documents):
    prose = " ".join(f"the w{i}a" for i in range(40))
    odd = " ".join(f"v{i}x" for i in range(80))
    marks = " ".join(f"the w{i}a##" for i in range(40))
    df = documents((1, prose, "en"), (2, odd, "en"), (3, odd, "xx"), (4, odd, None), (5, marks, "en"))
    got = {r.doc_id: (r.quality.kept, r.quality.broken) for r in quality.judge(df).collect()}
    assert got == {1: (True, []), 2: (False, ["stop_words"]), 3: (True, []), 4: (True, []), 5: (False, ["symbols"])}
    assert quality.keep_good(df).columns == df.columns
    # Other tables compile too, the empty one to no rule at all.
    assert quality.judge(df, ()).where("NOT quality.kept").count() == 0
    assert quality.judge(df.limit(0)).count() == 0


def test_rules_are_one_projection_without_python(documents):
    plan = quality.judge(documents((1, "a"))).select("quality.*")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Exchange|Python|Arrow|Sort", plan)


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """The rule as written: bound what is above, share the excess again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, out = share * sum(sizes.values()), set(names), {}
    while free:
        level = left / sum(weight[s] for s in free)
        above = {s for s in free if level * weight[s] >= most * sizes[s]}
        if not above:
            out |= {s: level * weight[s] for s in free}
            break
        out |= {s: most * sizes[s] for s in above}
        left -= sum(most * sizes[s] for s in above)
        free -= above
    return out


@pytest.mark.parametrize(
    "sizes",
    [{"a": 10}, {"a": 100, "b": 1, None: 50}, {"a": 1, "b": 1000, "c": 5, "d": 0}, {f"s{i}": i * i for i in range(1, 30)}, {"é": 5, "z": 7, "": 3}],
)
def test_targets(spark, sizes):
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx(targets(sizes))
    assert sum(got.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_mixture_follows_targets(documents, cluttered):
    rows = []
    for i in range(1500):
        source = ["hot", "hot", "a", "b", None][i % 5]
        rows.append((i, " ".join(["w"] * (1 + i * 7919 % 300)), "en", source, 1))
    rows += [(None, None, None, "a", None), (3, "w w", "en", "hot", 1), (3, "w w", "en", "hot", 1)]
    df = cluttered(documents(*rows))
    chosen = mixing.choose(df)
    out = chosen.select("doc_id", "source", "mix.*").collect()
    assert len(out) == len(rows)
    taken = defaultdict(int)
    want = {}
    for r in out:
        rate = r.target / r.source_size
        assert r.copies in (int(rate), int(rate) + 1) or abs(r.copies - rate) < 1e-6
        assert r.taken == r.copies * r.size <= 2 * r.size
        taken[r.source] += r.taken
        want[r.source] = r.target
    for s in want:
        assert abs(taken[s] - want[s]) <= 0.02 * want[s] + 300
    again = chosen.select("doc_id", "source", "mix.*").collect()
    assert Counter(map(str, again)) == Counter(map(str, out))
    mixed = mixing.mixed(df)
    assert mixed.columns == df.columns
    assert mixed.count() == sum(r.copies for r in out)
    assert mixing.choose(df.limit(0)).count() == 0


def test_mixture_without_words(documents):
    out = mixing.choose(documents((1, None, None, "a"), (2, "", None, None))).collect()
    assert [(r.mix["size"], r.mix["target"], r.mix["copies"]) for r in out] == [(0, 0.0, 0)] * 2


def test_ranks_in_a_hot_group(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("g"), (F.col("id") % 3).alias("s"), F.shiftrightunsigned(F.xxhash64("id"), 32).alias("h"))
    got = rank_in_groups(df, "g", ["s"], "h", ["id"]).collect()
    for g in "ab":
        own = sorted((r for r in got if r.g == g), key=lambda r: (r.s, r.h, r.id))
        assert [r["rank"] for r in own] == list(range(len(own)))


def test_components(spark):
    import random

    random.seed(2)
    links = [(random.randrange(400), random.randrange(400)) for _ in range(250)] + [(1000, 2000 + i) for i in range(300)] + [(i, i + 1) for i in range(5000, 5040)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    linked = {x for ab in links if ab[0] != ab[1] for x in ab}
    assert got == {x: find(x) for x in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_words(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    for r in df.select("text", split_words(F.col("text")).alias("w")).collect():
        assert r.w == WORD.findall(r.text or "")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet')")
    want = con.sql(ORACLES[name])
    got = QUERIES[name](spark, folder)
    names = sorted(got.columns)
    assert names == sorted(want.columns)
    key = lambda r: tuple(str(x) for x in r)
    ours = sorted((tuple(r[n] for n in names) for r in got.collect()), key=key)
    theirs = sorted((tuple(r) for r in want.select(*[duckdb.ColumnExpression(n) for n in names]).fetchall()), key=key)
    assert ours == theirs


def test_own_columns_come_back(documents, cluttered):
    df = cluttered(documents((1, "the cat and the dog " * 3 + " ".join(f"w{i} of" for i in range(60)), "en", "a"), (2, "short", "en", "a")))
    good = quality.keep_good(df)
    assert good.columns == df.columns
    assert [(r.doc_id, r.quality, r._row) for r in good.collect()] == [(1, "extra", "extra")]
    mixed = mixing.mixed(df)
    assert mixed.columns == df.columns
    assert {(r.mix, r._copy, r._source) for r in mixed.collect()} == {("extra", "extra", "extra")}
