"""Boosted trees against a plain booster, early stopping against a loop."""

import random

import pytest
from pyspark.sql import functions as F

from ratelake.plans import boosting
from ratelake.plans.boosting import BoostParams


def made(seed=1, n=300, missing=0.1):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        a, b, c = rng.randrange(8), round(rng.random(), 1), rng.choice([0.0, 1.0])
        y = 3.0 * a - 10 * b + (5 if c and a > 4 else 0) + rng.random()
        out.append((float(a) if rng.random() > missing else None, b, c, y))
    return out


def plain_tree(rows, gradient, p):
    """Cuts and weights by trying every value of every feature; missing goes left."""
    cuts, weights = {}, {}

    def shrunk(g):
        return max(abs(g) - p.l1, 0.0) * (1 if g > 0 else -1)

    def worth(g, h):
        return shrunk(g) ** 2 / (h + p.l2)

    def grow(node, members, depth):
        g, h = sum(gradient[i] for i in members), len(members)
        best = None
        if depth < p.max_depth:
            for f in range(3):
                known = sorted({rows[i][f] for i in members if rows[i][f] is not None})
                for v in ([float("-inf")] if any(rows[i][f] is None for i in members) else []) + known:
                    left = [i for i in members if rows[i][f] is None or rows[i][f] <= v]
                    if len(left) < p.min_curvature or h - len(left) < max(p.min_curvature, 0.5):
                        continue
                    gl = sum(gradient[i] for i in left)
                    gain = 0.5 * (worth(gl, len(left)) + worth(g - gl, h - len(left)) - worth(g, h))
                    if best is None or gain > best[0] + 1e-9:
                        best = (gain, f, v, left)
        if best is None or best[0] <= p.min_gain:
            weights[node] = -p.learning_rate * shrunk(g) / (h + p.l2)
            return
        _, f, v, left = best
        cuts[node] = (f, v)
        inside = set(left)
        grow(2 * node, left, depth + 1)
        grow(2 * node + 1, [i for i in members if i not in inside], depth + 1)

    grow(1, list(range(len(rows))), 0)
    return cuts, weights


def follow(row, cuts, weights):
    node = 1
    while node in cuts:
        f, v = cuts[node]
        node = 2 * node + int(row[f] is not None and row[f] > v)
    return weights[node]


@pytest.fixture(scope="module")
def table(spark):
    rows = made()
    return rows, spark.createDataFrame(rows, "a double, b double, c double, y double").cache()


@pytest.mark.parametrize("l1,l2", [(0.5, 1.0), (0.0, 0.0), (40.0, 5.0)])
def test_trees_equal_a_plain_booster(table, l1, l2):
    rows, df = table
    p = BoostParams(rounds=3, max_depth=3, learning_rate=0.5, l1=l1, l2=l2, row_share=1.0, column_share=1.0, patience=None)
    model = boosting.fit_boosted(df, ["a", "b", "c"], "y", p)
    base = sum(r[3] for r in rows) / len(rows)
    assert model.base == pytest.approx(base)
    margin = [base] * len(rows)
    for tree in model.trees:
        cuts, weights = plain_tree(rows, [m - r[3] for m, r in zip(margin, rows, strict=True)], p)
        assert {n: (f, v) for n, (f, _, v) in tree.cuts.items()} == cuts
        assert {n: w for n, w in tree.weights.items() if n not in tree.cuts} == pytest.approx(weights)
        margin = [m + follow(r, cuts, weights) for m, r in zip(margin, rows, strict=True)]
    got = {(r["a"], r["b"], r["c"], r["y"]): r["prediction"] for r in model.score(df).collect()}
    assert got == pytest.approx({r: m for r, m in zip(rows, margin, strict=True)})


def test_samples_follow_the_seed_and_nan_is_missing(spark, table):
    _, df = table
    p = BoostParams(rounds=2, max_depth=2, learning_rate=0.3, patience=None)
    first, again = (boosting.fit_boosted(df, ["a", "b", "c"], "y", p) for _ in range(2))
    assert [t.cuts for t in first.trees] == [t.cuts for t in again.trees]
    assert all(len({f for f, _, _ in t.cuts.values()}) <= 2 for t in first.trees)
    nan = df.withColumn("a", F.coalesce("a", F.lit(float("nan"))))
    assert [t.cuts for t in boosting.fit_boosted(nan, ["a", "b", "c"], "y", p).trees] == [t.cuts for t in first.trees]
    with pytest.raises(ValueError, match="label"):
        boosting.fit_boosted(df.limit(0), ["a"], "y", p)


def test_a_fit_stops_when_validation_stops_improving(spark, table, monkeypatch):
    monkeypatch.setattr(boosting, "STAGE", 4)
    _, df = table
    # Labels without any pattern: what is learnt from one half does not help on the other.
    noise = df.withColumn("y", F.rand(3) * 10)
    train, valid = noise.filter("b < 0.5"), noise.filter("b >= 0.5")
    p = BoostParams(rounds=40, max_depth=3, learning_rate=0.5, l1=0.0, l2=0.0, patience=3, min_delta=0.001, row_share=1.0)
    model = boosting.fit_boosted(train, ["a", "c"], "y", p, valid)
    best, stop = boosting._patience(model.curve, 3, 0.001)
    assert stop == len(model.curve) < 40 and len(model.trees) == best
    errors = model.score(valid).agg(F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("y"), 2)))).first()[0]
    assert best == 0 or errors == pytest.approx(model.curve[best - 1])


def test_early_stop_equals_the_loop(spark):
    rng = random.Random(2)
    for n, patience, delta in [(0, 3, 0.0), (1, 3, 0.0), (30, 3, 0.0), (30, 5, 0.2), (30, 100, 0.1)]:
        curve = [rng.random() for _ in range(n)]
        df = spark.createDataFrame([(i + 1, e) for i, e in enumerate(curve)], "round long, error double").repartition(3)
        got = boosting.early_stop(df, patience, delta).first()
        best, stop = boosting._patience(curve, patience, delta)
        assert (got["best_round"] or 0, got["stop_round"]) == (best, stop)


def test_bins_are_quantiles_when_values_are_many(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("a"))
    (edges,) = boosting.bin_edges(df, ["a"], 4)
    assert len(edges) == 4 and edges[-1] == 999 and edges == sorted(edges)
