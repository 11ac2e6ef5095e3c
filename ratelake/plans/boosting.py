"""Boosted regression trees with L1 and L2 terms, fitted by Spark aggregates.

Features are cut into bins once and written with the label. A level of a tree is one pass:
sums of gradients and curvatures by node, feature and bin, combined before the shuffle. The
gains of all cuts are window sums over these few rows, and only the best cut of each node
comes to the driver. So what is moved depends on bins, features and depth, not on rows.

Early stopping looks at a validation table every few rounds: one pass gives the error after
each of the new trees, and fitting ends once ``patience`` rounds brought no improvement.
"""

from __future__ import annotations

import json
import random
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelake.model import quoted
from ratelake.plans.training import COLUMN_SHARE, LEARNING_RATE, MAX_DEPTH, ROUNDS, ROW_SHARE, SEED
from ratelake.session import materialize

# Fixed values of the described model, beside those of plans/training.py.
L1, L2 = 0.5, 1.0
PATIENCE, MIN_DELTA = 50, 0.01
# Trees between two looks at the validation table, and between two copies of the training rows.
STAGE = 10
TREES = "array<struct<f:array<int>,t:array<double>,w:array<double>>>"


@dataclass(frozen=True)
class BoostParams:
    rounds: int = ROUNDS
    max_depth: int = MAX_DEPTH
    learning_rate: float = LEARNING_RATE
    l1: float = L1
    l2: float = L2
    row_share: float = ROW_SHARE
    column_share: float = float(COLUMN_SHARE)
    # Least curvature (rows, for squared error) on either side of a cut, and least gain.
    min_curvature: float = 1.0
    min_gain: float = 0.0
    bins: int = 256
    seed: int = SEED
    patience: int | None = PATIENCE
    min_delta: float = MIN_DELTA


@dataclass
class Tree:
    """Nodes by number: 1 is the root, 2n and 2n+1 follow n. A cut is (feature, bin, value); ``x <= value`` goes left."""

    cuts: dict[int, tuple[int, int, float]] = field(default_factory=dict)
    weights: dict[int, float] = field(default_factory=dict)

    def arrays(self, by_bin: bool) -> dict[str, list]:
        size = max([*self.cuts, *self.weights, 1]) + 1
        out: dict[str, list] = {"f": [-1] * size, "t": [0.0] * size, "w": [0.0] * size}
        for n, (f, b, value) in self.cuts.items():
            out["f"][n], out["t"][n] = f, float(b) if by_bin else value
        for n, w in self.weights.items():
            out["w"][n] = w
        return out


@dataclass
class BoostedTrees:
    features: list[str]
    base: float
    trees: list[Tree]
    # Error on the validation table after each round, if there was one.
    curve: list[float] = field(default_factory=list)

    def score(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        """Rows with their prediction; a missing feature goes left at every cut."""
        values = F.array(*[_known(c) for c in self.features])
        return df.withColumn(name, F.lit(self.base) + _sum_of(self.trees, values, False))


def _known(name: str) -> Column:
    value = quoted(name).cast("double")
    return F.when(~F.isnan(value), value)


def _literal(trees: Sequence[Tree], by_bin: bool) -> Column:
    return F.from_json(F.lit(json.dumps([t.arrays(by_bin) for t in trees])), TREES)


def _leaf(tree: Column, values: Column, depth: int) -> Column:
    """The node that the row comes to: as many steps as the tree is deep."""

    def step(node: Column, _: Column) -> Column:
        feature = F.get(tree["f"], node)
        right = F.coalesce(F.get(values, feature) > F.get(tree["t"], node), F.lit(False))
        return F.when(feature < 0, node).otherwise(2 * node + right.cast("int"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(max(1, depth))), F.lit(1), step)


def _depth(trees: Sequence[Tree]) -> int:
    return max((max([*t.cuts, 1]).bit_length() for t in trees), default=1)


def _sum_of(trees: Sequence[Tree], values: Column, by_bin: bool) -> Column:
    if not trees:
        return F.lit(0.0)
    depth = _depth(trees)
    return F.aggregate(_literal(trees, by_bin), F.lit(0.0), lambda total, t: total + F.get(t["w"], _leaf(t, values, depth)))


def bin_edges(df: DataFrame, features: Sequence[str], bins: int) -> list[list[float]]:
    """Ascending cut values per feature: all its values if they are few, else quantiles; at most ``bins``."""
    edges = []
    for c in features:
        values = df.select(_known(c).alias("v")).filter("v IS NOT NULL")
        few = [r[0] for r in values.distinct().limit(bins + 1).collect()]
        if len(few) > bins:
            shares = [(i + 1) / bins for i in range(bins)]
            few = values.agg(F.percentile_approx("v", shares, 100 * bins)).first()[0]
        edges.append(sorted(set(few)))
    return edges


def _binned(df: DataFrame, features: Sequence[str], label: str, edges: Sequence[Sequence[float]]) -> DataFrame:
    """``(bins, y)``: per feature how many edges are below the value; -1 where it is missing. Rows without a label go."""

    def place(name: str, cuts: Sequence[float]) -> Column:
        value = _known(name)
        points = F.from_json(F.lit(json.dumps(list(cuts))), "array<double>")
        return F.coalesce(F.when(value.isNotNull(), F.size(F.filter(points, lambda e: e < value))), F.lit(-1))

    y = _known(label)
    bins = F.array(*[place(c, e) for c, e in zip(features, edges, strict=True)])
    return df.select(bins.alias("bins"), y.alias("y")).filter("y IS NOT NULL")


def split_gains(sums: DataFrame, l1: float, l2: float, min_curvature: float = 1.0) -> DataFrame:
    """The gain of every cut, from ``(node, feature, bin, g, h)``: gradient and curvature sums.

    A cut after a bin sends that bin and all before it to the left. Columns added: ``gl``, ``hl``
    (left), ``gt``, ``ht`` (whole node) and ``gain``, NULL where a side has too little curvature.
    """
    node = ["node", "feature"]
    upto = Window.partitionBy(*node).orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*node)
    rows = sums.select(
        "node",
        "feature",
        "bin",
        F.sum("g").over(upto).alias("gl"),
        F.sum("h").over(upto).alias("hl"),
        F.sum("g").over(whole).alias("gt"),
        F.sum("h").over(whole).alias("ht"),
    )

    def worth(g: Column, h: Column) -> Column:
        return F.pow(_shrunk(g, l1), 2) / (h + l2)

    gr, hr = F.col("gt") - F.col("gl"), F.col("ht") - F.col("hl")
    gain = 0.5 * (worth(F.col("gl"), F.col("hl")) + worth(gr, hr) - worth(F.col("gt"), F.col("ht")))
    # Curvatures are sums of ones; half a row covers rounding.
    enough = (F.col("hl") >= min_curvature) & (hr >= min_curvature) & (hr > 0.5)
    return rows.withColumn("gain", F.when(enough, gain))


def _shrunk(g: Column, l1: float) -> Column:
    return F.signum(g) * F.greatest(F.abs(g) - l1, F.lit(0.0))


def best_splits(gains: DataFrame) -> DataFrame:
    """One row per node: its best cut; of equal ones the smallest feature and bin. ``gain`` is NULL if there is none."""
    order = F.struct(F.col("gain"), (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"))
    best = F.max_by(F.struct("feature", "bin", "gain", "gl", "hl"), order)
    return gains.groupBy("node").agg(best.alias("best"), F.first("gt").alias("gt"), F.first("ht").alias("ht")).select(
        "node", "best.*", "gt", "ht"
    )


def histogram(rows: DataFrame, node: Column, gradient: Column, features: Sequence[int]) -> DataFrame:
    """``(node, feature, bin, g, h)`` of rows with an array ``bins``; reduced before the shuffle."""
    kept = F.array(*[F.struct(F.lit(f).alias("feature"), F.get("bins", f).alias("bin")) for f in features])
    exploded = rows.select(node.alias("node"), gradient.alias("g"), F.explode(kept).alias("x"))
    return exploded.groupBy("node", F.col("x.feature").alias("feature"), F.col("x.bin").alias("bin")).agg(
        F.sum("g").alias("g"), F.count(F.lit(1)).cast("double").alias("h")
    )


def _weight(g: float, h: float, p: BoostParams) -> float:
    shrunk = max(abs(g) - p.l1, 0.0) * (1 if g > 0 else -1)
    return -p.learning_rate * shrunk / (h + p.l2) if h + p.l2 > 0 else 0.0


def _grow(rows: DataFrame, gradient: Column, edges: Sequence[Sequence[float]], features: Sequence[int], p: BoostParams) -> Tree:
    """One tree, level by level; the driver gets one row per node of a level."""
    tree, open_nodes = Tree(), {1}
    for level in range(p.max_depth):
        at = _leaf(F.get(_literal([tree], True), F.lit(0)), F.transform("bins", lambda b: b.cast("double")), level) if level else F.lit(1)
        sums = histogram(rows, at, gradient, features).filter(F.col("node").isin(sorted(open_nodes)))
        found = best_splits(split_gains(sums, p.l1, p.l2, p.min_curvature)).collect()
        deeper = set()
        for r in found:
            n = r["node"]
            if r["gain"] is None or r["gain"] <= p.min_gain:
                tree.weights[n] = _weight(r["gt"], r["ht"], p)
                continue
            # Missing values alone on the left: everything known is above the cut.
            value = edges[r["feature"]][r["bin"]] if r["bin"] >= 0 else float("-inf")
            tree.weights.pop(n, None)
            tree.cuts[n] = (r["feature"], r["bin"], value)
            tree.weights[2 * n] = _weight(r["gl"], r["hl"], p)
            tree.weights[2 * n + 1] = _weight(r["gt"] - r["gl"], r["ht"] - r["hl"], p)
            deeper |= {2 * n, 2 * n + 1}
        if not deeper:
            break
        open_nodes = deeper
    return tree


def fit_boosted(
    df: DataFrame, features: Sequence[str], label: str, params: BoostParams | None = None, validation: DataFrame | None = None
) -> BoostedTrees:
    """Fit on squared error. With ``validation`` and ``patience`` it stops early and keeps the best rounds.

    Rows without a label are left out; missing features go left. Row and column samples of a
    tree follow from the seed, the tree's number and the row's place in the written copy.
    Memory of the driver: the trees.
    """
    p = params or BoostParams()
    edges = bin_edges(df, features, p.bins)
    binned = _binned(df, features, label, edges)
    base = binned.agg(F.avg("y")).first()[0]
    if base is None:
        raise ValueError("there is no row with a label")
    rows = binned.withColumns({"row": F.monotonically_increasing_id(), "margin": F.lit(base)})
    rows = materialize(rows, "boost")
    model = BoostedTrees(list(features), base, [])
    usable = [i for i, e in enumerate(edges) if e]
    watched = None
    if validation is not None:
        watched = materialize(_binned(validation, features, label, edges).withColumn("margin", F.lit(base)), "boost-valid")
    values = F.transform("bins", lambda b: b.cast("double"))
    while len(model.trees) < p.rounds and usable:
        fresh: list[Tree] = []
        for number in range(len(model.trees), min(len(model.trees) + STAGE, p.rounds)):
            pick = random.Random(p.seed * 1_000_003 + number)
            some = sorted(pick.sample(usable, max(1, round(p.column_share * len(usable)))))
            drawn = rows
            if p.row_share < 1:
                drawn = rows.filter(F.pmod(F.xxhash64("row", F.lit(p.seed), F.lit(number)), F.lit(10_000)) < round(p.row_share * 10_000))
            gradient = F.col("margin") + _sum_of(fresh, values, True) - F.col("y")
            fresh.append(_grow(drawn, gradient, edges, some, p))
        if watched is not None:
            model.curve += staged_errors(watched, fresh)
            watched = materialize(watched.withColumn("margin", F.col("margin") + _sum_of(fresh, values, True)), "boost-valid")
        model.trees += fresh
        if watched is not None and p.patience is not None:
            best, stop = _patience(model.curve, p.patience, p.min_delta)
            if stop is not None:
                model.trees, model.curve = model.trees[:best], model.curve[:stop]
                return model
        rows = materialize(rows.withColumn("margin", F.col("margin") + _sum_of(fresh, values, True)), "boost")
    if watched is not None and p.patience is not None and model.curve:
        model.trees = model.trees[: _patience(model.curve, p.patience, p.min_delta)[0]]
    return model


def staged_errors(rows: DataFrame, trees: Sequence[Tree]) -> list[float]:
    """Root mean squared error after each further tree; one pass, one sum per tree."""
    values, depth = F.transform("bins", lambda b: b.cast("double")), _depth(trees)
    start = F.struct(F.col("margin").alias("m"), F.array().cast("array<double>").alias("all"))

    def add(state: Column, t: Column) -> Column:
        m = state["m"] + F.get(t["w"], _leaf(t, values, depth))
        return F.struct(m.alias("m"), F.concat(state["all"], F.array(m)).alias("all"))

    staged = F.aggregate(_literal(trees, True), start, add, lambda s: s["all"])
    errors = rows.select(F.posexplode(staged).alias("k", "m"), "y").groupBy("k").agg(F.sqrt(F.avg(F.pow(F.col("m") - F.col("y"), 2))).alias("e"))
    found = {r["k"]: r["e"] for r in errors.collect()}
    return [found[k] for k in sorted(found)]


def _patience(curve: Sequence[float], patience: int, min_delta: float) -> tuple[int, int | None]:
    """Number of the best round, and of the one where waiting ends (None if it does not)."""
    best, at = float("inf"), 0
    for n, e in enumerate(curve, 1):
        if e < best - min_delta:
            best, at = e, n
        elif n - at >= patience:
            return at, n
    return at, None


def early_stop(curve: DataFrame, patience: int = PATIENCE, min_delta: float = MIN_DELTA) -> DataFrame:
    """``(best_round, best_error, stop_round)`` of a validation curve ``(round, error)``, one row per round.

    A round is better if it lowers the best error so far by more than ``min_delta``. The stop
    is the round that is ``patience`` rounds behind the best one; NULL if there is none.
    Rounds number as many as there are trees, so they fit into one array.
    """
    rounds = F.array_sort(F.collect_list(F.struct(F.col("round").cast("long").alias("round"), F.col("error").cast("double").alias("error"))))
    start = F.expr("named_struct('at', CAST(NULL AS BIGINT), 'best', CAST(NULL AS DOUBLE), 'stop', CAST(NULL AS BIGINT))")

    def fold(state: Column, r: Column) -> Column:
        going = state["stop"].isNull()
        better = going & (state["best"].isNull() | (r["error"] < state["best"] - min_delta))
        over = going & ~better & (r["round"] - state["at"] >= patience)
        return F.struct(
            F.when(better, r["round"]).otherwise(state["at"]).alias("at"),
            F.when(better, r["error"]).otherwise(state["best"]).alias("best"),
            F.when(over, r["round"]).otherwise(state["stop"]).alias("stop"),
        )

    folded = curve.filter("error IS NOT NULL").agg(F.aggregate(rounds, start, fold).alias("s"))
    return folded.select(F.col("s.at").alias("best_round"), F.col("s.best").alias("best_error"), F.col("s.stop").alias("stop_round"))
