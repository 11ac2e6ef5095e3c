"""Approximate nearest neighbours by few stable projections and a kd-tree.

Vectors are projected onto a few Gaussian directions. The squared projected distance of
two points over their squared true distance then follows a chi-square law, whatever the
data. So neighbours are taken in order of projected distance and verified by true
distance, until the next one is so far out that a better neighbour would lie there with
small probability only.

A global kd-tree over the projections, fitted on a bounded sample, deals all rows to
cells. A query first searches its own cell, which bounds its k-th distance; the stopping
test then tells which other cells' boxes it must see at all. In a cell a kd-tree of its
own orders the leaves for each query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelake.session import materialize

K = 10
DIRECTIONS = 8
# A true neighbour is missed with at most this probability.
MISS = 0.02
SAMPLE = 65_536
CELL_ROWS = 8_192
LEAF_ROWS = 128
QUERY_PART = 100_000


def usable(vector: Column) -> Column:
    """Not NULL, not zero, and all components present and finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def chi_square_bound(freedom: int, beyond: float) -> float:
    """The value that a chi-square variable of even ``freedom`` exceeds with probability ``beyond``."""

    def tail(x: float) -> float:
        return math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(freedom // 2))

    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if tail(middle) > beyond else (low, middle)
    return high


def directions(dimension: int, count: int = DIRECTIONS) -> np.ndarray:
    return np.random.default_rng(8117).standard_normal((dimension, count))


def matrix(column: pa.ChunkedArray | pa.Array, dimension: int) -> np.ndarray:
    """A column of equally long lists as a matrix."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(array, pa.ChunkedArray):
        array = pa.concat_arrays(array.chunks) if array.num_chunks else pa.array([], pa.list_(pa.float64()))
    return np.asarray(array.flatten(), dtype=np.float64).reshape(-1, dimension)


class Tree:
    """Splits of a kd-tree in heap order: node i has children 2i+1 and 2i+2; the leaves are the cells."""

    def __init__(self, points: np.ndarray, depth: int):
        self.depth = depth
        self.axis = np.zeros((1 << depth) - 1, dtype=np.int64)
        self.cut = np.zeros((1 << depth) - 1)
        parts = {0: points}
        for node in range(len(self.axis)):
            own = parts.pop(node)
            if len(own):
                self.axis[node] = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
                self.cut[node] = np.median(own[:, self.axis[node]])
            right = own[:, self.axis[node]] > self.cut[node]
            parts[2 * node + 1], parts[2 * node + 2] = own[~right], own[right]

    def cell(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), dtype=np.int64)
        for _ in range(self.depth):
            right = points[np.arange(len(points)), self.axis[node]] > self.cut[node]
            node = 2 * node + 1 + right
        return node - len(self.axis)

    def boxes(self, dimension: int) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper corners of all cells."""
        low = np.full((1, dimension), -np.inf)
        high = np.full((1, dimension), np.inf)
        for level in range(self.depth):
            nodes = np.arange((1 << level) - 1, (2 << level) - 1)
            low, high = np.repeat(low, 2, axis=0), np.repeat(high, 2, axis=0)
            left = np.arange(len(nodes)) * 2
            high[left, self.axis[nodes]] = self.cut[nodes]
            low[left + 1, self.axis[nodes]] = self.cut[nodes]
        return low, high


def box_distance(point: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of a point to each box."""
    out = np.maximum(0.0, np.maximum(low - point, point - high))
    return np.einsum("ij,ij->i", out, out)


def search(query: np.ndarray, near: np.ndarray, k: int, own: int, vectors: np.ndarray, projected: np.ndarray, leaves: list[np.ndarray], low: np.ndarray, high: np.ndarray, ids: list[np.ndarray], bound: float) -> list[tuple[float, int]]:
    """The k nearest ``(distance, id)`` of one query among a cell's vectors, itself left out."""
    best: list[tuple[float, int]] = []
    away = box_distance(near, low, high)
    for leaf in np.argsort(away, kind="stable"):
        worst = best[k - 1][0] if len(best) >= k else math.inf
        if away[leaf] > bound * worst * worst:
            break
        rows = leaves[leaf]
        if worst < math.inf:
            gap = projected[rows] - near
            rows = rows[np.einsum("ij,ij->i", gap, gap) <= bound * worst * worst]
        gap = vectors[rows] - query
        distance = np.sqrt((gap * gap).sum(axis=1))
        for at in np.flatnonzero(distance <= worst):
            best.extend((float(distance[at]), int(i)) for i in ids[rows[at]] if i != own)
        best = sorted(best)[:k]
    return best


def _searcher(dimension: int, k: int, count: int, bound: float, leaf_rows: int):
    def find(rows: pa.Table, asked: pa.Table) -> pa.Table:
        found: tuple[list, list, list] = ([], [], [])
        if rows.num_rows and asked.num_rows:
            onto = directions(dimension, count)
            vectors = matrix(rows.column("vector"), dimension)
            projected = vectors @ onto
            tree = Tree(projected, max(0, math.ceil(math.log2(len(vectors) / leaf_rows))))
            cells = tree.cell(projected)
            order = np.argsort(cells, kind="stable")
            leaves = [x for x in np.split(order, np.flatnonzero(np.diff(cells[order])) + 1) if len(x)]
            low = np.array([projected[x].min(axis=0) for x in leaves])
            high = np.array([projected[x].max(axis=0) for x in leaves])
            ids = [np.asarray(i, dtype=np.int64) for i in rows.column("ids").to_pylist()]
            queries = matrix(asked.column("vector"), dimension)
            for own, query, near in zip(asked.column("query_id").to_pylist(), queries, queries @ onto, strict=True):
                for distance, i in search(query, near, k, own, vectors, projected, leaves, low, high, ids, bound):
                    for column, value in zip(found, (own, i, distance), strict=True):
                        column.append(value)
        return pa.table({"query_id": pa.array(found[0], pa.int64()), "vec_id": pa.array(found[1], pa.int64()), "score": pa.array(found[2], pa.float64())})

    return find


def distinct_vectors(vectors: DataFrame, k: int) -> DataFrame:
    """``(vector, ids)``: each vector once, with the ``k + 1`` smallest ids that have it.

    No query can need more of them, since equal vectors are equally near and ties go to
    smaller ids. The rank limit is applied before the shuffle, so a vector that very many
    rows share does not meet in one task.
    """
    first = Window.partitionBy("vector").orderBy("vec_id")
    few = vectors.distinct().withColumn("place", F.row_number().over(first)).where(F.col("place") <= k + 1)
    return few.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K, miss: float = MISS, sample: int = SAMPLE, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's k nearest of ``vectors``, by Euclidean distance.

    Both tables have ``vec_id`` and ``embedding``. A query's own id is no neighbour of
    it; rows that repeat count once; ties go to smaller ids. Vectors that are NULL, zero,
    or hold NULL or non-finite components take no part, nor do those of another length
    than most have (the longer one, if two are equally common), nor rows without id.
    """
    clean = lambda df: df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector")).where(usable(F.col("vector")) & F.col("vec_id").isNotNull())
    schema = "query_id long, rank int, vec_id long, score double"
    rows = clean(vectors)
    most = rows.groupBy(F.size("vector").alias("d")).count().agg(F.max(F.struct("count", "d"))).first()[0]
    if most is None:
        return vectors.sparkSession.createDataFrame([], schema)
    dimension = int(most["d"])
    known = materialize(distinct_vectors(rows.where(F.size("vector") == dimension), k), "vectors")
    asked = materialize(clean(queries).where(F.size("vector") == dimension).distinct().withColumnRenamed("vec_id", "query_id"), "queries")
    total = known.count()

    # The tree is fitted on a bounded sample; every row is put into its cells.
    share = min(1.0, sample / max(total, 1))
    drawn = known.where(F.shiftrightunsigned(F.xxhash64("vector"), 11).cast("double") < share * float(1 << 53)).select("vector")
    onto = directions(dimension)
    fitted = matrix(drawn.toArrow().column("vector"), dimension) @ onto
    depth = max(0, math.ceil(math.log2(min(max(total, 1) / cell_rows, max(len(fitted), 1) / 32))) if total > cell_rows else 0)
    tree = Tree(fitted, depth)
    bound = chi_square_bound(DIRECTIONS, miss)

    def with_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = tree.cell(matrix(batch.column("vector"), dimension) @ onto)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at)], names=[*batch.schema.names, "cell"])

    celled = materialize(known.mapInArrow(with_cells, "vector array<double>, ids array<long>, cell long"), "cells")
    # A cell that holds more rows than planned is searched in parts.
    parts = {c: max(1, math.ceil(n / (2 * cell_rows))) for c, n in celled.groupBy("cell").count().collect()}
    in_cell = [parts.get(c, 1) for c in range(1 << depth)]
    count = F.element_at(F.array(*[F.lit(n) for n in in_cell]), F.col("cell").cast("int") + 1)
    query_parts = max(1, math.ceil(asked.count() / QUERY_PART))
    dealt = celled.withColumn("part", F.pmod(F.xxhash64("vector"), count).cast("int")).withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(query_parts - 1))))
    dealt = dealt.select("cell", "part", "turn", "vector", "ids")
    turned = asked.withColumn("turn", F.pmod(F.xxhash64("query_id"), F.lit(query_parts)).cast("int"))
    find = _searcher(dimension, k, DIRECTIONS, bound, LEAF_ROWS)
    keys = ["cell", "part", "turn"]

    def found(sent: DataFrame) -> DataFrame:
        return dealt.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInArrow(find, "query_id long, vec_id long, score double")

    def best(df: DataFrame) -> DataFrame:
        order = Window.partitionBy("query_id").orderBy("score", "vec_id")
        return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    # First its own cell, for a bound of its k-th distance.
    home = turned.mapInArrow(with_cells, "query_id long, vector array<double>, turn int, cell long").withColumn("part", F.lit(0))
    first = best(found(home)).groupBy("query_id").agg(F.max("score").alias("radius"), F.count(F.lit(1)).alias("n"))
    bounded = turned.join(first, "query_id", "left").select("query_id", "vector", "turn", F.when(F.col("n") == k, F.col("radius")).alias("radius"))
    low, high = tree.boxes(onto.shape[1])

    def reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = matrix(batch.column("vector"), dimension) @ onto
            radius = batch.column("radius").to_pylist()
            cells = [
                np.flatnonzero(box_distance(p, low, high) <= (math.inf if r is None else bound * r * r)).tolist()
                for p, r in zip(at, radius, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.select(["query_id", "vector", "turn"]).columns, pa.array(cells, pa.list_(pa.int64()))], names=["query_id", "vector", "turn", "cells"]
            )

    everywhere = bounded.mapInArrow(reached, "query_id long, vector array<double>, turn int, cells array<long>")
    everywhere = everywhere.withColumn("cell", F.explode("cells")).withColumn("part", F.explode(F.sequence(F.lit(0), count - 1)))
    return best(found(everywhere.select(*keys, "query_id", "vector"))).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
