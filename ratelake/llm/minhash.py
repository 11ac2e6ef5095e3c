"""Near-duplicate documents by MinHash with tensored bands.

A table key of an ordinary banding needs its own ``r`` min-hashes. Here two collections
of ``m`` short bands are computed, and every pair of one band from each gives a table key:
m*m keys for the price of 2*m bands. Two documents meet in some table exactly if they
agree in a band of each collection, so with similarity s a pair is found with probability
``(1 - (1 - s**r)**m)**2``: 0.9990 at 0.85 and 0.9999 at 0.9 for m=8, r=3.

Documents with equal shingle sets are one class from the start, so copies never enter the
tables more than once. In a bucket every class is compared with one hub (the class that
shares most buckets with others, as the original of altered copies does), not with every
other; what is still apart afterwards is compared across the apart parts only. All links
are confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelake.llm.common import components, hash64, lower_ascii, shielded, shifted, split_words
from ratelake.session import materialize

WIDTH = 5
BANDS = 8
ROWS = 3
PERCENT = 85
# Node lists up to this many ids (8 bytes each) may be sent to every executor.
BROADCAST_IDS = 1_000_000


def with_shingles(df: DataFrame, text: Column, name: str) -> DataFrame:
    """Adds the distinct 64-bit hashes of the text's 5-word shingles.

    Fewer words than that form one shingle of the whole sequence; no words, no shingle.
    """
    w, p = F.col("_w"), F.col("_p")
    fours = F.zip_with(p, shifted(p, 2), lambda a, b: hash64(a, b))
    fives = F.zip_with(fours, shifted(w, 4), lambda a, b: hash64(a, b))
    # The number of words goes with a short sequence, so that it never equals a shingle.
    short = F.when(F.size(w) == 0, F.array().cast("array<bigint>")).otherwise(F.array(hash64(F.lit("short"), F.array_join(w, " "))))
    return (
        df.withColumn("_w", split_words(lower_ascii(text)))
        .withColumn("_p", F.zip_with(w, shifted(w, 1), lambda a, b: hash64(a, b)))
        .withColumn(name, F.when(F.size(w) < WIDTH, short).otherwise(F.array_distinct(F.slice(fives, F.lit(1), F.greatest(F.size(w) - (WIDTH - 1), F.lit(0))))))
        .drop("_w", "_p")
    )


def _mix(values: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that carries every bit into every other."""
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def _signer(bands: int, rows: int):
    """A function from batches of (doc_id, shingles) to ids, set sizes, set fingerprints and bands."""
    draw = np.random.default_rng(20240607)
    factors = draw.integers(0, 2**63, (2, bands, rows), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    masks = draw.integers(0, 2**63, (2, bands, rows), dtype=np.uint64)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("shingles")
            ends = np.asarray(lists.offsets)
            flat = np.asarray(lists.values)[ends[0] : ends[-1]].view(np.uint64)
            sizes = np.diff(ends)
            some = sizes > 0
            starts = (ends[:-1] - ends[0])[some]
            prints = np.zeros((2, len(sizes)), dtype=np.uint64)
            keys = np.zeros((2, len(sizes), bands), dtype=np.uint64)
            if len(starts):
                for k in range(2):
                    prints[k, some] = np.add.reduceat(_mix(flat + np.uint64(k + 1)), starts)
                for half in range(2):
                    for band in range(bands):
                        key = np.full(len(starts), half * bands + band, dtype=np.uint64)
                        for row in range(rows):
                            low = np.minimum.reduceat((flat ^ masks[half, band, row]) * factors[half, band, row], starts)
                            key = _mix(key ^ low)
                        keys[half, some, band] = key
            fill = lambda x: pa.FixedSizeListArray.from_arrays(pa.array(x.view(np.int64).ravel()), bands).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes.astype(np.int64)), *(pa.array(p.view(np.int64)) for p in prints), fill(keys[0]), fill(keys[1])],
                names=["doc_id", "n", "f1", "f2", "a", "b"],
            )

    return sign


def signatures(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per document: set size ``n``, set fingerprint ``f1, f2``, the two band collections."""
    sets = with_shingles(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")), F.col("text"), "shingles")
    return sets.select("doc_id", "shingles").mapInArrow(_signer(bands, rows), "doc_id long, n long, f1 long, f2 long, a array<long>, b array<long>")


def _few(ids: DataFrame) -> DataFrame:
    """The ids, marked for broadcast where their count is proven small."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets overlap in at least ``percent`` of their union."""
    left = sets.select(F.col("node").alias("x"), F.col("shingles").alias("sx"))
    right = sets.select(F.col("node").alias("y"), F.col("shingles").alias("sy"))
    both = pairs.join(left, "x").join(right, "y").withColumn("common", F.size(F.array_intersect("sx", "sy")))
    return both.where(100 * F.col("common") >= percent * (F.size("sx") + F.size("sy") - F.col("common"))).select(F.col("x").alias("a"), F.col("y").alias("b"))


def _fits(x: str, y: str, percent: int) -> Column:
    """Whether sets of these sizes can be that similar at all."""
    return 100 * F.least(x, y) >= percent * F.greatest(x, y)


def across(nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(x, y)`` of ``nodes (node, n, root)`` with different roots that can still be linked.

    Two sets that overlap so much share one of their rarest elements: with ``n`` elements,
    of which at least ``percent`` must be common, the rarest ``n - ceil(n * percent) + 1``
    cannot all be missing in the other. The first common one must moreover stand so far
    in front in both that enough elements follow. Altered copies differ from each other
    in elements of their own, which are the rarest, so pairs that only look alike drop out.
    """
    elements = materialize(nodes.join(sets, "node").select("node", "n", "root", F.explode("shingles").alias("element")), "elements")
    found_in = elements.groupBy("element").agg(F.count_distinct("node").alias("nodes"))
    rarest = Window.partitionBy("node").orderBy("nodes", "element")
    first = elements.join(found_in, "element").distinct().withColumn("place", F.row_number().over(rarest))
    least_common = F.ceil(F.col("n") * percent / 100)
    heads = first.where((F.col("place") <= F.col("n") - least_common + 1) & (F.col("nodes") > 1))
    heads = materialize(heads.select("element", "node", "n", "root", "place"), "heads")
    other = heads.select("element", F.col("node").alias("y"), F.col("n").alias("m"), F.col("root").alias("other"), F.col("place").alias("at"))
    common = F.ceil(percent * (F.col("n") + F.col("m")) / (100 + percent))
    enough = (F.col("place") + common <= F.col("n") + 1) & (F.col("at") + common <= F.col("m") + 1)
    return (
        heads.withColumnRenamed("node", "x")
        .join(other, "element")
        .where((F.col("x") < F.col("y")) & (F.col("root") != F.col("other")) & _fits("n", "m", percent) & enough)
        .select("x", "y")
        .distinct()
    )


def near_duplicates(docs: DataFrame, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per row of ``docs``.

    Documents whose shingle sets overlap in at least ``percent`` of the union are linked;
    ``component_id`` is the smallest doc_id reachable over links. NULL and empty texts
    have no shingles and no links. Rows that share a doc_id go each by its own text, and
    groups with the same smallest doc_id are one. A row without doc_id links nothing: its
    component is NULL and it is kept. Other columns of ``docs`` play no part.
    """
    signed = materialize(signatures(docs, bands, rows), "signatures")
    able = signed.where("n > 0 AND doc_id IS NOT NULL")
    classes = materialize(
        able.groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("node"), F.first("a").alias("a"), F.first("b").alias("b")), "classes"
    )
    tables = classes.select("node", "n", F.explode(F.flatten(F.transform("a", lambda x: F.transform("b", lambda y: hash64(x, y))))).alias("key"))
    shared = tables.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    met = materialize(tables.join(shared, "key"), "met")
    nodes = met.groupBy("node").agg(F.sum("members").alias("degree"))
    hubs = met.join(nodes, "node").groupBy("key").agg(F.max(F.struct("degree", (-F.col("node")).alias("node"), "n")).alias("hub"))
    pairs = (
        met.join(hubs, "key")
        .select(F.col("node").alias("x"), (-F.col("hub.node")).alias("y"), "n", F.col("hub.n").alias("m"))
        .where((F.col("x") != F.col("y")) & _fits("n", "m", percent))
        .select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
        .distinct()
    )
    pairs = materialize(pairs, "pairs")
    wanted = _few(met.select(F.col("node").alias("doc_id")).distinct())
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted, "doc_id", "left_semi")
    sets = materialize(with_shingles(chosen, F.col("text"), "shingles").select(F.col("doc_id").alias("node"), "shingles"), "sets")
    links = materialize(confirmed(pairs, sets, percent), "links")
    roots = components(links)

    # Buckets whose members are still in different components: compare across the components.
    placed = materialize(met.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "placed")
    apart = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("key")
    open_nodes = placed.join(apart, "key", "left_semi").select("node", "n", "root").distinct()
    rest = across(materialize(open_nodes, "open"), sets, percent).join(pairs, ["x", "y"], "left_anti")
    more = confirmed(materialize(rest, "rest"), sets, percent)
    links = materialize(links.union(more), "links")
    roots = components(links)

    found = able.groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("node"))
    named = materialize(found.join(roots, "node", "left").select("n", "f1", "f2", F.coalesce("root", "node").alias("component_id")), "named")
    linked = able.select("doc_id", "n", "f1", "f2").join(named, ["n", "f1", "f2"]).select("doc_id", "n", "component_id")
    alone = signed.where("n = 0 OR doc_id IS NULL").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return linked.union(alone).select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, percent: int = PERCENT, bands: int = BANDS) -> DataFrame:
    """The rows of ``docs`` that stay: one row of each group of linked texts, with its columns.

    The row with the smallest doc_id stays (NULL last). Rows are judged each by its own
    text: where doc_ids repeat or are NULL, rows are numbered first, so that a text is never
    dropped for another one that has its id, and of equal rows one stays. Texts without
    words are linked with nothing and all stay.
    """
    inside, back = shielded(docs, "doc_id", "text")
    unclear = docs.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL")
    if unclear.isEmpty():
        found = near_duplicates(docs, percent, bands)
        gone = materialize(found.where("NOT kept").select("doc_id"), "gone")
        return inside.join(_few(gone), "doc_id", "left_anti").select(*back.values())
    rows = materialize(inside.withColumn("_row", F.monotonically_increasing_id()), "rows")
    found = near_duplicates(rows.select(F.col("_row").alias("doc_id"), "text"), percent, bands)
    placed = found.select(F.col("doc_id").alias("_row"), "component_id").join(rows.select("_row", "doc_id"), "_row")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "_row")).alias("first")
    stay = materialize(placed.groupBy("component_id").agg(first).select("first._row"), "stay")
    return rows.join(_few(stay), "_row", "left_semi").select(*back.values())
