"""Mixing sources to target weights by systematic sampling.

Every source gets a target share of the words; a document's expected copies are its
source's target over its source's size. Within a source the expected copies are summed
up in a fixed order, one offset is added, and a copy is emitted for every whole number
that the running sum crosses. Documents of like length stand together in that order, so
the words taken stay near the target as well as the copies do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelake.llm.common import rank_in_groups, shielded, split_words

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
SEED = "mix-1"


def size_class(size: Column) -> Column:
    """Number of digits and the two leading ones: sizes of one class differ by a tenth at most."""
    digits = size.cast("string")
    return F.length(digits) * 100 + F.substring(digits, 1, 2).cast("int")


def spread_of(doc_id: Column) -> Column:
    """An evenly spread long below 2**32 for each id."""
    key = F.concat(F.lit(SEED + ":"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``(source, source_size, target)`` from rows of ``(source, size)``.

    Sources in code-point order, NULL last, take the weights in turn. The targets add up
    to ``share`` of all sizes; none is above ``most`` times its source's size, and what
    is above goes to the others by weight until none is. That ends where one water level
    serves all sources below their bound: with sources ordered by bound over weight, the
    bounded ones come first, so a running sum finds the level in one pass. The windows
    without partition run over one row per source.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = Window.orderBy(F.col("source").asc_nulls_last())
    at = (F.row_number().over(place) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), at + 1)
    bounded = sources.withColumn("weight", weight).withColumn("bound", most * F.col("source_size"))
    everything = Window.partitionBy()
    by_ratio = Window.orderBy((F.col("bound") / F.col("weight")), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (share * F.sum("source_size").over(everything) - F.coalesce(F.sum("bound").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    levelled = bounded.withColumn("_level", level).withColumn("_open", F.col("_level") * F.col("weight") < F.col("bound"))
    common = F.max(F.when(F.col("_open"), F.col("_level"))).over(everything)
    target = F.when(F.col("_open"), F.least(common * F.col("weight"), F.col("bound"))).otherwise(F.col("bound"))
    return levelled.withColumn("target", target.cast("double")).select("source", "source_size", "target")


def offset_of(source: Column) -> Column:
    """The source's random offset, a multiple of 2**-20 below 1."""
    key = F.concat(F.lit(SEED + "/"), F.coalesce(source, F.lit("")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 5), 16, 10).cast("double") / F.lit(float(1 << 20))


def _chosen(df: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """``df``, whose names are shielded, plus ``mix``."""
    sized = df.withColumn("_size", F.size(split_words(F.col("text"))).cast("long"))
    targets = source_targets(sized.select("source", F.col("_size").alias("size")), weights, share, most)
    key = F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))
    keyed = sized.withColumn("_source", key).withColumn("_class", size_class(F.col("_size"))).withColumn("_spread", spread_of(F.col("doc_id")))
    ranked = rank_in_groups(keyed, "_source", ["_class"], "_spread", ["doc_id"], "_rank")
    each = targets.withColumn("_source", key).drop("source").withColumnsRenamed({"source_size": "_source_size", "target": "_target"})
    rate = F.when(F.col("_source_size") > 0, F.col("_target") / F.col("_source_size")).otherwise(F.lit(0.0))
    start = offset_of(F.col("source"))
    crossed = F.floor(start + rate * (F.col("_rank") + 1)) - F.floor(start + rate * F.col("_rank"))
    mix = F.struct(
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        crossed.cast("long").alias("copies"),
        (crossed * F.col("_size")).cast("long").alias("taken"),
    )
    return ranked.join(each, "_source").withColumn("mix", mix)


def choose(df: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``df`` (with ``doc_id``, ``text``, ``source``) plus ``mix``: size, source_size, target, copies, taken.

    Rows of no size count, and take copies like others; a source of size 0 takes none.
    NULL sources form one source, NULL ids sort together, rows that repeat are rows of
    their own. Every rerun chooses the same copies. A document's copies are the floor or
    ceiling of its expectation, so never above ``most``. An existing ``mix`` column is
    replaced; other columns pass through whatever their names.
    """
    inside, back = shielded(df, "doc_id", "text", "source")
    return _chosen(inside, weights, share, most).select(*[c for name, c in back.items() if name != "mix"], "mix")


def mixed(df: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """The mixture itself: every row of ``df``, with all its columns, as often as it was chosen."""
    inside, back = shielded(df, "doc_id", "text", "source")
    chosen = _chosen(inside, weights, share, most).where("mix.copies > 0")
    return chosen.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("mix.copies")))).select(*back.values())
