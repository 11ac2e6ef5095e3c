"""Helpers shared by the corpus operators: words, keyed hashes, ranks, components."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Hashable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratelake.session import materialize

# The six ASCII white-space characters: blank, tab, line feed, vertical tab, form feed, return.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def once(key: Hashable, make: Callable[[], Any]) -> Any:
    """What ``make`` returns, made once per worker process and kept for its later tasks.

    Functions of this package travel by value, and their globals are new in every task; so
    vocabularies that are costly to load are kept in a module of their own.
    """
    kept = sys.modules.setdefault("_corpus_once", types.ModuleType("_corpus_once")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


def shielded(df: DataFrame, *used: str) -> tuple[DataFrame, dict[str, Column]]:
    """``df`` with names free for the operator's own columns, and the columns that give it back.

    All columns but ``used`` go under numbered names, so that no name of the caller's can
    clash with one made inside. The second part maps each of the caller's names to its column.
    """
    inside = {c: c if c in used else f"_given{i}" for i, c in enumerate(df.columns)}
    renamed = df.select(*[F.col(f"`{c.replace('`', '``')}`").alias(n) for c, n in inside.items()])
    return renamed, {c: F.col(n).alias(c) for c, n in inside.items()}


def split_words(text: Column) -> Column:
    """The runs of characters other than ASCII white space; NULL text has none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(F.length(trimmed) == 0, F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK_RUN))


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z; no other letter changes."""
    return F.translate(text, UPPER, UPPER.lower())


def shifted(array: Column, by: int) -> Column:
    """The array without its first ``by`` elements, for ``zip_with`` (which evaluates each array once)."""
    return F.slice(array, by + 1, 1 << 30)


def hash64(*columns: Column | str) -> Column:
    return F.xxhash64(*columns)


def where_computed(df: DataFrame, condition: Column) -> DataFrame:
    """The rows of ``df`` that meet a condition on computed columns.

    A filter is otherwise moved below the projection that computes them, and would
    compute them a second time, once more for every use in the condition. A row number,
    whose value does not matter, keeps it in place.
    """
    numbered = df.withColumn("_row", F.monotonically_increasing_id())
    return numbered.where(condition & (F.col("_row") >= 0)).drop("_row")


def rank_in_groups(df: DataFrame, group: str, strata: list[str], spread: str, order: list[str], name: str = "rank") -> DataFrame:
    """Adds the row's place (from 0) among the rows of its ``group``.

    Rows are ordered by ``strata``, then ``spread`` (an evenly spread non-negative
    long below 2**32), then ``order``; ``group``, strata and spread must not be NULL.
    No task sorts a whole group: a cell is a group, stratum and leading bits of
    ``spread``; there are about as many cells in the largest stratum as rows in a
    cell, so both the table of cells and a cell stay near the square root of it.
    Equal rows are interchangeable, whichever comes first.
    """
    stratum = [group, *strata]
    largest = df.groupBy(*stratum).count().agg(F.max("count")).first()[0] or 0
    bits = min(32, max(0, (int(largest).bit_length() - 1) // 2))
    celled = df.withColumn("_cell", F.shiftright(F.col(spread), 32 - bits))
    cells = celled.groupBy(*stratum, "_cell").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(group).orderBy(*strata, "_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.select(*stratum, "_cell", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*stratum, "_cell").orderBy(spread, *order)
    placed = celled.withColumn("_inside", F.row_number().over(inside) - 1)
    return placed.join(starts, [*stratum, "_cell"]).withColumn(name, F.col("_before") + F.col("_inside")).drop("_cell", "_before", "_inside")


def components(links: DataFrame, label: str = "links") -> DataFrame:
    """Connected components of ``links (a long, b long)``: ``(node, root)``, root the smallest node.

    Alternates two star contractions until the links are stars around the smallest
    nodes: first every node hands its larger neighbours to its smallest neighbour,
    then its smaller ones. Each round is a grouped minimum (combined before the
    shuffle) and a join, which may be split where a node has very many links; each
    round's links are written to the shared folder, which also cuts lineage.
    """
    links = materialize(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label
    )
    before = None
    while True:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = materialize(large, label)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x")).select("x.*")
        links = materialize(small.where("a <> b").distinct(), label)
        after = links.agg(F.count(F.lit(1)), F.sum(hash64("a", "b").cast("decimal(38,0)"))).first()
        if after == before:
            break
        before = after
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(links.select(F.col("b"), F.col("b")).distinct())


def text_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table of fixed values."""
    return spark.createDataFrame(rows, schema)
