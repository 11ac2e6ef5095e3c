"""Put series side by side, and months one after another."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelake.model import DATE_COLUMN, SeriesSpec, quoted
from ratelake.session import materialize


def outer_merge(frames: Sequence[DataFrame], key: str = DATE_COLUMN) -> DataFrame:
    """Full outer merge of any number of series on ``key``.

    A NULL key matches a NULL key, and repeated keys multiply. Instead of a chain
    of full joins, which would shuffle the growing result at every step, the
    distinct keys of all inputs are collected first and each input is joined to
    them from the left: the result keeps its partitioning, so each input is
    shuffled once.
    """
    if not frames:
        raise ValueError("nothing to merge")
    if len(frames) == 1:
        return frames[0]
    merged = reduce(DataFrame.union, [f.select(quoted(key)) for f in frames]).distinct()
    for i, frame in enumerate(frames):
        side = frame.withColumnRenamed(key, f"__key{i}")
        merged = merged.join(side, merged[key].eqNullSafe(side[f"__key{i}"]), "left").drop(f"__key{i}")
    return merged


def pivot_merge(
    long: DataFrame,
    specs: Sequence[SeriesSpec],
    key: str = DATE_COLUMN,
    series: str = "series",
    value: str = "value",
    duplicates: str = "fail",
) -> DataFrame:
    """The same merge for a long table ``(series, key, value)``.

    One shuffle for all series, and partial aggregation means that a key with a
    large share of the rows costs nothing extra. This is enough while each series
    holds a key once. Otherwise ``duplicates`` decides: ``fail`` stops the job,
    ``multiply`` sends only the repeated keys through :func:`outer_merge`.
    """
    present = long.filter(quoted(series).isin([s.api_name for s in specs]))
    counted = present.groupBy(quoted(key)).agg(
        *[_only(series, s, quoted(value), F.max).alias(s.column) for s in specs],
        *[_only(series, s, F.lit(1), F.count).alias(f"__n_{s.column}") for s in specs],
    )
    most = F.greatest(*[F.col(f"`__n_{s.column}`") for s in specs], F.lit(0))
    names = [quoted(s.column) for s in specs]
    if duplicates == "fail":
        message = F.lit(f"a series repeats a {key}; merge with duplicates='multiply'")
        checked = F.when(most > 1, F.raise_error(message).cast(long.schema[value].dataType))
        return counted.select(key, *[checked.otherwise(n).alias(s.column) for n, s in zip(names, specs)])
    if duplicates != "multiply":
        raise ValueError(f"unknown duplicates rule: {duplicates}")
    single = counted.filter(most <= 1).select(key, *names)
    repeated = counted.filter(most > 1).select(F.col(key).alias("__repeated"))
    again = present.join(repeated, quoted(key).eqNullSafe(F.col("__repeated")), "left_semi")
    frames = [
        again.filter(quoted(series) == F.lit(s.api_name)).select(quoted(key), quoted(value).alias(s.column))
        for s in specs
    ]
    return single.unionByName(outer_merge(frames, key))


def merge_long(
    long: DataFrame,
    specs: Sequence[SeriesSpec],
    key: str = DATE_COLUMN,
    series: str = "series",
    value: str = "value",
    stage: Callable[[DataFrame], DataFrame] = materialize,
) -> DataFrame:
    """The merge of a long table, repeated keys included.

    The rows are staged, so that parsing them happens once; then one aggregation
    finds out whether any key repeats at all. Almost always none does, and the
    single-shuffle form is enough.
    """
    rows = stage(long.select(quoted(series), quoted(key), quoted(value)))
    repeats = rows.groupBy(quoted(series), quoted(key)).count().filter("count > 1")
    return pivot_merge(rows, specs, key, series, value, "fail" if repeats.isEmpty() else "multiply")


def _only(series: str, spec: SeriesSpec, what: Column, aggregate) -> Column:
    return aggregate(F.when(quoted(series) == F.lit(spec.api_name), what))


def union_months(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack by column name; a column that one input lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def sort_by_key(df: DataFrame, key: str = DATE_COLUMN) -> DataFrame:
    """Ascending, NULLs last. For final output only: any later shuffle undoes it."""
    return df.orderBy(F.col(key).asc_nulls_last())


def sorted_positions(df: DataFrame, key: str = DATE_COLUMN, name: str = "position") -> DataFrame:
    """The rows of the sorted output with their place in it, from 0.

    The place follows from where the sort put a row: its place in its partition, and the
    rows of the partitions before. The sorted rows are written once, as a second sort could
    deal equal keys differently; one count per partition passes through one task.
    """
    placed = sort_by_key(df, key).withColumn("__id", F.monotonically_increasing_id())
    placed = materialize(placed.withColumn("__part", F.shiftright("__id", 33)), "sorted")
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("__part").agg(F.count("*").alias("__rows"))
    starts = counts.select("__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"))
    position = F.col("__start") + F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(starts, "__part").select(*[quoted(c) for c in df.columns], position.alias(name))
