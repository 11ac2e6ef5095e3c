"""Exact order statistics over data of any size.

The built-in exact aggregates (``median``, ``percentile``, ``mode``) keep every
distinct value of a group in one task. Here a global quantile is found by
narrowing: values are counted by bucket, the running counts tell which bucket holds
the wanted rank, and only the values inside it are looked at again. Each pass is a
scan with small partial aggregates by bucket, without a shuffle of the rows; as counts
of a bucket add up, no task has to merge what all others have gathered.

The same counts per day, kept as a table, give quantiles over any days without reading
the days again (:func:`day_counts`).
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelake.model import quoted
from ratelake.sinks.store import TableStore

# Values that one task may hold for the final, exact step.
EXACT_ROWS = 20_000
# The parts that a bracket is cut into by a pass.
ACCURACY = 4_096
# Buckets of the first pass: each reaches this many times further from zero than the one
# before. Doubles of all sizes and signs have about 150,000 of them.
GROWTH = 1.02
# More than any bucket number, so that signs stay apart and infinities come last.
FAR = 100_000


@dataclass
class _Target:
    column: str
    share: float
    low: float | None = None
    high: float | None = None
    skipped: int = 0
    inside: int = 0
    rank: float = 0.0

    def ends(self) -> tuple[int, int]:
        return math.floor(self.rank), math.ceil(self.rank)


def exact_quantiles(
    df: DataFrame,
    wanted: Mapping[str, Sequence[float]],
    exact_rows: int = EXACT_ROWS,
    accuracy: int = ACCURACY,
    counts: Mapping[str, int] | None = None,
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles per numeric column; NULL and NaN are ignored.

    Returns plain numbers (one per requested quantile). A column without values
    gives None. ``counts`` gives the number of values per column where known.
    """
    columns = list(wanted)
    if not columns:
        return {}
    clean = df.select([_number(c).alias(f"c{i}") for i, c in enumerate(columns)])
    if counts is None:
        found = clean.agg(*[F.count(f"c{i}").alias(c) for i, c in enumerate(columns)]).first()
        counts = found.asDict()
    targets: list[_Target] = []
    for i, c in enumerate(columns):
        n = counts[c]
        targets += [_Target(f"c{i}", p, inside=n, rank=p * (n - 1)) for p in wanted[c]]
    pending = [t for t in targets if t.inside > exact_rows]
    while pending:
        _narrow(clean, pending, accuracy)
        pending = [t for t in pending if t.inside > exact_rows and t.low != t.high]
    values = _finish(clean, targets)
    result: dict[str, list[float | None]] = {}
    for i, c in enumerate(columns):
        result[c] = [v for t, v in zip(targets, values) if t.column == f"c{i}"]
    return result


def _number(name: str) -> Column:
    value = quoted(name).cast("double")
    return F.when(~F.isnan(value), value)


def _within(t: _Target) -> Column:
    inside = F.col(t.column).isNotNull()
    if t.low is not None:
        inside &= (F.col(t.column) >= F.lit(t.low)) & (F.col(t.column) <= F.lit(t.high))
    return inside


def size_bucket(value: Column) -> Column:
    """A whole number that grows with the value, one per two per cent of its size; NULL for NULL."""
    size = F.floor(F.round(F.log(F.abs(value)) / F.lit(math.log(GROWTH)), 9)) + FAR
    far = F.when(F.abs(value) == F.lit(float("inf")), F.lit(2 * FAR)).otherwise(size)
    return F.when(value == 0, F.lit(0)).when(value > 0, far).when(value < 0, -far).cast("long")


def _narrow(clean: DataFrame, pending: list[_Target], accuracy: int) -> None:
    """Shrink every bracket to the bucket that holds its rank; one scan for all pending targets."""
    # Targets in the same bracket share its counts.
    sharing: dict[tuple, list[_Target]] = {}
    for t in pending:
        sharing.setdefault((t.column, t.low, t.high), []).append(t)
    groups = list(sharing.values())
    parts = []
    for i, group in enumerate(groups):
        t, value = group[0], F.col(group[0].column)
        bucket = size_bucket(value)
        if t.low is not None:
            share = (value - F.lit(t.low)) / F.lit(t.high - t.low)
            bucket = F.least(F.floor(share * accuracy), F.lit(accuracy - 1)).cast("long")
        part = F.struct(F.lit(i).alias("g"), bucket.alias("bucket"), value.alias("v"))
        parts.append(F.when(_within(t), part))
    counted = (
        clean.select(F.explode(F.array(*parts)).alias("x"))
        .filter("x IS NOT NULL")
        .groupBy("x.g", "x.bucket")
        .agg(F.count("*").alias("n"), F.min("x.v").alias("low"), F.max("x.v").alias("high"))
    )
    # The buckets of a bracket in order; their number is bounded, whatever the rows are.
    before = Window.partitionBy("g").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    wanted = F.lit(False)
    for i, group in enumerate(groups):
        for rank in {r - t.skipped for t in group for r in t.ends()}:
            wanted |= (F.col("g") == i) & (F.col("before") <= rank) & (F.col("before") + F.col("n") > rank)
    found = placed.filter(wanted).collect()
    for i, group in enumerate(groups):
        rows = [r for r in found if r["g"] == i]
        for t in group:
            lower, upper = (next(r for r in rows if r["before"] <= k - t.skipped < r["before"] + r["n"]) for k in t.ends())
            if lower["bucket"] == upper["bucket"]:
                t.low, t.high, t.inside = lower["low"], lower["high"], lower["n"]
                t.skipped += lower["before"]
            else:
                # The rank lies between two buckets: its neighbours are known exactly.
                share = t.rank - math.floor(t.rank)
                t.low = t.high = lower["high"] * (1 - share) + upper["low"] * share


def _finish(clean: DataFrame, targets: list[_Target]) -> list[float | None]:
    """The exact value from the few rows left in each bracket."""
    answers: list[float | None] = [None] * len(targets)
    asked = []
    for i, t in enumerate(targets):
        if t.low is not None and t.low == t.high:
            answers[i] = t.low
        elif t.inside:
            at = (t.rank - t.skipped) / (t.inside - 1) if t.inside > 1 else 0.0
            asked.append(F.percentile(F.when(_within(t), F.col(t.column)), min(1.0, max(0.0, at))).alias(f"a{i}"))
    if asked:
        found = clean.agg(*asked).first().asDict()
        for name, value in found.items():
            answers[int(name[1:])] = value
    return answers


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, mode)``: the most frequent text per column, the smallest on a tie.

    Counting is a distributed aggregation by (column, value); only the winners
    meet, so neither a hot value nor many distinct values crowd a task.
    """
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), quoted(c).cast("string").alias("value")) for c in columns])
    )
    counted = (
        df.select(pairs.alias("p"))
        .filter(F.col("p.value").isNotNull())
        .groupBy("p.column", "p.value")
        .agg(F.count("*").alias("n"))
    )
    return counted.groupBy("column").agg(F.min(F.struct(-F.col("n"), F.col("value").alias("value"))).alias("best")).select(
        "column", F.col("best.value").alias("mode")
    )


def day_counts(df: DataFrame, day: str, value: str) -> DataFrame:
    """``(day, bucket, n, low, high)``: how many values each bucket of a day holds, and the ends of them.

    NULL and NaN are left out. The size of a day's part does not depend on its number of rows.
    """
    v = _number(value)
    rows = df.select(quoted(day).cast("date").alias("day"), size_bucket(v).alias("bucket"), v.alias("v")).filter("v IS NOT NULL")
    return rows.groupBy("day", "bucket").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))


def store_day_counts(store: TableStore, table: str, df: DataFrame, day: str, value: str) -> None:
    """Count the days of ``df`` anew and put them in place of what was stored for these days."""
    counts = day_counts(df, day, value)
    store.ensure_table(table, counts.schema, "day", granularity="day", description="Values by day and bucket")
    store.replace_partitions(table, counts)


def stored_quantiles(store: TableStore, table: str, shares: Sequence[float], start: date | None = None, end: date | None = None) -> DataFrame:
    """``(share, n, low, high)`` over the stored days from ``start`` to ``end``.

    The value of rank ``floor(share * (n - 1))`` lies between ``low`` and ``high``, the ends of
    what its bucket holds: less than two per cent apart. Without values there are no rows.
    Days add up by bucket; only the buckets, a bounded number, pass through one task.
    """
    days = store.scan(table, start=start, end=end)
    summed = days.groupBy("bucket").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    # Both windows see the buckets only.
    order = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = summed.select("low", "high", F.col("n").alias("inside"), F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))
    total = summed.agg(F.sum("n").alias("n")).filter("n IS NOT NULL")
    asked = total.select("n", F.explode(F.array(*[F.lit(float(s)) for s in shares])).alias("share"))
    asked = asked.withColumn("rank", F.floor(F.col("share") * (F.col("n") - 1)))
    hit = (F.col("before") <= F.col("rank")) & (F.col("rank") < F.col("before") + F.col("inside"))
    return F.broadcast(asked).join(placed, hit).select("share", "n", "low", "high")
