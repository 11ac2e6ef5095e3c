"""How new data differ from a baseline.

The measure is not prescribed; chosen here: the population stability index over
the baseline's deciles, and the greatest distance between the two distribution functions,
which needs no bins.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelake.functions.parsing import observed, observed_in
from ratelake.model import quoted
from ratelake.operators.ordering import ROWS_PER_RANGE
from ratelake.operators.quantiles import exact_quantiles
from ratelake.operators.quality import OUTLIER_THRESHOLD, iqr_fences, outside
from ratelake.session import materialize

BINS = 10
# Stands in for an empty bin, whose logarithm would be infinite.
SMALLEST_SHARE = 1e-4


def population_stability(baseline: DataFrame, current: DataFrame, column: str, bins: int = BINS) -> DataFrame:
    """One row ``(column_name, psi)``; all counting is one grouped aggregation."""
    known = baseline.select(observed_in(baseline, column).alias(column))
    edges = exact_quantiles(known, {column: [i / bins for i in range(1, bins)]})[column]
    both = known.select(quoted(column).alias("v"), F.lit(1).alias("b"), F.lit(0).alias("c")).unionAll(
        current.select(observed_in(current, column).alias("v"), F.lit(0).alias("b"), F.lit(1).alias("c"))
    )
    bin_counts = (
        both.filter(F.col("v").isNotNull())
        .groupBy(_bin_of(F.col("v"), edges).alias("bin"))
        .agg(F.sum("b").alias("b"), F.sum("c").alias("c"))
    )
    totals = bin_counts.agg(
        F.sum("b").alias("b"), F.sum("c").alias("c"), F.collect_list(F.struct("b", "c")).alias("counts")
    )
    expected = F.greatest(F.col("x.b") / F.col("total_b"), F.lit(SMALLEST_SHARE))
    found = F.greatest(F.col("x.c") / F.col("total_c"), F.lit(SMALLEST_SHARE))
    # ``bins`` rows at most from here on.
    per_bin = totals.select(F.col("b").alias("total_b"), F.col("c").alias("total_c"), F.explode("counts").alias("x"))
    return per_bin.agg(F.sum((found - expected) * F.ln(found / expected)).alias("psi")).select(
        F.lit(column).alias("column_name"), "psi"
    )


def _bin_of(value: Column, edges: Sequence[float | None]) -> Column:
    """How many edges lie below the value."""
    steps = [F.when(value > F.lit(e), 1).otherwise(0) for e in edges if e is not None]
    total = F.lit(0)
    for s in steps:
        total = total + s
    return total


def distribution_distance(
    baseline: DataFrame, current: DataFrame, column: str, level: float = 0.05, rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """One row ``(column_name, distance, at_value, baseline_rows, current_rows, drifted)``.

    ``distance`` is the greatest difference between the shares of the two sides that are at or
    below a value (two-sample Kolmogorov-Smirnov), ``at_value`` the smallest value where it is
    reached, and ``drifted`` whether it is significant at ``level``. NULL and NaN take no part;
    where a side has no values, distance, value and verdict are NULL.

    Rows are counted by value before anything is sorted, so a hot value is one row. The values
    are cut into ranges of about ``rows_per_range``; each range sums its own counts, and what
    lies below it comes from one row per range. Only two totals reach the driver.
    """
    sides = baseline.select(observed_in(baseline, column).cast("double").alias("v"), F.lit(1).alias("b"), F.lit(0).alias("c")).unionAll(
        current.select(observed_in(current, column).cast("double").alias("v"), F.lit(0).alias("b"), F.lit(1).alias("c"))
    )
    counted = sides.filter(F.col("v").isNotNull()).groupBy("v").agg(F.sum("b").alias("b"), F.sum("c").alias("c"))
    counted = materialize(counted, "value-counts")
    values, b_rows, c_rows = counted.agg(F.count("*"), F.coalesce(F.sum("b"), F.lit(0)), F.coalesce(F.sum("c"), F.lit(0))).first()
    ranges = max(1, math.ceil(values / rows_per_range))
    cut = materialize(counted.repartitionByRange(ranges, "v").withColumn("range", F.spark_partition_id()), "value-ranges")
    below = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    per_range = cut.groupBy("range").agg(F.sum("b").alias("b"), F.sum("c").alias("c"))
    starts = per_range.select("range", *[F.coalesce(F.sum(x).over(below), F.lit(0)).alias(f"{x}_below") for x in "bc"])
    upto = Window.partitionBy("range").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = cut.select("range", "v", *[F.sum(x).over(upto).alias(x) for x in "bc"]).join(starts, "range")
    exact = lambda x: (F.col(x) + F.col(f"{x}_below")).cast("decimal(19,0)")
    # Whole numbers, so that equal distances are seen to be equal.
    gap = F.abs(exact("b") * F.lit(c_rows).cast("decimal(19,0)") - exact("c") * F.lit(b_rows).cast("decimal(19,0)"))
    most = sums.agg(F.max(F.struct(gap.alias("gap"), (-F.col("v")).alias("minus"))).alias("most"))
    both = F.lit(b_rows > 0 and c_rows > 0)
    distance = F.when(both, F.col("most.gap").cast("double") / F.nullif(F.lit(float(b_rows) * float(c_rows)), F.lit(0.0)))
    critical = math.sqrt(-math.log(level / 2) / 2) * math.sqrt((b_rows + c_rows) / max(1.0, float(b_rows) * float(c_rows)))
    return most.select(
        F.lit(column).alias("column_name"),
        distance.alias("distance"),
        F.when(both, -F.col("most.minus")).alias("at_value"),
        F.lit(b_rows).cast("bigint").alias("baseline_rows"),
        F.lit(c_rows).cast("bigint").alias("current_rows"),
        (distance > critical).alias("drifted"),
    )


def new_values(baseline: DataFrame, current: DataFrame, column: str) -> DataFrame:
    """Categories of ``current`` that the baseline lacks, with their row counts.

    Both sides are reduced to distinct values before they meet.
    """
    seen = baseline.select(quoted(column)).distinct()
    counted = current.filter(quoted(column).isNotNull()).groupBy(quoted(column)).agg(F.count("*").alias("n"))
    return counted.join(seen, column, "left_anti")


def missing_features(baseline: DataFrame, current: DataFrame) -> list[str]:
    """Baseline columns that are absent from the new data."""
    return [c for c in baseline.columns if c not in current.columns]


def feature_coverage(baseline: DataFrame, current: DataFrame) -> DataFrame:
    """Per baseline column: is it absent from the new data, and the share of rows with a value on both sides.

    A feature that still has its column but lost its values drifts as much as one that is
    gone. Two aggregates of one row each; a share over no rows is NULL.
    """
    gone = missing_features(baseline, current)

    def shares(df: DataFrame, side: str) -> DataFrame:
        total = F.nullif(F.count("*"), F.lit(0))
        held = [c for c in baseline.columns if c in df.columns]
        filled = [F.struct(F.lit(c).alias("column_name"), (F.count(observed_in(df, c)) / total).alias(side)) for c in held]
        return df.agg(F.array(*filled).alias("all")).select(F.inline("all"))

    before = shares(baseline, "baseline_filled").withColumn("missing", F.col("column_name").isin(gone))
    if len(gone) == len(baseline.columns):
        return before.withColumn("current_filled", F.lit(0.0))
    after = before.join(shares(current, "current_filled"), "column_name", "left")
    return after.withColumn("current_filled", F.when(F.col("missing"), F.lit(0.0)).otherwise(F.col("current_filled")))


def outlier_share(
    baseline: DataFrame, current: DataFrame, columns: Sequence[str], threshold: float = OUTLIER_THRESHOLD
) -> DataFrame:
    """Share of new values beyond the baseline's fences, per column."""
    fences = iqr_fences(baseline, columns, threshold)
    counted = current.agg(
        *[(F.count_if(outside(c, fences[c])) / F.count(observed(quoted(c)))).alias(c) for c in columns]
    )
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), quoted(c).alias("outlier_share")) for c in columns])
    return counted.select(F.inline(rows))
