"""Regression metrics and the rules built on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelake.functions.parsing import observed
from ratelake.model import quoted

# Thresholds.
OVERFIT_RMSE_DIFF = 10.0
OVERFIT_R2_DIFF = 0.1
MIN_R2 = 0.7
MAX_RMSE = 100.0
ALERT_RMSE_RISE = 0.10


def metric_columns(actual: Column, predicted: Column) -> list[Column]:
    """RMSE, R2 and MAE in a single pass; R2 is NULL for a constant target.

    Rows without both values do not count; NaN is no value.
    """
    actual, predicted = observed(actual), observed(predicted)
    both = actual.isNotNull() & predicted.isNotNull()
    error = F.when(both, actual - predicted)
    squared = F.sum(error * error)
    total = F.var_pop(F.when(both, actual)) * F.count(error)
    return [
        F.count(error).alias("n"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.when(total > 0, 1 - squared / total).alias("r2"),
        F.avg(F.abs(error)).alias("mae"),
    ]


def regression_metrics(
    df: DataFrame, actual: str, predicted: str, by: Sequence[str] | Sequence[Column] = ()
) -> DataFrame:
    """Metrics over all rows, or per group; groups are reduced before the shuffle."""
    return df.groupBy(*by).agg(*metric_columns(quoted(actual), quoted(predicted)))


def overfit_check(
    metrics: DataFrame,
    split: str = "split",
    rmse_diff: float = OVERFIT_RMSE_DIFF,
    r2_diff: float = OVERFIT_R2_DIFF,
    min_r2: float = MIN_R2,
    max_rmse: float = MAX_RMSE,
) -> DataFrame:
    """From one ``train`` and one ``test`` metric row: overfitting and acceptance."""

    def of(which: str, name: str) -> Column:
        return F.max(F.when(quoted(split) == F.lit(which), quoted(name)))

    both = metrics.agg(
        (of("test", "rmse") - of("train", "rmse")).alias("rmse_difference"),
        (of("train", "r2") - of("test", "r2")).alias("r2_difference"),
        of("test", "rmse").alias("__rmse"),
        of("test", "r2").alias("__r2"),
    )
    return both.select(
        "rmse_difference",
        "r2_difference",
        ((F.col("rmse_difference") > rmse_diff) | (F.col("r2_difference") > r2_diff)).alias("is_overfitting"),
        ((F.col("__r2") >= min_r2) & (F.col("__rmse") <= max_rmse)).alias("accepted"),
    )


def metrics_over_time(
    predictions: DataFrame,
    actuals: DataFrame,
    on: Sequence[str],
    period: Column,
    actual: str,
    predicted: str,
) -> DataFrame:
    """Join predictions to what really happened, then metrics per period."""
    joined = predictions.join(actuals, list(on), "inner")
    return joined.groupBy(period.alias("period")).agg(*metric_columns(quoted(actual), quoted(predicted)))


def rmse_alerts(per_period: DataFrame, rise: float = ALERT_RMSE_RISE) -> DataFrame:
    """Flag periods whose RMSE exceeds the previous period's by more than ``rise``.

    One row per period goes through the window, in one task: periods are meant to be
    months or days, not single moments.
    """
    before = F.lag("rmse").over(Window.orderBy("period"))
    return per_period.withColumn("previous_rmse", before).withColumn(
        "alert", F.coalesce(F.col("rmse") > F.col("previous_rmse") * F.lit(1 + rise), F.lit(False))
    )


def compare_models(current: DataFrame, candidate: DataFrame) -> DataFrame:
    """Two one-row metric frames to a decision: deploy only a lower RMSE."""
    old = current.select(F.struct("rmse", "r2")).scalar()
    return candidate.select(
        old.getField("rmse").alias("current_rmse"),
        F.col("rmse").alias("candidate_rmse"),
        old.getField("r2").alias("current_r2"),
        F.col("r2").alias("candidate_r2"),
        F.coalesce(F.col("rmse") < old.getField("rmse"), F.lit(False)).alias("deploy"),
    )


def prediction_distribution(df: DataFrame, predicted: str, period: Column) -> DataFrame:
    """Volume, mean, spread and extremes of predictions per period; NaN is no prediction."""
    value = observed(quoted(predicted))
    return df.groupBy(period.alias("period")).agg(
        F.count("*").alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("low"),
        F.max(value).alias("high"),
    )


def prediction_percentiles(
    df: DataFrame, predicted: str, period: Column, shares: Sequence[float] = (0.05, 0.25, 0.5, 0.75, 0.95)
) -> DataFrame:
    """``(period, share, value)``: the smallest prediction that at least this share of its period does not exceed.

    Predictions are reduced to counts of distinct values first. These are numbered through
    in ranges of values, so that a period with very many of them does not meet in one task.
    """
    value = observed(quoted(predicted))
    counted = df.select(period.alias("period"), value.alias("value")).filter(F.col("value").isNotNull())
    counted = counted.groupBy("period", "value").agg(F.count("*").alias("n"))
    whole = counted.groupBy("period").agg(F.sum("n").alias("rows"))
    upto = _running(counted)
    asked = F.explode(F.array(*[F.lit(float(s)) for s in shares])).alias("share")
    reached = upto.join(whole, "period").select("period", "value", "upto", "rows", asked)
    return (
        reached.filter(F.col("upto") >= F.ceil(F.col("share") * F.col("rows")))
        .groupBy("period", "share")
        .agg(F.min("value").alias("value"))
    )


def _running(counted: DataFrame) -> DataFrame:
    """Adds ``upto``: rows of the period with this value or a smaller one.

    A value's band is its leading two digits in scientific form, so bands follow each
    other in order; a window runs within a band, and one over the bands of a period.
    """
    size = F.floor(F.log10(F.abs("value")))
    digits = F.floor(F.abs("value") / F.pow(F.lit(10.0), size - 1))
    band = F.when(F.col("value") == 0, F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("b"))).otherwise(
        F.struct((F.signum("value") * (size + 400)).alias("a"), (F.signum("value") * digits).alias("b"))
    )
    banded = counted.withColumn("__band", band)
    inside = Window.partitionBy("period", "__band").orderBy("value")
    bands = banded.groupBy("period", "__band").agg(F.sum("n").alias("n"))
    earlier = Window.partitionBy("period").orderBy("__band").rowsBetween(Window.unboundedPreceding, -1)
    before = bands.select("period", "__band", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__before"))
    placed = banded.withColumn("__here", F.sum("n").over(inside)).join(before, ["period", "__band"])
    return placed.select("period", "value", (F.col("__before") + F.col("__here")).alias("upto"))
