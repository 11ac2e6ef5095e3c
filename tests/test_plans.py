"""What the physical plans must and must not contain."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from ratelake.model import SeriesSpec
from ratelake.operators.dedupe import keep_first
from ratelake.operators.features import lags
from ratelake.operators.fill import forward_fill
from ratelake.operators.impute import impute_mean
from ratelake.operators.merge import outer_merge, pivot_merge
from ratelake.operators.quantiles import modes


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def rates(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("rates") / "t")
    spark.range(3000).select(
        F.date_add(F.lit(date(2000, 1, 1)), F.col("id").cast("int")).alias("Fecha"),
        F.when(F.col("id") % 3 > 0, F.col("id") * 1.0).alias("a"),
        F.when(F.col("id") % 5 > 0, F.col("id") * 2.0).alias("b"),
        F.col("id").cast("string").alias("unused"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_fill_windows_are_cut_into_ranges(rates):
    text = plan(forward_fill(rates.select("Fecha", "a"), rows_per_range=200, distinct_order=True))
    assert "windowspecdefinition(__range" in text
    # Without a series key only one row per group of ranges goes through one task.
    assert text.count("Exchange SinglePartition") == 1
    assert "HashAggregate(keys=[__group" in text.split("Exchange SinglePartition")[1]
    assert "unused" not in text


def test_cut_rows_are_read_from_their_sorted_copy(spark, rates):
    keyed = rates.withColumn("k", F.when(F.col("Fecha") < date(2006, 1, 1), F.lit("long")).otherwise(F.lit("short")))
    text = plan(forward_fill(keyed.select("k", "Fecha", "a"), partition_by=["k"], rows_per_range=1000))
    assert "/ordered-" in text and "/long-series-" in text
    # The input itself is read for the short series only, the carry from one row per range.
    assert text.count("/rates") + text.count("/t]") <= 2 and "/per-range-" in text


def test_small_inputs_are_one_range(rates):
    text = plan(forward_fill(rates.select("Fecha", "a"), distinct_order=True))
    assert "/ordered-" not in text and "Exchange rangepartitioning" not in text


def test_lags_windows_are_partitioned_by_chunk(rates):
    text = plan(lags(rates.select("Fecha", "a"), ["a"], chunk_rows=500, rows_per_range=200))
    assert "windowspecdefinition(__chunk" in text


def test_pivot_is_one_shuffle_with_partial_aggregation(spark, rates):
    long = rates.select(F.lit("a").alias("series"), "Fecha", F.col("a").alias("value"))
    text = plan(pivot_merge(long, [SeriesSpec("a", "a", "a_obs")]))
    assert text.count("Exchange") == 1 and "partial_max" in text


def test_merge_shuffles_each_series_once(spark, rates):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frames = [rates.select("Fecha", F.col("a").alias(f"v{i}")) for i in range(4)]
        text = plan(outer_merge(frames))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("SortMergeJoin") == 4 and "FullOuter" not in text
    # Four series, the distinct keys, and one move of the keys to the null-safe key.
    assert text.count("Exchange hashpartitioning") == 6


def test_merge_of_big_inputs_is_not_forced_to_broadcast(spark, rates):
    assert "CartesianProduct" not in plan(outer_merge([rates.select("Fecha", "a"), rates.select("Fecha", "b")]))


def test_statistics_reach_rows_without_a_join(rates):
    text = plan(impute_mean(rates, ["a", "b"]))
    assert "Subquery" in text and "NestedLoopJoin" not in text and "Cartesian" not in text


def test_counting_and_first_rows_reduce_before_the_shuffle(rates):
    assert "partial_count" in plan(modes(rates, ["unused"]))
    assert "partial_min_by" in plan(keep_first(rates, ["Fecha"], ["a"]))
