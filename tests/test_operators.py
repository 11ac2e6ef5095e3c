"""Merging, filling, deduplication, imputation and the ordered primitives.

Every scalable form is compared with its plain, single-task equivalent.
"""

import math
import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F

from ratelake.model import SeriesSpec
from ratelake.operators import drift, features, metrics, quality
from ratelake.operators.dedupe import drop_duplicate_rows, keep_first
from ratelake.operators.features import lags, learn_categories, one_hot, rolling, scale, select_features
from ratelake.operators.fill import forward_fill
from ratelake.operators.filters import in_date_range, scan
from ratelake.operators.impute import impute_mean
from ratelake.operators.merge import outer_merge, pivot_merge, sort_by_key, union_months
from ratelake.operators.ordering import RANGE, row_numbers, with_ranges
from ratelake.operators.quantiles import exact_quantiles, modes, size_bucket, store_day_counts, stored_quantiles
from ratelake.plans.clean import clean

D1, D2 = date(2024, 1, 1), date(2024, 1, 2)


def test_merge_matches_null_keys_and_multiplies(spark, rows):
    a = spark.createDataFrame([(None, 1), (D1, 2)], "Fecha date, x int")
    b = spark.createDataFrame([(None, 3), (None, 4)], "Fecha date, y int")
    assert rows(outer_merge([a, b])) == sorted([(D1, 2, None), (None, 1, 3), (None, 1, 4)], key=repr)


def test_pivot_equals_join_on_unique_keys(spark, rows):
    rng = random.Random(1)
    data = [(s, D1 + timedelta(days=d), float(d)) for s in "abc" for d in range(60) if rng.random() < 0.6]
    long = spark.createDataFrame(data, "series string, Fecha date, value double")
    specs = [SeriesSpec(s, s, f"{s}_obs") for s in "abc"]
    frames = [long.filter(F.col("series") == s.name).select("Fecha", F.col("value").alias(s.column)) for s in specs]
    assert rows(pivot_merge(long, specs)) == rows(outer_merge(frames))


def test_pivot_refuses_or_multiplies_repeats(spark, rows):
    long = spark.createDataFrame(
        [("a", D1, 1.0), ("a", D1, 2.0), ("b", D1, 3.0), ("b", D2, 4.0)], "series string, Fecha date, value double"
    )
    specs = [SeriesSpec(s, s, f"{s}_obs") for s in "ab"]
    with pytest.raises(PySparkException, match="repeats"):
        pivot_merge(long, specs).collect()
    assert rows(pivot_merge(long, specs, duplicates="multiply")) == [
        (D1, 1.0, 3.0),
        (D1, 2.0, 3.0),
        (D2, None, 4.0),
    ]


def test_union_fills_missing_columns(spark, rows):
    m1 = spark.createDataFrame([(D1, 1, 2)], "Fecha date, a int, b int")
    m2 = spark.createDataFrame([(D2, 3)], "Fecha date, a int")
    assert rows(union_months([m1, m2])) == [(D1, 1, 2), (D2, 3, None)]


def test_output_sort_puts_nulls_last(spark):
    df = spark.createDataFrame([(None,), (D2,), (D1,)], "Fecha date")
    assert [r[0] for r in sort_by_key(df).collect()] == [D1, D2, None]


def test_fill_keeps_leading_nulls_and_adds_no_days(spark):
    days = [(1, None), (2, 5.0), (3, None), (6, None)]
    df = spark.createDataFrame([(date(2024, 1, d), v) for d, v in days], "Fecha date, v double")
    got = forward_fill(df).orderBy("Fecha").collect()
    assert [(r[0].day, r[1]) for r in got] == [(1, None), (2, 5.0), (3, 5.0), (6, 5.0)]


def test_fill_continues_from_a_seed(spark):
    df = spark.createDataFrame([(D1, None), (D2, 5.0)], "Fecha date, v double")
    seed = spark.createDataFrame([(7.0,)], "v double")
    assert [r[1] for r in forward_fill(df, seed=seed).orderBy("Fecha").collect()] == [7.0, 5.0]


def _random_series(spark, n=2000, hot=0.35, seed=3):
    """Several series; one holds most rows, and a third of all rows fall on one day."""
    rng = random.Random(seed)
    data = []
    for i in range(n):
        day = D1 + timedelta(days=200 if rng.random() < hot else rng.randrange(400))
        name = "hot" if rng.random() < 0.6 else rng.choice("abc")
        data.append((i, name, day, float(i) if rng.random() < 0.3 else None))
    return spark.createDataFrame(data, "id int, name string, day date, v double")


@pytest.mark.parametrize("rows_per_range", [10, 300, 700, 10_000])
def test_ranges_give_one_dense_order(spark, rows_per_range):
    df = _random_series(spark)
    got = row_numbers(df, "day", rows_per_range=rows_per_range).orderBy("row_number").collect()
    assert [r["row_number"] for r in got] == list(range(1, 2001))
    assert [r["day"] for r in got] == sorted(r["day"] for r in got)
    per_name = row_numbers(df, "day", ["name"], rows_per_range=rows_per_range)
    check = per_name.groupBy("name").agg(F.count("*").alias("n"), F.max("row_number").alias("m"), F.countDistinct("row_number").alias("d"))
    assert all(r["n"] == r["m"] == r["d"] for r in check.collect())


def test_only_long_series_are_cut(spark):
    df = _random_series(spark)
    ranged, cut_rows = with_ranges(df, "day", 700, partition_by=["name"])
    cut = {r["name"]: r["n"] for r in ranged.groupBy("name").agg(F.countDistinct(RANGE).alias("n")).collect()}
    assert cut_rows is not None and cut.pop("hot") > 1 and set(cut.values()) == {1}
    assert with_ranges(df, "day", 5000, partition_by=["name"])[1] is None


def test_a_hot_value_is_spread_over_several_ranges(spark):
    df = _random_series(spark)
    sizes = [r["count"] for r in with_ranges(df, "day", 150)[0].groupBy(RANGE).count().collect()]
    assert sum(sizes) == 2000 and max(sizes) == 150


@pytest.mark.parametrize("kind", ["hot tie", "common prefix", "equal rows", "hot decimal"])
def test_no_range_grows_with_a_hot_value(spark, kind):
    ids = spark.range(3000)
    made = {
        "hot tie": (ids.select(F.when(F.col("id") % 10 > 0, 7).otherwise(F.col("id")).alias("a"), F.col("id").alias("b")), ["a", "b"]),
        "common prefix": (ids.select(F.concat(F.lit("https://host/"), F.col("id")).alias("a")), ["a"]),
        "equal rows": (ids.select(F.lit(1).alias("a"), F.lit("x").alias("b")), ["a", "b"]),
        "hot decimal": (ids.select(F.lit(2).cast("decimal(30,2)").alias("a"), F.col("id").alias("b")), "a"),
    }
    df, order = made[kind]
    sizes = [r["count"] for r in with_ranges(df, order, 100)[0].groupBy(RANGE).count().collect()]
    assert sum(sizes) == 3000 and max(sizes) == 100 and len(sizes) <= 30 + 8
    numbers = [r["row_number"] for r in row_numbers(df, order, rows_per_range=100).select("row_number").collect()]
    assert sorted(numbers) == list(range(1, 3001))


def test_values_are_carried_across_groups_of_ranges(spark, rows):
    """One known value at the start reaches the last range, through every sorted partition."""
    df = spark.range(2000).select(F.col("id"), F.lit(None).cast("string").alias("k"), F.when(F.col("id") == 3, 5.0).alias("v"))
    for keys in ([], ["k"]):
        got = forward_fill(df, ["v"], "id", keys, rows_per_range=50)
        assert rows(got, "id", "v") == sorted(((i, 5.0 if i >= 3 else None) for i in range(2000)), key=repr)


@pytest.mark.parametrize("rows_per_range", [15, 200, 700, 10_000])
def test_fill_by_ranges_equals_one_window(spark, rows, rows_per_range):
    df = _random_series(spark).withColumn("ts", F.timestamp_micros(F.col("id") * F.lit(977) % 2003 * 1000000))
    window = Window.partitionBy("name").orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    plain = df.withColumn("v", F.last("v", ignorenulls=True).over(window))
    for distinct in (False, True):
        got = forward_fill(df, ["v"], "ts", ["name"], rows_per_range=rows_per_range, distinct_order=distinct)
        assert rows(got) == rows(plain)


def test_fill_over_undated_and_tied_rows_follows_one_order(spark):
    """With ties any order is right, but all of it must come from a single order."""
    df = _random_series(spark).withColumn("day", F.when(F.col("id") % 3 != 0, F.col("day")))
    filled = forward_fill(df, ["v"], "day", rows_per_range=40).select("id", F.col("v").alias("f"))
    numbered = row_numbers(df, "day", rows_per_range=40)
    window = Window.orderBy("row_number").rowsBetween(Window.unboundedPreceding, 0)
    expected = numbered.withColumn("e", F.last("v", ignorenulls=True).over(window))
    assert expected.join(filled, "id").filter(~F.col("e").eqNullSafe(F.col("f"))).count() == 0


def test_lags_and_rolling_by_chunks_equal_one_window(spark, rows):
    base = [(D1 + timedelta(days=i), float((i * 37) % 101) if i % 5 else None) for i in range(300)]
    df = spark.createDataFrame(base, "Fecha date, v double")
    w = Window.orderBy("Fecha")
    plain = df.select("Fecha", "v", *[F.lag("v", n).over(w).alias(f"v_lag_{n}") for n in (1, 7, 30)])
    assert rows(lags(df, ["v"], chunk_rows=31, rows_per_range=25)) == rows(plain)
    assert rows(lags(df, ["v"], chunk_rows=5, rows_per_range=25)) == rows(plain)
    got = rolling(df, ["v"], [7], chunk_rows=10, rows_per_range=25).orderBy("Fecha").collect()
    frame = w.rowsBetween(-6, 0)
    expected = df.select(
        F.when(F.count("v").over(frame) == 7, F.avg("v").over(frame)), F.when(F.count("v").over(frame) == 7, F.stddev_samp("v").over(frame)), "Fecha"
    ).orderBy("Fecha").collect()
    assert [(r["v_roll_mean_7"], r["v_roll_std_7"]) for r in got] == [pytest.approx((e[0], e[1])) for e in expected]


def test_rolling_is_null_until_the_window_is_full(spark):
    df = spark.createDataFrame([(D1 + timedelta(days=i), float(i)) for i in range(8)], "Fecha date, v double")
    got = [r["v_roll_mean_7"] for r in rolling(df, ["v"], [7]).orderBy("Fecha").collect()]
    assert got == [None] * 6 + [3.0, 4.0]


def test_first_row_per_key(spark, rows):
    df = spark.createDataFrame([(D1, 2, "late"), (D1, 1, None), (D2, 5, "x"), (None, 1, "n"), (None, 2, "m")], "d date, seq int, v string")
    assert rows(keep_first(df, ["d"], ["seq"])) == sorted([(D1, 1, None), (D2, 5, "x"), (None, 1, "n")], key=repr)


def test_whole_row_dedupe_treats_null_as_equal(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a"), (1.0, None), (float("nan"), "b"), (float("nan"), "b")], "x double, s string")
    assert drop_duplicate_rows(df).count() == 3


def test_clean(spark, rows):
    df = spark.createDataFrame([(1.0, "a"), (None, "b"), (3.0, "c"), (3.0, "c"), (None, None)], "x double, s string")
    assert rows(clean(df)) == [(1.0, "a"), (2.0, "a"), (2.0, "b"), (3.0, "c")]


def test_clean_leaves_empty_columns_and_whole_numbers(spark, rows):
    df = spark.createDataFrame([(1, None, None), (2, None, None), (None, None, None)], "i int, x double, s string")
    cleaned = clean(df)
    assert rows(cleaned) == [(1.0, None, None), (1.5, None, None), (2.0, None, None)]


def test_mode_takes_the_smallest_on_a_tie(spark, rows):
    df = spark.createDataFrame([("b", "x"), ("a", None), ("b", None), ("a", "x"), (None, "y")], "s string, t string")
    assert rows(modes(df, ["s", "t"])) == [("s", "a"), ("t", "x")]


@pytest.mark.parametrize("limit,accuracy", [(1_000_000, 10_000), (40, 20), (2, 3)])
def test_quantiles_are_exact_whatever_the_pass_limit(spark, limit, accuracy):
    rng = random.Random(5)
    values = [rng.choice([0.0, 1.5, rng.gauss(0, 1e6), rng.random()]) for _ in range(999)]
    df = spark.createDataFrame([(v, None) for v in values] + [(None, None), (float("nan"), None)], "v double, w double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = exact_quantiles(df, {"v": probs, "w": [0.5]}, exact_rows=limit, accuracy=accuracy)
    ordered = sorted(values)

    def at(p):
        k = p * (len(ordered) - 1)
        low = int(k)
        high = min(low + 1, len(ordered) - 1)
        return ordered[low] + (ordered[high] - ordered[low]) * (k - low)

    assert got["v"] == pytest.approx([at(p) for p in probs])
    assert got["w"] == [None]


def test_quantiles_of_extreme_values(spark):
    inf = float("inf")
    values = [-inf, -inf, -1e308, -5.0, -1e-300, -0.0, 0.0, 5e-324, 1e-300, 1.0, 1.0 + 2**-52, 1e308, inf, inf, float("nan"), None] * 3
    known = sorted(v for v in values if v is not None and v == v)
    df = spark.createDataFrame([(v,) for v in values], "v double")
    # Shares whose ranks are whole numbers.
    last = len(known) - 1
    ranks = [k for k in range(len(known)) if k / last * last == k]
    assert len(ranks) > 20
    assert exact_quantiles(df, {"v": [k / last for k in ranks]}, exact_rows=1)["v"] == [known[k] for k in ranks]


def test_size_buckets_follow_the_order_of_values(spark):
    values = [-float("inf"), -1e308, -1e-300, -5e-324, 0.0, 5e-324, 1e-300, 0.99, 1.0, 1.02, 1.5, 1e308, float("inf")]
    found = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").select("i", size_bucket(F.col("v")).alias("b"))
    buckets = [r["b"] for r in found.orderBy("i").collect()]
    assert buckets == sorted(buckets) and len(set(buckets)) == len(buckets)


def test_day_counts_add_up_and_days_are_replaced(spark, store):
    rng = random.Random(3)
    data = [(date(2024, 1, rng.randint(1, 20)), rng.choice([None, float("nan"), rng.gauss(0, 50), 7.0])) for _ in range(2000)]
    df = spark.createDataFrame(data, "day date, v double")
    store_day_counts(store, "c", df, "day", "v")
    again = df.filter(F.col("day") > date(2024, 1, 15)).withColumn("v", F.col("v") + 1000)
    store_day_counts(store, "c", again, "day", "v")
    kept = [(d, v if d <= date(2024, 1, 15) else v + 1000) for d, v in data if v is not None and v == v]
    for start, end in ((None, None), (date(2024, 1, 3), date(2024, 1, 17)), (date(2024, 1, 16), None)):
        known = sorted(v for d, v in kept if (start is None or d >= start) and (end is None or d <= end))
        shares = [0.0, 0.1, 0.5, 0.9, 1.0]
        got = {r["share"]: r for r in stored_quantiles(store, "c", shares, start, end).collect()}
        for s in shares:
            value = known[math.floor(s * (len(known) - 1))]
            assert got[s]["n"] == len(known) and got[s]["low"] <= value <= got[s]["high"]
            assert got[s]["high"] - got[s]["low"] <= 0.0201 * abs(value) + 1e-12
    assert stored_quantiles(store, "c", [0.5], date(2025, 1, 1)).count() == 0
    plan = stored_quantiles(store, "c", [0.5])._jdf.queryExecution().executedPlan().toString()
    # What meets in one task has been added up by bucket before.
    for part in plan.split("Exchange SinglePartition")[1:]:
        assert "HashAggregate(keys=[bucket" in part


def test_mean_imputation(spark, rows):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "x double")
    assert rows(impute_mean(df)) == [(1.0,), (2.0,), (3.0,)]


def test_scaling_a_constant_column_gives_zero(spark):
    df = spark.createDataFrame([(2.0, 1.0), (2.0, 3.0)], "c double, v double")
    for method in ("standard", "minmax", "robust"):
        got = scale(df, ["c", "v"], method).collect()
        assert [r["c"] for r in got] == [0.0, 0.0]
        assert got[0]["v"] != got[1]["v"]
    with pytest.raises(ValueError):
        scale(df, ["c"], "other")


def test_one_hot_ignores_unknown_values(spark, rows):
    learned = learn_categories(spark.createDataFrame([("b",), ("a",), (None,)], "s string"), ["s"])
    assert learned == {"s": ["a", "b"]}
    df = spark.createDataFrame([("a",), ("z",), (None,)], "s string")
    assert rows(one_hot(df, learned), "s_a", "s_b") == [(0, 0), (0, 0), (1, 0)]


def test_feature_selection_names_what_is_missing(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert select_features(df, ["b"]).columns == ["b"]
    with pytest.raises(ValueError, match=r"\['x', 'y'\]"):
        select_features(df, ["x", "a", "y"])


def test_scan_limit_zero_means_all_and_none_means_null(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, None)], "i int, s string")
    assert scan(df, limit=0).count() == 3
    assert scan(df, {"s": None}).count() == 2
    assert scan(df, {"s": "it's"}).count() == 0
    assert scan(df, {"s": None, "i": 2}, 5).count() == 1


def test_range_bounds_reach_the_file_scan(spark, tmp_path):
    from datetime import datetime

    path = str(tmp_path / "t")
    spark.range(10).select(F.date_add(F.lit(D1), F.col("id").cast("int")).alias("Fecha")).write.parquet(path)
    got = in_date_range(spark.read.parquet(path), datetime(2024, 1, 3, 10), datetime(2024, 1, 6, 9))
    assert "PushedFilters: [IsNotNull(Fecha), GreaterThanOrEqual(Fecha,2024-01-04)" in got._jdf.queryExecution().executedPlan().toString()
    assert got.count() == 3


def test_nan_is_missing_everywhere(spark):
    nan = float("nan")
    df = spark.createDataFrame([(i, float(i)) for i in range(10)] + [(10, nan)], "k int, v double")
    clean = df.filter("k < 10")
    assert quality.missing_share(df, ["v"]).first().missing_share == pytest.approx(1 / 11)
    assert quality.iqr_outliers(df, ["v"]).first().outliers == 0
    assert drift.population_stability(clean, df, "v").first().psi == 0
    assert drift.outlier_share(clean, df, ["v"]).first().outlier_share == 0
    for method in ("standard", "minmax", "robust"):
        got = {r.k: r.v for r in features.scale(df, ["v"], method).collect()}
        want = {r.k: r.v for r in features.scale(clean, ["v"], method).collect()}
        assert got == {**want, 10: None}
    rolled = {r.k: r.v_roll_mean_2 for r in features.rolling(df, ["v"], [2], "k").collect()}
    assert rolled[9] == 8.5 and rolled[10] is None
    assert {r.k: r.v for r in forward_fill(df, ["v"], "k").collect()}[10] == 9.0
    assert metrics.regression_metrics(df.withColumn("p", F.col("v") + 1), "v", "p").first().n == 10


@pytest.mark.parametrize("limit", [3, 50])
def test_fill_by_several_columns_decimals_and_texts(spark, limit):
    rows = [(i, i // 10, -i, Decimal(10**20 + i), f"2024-01-01T{i:05d}", float(i) if i % 3 == 0 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "k int, day int, minus int, dec decimal(38,0), txt string, v double")

    def brute(key):
        out, last = {}, None
        for r in sorted(rows, key=key):
            last = r[5] if r[5] is not None else last
            out[r[0]] = last
        return out

    for order, key in ((["day", "minus"], lambda r: (r[1], r[2])), ("dec", lambda r: r[3]), ("txt", lambda r: r[4])):
        got = {r.k: r.v for r in forward_fill(df, ["v"], order, rows_per_range=limit).collect()}
        assert got == brute(key)
    lagged = {r.k: r.k_lag_1 for r in features.lags(df, ["k"], [1], ["day", "minus"], rows_per_range=limit, chunk_rows=7).collect()}
    order = [r[0] for r in sorted(rows, key=lambda r: (r[1], r[2]))]
    assert lagged == dict(zip(order, [None, *order[:-1]], strict=True))


def test_ranges_do_not_collapse_when_many_order_values_are_missing(spark):
    df = spark.range(4000).select("id", F.when(F.col("id") % 2 == 0, F.col("id").cast("double")).alias("at"))
    ranged, _ = with_ranges(df, "at", rows_per_range=500)
    sizes = [r["count"] for r in ranged.groupBy(RANGE).count().collect()]
    assert max(sizes) <= 1000 and sum(sizes) == 4000


def test_prediction_percentiles(spark):
    rows = [(d, v) for d in (1, 2) for v in (*range(-50, 51), 0, 1e-9, 1e9, 123.456, 123.457)]
    df = spark.createDataFrame([(d, float(v)) for d, v in rows] + [(1, float("nan")), (1, None)], "d int, v double")
    got = {(r.period, r.share): r.value for r in metrics.prediction_percentiles(df, "v", F.col("d"), (0.1, 0.5, 1.0)).collect()}
    for d in (1, 2):
        own = sorted(float(v) for p, v in rows if p == d)
        for share in (0.1, 0.5, 1.0):
            assert got[d, share] == own[math.ceil(share * len(own)) - 1]


def test_category_limit_is_per_column(spark):
    df = spark.createDataFrame([(f"a{i}", "x") for i in range(5)], "p string, q string")
    assert features.learn_categories(df, ["p", "q"], most=5)["q"] == ["x"]
    with pytest.raises(ValueError, match="p"):
        features.learn_categories(df, ["p", "q"], most=4)


@pytest.mark.parametrize("rows_per_range", [3, 10_000])
def test_distribution_distance_equals_brute_force(spark, rows_per_range):
    rng = random.Random(5)
    before = [rng.gauss(0, 1) for _ in range(300)] + [2.0] * 400 + [None, math.nan]
    after = [rng.gauss(0.4, 1) for _ in range(200)] + [2.0] * 100 + [None]
    known = [[v for v in side if v is not None and v == v] for side in (before, after)]
    share = lambda side, v: sum(x <= v for x in side) / len(side)
    want = max(abs(share(known[0], v) - share(known[1], v)) for v in known[0] + known[1])
    frames = [spark.createDataFrame([(v,) for v in side], "v double") for side in (before, after)]
    got = drift.distribution_distance(*frames, "v", rows_per_range=rows_per_range).first()
    assert got.distance == pytest.approx(want) and got.drifted and (got.baseline_rows, got.current_rows) == (700, 300)
    assert abs(share(known[0], got.at_value) - share(known[1], got.at_value)) == pytest.approx(want)
    same = drift.distribution_distance(frames[0], frames[0], "v", rows_per_range=rows_per_range).first()
    assert same.distance == 0 and not same.drifted
    none = drift.distribution_distance(frames[0], frames[1].limit(0), "v").first()
    assert (none.distance, none.at_value, none.drifted, none.current_rows) == (None, None, None, 0)


def test_sparse_one_hot(spark):
    values = [(i, f"v{i % 1500:04}", "ab"[i % 2]) for i in range(3000)] + [(3000, None, "a"), (3001, None, None)]
    df = spark.createDataFrame(values, "id long, wide string, `a.b` string")
    dictionary = features.learn_dictionary(df, ["wide", "a.b"])
    listed = dictionary.orderBy("index").collect()
    assert [(r.column, r.value) for r in listed] == [("wide", f"v{i:04}") for i in range(1500)] + [("a.b", "a"), ("a.b", "b")]
    assert [r["index"] for r in listed] == list(range(1502))
    got = {r.id: (r.indices, r["values"]) for r in features.one_hot_sparse(df, dictionary, ["wide", "a.b"]).collect()}
    assert got == {i: ([i % 1500, 1500 + i % 2], [1.0, 1.0]) for i in range(3000)} | {3000: ([1500], [1.0]), 3001: ([], [])}
    new = spark.createDataFrame([(1, "unseen", "b")], "id long, wide string, `a.b` string")
    assert features.one_hot_sparse(new, dictionary, ["wide", "a.b"]).first().indices == [1501]
    assert features.learn_dictionary(df.limit(0), ["wide"]).count() == 0
