"""Quality, metrics, drift, training."""

import math
from datetime import date, datetime

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelake.operators import drift, metrics, quality
from ratelake.plans import training
from ratelake.queries import analytics


def test_missing_share_has_a_strict_threshold(spark):
    df = spark.createDataFrame([(None if i == 0 else i, None if i < 2 else i) for i in range(10)], "a int, b int")
    got = {r["column_name"]: (r["missing_share"], r["too_many"]) for r in quality.missing_share(df, ["a", "b"]).collect()}
    assert got == {"a": (0.1, False), "b": (0.2, True)}


def test_outliers_beyond_three_iqr(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 10)] + [(100.0,), (None,)], "v double")
    row = quality.iqr_outliers(df, ["v"]).first()
    assert (row["low"], row["high"], row["outliers"]) == (-10.25, 21.25, 1)


def test_freshness_and_range(spark):
    df = spark.createDataFrame([(date(2024, 1, 1), 5.0), (date(2024, 1, 3), 50.0)], "d date, v double")
    row = quality.range_and_freshness(df, {"v": (0, 10)}, "d", datetime(2024, 1, 5, 9), 1).first()
    assert tuple(row) == (1, date(2024, 1, 3), 2, False)


def test_schema_differences(spark):
    have = spark.createDataFrame([], "a int, b string").schema
    want = spark.createDataFrame([], "a bigint, c string").schema
    assert quality.schema_differences(have, want) == ["missing c", "unexpected b", "a is int, not bigint"]


def test_metrics_ignore_rows_without_both_values(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 3.0), (None, 1.0), (1.0, None)], "y double, p double")
    row = metrics.regression_metrics(df, "y", "p").first()
    assert row["n"] == 3 and row["mae"] == 1.0
    assert row["rmse"] == pytest.approx(math.sqrt(5 / 3)) and row["r2"] == pytest.approx(1 - 5 / 8)
    constant = df.withColumn("y", F.lit(1.0))
    assert metrics.regression_metrics(constant, "y", "p").first()["r2"] is None


@pytest.mark.parametrize(
    "test_rmse,test_r2,expected",
    [(55.0, 0.85, (False, True)), (56.1, 0.9, (True, True)), (50.0, 0.7, (True, True)), (55.0, 0.65, (True, False))],
)
def test_overfit_rule(spark, test_rmse, test_r2, expected):
    df = spark.createDataFrame([("train", 46.0, 0.9), ("test", test_rmse, test_r2)], "split string, rmse double, r2 double")
    row = metrics.overfit_check(df).first()
    assert (row["is_overfitting"], row["accepted"]) == expected


def test_alert_on_more_than_ten_percent(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 11.0), (3, 12.2), (4, 5.0)], "period int, rmse double")
    assert [r["alert"] for r in metrics.rmse_alerts(df).orderBy("period").collect()] == [False, False, True, False]


def test_only_a_better_model_is_deployed(spark):
    def one(rmse):
        return spark.createDataFrame([(rmse, 0.5)], "rmse double, r2 double")

    assert metrics.compare_models(one(2.0), one(1.9)).first()["deploy"] is True
    assert metrics.compare_models(one(2.0), one(2.0)).first()["deploy"] is False


def test_drift(spark):
    base = spark.createDataFrame([(float(i), "a") for i in range(1000)], "v double, s string")
    same = drift.population_stability(base, base, "v").first()["psi"]
    moved = drift.population_stability(base, base.withColumn("v", F.col("v") + 400), "v").first()["psi"]
    assert same == pytest.approx(0) and moved > 0.25
    new = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "s string")
    assert [tuple(r) for r in drift.new_values(base, new, "s").collect()] == [("b", 2)]
    assert drift.missing_features(base, new) == ["v"]


def test_split_does_not_depend_on_order_or_partitions(spark):
    df = spark.range(5000)
    split = training.with_split(df, "id", seed=training.SEED)
    again = training.with_split(df.repartition(7).orderBy(F.desc("id")), "id", seed=training.SEED)
    assert split.exceptAll(again).count() == 0
    assert 0.17 < split.filter("split = 'test'").count() / 5000 < 0.23


def test_fit_save_load_and_score(spark, tmp_path):
    df = spark.range(400).select((F.col("id") % 20).cast("double").alias("x"), F.rand(1).alias("z"), "id")
    df = training.with_split(df.withColumn("y", F.col("x") * 3), "id")
    model = training.fit(df, ["x", "z"], "y", rounds=10, max_depth=3, learning_rate=0.3)
    path = str(tmp_path / "model")
    model.save(path)
    rows = training.score(PipelineModel.load(path), df)
    assert rows.count() == 400 and "features" not in rows.columns
    assert all(r["r2"] > 0.8 for r in training.evaluate(model, df, "y").collect())


def test_defaults_early_stopping_and_folds(spark):
    stage = training.booster(["x"], "y").getStages()[1]
    assert (stage.getMaxDepth(), stage.getMaxIter(), stage.getStepSize(), stage.getSeed()) == (6, 1000, 0.01, 42)
    df = spark.range(200).select(F.col("id").cast("double").alias("x"), (F.col("id") * 2.0).alias("y"), (F.col("id") % 5 == 0).alias("held"))
    stopped = training.fit(df, ["x"], "y", rounds=30, max_depth=4, learning_rate=0.5, validation="held")
    assert stopped.stages[1].getNumTrees < 30
    folds = training.cross_validate(df, ["x"], "y", folds=2, rounds=2, max_depth=2, learning_rate=0.5)
    assert len(folds.avgMetrics) == 1


def test_training_csv(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a,b\n1,2.5\n3,\n")
    got = training.read_training_csv(spark, str(path), "a int, b double").collect()
    assert [tuple(r) for r in got] == [(1, 2.5), (3, None)]


def test_schema_report_of_odd_tables(spark, rows):
    want = T.StructType.fromDDL("a int, b string, `c.d` double")
    df = spark.createDataFrame([(1, None, float("nan")), (None, None, 2.0)], "a int, b string, `c.d` double")
    names = ("column_name", "problem", "present")
    assert rows(quality.schema_report(df, want), *names) == [("a", None, 1), ("b", "empty", 0), ("c.d", None, 1)]
    # Without rows nothing is called empty.
    assert {r.problem for r in quality.schema_report(df.limit(0), want).collect()} == {None}
    assert rows(quality.schema_report(df.select("b"), want), *names)[0] == ("a", "missing", 0)


def test_feature_coverage_without_columns_or_rows(spark, rows):
    base = spark.createDataFrame([(1, "x"), (None, "y")], "a int, b string")
    got = rows(drift.feature_coverage(base, base.select("b").limit(0)), "column_name", "baseline_filled", "missing", "current_filled")
    assert got == [("a", 0.5, True, 0.0), ("b", 1.0, False, None)]
    other = spark.createDataFrame([(1,)], "z int")
    assert {(r.missing, r.current_filled) for r in drift.feature_coverage(base, other).collect()} == {(True, 0.0)}


def test_prediction_runs_replace_only_their_day(spark, store, rows):
    df = spark.createDataFrame([(1, 2.0), (2, 3.0)], "k int, prediction double")
    one, two = date(2024, 1, 1), date(2024, 1, 2)
    training.save_predictions(store, "p", df, one)
    training.save_predictions(store, "p", df, two)
    training.save_predictions(store, "p", df.filter("k = 1"), two)
    assert rows(training.read_predictions(store, "p"), "k") == [(1,)]
    assert rows(training.read_predictions(store, "p", one), "k") == [(1,), (2,)]
    # A repeated run without rows leaves that day empty.
    training.save_predictions(store, "p", df.limit(0), two)
    assert rows(training.read_predictions(store, "p"), "k", "scored_on") == [(1, one), (2, one)]


def test_a_fit_deals_its_rows_to_tasks_of_bounded_size(spark, monkeypatch):
    given = []

    class Spy:
        def fit(self, df):
            given.append(df)

    monkeypatch.setattr(training, "booster", lambda *args, **params: Spy())
    monkeypatch.setattr(training, "ROWS_PER_TASK", 500, raising=False)
    # One part of a file holds all rows, and half of them are equal in what the fit reads.
    df = spark.range(20_000, numPartitions=1).select(
        "id", F.when(F.col("id") % 2 == 0, F.lit(1.0)).otherwise(F.col("id") % 97).alias("x"), (F.col("id") % 5).alias("y.z"), F.create_map("id", "id").alias("m")
    )
    df = df.withColumn("x", F.when(F.col("id") < 10_000, 1.0).otherwise(F.col("x"))).withColumn("y.z", F.when(F.col("id") < 10_000, 1).otherwise(F.col("`y.z`")))
    training.fit(df, ["x"], "y.z")
    training.fit(df.repartition(7), ["x"], "y.z")
    parts = [g.rdd.map(tuple).glom().collect() for g in given]
    assert max(map(len, parts[0])) <= 1000 and parts[0] == parts[1]
    want = sorted(tuple(r) for r in df.select("x", "`y.z`").collect())
    assert sorted(r for part in parts[0] for r in part) == want
    training.fit(df.limit(400), ["x"], "y.z")
    assert given[-1].count() == 400


def test_gbt_fit_trains_the_described_model(spark, monkeypatch, tmp_path):
    amounts = [(F.col("id") % n).cast("double").alias(c) for c, n in (("l_quantity", 7), ("l_discount", 5), ("l_tax", 3))]
    lines = spark.range(200).select(F.col("id").alias("l_orderkey"), *amounts, (F.col("id") * 2.0).alias("l_extendedprice"))
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    asked, made = [], training.booster

    def short(features, label, **params):
        asked.append(made(features, label, **params).getStages()[1])
        return made(features, label, rounds=2, max_depth=2)

    monkeypatch.setattr(training, "booster", short)
    assert sum(r["n"] for r in analytics.gbt_fit(spark, str(tmp_path)).collect()) == 200
    (model,) = asked
    assert (model.getMaxIter(), model.getMaxDepth(), model.getStepSize(), model.getSeed()) == (1000, 6, 0.01, 42)
    assert (model.getSubsamplingRate(), model.getFeatureSubsetStrategy()) == (0.8, "0.8")
    assert not model.isDefined("validationIndicatorCol")


def test_a_long_fit_has_a_folder_for_checkpoints(spark):
    context = spark.sparkContext._jsc.sc()
    put = getattr(context, "checkpointDir_$eq")
    df, before = spark.range(50).select(F.col("id").cast("double").alias("x")), context.checkpointDir()
    try:
        put(spark._jvm.scala.Option.empty())
        training.fit(df, ["x"], "x", rounds=2, max_depth=1)
        assert spark.sparkContext.getCheckpointDir() is None
        training.fit(df, ["x"], "x", rounds=12, max_depth=1)
        assert spark.sparkContext.getCheckpointDir() is not None
    finally:
        if before.isDefined():
            put(before)


def test_a_long_fit_may_deal_a_small_table_too(spark):
    df = spark.range(1000, numPartitions=1).select("id", F.col("id").cast("double").alias("x"))
    with training.spread(df, ["x"], above=1000) as rows:
        assert rows is df
    with training.spread(df, ["x"], above=999) as rows:
        parts = [len(p) for p in rows.rdd.glom().collect()]
    assert sum(parts) == 1000 and len(parts) == spark.sparkContext.defaultParallelism and max(parts) < 300
