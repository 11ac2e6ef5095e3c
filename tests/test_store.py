"""Table store: layouts, writes, merges and deletes."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ratelake.model import RATE_SCHEMA
from ratelake.sinks.store import BUCKET, PARTITION, UNDATED


def table(spark, store, data, schema, part, name="t", **more):
    df = spark.createDataFrame(data, schema)
    store.ensure_table(name, df.schema, part, **more)
    store.append(name, df)
    return df


def test_source_null_overwrites(spark, store, rows):
    table(spark, store, [(date(2024, 1, 1), 5.0)], "Fecha date, v double", "Fecha")
    store.upsert("t", spark.createDataFrame([(date(2024, 1, 1), None)], "Fecha date, v double"))
    assert rows(store.scan("t")) == [(date(2024, 1, 1), None)]


def test_null_key_is_rejected_or_inserted_each_time(spark, store, rows):
    table(spark, store, [(date(2024, 1, 1), 5.0)], "Fecha date, v double", "Fecha")
    undated = spark.createDataFrame([(None, 1.0)], "Fecha date, v double")
    with pytest.raises(PySparkException, match="NULL in required column"):
        store.upsert("t", undated)
    for _ in range(2):
        store.upsert("t", undated, allow_null_key=True)
    assert rows(store.scan("t")) == sorted([(date(2024, 1, 1), 5.0), (None, 1.0), (None, 1.0)], key=repr)
    assert store.partitions("t") == ["2024-01", UNDATED]
    assert store.latest_date("t") == date(2024, 1, 1)


def test_row_moves_to_another_month(spark, store, rows):
    table(spark, store, [("k1", date(2024, 1, 15))], "k string, d date", "d")
    store.upsert("t", spark.createDataFrame([("k1", date(2024, 2, 3))], "k string, d date"), "k")
    assert rows(store.scan("t")) == [("k1", date(2024, 2, 3))]
    assert store.partitions("t") == ["2024-02"]


def test_repeated_source_key(spark, store, rows):
    table(spark, store, [("k1", date(2024, 1, 15))], "k string, d date", "d")
    twice = spark.createDataFrame([("k1", date(2024, 1, 1)), ("k1", date(2024, 1, 2))], "k string, d date")
    with pytest.raises(ValueError, match="repeats key 'k1'"):
        store.upsert("t", twice, "k")
    fresh = spark.createDataFrame([("k2", date(2024, 1, 1)), ("k2", date(2024, 1, 2))], "k string, d date")
    store.upsert("t", fresh, "k")
    assert store.scan("t").count() == 3
    assert [t.name for t in spark.catalog.listTables(store.database)] == ["t"]


def test_columns_the_source_lacks_are_kept(spark, store, rows):
    table(spark, store, [("a", date(2024, 1, 1), 1, 9)], "k string, d date, v int, w int", "d")
    store.upsert("t", spark.createDataFrame([("a", 2), ("b", 3)], "k string, v int"), "k")
    assert rows(store.scan("t")) == [("a", date(2024, 1, 1), 2, 9), ("b", None, 3, None)]


def test_older_source_rows_can_be_refused(spark, store, rows):
    table(spark, store, [("a", 5, date(2024, 1, 5)), ("b", 1, date(2024, 1, 1))], "k string, v int, d date", "d")
    news = spark.createDataFrame([("a", 4, date(2024, 1, 4)), ("b", 2, date(2024, 2, 2))], "k string, v int, d date")
    store.upsert("t", news, "k", newer_by="d")
    assert rows(store.scan("t"), "k", "v") == [("a", 5), ("b", 2)]


def test_random_upserts_match_a_dictionary(spark, store, rows):
    """Brute force: many keys, one month with a third of the rows, NULLs, moves and inserts."""
    rng = random.Random(11)

    def day():
        return date(2024, 3, 1) if rng.random() < 0.34 else date(2024, rng.randint(1, 12), rng.randint(1, 28))

    held = {k: (day(), rng.random()) for k in range(400)}
    table(spark, store, [(k, *v) for k, v in held.items()], "k int, d date, v double", "d", cluster_fields=["k"])
    for _ in range(2):
        news = {k: (day(), rng.random() if rng.random() < 0.8 else None) for k in rng.sample(range(600), 150)}
        df = spark.createDataFrame([(k, *v) for k, v in news.items()], "k int, d date, v double")
        held |= news
        expected = sorted(((k, *v) for k, v in held.items()), key=repr)
        store.upsert("t", df, "k")
        assert rows(store.scan("t")) == expected
        store.upsert("t", df, "k")
        assert rows(store.scan("t")) == expected
    assert store.partitions("t") == sorted({f"{d:%Y-%m}" for d, _ in held.values()})


def test_delete_then_upsert_restores_the_table(spark, store, rows):
    data = [(date(2024, m, d), float(m * d)) for m in (1, 2, 3) for d in (1, 10, 20)]
    df = table(spark, store, data, "Fecha date, v double", "Fecha")
    store.delete_range("t", date(2024, 1, 10), date(2024, 3, 10))
    assert rows(store.scan("t")) == [(date(2024, 1, 1), 1.0), (date(2024, 3, 20), 60.0)]
    store.upsert("t", df.filter(F.col("Fecha").between(date(2024, 1, 10), date(2024, 3, 10))))
    assert rows(store.scan("t")) == sorted(data, key=repr)


def test_emptied_month_disappears(spark, store, rows):
    data = [(date(2024, 1, 15), 1), (date(2024, 1, 16), 2), (date(2024, 2, 15), 3)]
    table(spark, store, data, "d date, v int", "d")
    # The month is rewritten, not dropped: 29 February is outside the range.
    store.delete_range("t", date(2024, 2, 1), date(2024, 2, 28), "d")
    assert rows(store.scan("t"), "v") == [(1,), (2,)]
    assert store.partitions("t") == ["2024-01"]


def test_delete_one_day_and_by_another_column(spark, store, rows):
    data = [(date(2024, 1, 15), date(2024, 5, 1)), (date(2024, 1, 16), date(2024, 6, 1)), (date(2024, 2, 1), None)]
    table(spark, store, data, "d date, e date", "d")
    store.delete_range("t", datetime(2024, 1, 15, 23), column="d")
    assert store.scan("t").count() == 2
    store.delete_range("t", date(2024, 6, 1), date(2024, 6, 30), "e")
    assert rows(store.scan("t")) == [(date(2024, 2, 1), None)]


def test_delete_on_timestamps_stops_at_midnight(spark, store, rows):
    data = [(datetime(2024, 1, 31, 0),), (datetime(2024, 1, 31, 10),), (datetime(2024, 1, 2, 5),)]
    table(spark, store, data, "ts timestamp", "ts")
    store.delete_range("t", date(2024, 1, 1), date(2024, 1, 31), "ts")
    assert rows(store.scan("t")) == [(datetime(2024, 1, 31, 10),)]


def test_other_layout_is_rewritten_without_loss(spark, store, rows):
    data = [(date(2024, 1, 1), 1), (date(2024, 1, 2), 2), (date(2024, 2, 1), 3), (None, 4)]
    df = table(spark, store, data, "Fecha date, v int", "Fecha", granularity="day", cluster_fields=["v"])
    assert len(store.partitions("t")) == 4
    store.ensure_table("t", df.schema, "Fecha", granularity="month")
    assert store.partitions("t") == ["2024-01", "2024-02", UNDATED]
    assert rows(store.scan("t")) == sorted(data, key=repr)
    assert store.layout("t")["cluster_fields"] == ["v"]


def test_fixed_schema_table_requires_its_fields(spark, store, rows):
    store.ensure_rate_table()
    assert store.schema("exchange_rates").names == RATE_SCHEMA.names
    row = (date(2024, 1, 1), 1.0, None, None, datetime(2024, 1, 2), "x")
    store.append("exchange_rates", spark.createDataFrame([row], RATE_SCHEMA))
    assert rows(store.scan("exchange_rates")) == [row]
    undated = spark.createDataFrame([(None, *row[1:])], RATE_SCHEMA.simpleString()[7:-1].replace(":", " "))
    with pytest.raises(PySparkException, match="NULL in required column"):
        store.append("exchange_rates", undated)
    assert store.scan("exchange_rates").count() == 1


def test_truncate_empty_and_schema_checks(spark, store, rows):
    df = table(spark, store, [(date(2024, 1, 1), 1)], "d date, v int", "d")
    with pytest.raises(ValueError, match="not empty"):
        store.write_empty("t", df)
    store.truncate("t", df.limit(0))
    assert store.scan("t").count() == 0 and store.latest_date("t", "d") is None
    store.write_empty("t", df.select("v", "d"))
    assert rows(store.scan("t")) == [(date(2024, 1, 1), 1)]
    for bad in (df.drop("v"), df.withColumn("x", F.lit(1)), df.withColumn("v", F.lit("a"))):
        with pytest.raises(ValueError, match="schema mismatch"):
            store.append("t", bad)


def test_missing_table_is_an_error_not_an_empty_mark(store):
    with pytest.raises(PySparkException):
        store.latest_date("absent")


def test_scan_prunes_months(spark, store, rows):
    table(spark, store, [(date(2024, m, 5), m) for m in range(1, 13)], "d date, v int", "d")
    for df in (store.scan("t", start=date(2024, 3, 1), end=date(2024, 4, 30)), store.scan("t", {"d": date(2024, 3, 5)})):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert f"({PARTITION}" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert rows(store.scan("t", start=date(2024, 3, 1), end=date(2024, 4, 30)), "v") == [(3,), (4,)]
    assert store.scan("t", limit=5).count() == 5


def test_unpartitioned_table(spark, store, rows):
    df = table(spark, store, [(1, "a"), (2, "b")], "k int, s string", None)
    store.upsert("t", spark.createDataFrame([(2, "c"), (3, "d")], "k int, s string"), "k")
    assert rows(store.scan("t")) == [(1, "a"), (2, "c"), (3, "d")]
    with pytest.raises(ValueError, match="no partition field"):
        store.scan("t", start=date(2024, 1, 1))
    store.ensure_table("t", df.schema)


def test_unpartitioned_table_keeps_rows_without_a_match(spark, store, rows):
    table(spark, store, [(1, "a"), (2, "b")], "k int, s string", None)
    store.upsert("t", spark.createDataFrame([(3, "c")], "k int, s string"), "k")
    assert rows(store.scan("t")) == [(1, "a"), (2, "b"), (3, "c")]


def test_undated_rows_stay_when_the_source_has_no_date(spark, store, rows):
    table(spark, store, [("k1", None, 1), ("k2", date(2024, 1, 1), 2)], "k string, d date, v int", "d")
    store.upsert("t", spark.createDataFrame([("k3", 3), ("k2", 5)], "k string, v int"), "k")
    assert rows(store.scan("t")) == [("k1", None, 1), ("k2", date(2024, 1, 1), 5), ("k3", None, 3)]


def test_newer_by_several_columns(spark, store, rows):
    schema = "k string, d date, n int, v int"
    table(spark, store, [("a", date(2024, 1, 1), 9, 1), ("b", None, 1, 1)], schema, "d")
    news = [("a", date(2024, 1, 1), 3, 2), ("b", date(2024, 1, 1), None, 2)]
    store.upsert("t", spark.createDataFrame(news, schema), "k", newer_by=["d", "n"])
    assert rows(store.scan("t"), "k", "v") == [("a", 1), ("b", 2)]


def test_flags_say_which_columns_a_row_holds(spark, store, rows):
    table(spark, store, [(1, 10, 20), (2, 11, 21)], "k int, a int, b int", None)
    news = spark.createDataFrame([(1, 5, None, True, False), (2, None, 7, True, True), (3, 1, 2, False, True)], "k int, a int, b int, fa boolean, fb boolean")
    store.upsert("t", news, "k", presence={"a": "fa", "b": "fb"})
    assert rows(store.scan("t")) == [(1, 5, 20), (2, None, 7), (3, 1, 2)]


def test_repair_keeps_the_comment(spark, store):
    df = spark.createDataFrame([(1, date(2024, 1, 1))], "k int, d date")
    store.ensure_table("t", df.schema, "d", granularity="day", description="it's kept")
    store.append("t", df)
    store.repair_layout("t", "month")
    assert spark.catalog.getTable(f"{store.database}.t").description == "it's kept"
    assert store.scan("t").count() == 1


def test_whole_days_of_a_timestamp_column(spark, store, rows):
    stamps = [(1, datetime(2024, 1, 1, 5)), (2, datetime(2024, 1, 2, 0)), (3, datetime(2024, 1, 2, 7)), (4, datetime(2024, 1, 3, 1))]
    df = table(spark, store, stamps, "k int, d timestamp", "d")
    store.delete_range("t", date(2024, 1, 1), date(2024, 1, 2), "d")
    assert rows(store.scan("t"), "k") == [(3,), (4,)]
    store.truncate("t", df)
    store.delete_range("t", date(2024, 1, 1), date(2024, 1, 2), "d", align_days=True)
    assert rows(store.scan("t"), "k") == [(4,)]


def bucketed(store, spark, n=200, buckets=8):
    rows = spark.range(n).select(
        F.col("id").alias("k"),
        F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 60).cast("int")).alias("day"),
        F.col("id").cast("double").alias("v"),
    )
    store.ensure_table("b", rows.schema, "day", bucket_key="k", buckets=buckets)
    store.append("b", rows)
    return rows


def files_of(store, table):
    return set(store.spark.table(store.name(table)).inputFiles())


def test_upsert_touches_only_the_buckets_of_its_keys(spark, store, rows):
    bucketed(store, spark)
    assert len({b for _, b in store.cells("b")}) == 8
    before = files_of(store, "b")
    news = spark.createDataFrame([(5, date(2024, 3, 9), -5.0), (900, date(2024, 1, 2), 9.0)], "k long, day date, v double")
    buckets = {r[0] for r in news.select(F.pmod(F.xxhash64("k"), F.lit(8))).collect()}
    store.upsert("b", news, "k")
    spark.catalog.refreshTable(store.name("b"))
    gone = before - files_of(store, "b")
    # Key 5 left its cell, key 900 joined one: two old files at most, all of their buckets.
    assert gone and len(gone) <= 2
    assert all(any(f"{BUCKET}={b}/" in f for b in buckets) for f in gone)
    want = {k: (date(2024, 1, 1) + timedelta(days=k % 60), float(k)) for k in range(200)}
    want |= {5: (date(2024, 3, 9), -5.0), 900: (date(2024, 1, 2), 9.0)}
    assert rows(store.scan("b"), "k", "day", "v") == sorted(((k, *v) for k, v in want.items()), key=repr)


def test_plans_of_bucketed_tables_list_only_touched_buckets(spark, store):
    bucketed(store, spark)
    one = store.scan("b", {"k": 17})
    assert [r["k"] for r in one.collect()] == [17]
    assert len(one.inputFiles()) == 1 or f"{BUCKET}#" in one._jdf.queryExecution().executedPlan().toString()
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_bucket" in plan

    read = []
    original = type(store)._rewrite_merged

    def watch(self, table, schema, target, *rest):
        read.append(target._jdf.queryExecution().executedPlan().toString())
        return original(self, table, schema, target, *rest)

    type(store)._rewrite_merged = watch
    try:
        store.upsert("b", spark.createDataFrame([(17, date(2024, 1, 3), 1.0)], "k long, day date, v double"), "k")
    finally:
        type(store)._rewrite_merged = original
    # The keys, too, are read from one bucket.
    assert "(_bucket" in read[0].split("PartitionFilters")[1].split("]")[0]


def test_bucketed_upserts_equal_plain_ones(spark, store, rows):
    """Random batches over a bucketed and a plain table: moves, inserts, undated rows, and columns left out."""
    rng = random.Random(4)
    store.ensure_table("plain", bucketed(store, spark, 80, 5).schema, "day")
    store.append("plain", store.scan("b"))
    for step in range(4):
        keys = rng.sample(range(120), 25)
        data = [(k, date(2024, rng.randint(1, 4), 3) if rng.random() < 0.8 else None, rng.random()) for k in keys]
        news = spark.createDataFrame(data, "k long, day date, v double")
        news = news.drop("day") if step == 2 else news
        store.upsert("b", news, "k")
        store.upsert("plain", news, "k")
        assert rows(store.scan("b"), "k", "day", "v") == rows(store.scan("plain"), "k", "day", "v")
    store.delete_range("b", date(2024, 1, 20), date(2024, 3, 2), "day")
    store.delete_range("plain", date(2024, 1, 20), date(2024, 3, 2), "day")
    assert rows(store.scan("b"), "k", "day", "v") == rows(store.scan("plain"), "k", "day", "v")
    # A key that is not the one the buckets follow.
    other = spark.createDataFrame([(7, date(2024, 1, 5), 77.0)], "k long, day date, v double")
    day = store.scan("b").filter("day IS NOT NULL").groupBy("day").count().filter("count = 1").first()
    if day:
        moved = other.withColumn("day", F.lit(day["day"]))
        for name in ("b", "plain"):
            store.upsert(name, moved, "day")
        assert rows(store.scan("b"), "k", "day", "v") == rows(store.scan("plain"), "k", "day", "v")


def test_buckets_can_be_changed_and_are_checked(spark, store, rows):
    made = bucketed(store, spark)
    before = rows(store.scan("b"))
    store.ensure_table("b", made.schema, "day", bucket_key="k", buckets=3)
    assert store.layout("b")["buckets"] == 3 and {b for _, b in store.cells("b")} <= {0, 1, 2}
    assert rows(store.scan("b")) == before
    with pytest.raises(ValueError, match="bucket_key"):
        store.ensure_table("c", made.schema, "day", bucket_key="nothing", buckets=3)
    with pytest.raises(ValueError, match="bucket_key"):
        store.ensure_table("c", made.schema, "day", buckets=3)
