"""The newest row per key from streaming state."""

import random

import pytest
from pyspark.sql import functions as F

from ratelake.session import work_path
from ratelake.sinks.store import TableStore
from ratelake.streaming import state

SCHEMA = "k string, at timestamp, version int, v double"
BY = ["at", "version"]


def corrections(spark, n=400, seed=1):
    """Rows that correct each other, some of them equal in all that orders them."""
    rng = random.Random(seed)
    data = [(rng.choice("abcdefghij") if rng.random() < 0.95 else None, rng.randrange(30) * 86400, rng.randrange(4), float(i)) for i in range(n)]
    df = spark.createDataFrame(data, "k string, s long, version int, v double")
    return df.select("k", F.timestamp_seconds("s").alias("at"), "version", "v"), data


def newest(data):
    best = {}
    for k, s, version, v in data:
        best[k] = max(best.get(k, (s, version, v)), (s, version, v))
    return sorted(((k, *x) for k, x in best.items()), key=repr)


def read(store, table, rows):
    return rows(state.current_rows(store, table, ["k"], BY).withColumn("s", F.unix_seconds("at")), "k", "s", "version", "v")


@pytest.mark.parametrize("backwards", [False, True])
def test_any_order_of_files_and_a_restart_give_the_newest(spark, store, rows, monkeypatch, backwards):
    df, data = corrections(spark)
    inbox, progress = work_path(spark, "inbox"), work_path(spark, "progress")
    df.limit(0).write.parquet(inbox)
    parts = [df.filter(F.pmod(F.col("v").cast("int"), F.lit(3)) == i) for i in range(3)]
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(inbox)
    # No batch reads the table.
    monkeypatch.setattr(TableStore, "_read", lambda *a: pytest.fail("the table was read"))
    for part in reversed(parts) if backwards else parts:
        part.coalesce(1).write.mode("append").parquet(inbox)
        state.state_stream(stream, store, "t", ["k"], BY, progress, "at", "90 days").awaitTermination()
    monkeypatch.undo()
    assert len(store.partitions("t")) >= 3
    assert read(store, "t", rows) == newest(data)
    state.compact(store, "t", ["k"], BY)
    assert store.partitions("t") == [state.BASE]
    state.compact(store, "t", ["k"], BY)
    assert read(store, "t", rows) == newest(data)


def test_rows_behind_the_horizon_are_counted_and_can_be_added(spark, store, rows):
    inbox, progress = work_path(spark, "inbox"), work_path(spark, "progress")
    spark.createDataFrame([], SCHEMA).write.parquet(inbox)
    stream = spark.readStream.schema(SCHEMA).parquet(inbox)

    def land(*data):
        df = spark.createDataFrame(data, "k string, s long, version int, v double")
        df = df.select("k", F.timestamp_seconds("s").alias("at"), "version", "v")
        df.coalesce(1).write.mode("append").parquet(inbox)
        run = state.state_stream(stream, store, "t", ["k"], BY, progress, "at", "1 day")
        run.awaitTermination()
        return df, state.refused_rows(run)

    assert land(("a", 0, 1, 1.0))[1] == 0
    assert land(("b", 86400 * 100, 1, 2.0))[1] == 0
    late, refused = land(("c", 3600, 1, 3.0), ("a", 7200, 2, 4.0))
    assert refused == 2
    state.add_rows(store, "t", late, "late")
    want = newest([("a", 0, 1, 1.0), ("b", 86400 * 100, 1, 2.0), ("c", 3600, 1, 3.0), ("a", 7200, 2, 4.0)])
    assert read(store, "t", rows) == want


def test_state_without_event_time_keeps_every_key(spark, store, rows):
    df, data = corrections(spark, 100, 2)
    inbox = work_path(spark, "inbox")
    df.repartition(4).write.parquet(inbox)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 2).parquet(inbox)
    state.state_stream(stream, store, "t", ["k"], BY, work_path(spark, "progress")).awaitTermination()
    assert read(store, "t", rows) == newest(data)
    with pytest.raises(ValueError, match="go together"):
        state.state_stream(stream, store, "t", ["k"], BY, work_path(spark, "progress"), event_time="at")


def test_a_repeated_batch_leaves_the_same_rows(spark, store, rows):
    one = spark.createDataFrame([("a", None, 1, 1.0)], SCHEMA)
    store.ensure_table("t", one.schema)
    for _ in range(2):
        store.write_part("t", "000000000001", one)
    assert rows(store.scan("t")) == rows(one)
    store.write_part("t", "000000000001", one.limit(0))
    assert store.partitions("t") == []
    store.ensure_table("dated", one.schema, "at")
    with pytest.raises(ValueError, match="layout"):
        store.write_part("dated", "x", one)
