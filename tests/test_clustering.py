"""Interleaved layout over several fields."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ratelake.sinks.clustering import interleaved, place


def test_bits_in_turn(spark):
    df = spark.createDataFrame([(x, y, z) for x in range(4) for y in range(4) for z in (0, 3)], "x int, y int, z int")
    got = df.select("*", interleaved([F.col(c) for c in "xyz"], 2).alias("p")).collect()
    for r in got:
        bits = "".join(f"{n:02b}"[i] for i in range(2) for n in (r.x, r.y, r.z))
        assert r.p == int(bits, 2)


def touched(store, table, column, values):
    """Mean share of row groups whose statistics allow a value, and the number of row groups."""
    root = store.spark.sql(f"DESCRIBE EXTENDED {store.name(table)}").filter("col_name = 'Location'").first()[1]
    bounds = []
    for file in glob.glob(root.removeprefix("file:") + "/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.names.index(column)
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            bounds.append((stats.min, stats.max))
    return sum(low <= v <= high for v in values for low, high in bounds) / len(values) / len(bounds), len(bounds)


def test_filters_on_each_field_skip_row_groups(spark, store):
    rows = spark.range(64_000, numPartitions=8).select(
        F.xxhash64("id").alias("a"), F.hash("id", F.lit(1)).cast("double").alias("b"),
        F.concat(F.lit("https://host/"), F.md5(F.col("id").cast("string"))).alias("c"), "id",
    )
    fields = ["a", "b", "c"]
    store.ensure_table("near", rows.schema, cluster_fields=fields, interleave=True)
    store.ensure_table("sorted", rows.schema, cluster_fields=fields)
    for name in ("near", "sorted"):
        store.append(name, rows)
        assert store.scan(name).exceptAll(rows).isEmpty() and store.scan(name).count() == 64_000
    probes = rows.filter("id % 300 = 0").collect()
    found = {(t, c): touched(store, t, c, [r[c] for r in probes]) for t in ("near", "sorted") for c in fields}
    # Eight tasks make one bit of each of three fields: half of the row groups, more where cuts are uneven.
    assert all(found["near", c][0] <= 0.75 and found["near", c][1] >= 8 for c in fields), found
    assert found["sorted", "b"][0] > 0.99 and found["sorted", "c"][0] > 0.99


def test_odd_values_and_few_of_them(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(None, None, None, None), (nan, "", None, True), (inf, "é", None, False), (-inf, "éa", None, True),
            (1.7e308, "é\0", None, True), (-1.7e308, "x" * 5000, None, True), (0.0, None, None, None)]
    df = spark.createDataFrame(rows, "a double, b string, c date, d boolean")
    assert df.select(place(df, ["a", "b", "c", "d"]).alias("p")).filter("p IS NOT NULL").count() == len(rows)
    got = {r.a: r.p for r in df.filter(F.abs("a") < F.lit(inf)).select("a", place(df, ["a", "c"]).alias("p")).collect()}
    assert got[-1.7e308] < got[0.0] < got[1.7e308]
    empty = df.limit(0)
    assert empty.select(place(empty, ["a", "b"])).count() == 0
    with pytest.raises(ValueError):
        place(df, ["a"])
    with pytest.raises(ValueError):
        place(df.withColumn("m", F.array("a")), ["a", "m"])


def test_hot_values_do_not_hide_the_rest(spark):
    """Nine tenths of the rows share one value; the others still get places of their own."""
    df = spark.range(10_000).select(F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(5000).alias("a"), (-F.col("id")).alias("b"))
    places = df.filter("a <> 5000").select(place(df, ["a", "b"]).alias("p")).distinct().count()
    assert places > 100


def test_updates_and_other_layouts_keep_the_rows(spark, store, rows):
    df = spark.createDataFrame([(i, i % 7, f"2024-0{1 + i % 3}-10") for i in range(60)], "k int, v int, d string")
    df = df.withColumn("d", F.col("d").cast("date"))
    store.ensure_table("t", df.schema, "d", ["k", "v"], interleave=True, bucket_key="k", buckets=2)
    store.append("t", df)
    store.upsert("t", df.filter("k < 5").withColumn("v", F.lit(100)), "k")
    want = df.withColumn("v", F.when(F.col("k") < 5, 100).otherwise(F.col("v")))
    assert rows(store.scan("t")) == rows(want)
    store.ensure_table("t", df.schema, "d", granularity="day")
    assert store.layout("t")["interleave"] and rows(store.scan("t")) == rows(want)
    store.truncate("t", df)
    assert rows(store.scan("t")) == rows(df)
    assert not [r for r in spark.sql(f"SHOW TABLES IN `{store.database}`").collect() if r.tableName.startswith("stage_")]
    with pytest.raises(ValueError):
        store.ensure_table("u", df.schema, cluster_fields=["k"], interleave=True)
