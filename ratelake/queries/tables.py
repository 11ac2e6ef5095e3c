"""Queries on the table store, the ingestion run and streaming."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ratelake.functions.parsing import parse_decimal
from ratelake.model import DATE_COLUMN, VALUE_FIELD
from ratelake.plans.ingest import IngestConfig, run_ingest
from ratelake.plans.prepare import prepare
from ratelake.queries.inputs import (
    DAILY,
    NOW,
    SERIES_MAP,
    SPECS,
    VALUE_NAMES,
    WIDE,
    as_payload,
    daily,
    each,
    fresh_store,
    land,
    landed,
    plugged,
)
from ratelake.queries.registry import query, table
from ratelake.session import work_path
from ratelake.sinks.store import PARTITION
from ratelake.sources.observations import accepted, write_landing
from ratelake.sources.pluggable import dated
from ratelake.streaming import state
from ratelake.streaming.ingest import (
    filled,
    latest_per_key,
    presence_of,
    quarantine_counts,
    rate_rows,
    stream_landing,
    upsert_stream,
)


def _orders_table(spark, sf_dir, rows=None, name="orders"):
    """A month-partitioned copy of orders, or of some of its rows."""
    orders = table(spark, sf_dir, "orders")
    store = fresh_store(spark)
    store.ensure_table(name, orders.schema, "o_orderdate", ["o_orderkey"], ["o_orderkey", "o_orderdate"])
    store.append(name, orders if rows is None else rows)
    return store


def _by_status(spark, sf_dir, status):
    return table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == status)


@query("SELECT * FROM orders")
def write_append(spark, sf_dir):
    store = _orders_table(spark, sf_dir, _by_status(spark, sf_dir, "F"))
    store.append("orders", _by_status(spark, sf_dir, "O"))
    store.append("orders", _by_status(spark, sf_dir, "P"))
    return store.scan("orders")


@query("SELECT * REPLACE (o_totalprice * 2 AS o_totalprice) FROM orders")
def write_truncate(spark, sf_dir):
    store = _orders_table(spark, sf_dir)
    store.truncate("orders", table(spark, sf_dir, "orders").withColumn("o_totalprice", F.col("o_totalprice") * 2))
    return store.scan("orders")


@query("SELECT *, true AS second_load_refused FROM orders")
def write_empty(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    store = fresh_store(spark)
    store.ensure_table("orders", orders.schema, "o_orderdate")
    store.write_empty("orders", orders)
    refused = False
    try:
        store.write_empty("orders", orders)
    except ValueError:
        refused = True
    return store.scan("orders").withColumn("second_load_refused", F.lit(refused))


@query("SELECT max(o_orderdate) AS max_date FROM orders")
def latest_date(spark, sf_dir):
    store = _orders_table(spark, sf_dir)
    newest = store.latest_date("orders", "o_orderdate")
    return spark.range(1).select(F.lit(str(newest)).cast("timestamp_ntz").alias("max_date"))


ORDER_FACTS = """facts AS (
    SELECT l_orderkey AS k, max(l_extendedprice) AS price, CAST(max(l_shipdate) AS DATE) AS day,
           count(*) AS lines FROM lineitem GROUP BY 1),
  news AS (
    SELECT o_orderkey AS k, CASE WHEN NOT (o_orderstatus = 'F' AND o_orderpriority = '5-LOW') THEN o_totalprice END AS price,
           CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderstatus <> 'P')"""


@query(
    f"""WITH {ORDER_FACTS}
  SELECT coalesce(f.k, n.k) AS k, CASE WHEN n.k IS NOT NULL THEN n.price ELSE f.price END AS price,
    CASE WHEN n.k IS NOT NULL THEN n.day ELSE f.day END AS day, f.lines AS lines
  FROM facts f FULL JOIN news n ON f.k = n.k"""
)
def upsert_merge(spark, sf_dir):
    """Order facts from the lines, revised by the orders themselves.

    Some orders have no lines (inserts), some are pending (kept), most move to
    another month, and some prices are overwritten by NULL.
    """
    facts = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(
        F.max("l_extendedprice").alias("price"),
        F.max("l_shipdate").cast("date").alias("day"),
        F.count("*").alias("lines"),
    )
    withheld = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "5-LOW")
    news = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") != "P").select(
        F.col("o_orderkey").alias("k"),
        F.when(~withheld, F.col("o_totalprice")).alias("price"),
        F.col("o_orderdate").cast("date").alias("day"),
    )
    store = fresh_store(spark)
    store.ensure_table("facts", facts.schema, "day", ["k"])
    store.append("facts", facts)
    store.upsert("facts", news, "k")
    return store.scan("facts")


def _facts(spark, sf_dir):
    """What the lines say about each order."""
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(
        F.max("l_extendedprice").alias("price"),
        F.max("l_shipdate").cast("date").alias("day"),
        F.count("*").alias("lines"),
    )


@query(
    """SELECT * FROM lineitem WHERE l_partkey BETWEEN 20 AND 40
  UNION ALL SELECT * FROM lineitem WHERE l_extendedprice > 50000 AND l_shipdate < TIMESTAMP '1997-01-01'"""
)
def clustered_scan(spark, sf_dir):
    """Lines laid out by part, price and date alike, written in two loads, then read by each of them."""
    lines, store = table(spark, sf_dir, "lineitem"), fresh_store(spark)
    fields = ["l_partkey", "l_extendedprice", "l_shipdate"]
    store.ensure_table("lines", lines.schema, cluster_fields=fields, interleave=True)
    for flag in (F.col("l_returnflag") == "N", F.col("l_returnflag") != "N"):
        store.append("lines", lines.filter(flag))
    rows = store.scan("lines")
    early = F.col("l_shipdate") < F.lit("1997-01-01").cast("timestamp_ntz")
    return rows.filter("l_partkey BETWEEN 20 AND 40").unionAll(rows.filter((F.col("l_extendedprice") > 50000) & early))


@query(
    """WITH facts AS (
    SELECT l_orderkey AS k, max(l_extendedprice) AS price, CAST(max(l_shipdate) AS DATE) AS day,
           count(*) AS lines FROM lineitem GROUP BY 1),
  late AS (
    SELECT o_orderkey AS k, o_totalprice AS price, CAST(o_orderdate AS DATE) AS day FROM orders
    WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '2001-06-01'),
  renamed AS (SELECT o_orderkey AS k, -o_totalprice AS price FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')
  SELECT coalesce(f.k, l.k, r.k) AS k,
    CASE WHEN r.k IS NOT NULL THEN r.price WHEN l.k IS NOT NULL THEN l.price ELSE f.price END AS price,
    CASE WHEN l.k IS NOT NULL THEN l.day ELSE f.day END AS day, f.lines AS lines
  FROM facts f FULL JOIN late l ON f.k = l.k FULL JOIN renamed r ON coalesce(f.k, l.k) = r.k"""
)
def upsert_bucketed(spark, sf_dir):
    """Order facts in buckets of their key; two later batches move rows to other months, add some, and change prices only."""
    facts, orders = _facts(spark, sf_dir), table(spark, sf_dir, "orders")
    store = fresh_store(spark)
    store.ensure_table("facts", facts.schema, "day", ["k"], bucket_key="k", buckets=4)
    store.append("facts", facts)
    late = orders.filter((F.col("o_orderstatus") == "F") & (F.col("o_orderdate") >= F.lit("2001-06-01").cast("timestamp_ntz")))
    news = late.select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("price"), F.col("o_orderdate").cast("date").alias("day"))
    store.upsert("facts", news, "k")
    urgent = orders.filter((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT"))
    store.upsert("facts", urgent.select(F.col("o_orderkey").alias("k"), (-F.col("o_totalprice")).alias("price")), "k")
    return store.scan("facts")


@query(
    """WITH t AS (SELECT CAST(o_orderdate AS DATE) AS "Fecha", max(o_totalprice) AS v, min(o_totalprice) AS low
      FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
    s AS (SELECT CAST(o_orderdate AS DATE) AS "Fecha", max(o_totalprice) AS v, min(o_totalprice) AS low
      FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1)
  SELECT coalesce(s."Fecha", t."Fecha") AS "Fecha",
    CASE WHEN s."Fecha" IS NOT NULL THEN s.v ELSE t.v END AS v,
    CASE WHEN s."Fecha" IS NOT NULL THEN s.low ELSE t.low END AS low FROM t FULL JOIN s ON t."Fecha" = s."Fecha\""""
)
def upsert_by_date(spark, sf_dir):
    """The default merge key: a date, which also names the partition."""

    def rates(rows):
        return rows.groupBy(F.col("o_orderdate").cast("date").alias(DATE_COLUMN)).agg(
            F.max("o_totalprice").alias("v"), F.min("o_totalprice").alias("low")
        )

    orders = table(spark, sf_dir, "orders")
    first = rates(orders.filter(F.col("o_orderstatus") == "F"))
    store = fresh_store(spark)
    store.ensure_table("rates", first.schema, DATE_COLUMN)
    store.append("rates", first)
    store.upsert("rates", rates(orders.filter(F.col("o_orderstatus") != "F")))
    return store.scan("rates")


@query(
    """SELECT * FROM orders
  WHERE NOT CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-15' AND DATE '1996-04-03'"""
)
def delete_range(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    dated = orders.withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    store = fresh_store(spark)
    store.ensure_table("orders", dated.schema, "o_orderdate")
    store.append("orders", dated)
    store.delete_range("orders", datetime(1996, 1, 15, 10, 32), datetime(1996, 4, 3), "o_orderdate")
    return store.scan("orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))


@query("SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders GROUP BY 1")
def month_partition_layout(spark, sf_dir):
    store = _orders_table(spark, sf_dir)
    return spark.table(store.name("orders")).groupBy(F.col(PARTITION).alias("month")).agg(F.count("*").alias("n"))


@query(
    """SELECT CAST(ts AS DATE) AS "Fecha", max(value) AS usdclp_obs, min(value) AS eurclp_obs,
    CAST(count(*) AS DOUBLE) AS ufclp, TIMESTAMP '2002-01-01 10:32:00' AS ingestion_timestamp,
    'CMF_Chile_API' AS data_source FROM events GROUP BY 1"""
)
def fixed_schema_table(spark, sf_dir):
    rates = table(spark, sf_dir, "events").groupBy(F.col("ts").cast("date").alias(DATE_COLUMN)).agg(
        F.max("value").alias("usdclp_obs"),
        F.min("value").alias("eurclp_obs"),
        F.count("*").cast("double").alias("ufclp"),
        F.lit(NOW).alias("ingestion_timestamp"),
        F.lit("CMF_Chile_API").alias("data_source"),
    )
    store = fresh_store(spark)
    store.ensure_rate_table()
    store.append("exchange_rates", rates)
    stored = store.scan("exchange_rates")
    return stored.withColumn("ingestion_timestamp", F.col("ingestion_timestamp").cast("timestamp_ntz"))


@query("SELECT event_id, CAST(ts AS DATE) AS day, value, strftime(ts, '%Y-%m') AS part FROM events")
def layout_repair(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("date").alias("day"), "value")
    store = fresh_store(spark)
    store.ensure_table("events", events.schema, "day", granularity="day")
    store.append("events", events)
    store.ensure_table("events", events.schema, "day", granularity="month")
    return spark.table(store.name("events")).withColumnRenamed(PARTITION, "part")


@query(
    """SELECT user_id, event_id, ts, event_type, value FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""
)
def stream_upsert(spark, sf_dir):
    """Events arrive in several micro-batches, in no particular order; the newest per user stays."""
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    inbox = work_path(spark, "inbox")
    # As many files as the table has partitions or twice the cores, so that there are several batches.
    files = max(events.rdd.getNumPartitions(), 2 * spark.sparkContext.defaultParallelism)
    events.repartition(files, "event_id").write.parquet(inbox)
    store = fresh_store(spark)
    store.ensure_table("latest", events.schema, "ts")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", -(-files // 3)).parquet(inbox)
    upsert_stream(
        stream,
        store,
        "latest",
        "user_id",
        work_path(spark, "progress"),
        latest_per_key("user_id", ["ts", "event_id"]),
        newer_by=["ts", "event_id"],
    ).awaitTermination()
    return store.scan("latest")


@query(
    """SELECT user_id, event_id, ts, event_type, value FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""
)
def stream_state_corrections(spark, sf_dir):
    """The newest event per user from streaming state: files in two goes, the second from the checkpoint of the first."""
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    inbox, progress = work_path(spark, "inbox"), work_path(spark, "progress")
    store = fresh_store(spark)
    events.limit(0).write.parquet(inbox)
    files = max(events.rdd.getNumPartitions(), spark.sparkContext.defaultParallelism)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", -(-files // 2)).parquet(inbox)
    late = F.col("event_id") % 2 == 0
    for part in (events.filter(~late), events.filter(late)):
        part.repartition(files, "event_id").write.mode("append").parquet(inbox)
        run = state.state_stream(stream, store, "newest", ["user_id"], ["ts", "event_id"], progress, "ts", "60 days")
        run.awaitTermination()
        if state.refused_rows(run):
            state.add_rows(store, "newest", part, "again")
    state.compact(store, "newest", ["user_id"], ["ts", "event_id"])
    return state.current_rows(store, "newest", ["user_id"], ["ts", "event_id"])


FILLED = (
    f"""WITH {WIDE} SELECT "Fecha", """
    + each('last_value({c} IGNORE NULLS) OVER (ORDER BY "Fecha" ROWS UNBOUNDED PRECEDING) AS {c}')
    + """, TIMESTAMP '2002-01-01 10:32:00' AS ingestion_timestamp, 'CMF_Chile_API' AS data_source FROM wide"""
)


def _zoneless(df):
    return df.withColumn("ingestion_timestamp", F.col("ingestion_timestamp").cast("timestamp_ntz"))


@query(FILLED)
def stream_landing_rates(spark, sf_dir):
    """Landing files as a stream of several batches, each with a part of the series and months."""
    store = _streamed_rates(spark, as_payload(daily(spark, sf_dir)))
    return _zoneless(filled(store, "rates", SPECS))


def _streamed_rates(spark, payload):
    root = land(payload)
    store = fresh_store(spark)
    shape = rate_rows(SPECS, NOW)
    columns = ", ".join(f"{s.column} double" for s in SPECS)
    schema = StructType.fromDDL(
        f"{DATE_COLUMN} date, {columns}, ingestion_timestamp timestamp, data_source string"
    )
    store.ensure_table("rates", schema, DATE_COLUMN, required=[DATE_COLUMN])
    files = payload.select("series", "month").distinct().count()
    upsert_stream(
        stream_landing(spark, root, files_per_batch=-(-files // 3)),
        store,
        "rates",
        DATE_COLUMN,
        work_path(spark, "progress"),
        shape,
        stage_batch=True,
        presence=presence_of(SPECS),
        quarantine="quarantine",
    ).awaitTermination()
    return store


@query(
    f"""WITH {DAILY} SELECT series, 'no valid date' AS defect, count(*) AS records
  FROM daily WHERE day("Fecha") = 13 GROUP BY 1"""
)
def stream_quarantine(spark, sf_dir):
    """Records without a valid date, kept and counted while the rest is merged."""
    payload = as_payload(daily(spark, sf_dir))
    spoiled = F.when(F.substring(DATE_COLUMN, 9, 2) == "13", F.lit("13th")).otherwise(F.col(DATE_COLUMN))
    store = _streamed_rates(spark, payload.withColumn(DATE_COLUMN, spoiled))
    return quarantine_counts(store, "quarantine")


@query("SELECT o_orderkey AS k, o_totalprice AS v FROM orders")
def upsert_unpartitioned(spark, sf_dir):
    """A table without partitions keeps its rows when none of the new keys is in it."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v"))
    store = fresh_store(spark)
    store.ensure_table("facts", orders.schema)
    store.append("facts", orders.filter("k % 2 = 0"))
    store.upsert("facts", orders.filter("k % 2 = 1"), "k")
    return store.scan("facts")


@query(
    """SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderdate AS DATE) END AS day,
    CASE WHEN o_orderkey % 3 = 2 THEN o_totalprice * 2 ELSE o_totalprice END AS v
  FROM orders"""
)
def upsert_undated(spark, sf_dir):
    """A source without the date column over a table that has undated rows: updates and inserts, none lost."""
    orders = table(spark, sf_dir, "orders")
    held = orders.select(
        F.col("o_orderkey").alias("k"),
        F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderdate").cast("date")).alias("day"),
        F.col("o_totalprice").alias("v"),
    )
    store = fresh_store(spark)
    store.ensure_table("facts", held.schema, "day")
    # Of the undated rows the even keys are stored, the odd ones come as inserts.
    store.append("facts", held.filter("k % 3 = 0 OR k % 2 = 0"))
    news = held.withColumn("v", F.when(F.col("k") % 3 == 2, F.col("v") * 2).otherwise(F.col("v")))
    store.upsert("facts", news.filter("k % 3 = 2 OR (k % 3 = 1 AND k % 2 = 1)").drop("day"), "k")
    return store.scan("facts")


def _config(store, **changes):
    return IngestConfig(
        database=store.database, location=store.location, series=tuple(SERIES_MAP), series_map=SERIES_MAP, **changes
    )


@query(FILLED)
def ingest_run(spark, sf_dir):
    """The whole run: landing files, merge, fill, stamp, load, read back."""
    store = fresh_store(spark)
    return _zoneless(run_ingest(spark, landed(spark, sf_dir), _config(store), "full", NOW))


@query(
    f"""WITH {DAILY}, recent AS (SELECT * FROM daily
      WHERE "Fecha" >= TIMESTAMP '2001-06-02 10:32:00' AND "Fecha" <= TIMESTAMP '2001-08-01 10:32:00'),
    wide AS (SELECT "Fecha", """
    + each("max(v) FILTER (series = '{s}') AS {c}")
    + """ FROM recent GROUP BY 1)
  SELECT "Fecha", """
    + each('last_value({c} IGNORE NULLS) OVER (ORDER BY "Fecha" ROWS UNBOUNDED PRECEDING) AS {c}')
    + """, TIMESTAMP '2001-08-01 10:32:00' AS ingestion_timestamp, 'CMF_Chile_API' AS data_source FROM wide"""
)
def ingest_backfill(spark, sf_dir):
    """A 60-day backfill, then the same window again: the rerun must change nothing."""
    store = fresh_store(spark)
    source, now = landed(spark, sf_dir), datetime(2001, 8, 1, 10, 32)
    run_ingest(spark, source, _config(store), "backfill", now, backfill_days=60)
    return _zoneless(run_ingest(spark, source, _config(store), "backfill", now, backfill_days=60))


@query(
    """SELECT * FROM orders WHERE o_orderstatus = 'O'
  AND CAST(o_orderdate AS DATE) BETWEEN DATE '1997-05-10' AND DATE '1997-08-20'"""
)
def table_scan_range(spark, sf_dir):
    """Equality and date range on a stored table: the range also prunes month partitions."""
    store = _orders_table(spark, sf_dir)
    return store.scan("orders", {"o_orderstatus": "O"}, start=date(1997, 5, 10), end=date(1997, 8, 20))


@query(f"WITH {DAILY} SELECT series, \"Fecha\", v AS value FROM daily")
def stream_custom_source(spark, sf_dir):
    """A registered client as a stream, stopped and resumed: each file is delivered once."""
    payload = as_payload(daily(spark, sf_dir))
    early = F.col("month") < "1998-01"
    root, out, progress = land(payload.filter(early)), work_path(spark, "delivered"), work_path(spark, "progress")
    source = plugged(spark, root)
    for news in (None, payload.filter(~early)):
        if news is not None:
            write_landing(news, root)
        stream = dated(spark.readStream.format(source.name).option("slicesPerPartition", 16).load())
        (
            stream.writeStream.format("parquet")
            .option("checkpointLocation", progress)
            .trigger(availableNow=True)
            .start(out)
            .awaitTermination()
        )
    rows = spark.read.schema(stream.schema).parquet(out)
    return accepted(rows).select("series", DATE_COLUMN, parse_decimal(F.col(VALUE_FIELD)).alias("value"))


@query(
    f"""WITH {WIDE} SELECT *, TIMESTAMP '2002-01-01 10:32:00' AS ingestion_timestamp, 'CMF_Chile_API' AS data_source
  FROM wide WHERE {" AND ".join(f"{c} IS NOT NULL" for c in VALUE_NAMES)}"""
)
def ingest_custom_steps(spark, sf_dir):
    """A run with the caller's own source and own preparation, which keeps complete days only."""

    def complete_days(wide, *rest, seed=None):
        return prepare(wide.dropna(subset=VALUE_NAMES), *rest, seed=seed)

    store, source = fresh_store(spark), plugged(spark, land(as_payload(daily(spark, sf_dir))))
    return _zoneless(run_ingest(spark, source, _config(store), "full", NOW, preparation=complete_days))
