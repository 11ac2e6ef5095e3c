"""Queries on reading, parsing, merging and preparing series."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ratelake.functions.dates import hour_start
from ratelake.functions.parsing import is_bad_date, is_coerced, parse_date, parse_decimal
from ratelake.model import DATE_COLUMN, VALUE_FIELD
from ratelake.operators.audit import audit_columns
from ratelake.operators.dedupe import drop_duplicate_rows, keep_first
from ratelake.operators.fill import forward_fill
from ratelake.operators.filters import in_date_range, scan
from ratelake.operators.merge import outer_merge, pivot_merge, sorted_positions, union_months
from ratelake.plans.clean import clean
from ratelake.plans.ingest import fill_counts, mode_windows
from ratelake.plans.ingest import ingest_metrics as count_records
from ratelake.plans.prepare import prepare
from ratelake.queries.inputs import (
    DAILY,
    KNOWN,
    NOW,
    SPECS,
    VALUE_NAMES,
    WIDE,
    as_payload,
    comma_text,
    daily,
    each,
    land,
    landed,
    plugged,
    series_of,
    wide,
)
from ratelake.queries.registry import query, table
from ratelake.sources.observations import LandingSource, accepted, parse_documents
from ratelake.sources.observations import landing_inventory as inventory
from ratelake.sources.requests import month_requests
from ratelake.sources.series import read_many, read_range, read_series


def _typed(df):
    return df.withColumns({c: parse_decimal(F.col(c)) for c in df.columns if c in VALUE_NAMES})


@query(
    """SELECT s AS api_name, CAST(m AS DATE) AS month_start,
         s || '/' || strftime(m, '%Y') || '/' || strftime(m, '%m') AS path
  FROM (SELECT lower(replace(substr(o_orderpriority, 3), ' ', '_')) AS s,
          unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)),
                                 INTERVAL 1 MONTH)) AS m
        FROM orders GROUP BY 1)"""
)
def request_grid(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    bounds = table(spark, sf_dir, "orders").groupBy(series_of(F.col("o_orderpriority")).alias("api_name")).agg(
        F.min(day).alias("start"), F.max(day).alias("end")
    )
    return month_requests(bounds).select("api_name", "month_start", "path")


def _documents(spark, sf_dir):
    """XML documents of at most 1000 orders each: the key is unique, so a span of keys bounds them."""
    orders = table(spark, sf_dir, "orders")
    record = F.concat(
        F.lit("<Obs><Fecha>"),
        F.date_format("o_orderdate", "yyyy-MM-dd"),
        F.lit("</Fecha><Valor>"),
        comma_text(F.col("o_totalprice")),
        F.lit("</Valor></Obs>"),
    )
    body = F.array_join(F.collect_list(record), "")
    return orders.groupBy(
        series_of(F.col("o_orderpriority")).alias("series"),
        F.floor(F.col("o_orderkey") / 1000).cast("string").alias("file"),
    ).agg(F.concat(F.lit("<ObservacionesSeries>"), body, F.lit("</ObservacionesSeries>")).alias("xml"))


OBSERVATIONS = """SELECT lower(replace(substr(o_orderpriority, 3), ' ', '_')) AS series,
  CAST(o_orderdate AS DATE) AS "Fecha", o_totalprice AS value FROM orders"""


def _parsed(documents, pairing):
    return accepted(parse_documents(documents, "xml", pairing)).select(
        "series", DATE_COLUMN, parse_decimal(F.col(VALUE_FIELD)).alias("value")
    )


@query(OBSERVATIONS)
def xml_observations(spark, sf_dir):
    return _parsed(_documents(spark, sf_dir), "record")


@query(OBSERVATIONS)
def xml_observations_positional(spark, sf_dir):
    return _parsed(_documents(spark, sf_dir), "positional")


@query(f"WITH {DAILY} SELECT \"Fecha\", v AS urgent_obs FROM daily WHERE series = 'urgent'")
def series_read(spark, sf_dir):
    read = read_series(spark, landed(spark, sf_dir), "urgent", NOW, "1995", "01", known=KNOWN)
    return _typed(read)


@query(
    f"""WITH {DAILY} SELECT series, "Fecha", v AS value FROM daily
  WHERE series IN ('urgent', 'low') AND strftime("Fecha", '%Y-%m') BETWEEN '1996-03' AND '1997-02'"""
)
def custom_source_read(spark, sf_dir):
    """Observations through a registered client: other series and months are never fetched."""
    source = plugged(spark, land(as_payload(daily(spark, sf_dir))))
    seen = source.observations(spark, [KNOWN["urgent"], KNOWN["low"]], ("1996-03", "1997-02"))
    return accepted(seen).select("series", DATE_COLUMN, parse_decimal(F.col(VALUE_FIELD)).alias("value"))


@query(
    f"WITH {DAILY} SELECT \"Fecha\", "
    + ", ".join(f"max(v) FILTER (series = '{s.api_name}') AS {s.column}" for s in SPECS if s.name != "low")
    + " FROM daily WHERE series <> 'low' GROUP BY 1"
)
def multi_series_read(spark, sf_dir):
    payload = as_payload(daily(spark, sf_dir))
    # Dates of one series are spoiled in one month, which fails the whole series.
    spoiled = (F.col("series") == "low") & (F.col("month") == "1998-06")
    bad = payload.withColumn(DATE_COLUMN, F.when(spoiled, F.lit("30/06/98")).otherwise(F.col(DATE_COLUMN)))
    return _typed(read_many(spark, LandingSource(land(bad)), list(KNOWN), NOW, "1995", "01", known=KNOWN, strict=True))


@query(
    f"WITH {WIDE} SELECT * FROM wide WHERE \"Fecha\" >= TIMESTAMP '1995-01-01 10:32:00' "
    "AND \"Fecha\" <= TIMESTAMP '2002-01-01 10:32:00'"
)
def range_read(spark, sf_dir):
    return _typed(read_range(spark, landed(spark, sf_dir), SPECS, datetime(1995, 1, 1, 10, 32), NOW))


@query(
    f"WITH {WIDE} SELECT * FROM wide WHERE \"Fecha\" >= TIMESTAMP '1998-01-15 10:32:00' "
    "AND \"Fecha\" <= TIMESTAMP '1998-04-10 10:32:00'"
)
def range_read_months(spark, sf_dir):
    start, end = datetime(1998, 1, 15, 10, 32), datetime(1998, 4, 10, 10, 32)
    return _typed(read_range(spark, landed(spark, sf_dir), SPECS, start, end))


@query(
    """SELECT o_orderkey, o_orderdate FROM orders
  WHERE o_orderdate >= TIMESTAMP '1996-03-01 10:32:00' AND o_orderdate <= TIMESTAMP '1999-03-01 10:32:00'"""
)
def date_range_filter(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return in_date_range(orders, datetime(1996, 3, 1, 10, 32), datetime(1999, 3, 1, 10, 32), "o_orderdate")


@query(
    """WITH n AS (SELECT DISTINCT o_orderdate + INTERVAL 632 MINUTE AS t FROM orders)
  SELECT 'incremental' AS mode, t - INTERVAL 1 DAY AS start_ts, t AS end_ts FROM n
  UNION ALL SELECT 'backfill', t - INTERVAL 7 DAY, t FROM n
  UNION ALL SELECT 'full', TIMESTAMP '1990-01-01 00:00:00', t FROM n"""
)
def mode_window(spark, sf_dir):
    moments = table(spark, sf_dir, "orders").select(
        (F.col("o_orderdate") + F.expr("interval 632 minutes")).alias("now")
    )
    return moments.distinct().select(F.inline(mode_windows(F.col("now"))))


@query(
    """SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
  ORDER BY o_orderkey LIMIT 5"""
)
def scan_filter_limit(spark, sf_dir):
    ordered = table(spark, sf_dir, "orders").orderBy("o_orderkey")
    return scan(ordered, {"o_orderstatus": "F", "o_orderpriority": "1-URGENT"}, 5)


@query(f"WITH {DAILY} SELECT DISTINCT series, strftime(\"Fecha\", '%Y-%m') AS month FROM daily")
def landing_inventory(spark, sf_dir):
    files = inventory(spark, landed(spark, sf_dir).root)
    named = files.select(
        F.regexp_extract("path", r"series=([^/]+)", 1).alias("series"),
        F.regexp_extract("path", r"month=([^/]+)", 1).alias("month"),
    )
    return named.distinct()


@query(
    """SELECT o_orderkey,
    CASE o_orderkey % 6 WHEN 0 THEN CAST(o_orderdate AS DATE) WHEN 1 THEN CAST(o_orderdate AS DATE) END AS parsed,
    o_orderkey % 6 >= 3 AS bad FROM orders"""
)
def date_parse(spark, sf_dir):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    kind = F.col("o_orderkey") % 6
    text = (
        F.when(kind == 0, day)
        .when(kind == 1, F.date_format("o_orderdate", "yyyy-M-d"))
        .when(kind == 2, F.lit(""))
        .when(kind == 3, F.concat(F.lit(" "), day))
        .when(kind == 4, F.concat(day, F.lit("T00:00")))
        .otherwise(F.concat(F.year("o_orderdate"), F.lit("-13-01")))
    )
    read = table(spark, sf_dir, "orders").select("o_orderkey", text.alias("t"))
    return read.select("o_orderkey", parse_date(F.col("t")).alias("parsed"), is_bad_date(F.col("t")).alias("bad"))


@query(
    """SELECT event_id,
    CASE WHEN event_id % 5 IN (0, 2) THEN value END AS plain,
    round(CASE event_id % 5 WHEN 0 THEN value WHEN 1 THEN value + 1000 WHEN 2 THEN value END, 6) AS spanish,
    event_id % 5 IN (1, 3, 4) AS coerced FROM events"""
)
def decimal_comma(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    kind = F.col("event_id") % 5
    value = comma_text(F.col("value"))
    thousands = F.concat(
        F.lit("1."), F.lpad(F.floor("value").cast("string"), 3, "0"), F.regexp_extract(value, ",.*$", 0)
    )
    text = (
        F.when(kind == 0, value)
        .when(kind == 1, thousands)
        .when(kind == 2, F.concat(F.lit(" "), value, F.lit(" ")))
        .when(kind == 3, F.concat(value, F.lit("d")))
        .otherwise(F.lit("nan"))
    )
    read = events.select("event_id", text.alias("t"))
    return read.select(
        "event_id",
        parse_decimal(F.col("t")).alias("plain"),
        F.round(parse_decimal(F.col("t"), "es"), 6).alias("spanish"),
        is_coerced(F.col("t")).alias("coerced"),
    )


def _with_undated(spark, sf_dir):
    """The daily series plus one row without a date in each."""
    long = daily(spark, sf_dir)
    undated = long.groupBy("series").agg(F.max("value").alias("value"))
    return long.unionByName(undated, allowMissingColumns=True)


UNDATED_MERGE = f"""WITH {DAILY}, long AS (
    SELECT * FROM daily UNION ALL SELECT series, NULL, max(v) FROM daily GROUP BY 1),
  k AS (SELECT DISTINCT "Fecha" FROM long)
  SELECT k."Fecha", {each("{c}.v AS {c}")} FROM k """ + each(
    "LEFT JOIN (SELECT * FROM long WHERE series = '{s}') {c} ON k.\"Fecha\" IS NOT DISTINCT FROM {c}.\"Fecha\"", " "
)


@query(UNDATED_MERGE)
def series_outer_merge(spark, sf_dir):
    long = _with_undated(spark, sf_dir)
    return outer_merge(
        [long.filter(F.col("series") == s.api_name).select(DATE_COLUMN, F.col("value").alias(s.column)) for s in SPECS]
    )


@query(UNDATED_MERGE)
def series_pivot_merge(spark, sf_dir):
    return pivot_merge(_with_undated(spark, sf_dir), SPECS)


@query(
    f"""WITH {DAILY}, long AS (SELECT * FROM daily UNION ALL SELECT series, "Fecha", v + 1 FROM daily
      WHERE series = 'urgent' AND strftime("Fecha", '%d') = '01'),
  k AS (SELECT DISTINCT "Fecha" FROM long)
  SELECT k."Fecha", {each("{c}.v AS {c}")} FROM k """
    + each(
        "LEFT JOIN (SELECT * FROM long WHERE series = '{s}') {c} ON k.\"Fecha\" IS NOT DISTINCT FROM {c}.\"Fecha\"", " "
    )
)
def series_merge_repeated(spark, sf_dir):
    """A series that reports some days twice: its rows multiply."""
    long = daily(spark, sf_dir)
    again = long.filter((F.col("series") == "urgent") & (F.day(DATE_COLUMN) == 1)).withColumn("value", F.col("value") + 1)
    return pivot_merge(long.unionByName(again), SPECS, duplicates="multiply")


@query(
    f"""WITH {WIDE} SELECT "Fecha", """
    + each('last_value({c} IGNORE NULLS) OVER (ORDER BY "Fecha" ROWS UNBOUNDED PRECEDING) AS {c}')
    + " FROM wide"
)
def forward_fill_days(spark, sf_dir):
    return forward_fill(wide(spark, sf_dir), distinct_order=True)


@query(
    """WITH h AS (SELECT date_trunc('hour', ts) AS hour, event_type, max(value) AS v FROM events GROUP BY 1, 2),
  w AS (SELECT hour, """
    + ", ".join(f"max(v) FILTER (event_type = '{t}') AS {t}" for t in ("click", "view", "purchase", "signup", "error"))
    + """ FROM h GROUP BY 1)
  SELECT hour, """
    + ", ".join(
        f"last_value({t} IGNORE NULLS) OVER (ORDER BY hour ROWS UNBOUNDED PRECEDING) AS {t}"
        for t in ("click", "view", "purchase", "signup", "error")
    )
    + " FROM w",
    name="forward_fill",
)
def forward_fill_hours(spark, sf_dir):
    types = ["click", "view", "purchase", "signup", "error"]
    hourly = table(spark, sf_dir, "events").groupBy(hour_start(F.col("ts")).alias("hour")).agg(
        *[F.max(F.when(F.col("event_type") == t, F.col("value"))).alias(t) for t in types]
    )
    return forward_fill(hourly, types, order_by="hour", rows_per_range=200, distinct_order=True)


@query(
    """SELECT event_id, user_id, ts, last_value(CASE WHEN event_type <> 'error' THEN value END IGNORE NULLS)
    OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS value FROM events"""
)
def forward_fill_long(spark, sf_dir):
    """Every event of every user; a user with many events is cut along time."""
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "ts", F.when(F.col("event_type") != "error", F.col("value")).alias("value")
    )
    return forward_fill(events, ["value"], "ts", ["user_id"], rows_per_range=2000, distinct_order=True)


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_returnflag, l_linestatus, last_value(CASE WHEN l_discount > 0.07 THEN l_extendedprice END IGNORE NULLS)
    OVER (ORDER BY l_linestatus, l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice ROWS UNBOUNDED PRECEDING) AS price FROM lineitem"""
)
def forward_fill_hot_tie(spark, sf_dir):
    """Lines in the order of two texts with a handful of values: half of the rows are tied on the first one."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_extendedprice",
        "l_returnflag",
        "l_linestatus",
        F.when(F.col("l_discount") > 0.07, F.col("l_extendedprice")).alias("price"),
    )
    order = ["l_linestatus", "l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return forward_fill(lines, ["price"], order, rows_per_range=1000)


@query(
    """WITH o AS (SELECT -nullif(o_orderkey, 1) AS k, o_totalprice FROM orders)
  SELECT k, o_totalprice, row_number() OVER (ORDER BY k NULLS LAST) - 1 AS position FROM o"""
)
def sorted_output(spark, sf_dir):
    """The place of every row in the sorted output, taken from where the sort has put it."""
    orders = table(spark, sf_dir, "orders").select(
        (-F.nullif("o_orderkey", F.lit(1))).alias("k"), "o_totalprice"
    )
    return sorted_positions(orders, "k")


@query(
    f"""WITH {WIDE} SELECT "Fecha", """
    + each('last_value({c} IGNORE NULLS) OVER (ORDER BY "Fecha" ROWS UNBOUNDED PRECEDING) AS {c}')
    + """, TIMESTAMP '2002-01-01 10:32:00' AS ingestion_timestamp, 'CMF_Chile_API' AS data_source, 1 AS run
  FROM wide"""
)
def prepare_rates(spark, sf_dir):
    text = wide(spark, sf_dir)
    text = text.withColumns({c: comma_text(F.col(c)) for c in VALUE_NAMES}).withColumn(
        DATE_COLUMN, F.col(DATE_COLUMN).cast("string")
    )
    ready = prepare(text, NOW, metadata={"run": 1}, distinct_dates=True)
    return ready.withColumn("ingestion_timestamp", F.col("ingestion_timestamp").cast("timestamp_ntz"))


@query(
    """SELECT o_orderkey, 'revised' AS o_orderstatus, TIMESTAMP '2002-01-01 10:32:00' AS ingestion_timestamp,
    'orders' AS data_source, 7 AS batch FROM orders""",
    name="audit_columns",
)
def audit_columns_added(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    stamped = audit_columns(orders, NOW, "orders", {"batch": 7, "o_orderstatus": "revised"})
    return stamped.withColumn("ingestion_timestamp", F.col("ingestion_timestamp").cast("timestamp_ntz"))


@query(
    """SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderstatus = 'F'
  UNION ALL SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderstatus = 'O'
  UNION ALL SELECT o_orderkey, o_totalprice, NULL FROM orders WHERE o_orderstatus = 'P'""",
    name="union_months",
)
def months_union(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    slices = [orders.filter(F.col("o_orderstatus") == s) for s in ("F", "O", "P")]
    full = ["o_orderkey", "o_totalprice", "o_orderpriority"]
    return union_months(
        [slices[0].select(*full), slices[1].select(*reversed(full)), slices[2].select("o_totalprice", "o_orderkey")]
    )


@query(
    """SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) = 1"""
)
def dedupe_first(spark, sf_dir):
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *order)
    return keep_first(lines, ["l_orderkey", "l_linenumber"], order)


@query(
    """SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus, nullif(l_discount, 0) AS l_discount FROM lineitem"""
)
def clean_dedupe(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_returnflag", "l_linestatus", F.nullif("l_discount", F.lit(0.0)).alias("l_discount")
    )
    return drop_duplicate_rows(lines)


@query(
    """WITH x AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price,
      CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderstatus END AS status FROM orders),
    d AS (SELECT DISTINCT * FROM (SELECT * FROM x UNION ALL SELECT * FROM x WHERE status = 'F'))
  SELECT o_orderkey, round(coalesce(price, (SELECT median(price) FROM d)), 6) AS price,
    coalesce(status, (SELECT status FROM d WHERE status IS NOT NULL GROUP BY 1
                      ORDER BY count(*) DESC, status LIMIT 1)) AS status FROM d"""
)
def clean_impute(spark, sf_dir):
    gaps = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderstatus")).alias("status"),
    )
    doubled = gaps.unionByName(gaps.filter(F.col("status") == "F"))
    return clean(doubled).withColumn("price", F.round("price", 6))


@query(
    """SELECT event_type AS series, count(*) AS records, count(*) FILTER (event_id % 11 = 0) AS defects,
    count(*) FILTER (event_id % 7 = 0) AS coerced FROM events GROUP BY 1"""
)
def ingest_metrics(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    observations = events.select(
        F.col("event_type").alias("series"),
        F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("1."), F.col("value").cast("string")))
        .otherwise(comma_text(F.col("value")))
        .alias(VALUE_FIELD),
        F.when(F.col("event_id") % 11 == 0, F.lit("bad date")).alias("defect"),
    )
    return count_records(observations)


@query(
    f'WITH {WIDE} SELECT count(*) AS "rows", ' + each("count(*) FILTER ({c} IS NULL) AS {c}_nulls") + " FROM wide"
)
def merge_gaps(spark, sf_dir):
    return fill_counts(wide(spark, sf_dir))
