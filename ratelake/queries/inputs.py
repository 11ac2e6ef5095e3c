"""Rate series derived from the given tables.

A series is an order priority; its daily rate is the highest order total of that
day. Not every priority has an order every day, so the series have gaps.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake.model import DATE_COLUMN, VALUE_FIELD, SeriesSpec
from ratelake.operators.merge import pivot_merge
from ratelake.queries.registry import table
from ratelake.session import work_path
from ratelake.sinks.store import TableStore
from ratelake.sources.observations import LandingSource, write_landing
from ratelake.sources.pluggable import FolderClient, PluggedSource, register_source

SPECS = tuple(SeriesSpec(n, n, f"{n}_obs") for n in ("urgent", "high", "medium", "not_specified", "low"))
SERIES_MAP = {s.name: {"api": s.api_name, "column": s.column} for s in SPECS}
KNOWN = {s.name: s for s in SPECS}
VALUE_NAMES = [s.column for s in SPECS]
NOW = datetime(2002, 1, 1, 10, 32)

# The same series in SQL, for the comparisons.
DAILY = """daily AS (
  SELECT lower(replace(substr(o_orderpriority, 3), ' ', '_')) AS series,
         CAST(o_orderdate AS DATE) AS "Fecha", max(o_totalprice) AS v
  FROM orders GROUP BY 1, 2)"""
WIDE = (
    DAILY
    + """, wide AS (
  SELECT "Fecha", """
    + ", ".join(f"max(v) FILTER (series = '{s.api_name}') AS {s.column}" for s in SPECS)
    + """ FROM daily GROUP BY "Fecha")"""
)


def each(template: str, separator: str = ", ") -> str:
    """The template once per series column, ``{c}`` being the column and ``{s}`` the series."""
    return separator.join(template.format(c=s.column, s=s.api_name) for s in SPECS)


def series_of(priority: Column) -> Column:
    return F.lower(F.replace(F.substring(priority, 3, 100), F.lit(" "), F.lit("_")))


def comma_text(value: Column) -> Column:
    return F.replace(value.cast("string"), F.lit("."), F.lit(","))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(series, Fecha, value)``, one row per series and day."""
    orders = table(spark, sf_dir, "orders")
    return orders.groupBy(
        series_of(F.col("o_orderpriority")).alias("series"), F.col("o_orderdate").cast("date").alias(DATE_COLUMN)
    ).agg(F.max("o_totalprice").alias("value"))


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_merge(daily(spark, sf_dir), SPECS)


def as_payload(long: DataFrame) -> DataFrame:
    """Typed long rows to the text rows of a landing folder."""
    return long.select(
        "series",
        F.date_format(DATE_COLUMN, "yyyy-MM").alias("month"),
        F.col(DATE_COLUMN).cast("string").alias(DATE_COLUMN),
        comma_text(F.col("value")).alias(VALUE_FIELD),
    )


def land(payload: DataFrame) -> str:
    """Write a fresh landing folder; returns its path."""
    root = work_path(payload.sparkSession, "landing")
    write_landing(payload, root)
    return root


def landed(spark: SparkSession, sf_dir: str) -> LandingSource:
    return LandingSource(land(as_payload(daily(spark, sf_dir))), exact_months=True)


def plugged(spark: SparkSession, root: str) -> PluggedSource:
    """A landing folder behind a client of its own, registered under a fresh name."""
    name = f"landing_{uuid.uuid4().hex[:12]}"
    register_source(spark, name, FolderClient(root))
    return PluggedSource(name, exact_months=True, slices_per_partition=16)


def fresh_store(spark: SparkSession) -> TableStore:
    """A store in its own database below the shared folder."""
    location = work_path(spark, "db")
    store = TableStore(spark, location.rsplit("/", 1)[1].replace("-", "_"), location)
    store.ensure_database()
    return store
