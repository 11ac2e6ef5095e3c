"""Which (series, month) pieces a date range needs, as rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake.functions.dates import month_text, months_between_inclusive, whole_days_between, year_text
from ratelake.model import DEFAULT_SERIES, SeriesSpec

# The switch to one bulk request, its start, and the path shapes.
BULK_AFTER_DAYS = 90
BULK_YEAR, BULK_MONTH = "1900", "01"
MONTH_PATH = "%s/%s/%s"
FROM_MONTH_PATH = "%s/posteriores/%s/%s"


def is_bulk(start: datetime, end: datetime) -> bool:
    """More than 90 whole days: one read of everything instead of month by month."""
    return whole_days_between(start, end) > BULK_AFTER_DAYS


def request_path(api_name: Column, year: Column, month: Column, onwards: bool = True) -> Column:
    """Resource path of one request. Credentials never become part of it."""
    return F.format_string(FROM_MONTH_PATH if onwards else MONTH_PATH, api_name, year, month)


def month_requests(bounds: DataFrame, onwards: bool = False) -> DataFrame:
    """One row per series and month from ``bounds(api_name, start, end)``.

    Months are counted on dates, so a last month that starts earlier in the day
    than the range does is included.
    """
    months = bounds.select(
        "api_name", F.explode(months_between_inclusive(F.col("start"), F.col("end"))).alias("month_start")
    )
    stamped = months.withColumns({"year": year_text(F.col("month_start")), "month": month_text(F.col("month_start"))})
    return stamped.withColumn("path", request_path(F.col("api_name"), F.col("year"), F.col("month"), onwards))


def request_grid(
    spark: SparkSession,
    start: datetime,
    end: datetime,
    specs: Sequence[SeriesSpec] = DEFAULT_SERIES,
) -> DataFrame:
    """The requests for one range: a bulk row per series, or a row per series and month."""
    named = F.explode(F.array(*[F.lit(s.api_name) for s in specs])).alias("api_name")
    bulk = is_bulk(start, end)
    first = date(int(BULK_YEAR), int(BULK_MONTH), 1) if bulk else start.date()
    last = first if bulk else end.date()
    bounds = spark.range(1).select(named, F.lit(first).alias("start"), F.lit(last).alias("end"))
    return month_requests(bounds, onwards=bulk)
