"""Reading one series, several series, or a date range of several series."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake.model import DATE_COLUMN, VALUE_FIELD, SeriesSpec, catalogue, find_series, quoted
from ratelake.operators.filters import in_date_range
from ratelake.operators.merge import merge_long
from ratelake.session import materialize
from ratelake.sources.observations import SeriesSource, accepted, quarantine
from ratelake.sources.requests import is_bulk


def default_month(year: str | None, month: str | None, now: datetime) -> tuple[str, str]:
    """The month of ``now`` unless both parts are given."""
    return (f"{now:%Y}", f"{now:%m}") if year is None or month is None else (year, month)


def read_series(
    spark: SparkSession,
    source: SeriesSource,
    name: str,
    now: datetime,
    year: str | None = None,
    month: str | None = None,
    onwards: bool = True,
    known: Mapping[str, SeriesSpec] | None = None,
    strict: bool = False,
) -> DataFrame:
    """``(Fecha, <series column>)``, values still text; an unknown series is an error.

    ``onwards`` reads from the given month on, otherwise only that month.
    """
    spec = find_series(name, known)
    y, m = default_month(year, month, now)
    first = f"{y}-{m}"
    seen = source.observations(spark, [spec], (first, None if onwards else first))
    return one_series(accepted(seen, strict), spec)


def one_series(observations: DataFrame, spec: SeriesSpec) -> DataFrame:
    """One series out of the long shape, its value column renamed."""
    return (
        observations.filter(F.col("series") == F.lit(spec.api_name))
        .select(DATE_COLUMN, VALUE_FIELD)
        .withColumnRenamed(VALUE_FIELD, spec.column)
    )


def read_many(
    spark: SparkSession,
    source: SeriesSource,
    names: Sequence[str],
    now: datetime,
    year: str | None = None,
    month: str | None = None,
    onwards: bool = True,
    merge: bool = True,
    known: Mapping[str, SeriesSpec] | None = None,
    strict: bool = False,
) -> DataFrame | dict[str, DataFrame]:
    """Several series, merged by date or as a dict of lazy frames.

    Unknown names are skipped, and with ``strict`` so is every series with a
    defective record; finding those is a pass over the data that returns names
    only. Without any series left the result is None or an empty dict.
    """
    known = catalogue() if known is None else known
    specs = [known[n] for n in names if n in known]
    y, m = default_month(year, month, now)
    first = f"{y}-{m}"
    good = None
    if specs:
        seen = source.observations(spark, specs, (first, None if onwards else first))
        if strict:
            failed = {r["series"] for r in quarantine(seen).select("series").distinct().collect()}
            specs = [s for s in specs if s.api_name not in failed]
        good = accepted(seen)
    if not merge:
        return {s.name: one_series(good, s) for s in specs}
    return merge_long(_long(good), specs) if specs else None


def read_range(
    spark: SparkSession,
    source: SeriesSource,
    specs: Sequence[SeriesSpec],
    start: datetime,
    end: datetime,
    strict: bool = False,
    align_days: bool = False,
    stage: Callable[[DataFrame], DataFrame] = materialize,
) -> DataFrame:
    """Wide table for a date range, bounds included, values still text.

    Ranges over 90 days are one merge of everything read. Shorter ranges are
    merged month by month, and of two months that report the same date the
    earlier one wins with its whole row.
    """
    seen = range_observations(spark, source, specs, start, end)
    # Strictness looks at the observations twice.
    good = usable(stage(seen) if strict else seen, start, end, strict)
    return merge_range(good, specs, start, end, align_days, stage)


def range_observations(
    spark: SparkSession, source: SeriesSource, specs: Sequence[SeriesSpec], start: datetime, end: datetime
) -> DataFrame:
    """The observations of the months that a range needs, not yet cut to it."""
    bulk = is_bulk(start, end)
    # A payload may run on past its own month, so a bulk read starts at the first.
    lower = None if bulk and not getattr(source, "exact_months", False) else f"{start:%Y-%m}"
    return source.observations(spark, specs, (lower, f"{end:%Y-%m}"))


def usable(observations: DataFrame, start: datetime, end: datetime, strict: bool = False) -> DataFrame:
    """Without defects; ``strict`` fails a whole series, or one month of it in a short range."""
    return accepted(observations, strict, ("series",) if is_bulk(start, end) else ("series", "month"))


def merge_range(
    observations: DataFrame,
    specs: Sequence[SeriesSpec],
    start: datetime,
    end: datetime,
    align_days: bool = False,
    stage: Callable[[DataFrame], DataFrame] = materialize,
) -> DataFrame:
    """Cut to the range and put the series side by side."""
    # The range filter commutes with a merge on the date, and is cheaper before it.
    wanted = in_date_range(observations, start, end, align_days=align_days)
    if is_bulk(start, end):
        return merge_long(_long(wanted), specs, stage=stage)
    return first_month_wins(wanted, specs)


def _long(observations: DataFrame) -> DataFrame:
    return observations.select("series", DATE_COLUMN, F.col(VALUE_FIELD).alias("value"))


def first_month_wins(observations: DataFrame, specs: Sequence[SeriesSpec]) -> DataFrame:
    """Merge within each month, then keep the first month's row per date.

    Two aggregations, both reduced on the map side: a busy date never meets in one
    task as rows.
    """
    position = F.struct("file", "seq")

    def first_of(spec: SeriesSpec) -> Column:
        mine = F.col("series") == F.lit(spec.api_name)
        return F.min_by(VALUE_FIELD, F.when(mine, position))

    monthly = observations.groupBy(DATE_COLUMN, "month").agg(*[first_of(s).alias(s.column) for s in specs])
    rows = F.struct(*[quoted(s.column) for s in specs])
    first = monthly.groupBy(DATE_COLUMN).agg(F.min_by(rows, F.col("month")).alias("__row"))
    return first.select(
        DATE_COLUMN, *[F.col("__row").getField(s.column).alias(s.column) for s in specs]
    )

