"""Row selection."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime, time
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelake.model import DATE_COLUMN, quoted


def equals_all(filters: Mapping[str, Any]) -> Column | None:
    """Conjunction of equalities; a None value asks for NULL."""
    condition = None
    for name, value in filters.items():
        test = quoted(name).isNull() if value is None else quoted(name) == F.lit(value)
        condition = test if condition is None else condition & test
    return condition


def scan(df: DataFrame, filters: Mapping[str, Any] | None = None, limit: int | None = None) -> DataFrame:
    """Equality filters, then at most ``limit`` rows; 0 and None mean all rows."""
    condition = equals_all(filters or {})
    if condition is not None:
        df = df.filter(condition)
    return df.limit(limit) if limit else df


def in_date_range(
    df: DataFrame,
    start: date | datetime,
    end: date | datetime,
    column: str = DATE_COLUMN,
    align_days: bool = False,
) -> DataFrame:
    """Both bounds included, compared as instants.

    A start with a time of day therefore leaves out a midnight value of the same
    day. ``align_days`` widens the bounds to whole days. The bounds are turned to
    the column's own type here, so that the comparison reaches the file scan.
    """
    if align_days:
        start, end = _day(start), _day(end)
    kind = df.schema[column].dataType.typeName()
    if kind == "date":
        first = _day(start)
        low = F.lit(first) if _as_datetime(start) == _as_datetime(first) else F.date_add(F.lit(first), 1)
        return df.filter((quoted(column) >= low) & (quoted(column) <= F.lit(_day(end))))
    end_moment = datetime.combine(end, time.max) if align_days else _as_datetime(end)
    low, high = (F.lit(str(m)).cast(df.schema[column].dataType) for m in (_as_datetime(start), end_moment))
    return df.filter((quoted(column) >= low) & (quoted(column) <= high))


def _day(moment: date | datetime) -> date:
    return moment.date() if isinstance(moment, datetime) else moment


def _as_datetime(moment: date | datetime) -> datetime:
    return moment if isinstance(moment, datetime) else datetime.combine(moment, time.min)
