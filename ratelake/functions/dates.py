"""Calendar expressions."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def next_month(day: Column) -> Column:
    return F.add_months(month_start(day), 1)


def months_between_inclusive(start: Column, end: Column) -> Column:
    """Array of month starts from the month of ``start`` to the month of ``end``."""
    return F.sequence(month_start(start), month_start(end), F.expr("interval 1 month"))


def year_text(day: Column) -> Column:
    return F.date_format(day, "yyyy")


def month_text(day: Column) -> Column:
    return F.date_format(day, "MM")


def whole_days(start: Column, end: Column) -> Column:
    """Elapsed 24-hour periods, rounded down, between two timestamps or dates."""
    seconds = F.unix_timestamp(end.cast("timestamp")) - F.unix_timestamp(start.cast("timestamp"))
    return F.floor(seconds / F.lit(86400)).cast("int")


def hour_start(moment: Column) -> Column:
    """Start of the hour, without a zone."""
    return F.date_trunc("hour", moment).cast("timestamp_ntz")


def whole_days_between(start: datetime, end: datetime) -> int:
    return (end - start) // timedelta(days=1)


def order_number(column: Column, data_type: T.DataType) -> Column:
    """A number that sorts as the column does, NULLs last.

    Decimals beyond a double's precision and texts that begin alike get equal numbers.
    """
    if isinstance(data_type, T.DateType):
        number = F.unix_date(column).cast("bigint")
    elif isinstance(data_type, T.TimestampType):
        number = F.unix_micros(column)
    elif isinstance(data_type, T.TimestampNTZType):
        # Field by field, so that no zone rule can fold two instants together.
        seconds = F.hour(column) * F.lit(3600) + F.minute(column) * F.lit(60)
        micros = (F.date_part(F.lit("SECOND"), column) * F.lit(1000000)).cast("bigint")
        number = (
            F.unix_date(column.cast("date")).cast("bigint") * F.lit(86400000000)
            + seconds.cast("bigint") * F.lit(1000000)
            + micros
        )
    elif isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        number = column.cast("bigint")
    elif isinstance(data_type, (T.FloatType, T.DoubleType, T.DecimalType)):
        return F.coalesce(column.cast("double"), F.lit(float("inf")))
    elif isinstance(data_type, T.StringType):
        # The first seven bytes, as one number.
        number = F.conv(F.rpad(F.hex(F.substring(column.cast("binary"), 1, 7)), 14, "0"), 16, 10).cast("bigint")
    else:
        raise TypeError(f"cannot order by {data_type.simpleString()}")
    return F.coalesce(number, F.lit(9223372036854775807))
