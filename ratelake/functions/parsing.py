"""Text to typed values, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelake.model import quoted

# The accepted spellings.
DATE_PATTERN = r"^\d{4}-\d{1,2}-\d{1,2}$"
MISSING_DATE_TEXTS = ("", "NaT", "nat", "NAT", "nan", "NaN", "NAN")
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
INFINITY_PATTERN = r"(?i)^\s*[+-]?inf(inity)?\s*$"


def parse_date(text: Column) -> Column:
    """Strict year-month-day text to a date; anything else is NULL.

    The pattern guard is needed because a cast alone also takes ``2024``,
    leading blanks and a time of day.
    """
    return F.when(text.rlike(DATE_PATTERN), text.try_cast("date"))


def is_bad_date(text: Column) -> Column:
    """True for text that is neither a date nor one of the spellings of "missing"."""
    return F.coalesce(
        text.isNotNull() & ~text.isin(*MISSING_DATE_TEXTS) & parse_date(text).isNull(), F.lit(False)
    )


def parse_date_or_fail(text: Column) -> Column:
    """Like :func:`parse_date`, but bad text fails the job."""
    message = F.concat(F.lit("not a yyyy-mm-dd date: "), text)
    return F.when(is_bad_date(text), F.raise_error(message).cast("date")).otherwise(parse_date(text))


def parse_decimal(text: Column, number_format: str = "plain") -> Column:
    """Decimal-comma text to a double; text that is no number is NULL.

    ``plain`` turns every comma into a dot, so a thousands dot makes the value
    NULL. ``es`` drops the thousands dots first. The guard keeps out spellings
    that only the cast would take, such as a trailing ``d`` or ``nan``.
    """
    if number_format == "es":
        text = F.replace(text, F.lit("."), F.lit(""))
    elif number_format != "plain":
        raise ValueError(f"unknown number format: {number_format}")
    dotted = F.replace(text, F.lit(","), F.lit("."))
    return F.when(dotted.rlike(NUMBER_PATTERN) | dotted.rlike(INFINITY_PATTERN), dotted.try_cast("double"))


def is_coerced(text: Column, number_format: str = "plain") -> Column:
    """True where text was present but became NULL: the count to watch for locale trouble."""
    return text.isNotNull() & (F.trim(text) != "") & parse_decimal(text, number_format).isNull()


def is_floating(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.FloatType, T.DoubleType))


def nan_to_null(value: Column) -> Column:
    """NaN means "missing" here; one spelling of it is enough."""
    return F.when(~F.isnan(value), value)


def observed(value: Column) -> Column:
    """A number of any type, NULL where it is NaN."""
    return F.when(~F.isnan(value.cast("double")), value)


def observed_in(df: DataFrame, column: str) -> Column:
    """The column, NULL where it is NaN; other types than floating ones pass as they are."""
    value = quoted(column)
    return nan_to_null(value) if is_floating(df.schema[column].dataType) else value
