"""Merged text columns to a table-ready frame."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from ratelake.functions.parsing import is_floating, nan_to_null, parse_date_or_fail, parse_decimal
from ratelake.model import DATE_COLUMN, DEFAULT_DATA_SOURCE, quoted, value_columns
from ratelake.operators.audit import audit_columns
from ratelake.operators.fill import forward_fill
from ratelake.operators.ordering import ROWS_PER_RANGE


def type_columns(df: DataFrame, number_format: str = "plain") -> DataFrame:
    """Date text to dates (bad text fails), value text to doubles (bad text is NULL)."""
    typed = {
        c: parse_decimal(quoted(c), number_format)
        for c in value_columns(df)
        if isinstance(df.schema[c].dataType, T.StringType)
    }
    typed |= {c: nan_to_null(quoted(c)) for c in value_columns(df) if is_floating(df.schema[c].dataType)}
    if DATE_COLUMN in df.columns and isinstance(df.schema[DATE_COLUMN].dataType, T.StringType):
        typed[DATE_COLUMN] = parse_date_or_fail(quoted(DATE_COLUMN))
    return df.withColumns(typed) if typed else df


def prepare(
    df: DataFrame,
    ingestion_timestamp: datetime | Column,
    data_source: str = DEFAULT_DATA_SOURCE,
    metadata: Mapping[str, Any] | None = None,
    number_format: str = "plain",
    seed: DataFrame | None = None,
    distinct_dates: bool = False,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Type the columns, carry values across gaps, stamp the rows."""
    return (
        df.transform(type_columns, number_format)
        .transform(forward_fill, rows_per_range=rows_per_range, seed=seed, distinct_order=distinct_dates)
        .transform(audit_columns, ingestion_timestamp, data_source, metadata)
    )
