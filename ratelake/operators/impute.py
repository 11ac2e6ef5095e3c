"""Replace missing values by a statistic of their column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelake.functions.parsing import observed_in
from ratelake.operators.quantiles import exact_quantiles, modes


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def present_counts(df: DataFrame, columns: Sequence[str]) -> tuple[int, dict[str, int]]:
    """Rows, and values per column (NaN is missing): one scan for all of them."""
    counted = df.agg(
        F.count("*").alias("rows"), *[F.count(observed_in(df, c)).alias(f"c{i}") for i, c in enumerate(columns)]
    ).first()
    return counted["rows"], {c: counted[f"c{i}"] for i, c in enumerate(columns)}


def fill_values(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    filled = {
        c: F.coalesce(observed_in(df, c), F.lit(v).cast(_fill_type(df.schema[c].dataType)))
        for c, v in values.items()
        if v is not None
    }
    return df.withColumns(filled) if filled else df


def _fill_type(t: T.DataType) -> T.DataType:
    # A median or mean of whole numbers need not be whole.
    return T.DoubleType() if isinstance(t, T.IntegralType) else t


def impute_median_mode(df: DataFrame) -> DataFrame:
    """Exact median for numeric columns, mode for text columns.

    Columns without NULLs keep their type and cost nothing further; a column with
    no value at all stays NULL.
    """
    numeric, text = numeric_columns(df), text_columns(df)
    rows, present = present_counts(df, numeric + text)
    gaps = {c for c, n in present.items() if n < rows}
    wanted = {c: [0.5] for c in numeric if c in gaps}
    values: dict[str, Any] = {c: q[0] for c, q in exact_quantiles(df, wanted, counts=present).items()}
    texts = [c for c in text if c in gaps]
    if texts:
        # One row per column: bounded by the width of the schema.
        values |= {r["column"]: r["mode"] for r in modes(df, texts).collect()}
    return fill_values(df, values)


def impute_mean(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The column mean, as one scalar subquery over all columns."""
    columns = list(columns) if columns is not None else numeric_columns(df)
    means = df.select(F.struct(*[F.avg(observed_in(df, c)).alias(c) for c in columns])).scalar()
    return df.withColumns({c: F.coalesce(observed_in(df, c), means.getField(c)) for c in columns})
