"""Data model: the series catalogue, column names and the canonical table schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names and defaults that results must carry unchanged.
DATE_COLUMN = "Fecha"
VALUE_FIELD = "Valor"
TIMESTAMP_COLUMN = "ingestion_timestamp"
SOURCE_COLUMN = "data_source"
DEFAULT_DATA_SOURCE = "CMF_Chile_API"
NON_VALUE_COLUMNS = (DATE_COLUMN, TIMESTAMP_COLUMN, SOURCE_COLUMN)


@dataclass(frozen=True)
class SeriesSpec:
    """One rate series: user-facing name, name at the source, column in the table."""

    name: str
    api_name: str
    column: str


DEFAULT_SERIES = (
    SeriesSpec("usd", "dolar", "usdclp_obs"),
    SeriesSpec("eur", "euro", "eurclp_obs"),
    SeriesSpec("uf", "uf", "ufclp"),
)

RATE_SCHEMA = T.StructType(
    [
        T.StructField(DATE_COLUMN, T.DateType(), False),
        T.StructField("usdclp_obs", T.DoubleType()),
        T.StructField("eurclp_obs", T.DoubleType()),
        T.StructField("ufclp", T.DoubleType()),
        T.StructField(TIMESTAMP_COLUMN, T.TimestampType(), False),
        T.StructField(SOURCE_COLUMN, T.StringType()),
    ]
)


def catalogue(mapping: Mapping[str, Mapping[str, str]] | None = None) -> dict[str, SeriesSpec]:
    """The known series by name; ``mapping`` replaces the built-in list."""
    if mapping is None:
        return {s.name: s for s in DEFAULT_SERIES}
    return {name: SeriesSpec(name, m["api"], m["column"]) for name, m in mapping.items()}


def find_series(name: str, known: Mapping[str, SeriesSpec] | None = None) -> SeriesSpec:
    known = catalogue() if known is None else known
    if name not in known:
        raise ValueError(f"Invalid currency type: {name}")
    return known[name]


def value_columns(df: DataFrame, exclude: Sequence[str] = NON_VALUE_COLUMNS) -> list[str]:
    """Every column that is neither the date nor an audit column."""
    return [c for c in df.columns if c not in exclude]


def quoted(name: str) -> Column:
    """A column reference that survives dots and blanks in the name."""
    return F.col("`" + name.replace("`", "``") + "`")


def require_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fail the job on a NULL in a required column.

    Spark does not enforce NOT NULL on file tables, so the check rides along in
    the plan: no extra pass, and the write cannot commit past it.
    """
    checked = {
        c: F.coalesce(quoted(c), F.raise_error(F.lit(f"NULL in required column {c}")).cast(df.schema[c].dataType))
        for c in columns
    }
    return df.withColumns(checked) if checked else df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns in table order with table types; unknown or missing columns are errors."""
    unknown = [c for c in df.columns if c not in schema.names]
    missing = [c for c in schema.names if c not in df.columns]
    if unknown or missing:
        raise ValueError(f"schema mismatch: unknown columns {unknown}, missing columns {missing}")
    wrong = [
        f"{f.name}: {df.schema[f.name].dataType.simpleString()} is not {f.dataType.simpleString()}"
        for f in schema
        if not _assignable(df.schema[f.name].dataType, f.dataType)
    ]
    if wrong:
        raise ValueError("schema mismatch: " + "; ".join(wrong))
    return df.select([quoted(f.name).cast(f.dataType).alias(f.name) for f in schema])


def _assignable(have: T.DataType, want: T.DataType) -> bool:
    if have == want or isinstance(have, T.NullType):
        return True
    if isinstance(have, T.NumericType) and isinstance(want, T.NumericType):
        return isinstance(want, (T.DoubleType, T.DecimalType)) or _integral_width(have) <= _integral_width(want)
    dates = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return isinstance(have, dates) and isinstance(want, dates[1:])


def _integral_width(t: T.DataType) -> int:
    order = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
    return order.index(type(t)) if type(t) in order else len(order)
