"""Model features from a dated table.

Planned parts of the model: where the description leaves a choice open, the
choice made here is stated.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelake.functions.parsing import observed, observed_in
from ratelake.model import DATE_COLUMN, quoted
from ratelake.operators.merge import sorted_positions
from ratelake.operators.ordering import ROWS_PER_RANGE, over_previous_rows
from ratelake.operators.quantiles import exact_quantiles

# Lags, windows and the columns they apply to.
LAGS = (1, 7, 30)
WINDOWS = (7, 30)
FEATURE_COLUMNS = ("usdclp_obs", "eurclp_obs")


def date_parts(df: DataFrame, column: str = DATE_COLUMN) -> DataFrame:
    """Year, month, day, and day of week with Monday as 0."""
    day = quoted(column)
    return df.withColumns(
        {"year": F.year(day), "month": F.month(day), "day": F.day(day), "dayofweek": F.weekday(day)}
    )


def lags(
    df: DataFrame,
    columns: Sequence[str] = FEATURE_COLUMNS,
    steps: Sequence[int] = LAGS,
    order_by: str | Sequence[str] = DATE_COLUMN,
    partition_by: Sequence[str] = (),
    chunk_rows: int = 100_000,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """``<column>_lag_<n>``: the value n rows (not calendar days) earlier."""
    built = _lag_columns(columns, steps)
    return over_previous_rows(df, order_by, built, max(steps), partition_by, chunk_rows, rows_per_range)


def rolling(
    df: DataFrame,
    columns: Sequence[str] = FEATURE_COLUMNS,
    windows: Sequence[int] = WINDOWS,
    order_by: str | Sequence[str] = DATE_COLUMN,
    partition_by: Sequence[str] = (),
    chunk_rows: int = 100_000,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """``<column>_roll_mean_<n>`` and ``_roll_std_<n>`` over the last n rows.

    NULL until n values are there, NaN being none; the deviation is the sample one.
    """
    built = _rolling_columns(columns, windows)
    return over_previous_rows(df, order_by, built, max(windows) - 1, partition_by, chunk_rows, rows_per_range)


def engineer(
    df: DataFrame,
    columns: Sequence[str] = FEATURE_COLUMNS,
    steps: Sequence[int] = LAGS,
    windows: Sequence[int] = WINDOWS,
    order_by: str | Sequence[str] = DATE_COLUMN,
    partition_by: Sequence[str] = (),
    chunk_rows: int = 100_000,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Date parts, lags and rolling statistics; the rows are ordered once for all of them."""
    built = _lag_columns(columns, steps) | _rolling_columns(columns, windows)
    reach = max(*steps, *(n - 1 for n in windows))
    looked = over_previous_rows(df, order_by, built, reach, partition_by, chunk_rows, rows_per_range)
    return date_parts(looked, order_by if isinstance(order_by, str) else order_by[0])


def _lag_columns(columns: Sequence[str], steps: Sequence[int]) -> dict:
    return {f"{c}_lag_{n}": (lambda w, c=c, n=n: F.lag(quoted(c), n).over(w)) for c in columns for n in steps}


def _rolling_columns(columns: Sequence[str], windows: Sequence[int]) -> dict:
    def full(aggregate, column: str, n: int):
        def build(window) -> Column:
            frame = window.rowsBetween(-(n - 1), 0)
            value = observed(quoted(column))
            return F.when(F.count(value).over(frame) == n, aggregate(value).over(frame))

        return build

    built = {}
    for c in columns:
        for n in windows:
            built[f"{c}_roll_mean_{n}"] = full(F.avg, c, n)
            built[f"{c}_roll_std_{n}"] = full(F.stddev_samp, c, n)
    return built


def scale(df: DataFrame, columns: Sequence[str], method: str = "standard") -> DataFrame:
    """Standard, min-max or robust scaling of whole columns; a constant column becomes 0, NaN NULL."""
    df = df.withColumns({c: observed_in(df, c) for c in columns})
    if method == "robust":
        quartiles = exact_quantiles(df, {c: [0.25, 0.5, 0.75] for c in columns})
        centre = {c: F.lit(q[1]) for c, q in quartiles.items()}
        width = {c: F.lit(None if q[0] is None else q[2] - q[0]).cast("double") for c, q in quartiles.items()}
    elif method in ("standard", "minmax"):
        first, second = (F.avg, F.stddev_pop) if method == "standard" else (F.min, F.max)
        parts = [F.struct(first(quoted(c)).alias("a"), second(quoted(c)).alias("b")).alias(c) for c in columns]
        stats = df.select(F.struct(*parts)).scalar()
        centre = {c: stats.getField(c).getField("a") for c in columns}
        spread = {c: stats.getField(c).getField("b") for c in columns}
        width = spread if method == "standard" else {c: spread[c] - centre[c] for c in columns}
    else:
        raise ValueError(f"unknown scaling method: {method}")
    return df.withColumns(
        {c: F.when(width[c] == 0, F.lit(0.0)).otherwise((quoted(c) - centre[c]) / width[c]) for c in columns}
    )


def learn_categories(df: DataFrame, columns: Sequence[str], most: int = 1000) -> dict[str, list[str]]:
    """Sorted distinct values per column; one output column each, hence the limit.

    The limit is checked, not applied: too many values are an error.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), quoted(c).alias("value")) for c in columns]))
    distinct = df.select(pairs.alias("p")).select("p.*").filter(F.col("value").isNotNull()).distinct()
    crowded = [r["column"] for r in distinct.groupBy("column").count().filter(F.col("count") > most).collect()]
    if crowded:
        raise ValueError(f"more than {most} categories in {sorted(crowded)}")
    rows = distinct.collect()
    return {c: sorted(r["value"] for r in rows if r["column"] == c) for c in columns}


def one_hot(df: DataFrame, categories: Mapping[str, Sequence[str]]) -> DataFrame:
    """``<column>_<value>`` of 0 or 1; an unknown or missing value gives only zeros."""
    return df.withColumns(
        {
            f"{c}_{v}": F.when(quoted(c) == F.lit(v), F.lit(1)).otherwise(F.lit(0))
            for c, values in categories.items()
            for v in values
        }
    )


def learn_dictionary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, value, index)``: the values of each column with their places in the vector.

    Places run through the columns in the given order, and within one through its values in
    code-point order. The table may have any number of rows: values are made distinct
    before the shuffle and numbered by a distributed sort.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("place"), quoted(c).cast("string").alias("value")) for i, c in enumerate(columns)]))
    distinct = df.select(pairs.alias("entry")).filter(F.col("entry.value").isNotNull()).distinct()
    names = F.array(*[F.lit(c) for c in columns])
    return sorted_positions(distinct, "entry", "index").select(
        F.get(names, F.col("entry.place")).alias("column"), F.col("entry.value").alias("value"), "index"
    )


def one_hot_sparse(df: DataFrame, dictionary: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` plus ``indices`` and ``values``, the places of a row's vector that are not 0, in order.

    An unknown or missing value sets nothing. Each column is one left join with its part of
    the dictionary; Spark sends small parts to all tasks and splits hot values otherwise.
    Keep the dictionary as a table: it is what later data are encoded by, and its row count
    is the length of the vectors.
    """
    found = df
    for i, c in enumerate(columns):
        part = dictionary.filter(F.col("column") == c).select(F.col("value").alias(f"__value{i}"), F.col("index").alias(f"__index{i}"))
        found = found.join(part, quoted(c).cast("string") == F.col(f"__value{i}"), "left")
    indices = F.sort_array(F.array_compact(F.array(*[F.col(f"__index{i}") for i in range(len(columns))])))
    ready = found.withColumn("indices", indices).withColumn("values", F.array_repeat(F.lit(1.0), F.size("indices")))
    return ready.select(*[quoted(c) for c in df.columns], "indices", "values")


def select_features(df: DataFrame, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the named features; missing ones are an error that lists them."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"Missing features: {missing}")
    return df.select(*[quoted(c) for c in [*keep, *names]])
