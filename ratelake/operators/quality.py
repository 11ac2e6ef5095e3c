"""Data-quality checks. Each is one aggregation over the table; NaN counts as missing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelake.functions.parsing import observed, observed_in
from ratelake.model import quoted
from ratelake.operators.quantiles import exact_quantiles

# Thresholds.
MISSING_THRESHOLD = 0.1
OUTLIER_THRESHOLD = 3.0


def missing_share(df: DataFrame, columns: Sequence[str], threshold: float = MISSING_THRESHOLD) -> DataFrame:
    """Per column: share of NULLs, and whether it exceeds the threshold."""
    counted = df.agg(F.count("*").alias("__rows"), *[F.count(observed_in(df, c)).alias(c) for c in columns])
    share = (F.col("__rows") - F.col("c.present")) / F.col("__rows")
    listed = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column_name"), quoted(c).alias("present")) for c in columns])
    )
    return counted.select("__rows", listed.alias("c")).select(
        F.col("c.column_name").alias("column_name"),
        share.alias("missing_share"),
        (share > F.lit(threshold)).alias("too_many"),
    )


def iqr_fences(df: DataFrame, columns: Sequence[str], threshold: float = OUTLIER_THRESHOLD) -> dict[str, tuple]:
    """``q1 - t*iqr`` and ``q3 + t*iqr`` per column."""
    clean = df.select(*[observed_in(df, c).alias(c) for c in columns])
    quartiles = exact_quantiles(clean, {c: [0.25, 0.75] for c in columns})
    return {
        c: (q1 - threshold * (q3 - q1), q3 + threshold * (q3 - q1)) if q1 is not None else (None, None)
        for c, (q1, q3) in quartiles.items()
    }


def outside(column: str, fences: tuple) -> Column:
    low, high = (F.lit(v).cast("double") for v in fences)
    value = observed(quoted(column))
    return F.coalesce((value < low) | (value > high), F.lit(False))


def iqr_outliers(df: DataFrame, columns: Sequence[str], threshold: float = OUTLIER_THRESHOLD) -> DataFrame:
    """Per column: the fences and how many values lie outside."""
    fences = iqr_fences(df, columns, threshold)
    counted = df.agg(*[F.count_if(outside(c, fences[c])).alias(c) for c in columns])
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(fences[c][0]).cast("double").alias("low"),
                F.lit(fences[c][1]).cast("double").alias("high"),
                quoted(c).alias("outliers"),
            )
            for c in columns
        ]
    )
    return counted.select(F.inline(rows))


def range_and_freshness(
    df: DataFrame,
    bounds: Mapping[str, tuple[float, float]],
    date_column: str,
    now: datetime,
    max_age_days: int,
) -> DataFrame:
    """Values outside their allowed range, and whether the newest row is recent enough."""
    newest = F.max(quoted(date_column)).cast("date")
    today = F.lit(now.date())
    return df.agg(
        *[
            F.count_if((observed(quoted(c)) < F.lit(low)) | (observed(quoted(c)) > F.lit(high))).alias(f"{c}_out_of_range")
            for c, (low, high) in bounds.items()
        ],
        newest.alias("newest"),
        F.date_diff(today, newest).alias("age_days"),
        (F.date_diff(today, newest) <= F.lit(max_age_days)).alias("fresh"),
    )


def schema_differences(have: T.StructType, want: T.StructType) -> list[str]:
    """Missing, unexpected and differently typed columns."""
    found = {f.name: f.dataType for f in have}
    expected = {f.name: f.dataType for f in want}
    return (
        [f"missing {n}" for n in expected if n not in found]
        + [f"unexpected {n}" for n in found if n not in expected]
        + [
            f"{n} is {found[n].simpleString()}, not {t.simpleString()}"
            for n, t in expected.items()
            if n in found and found[n] != t
        ]
    )


def schema_report(df: DataFrame, want: T.StructType) -> DataFrame:
    """One row per column of either side: its types, what is wrong, and its values that are not missing.

    ``problem`` is ``missing``, ``unexpected``, ``type``, ``empty`` (rows, but no value) or NULL.
    A column that is there in name but never filled passes a check of names and types; the
    counts, one aggregate over the table, show it.
    """
    found = {f.name: f.dataType for f in df.schema}
    expected = {f.name: f.dataType for f in want}
    counted = df.agg(F.count("*").alias("__rows"), *[F.count(observed_in(df, c)).alias(f"{c}__n") for c in found])
    rows = []
    for name in [*expected, *(c for c in found if c not in expected)]:
        has, wants = found.get(name), expected.get(name)
        wrong = "missing" if has is None else "unexpected" if wants is None else "type" if has != wants else None
        present = F.lit(0).cast("bigint") if has is None else quoted(f"{name}__n")
        empty = F.when((present == 0) & (F.col("__rows") > 0), F.lit("empty"))
        rows.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(wants.simpleString() if wants else None).cast("string").alias("expected"),
                F.lit(has.simpleString() if has else None).cast("string").alias("found"),
                (F.lit(wrong) if wrong else empty).alias("problem"),
                present.alias("present"),
            )
        )
    return counted.select(F.inline(F.array(*rows)))
