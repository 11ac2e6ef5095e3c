"""Duplicate removal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelake.model import quoted


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Whole-row DISTINCT; NULL equals NULL. Copies collapse before the shuffle."""
    return df.dropDuplicates()


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The first row of each key in the given order.

    An aggregate rather than a ranking window: rows of a hot key are reduced on
    the map side instead of being sorted in one task. ``order_by`` must be a total
    order within a key for the result to be repeatable.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates()
    picked = df.groupBy(*[quoted(k) for k in keys]).agg(
        F.min_by(F.struct(*[quoted(c) for c in rest]), F.struct(*[quoted(c) for c in order_by])).alias("__first")
    )
    return picked.select(
        *[quoted(c) if c in keys else F.col("__first").getField(c).alias(c) for c in df.columns]
    )
