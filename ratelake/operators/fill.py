"""Carry the last known value across gaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratelake.functions.parsing import observed_in
from ratelake.model import DATE_COLUMN, quoted, value_columns
from ratelake.operators.ordering import (
    BY,
    KEY,
    LEAD_IN,
    RANGE,
    ROWS_PER_RANGE,
    TIE,
    before_ranges,
    kept_order,
    order_names,
    range_window,
    with_ranges,
)


def forward_fill(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    order_by: str | Sequence[str] = DATE_COLUMN,
    partition_by: Sequence[str] = (),
    rows_per_range: int = ROWS_PER_RANGE,
    seed: DataFrame | None = None,
    distinct_order: bool = False,
) -> DataFrame:
    """Replace each NULL or NaN by the latest earlier value of its column.

    Leading NULLs stay NULL, and no calendar rows are added. Each range of the
    order column is filled on its own, led by one row with the values carried in
    from earlier ranges. ``seed`` is a one-row DataFrame with values known from
    before the first row. ``distinct_order`` states that no two rows of a series
    share an order value, which lets the per-range step aggregate by hash.
    """
    keys = list(partition_by)
    if columns is None:
        columns = [c for c in value_columns(df) if c not in order_names(order_by) and c not in keys]
    df = df.withColumns({c: observed_in(df, c) for c in columns}) if columns else df
    ranged, cut_rows = with_ranges(df, order_by, rows_per_range, distinct_order, keys)
    rows, kept = ranged.withColumn(LEAD_IN, F.lit(False)), len(kept_order(df, order_by))
    if cut_rows is not None and columns:
        latest = F.col(KEY) if distinct_order and not kept else F.struct(KEY, *[f"{BY}{i}" for i in range(kept)], TIE)
        last_known = {c: F.max_by(quoted(c), F.when(quoted(c).isNotNull(), latest)) for c in columns}
        per_range = ranged.filter(cut_rows).groupBy(*keys, RANGE).agg(*[v.alias(c) for c, v in last_known.items()])
        carried = before_ranges(per_range, keys, columns)
        rows = rows.unionByName(carried.withColumn(LEAD_IN, F.lit(True)), allowMissingColumns=True)
    so_far = range_window(keys, kept).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = rows.withColumns({c: F.last(quoted(c), ignorenulls=True).over(so_far) for c in columns})
    result = filled.filter(~F.col(LEAD_IN)).select(*[quoted(c) for c in df.columns])
    if seed is None:
        return result
    known = seed.select(F.struct(*[quoted(c) for c in columns]).alias("known")).scalar()
    return result.withColumns({c: F.coalesce(quoted(c), known.getField(c)) for c in columns})
