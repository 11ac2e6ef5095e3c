"""Order-dependent work without a single-task window.

A window without PARTITION BY runs in one task, and one with PARTITION BY runs a
hot key in one task. Both are avoided by cutting the rows in their order into ranges
of equal row count: each range is one window partition, and what a range must know
about its predecessors (a running total, a last value) is pre-aggregated to one row
per range and put in front of it.

Rows are range-partitioned by the series, all order columns, a row hash and a salt, so
neither a hot value, nor texts that begin alike, nor equal rows keep a task from being
split. Sorted partitions are then cut by position, which makes every range but a
partition's last exactly as long as asked for, however many rows there are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelake.functions.dates import order_number
from ratelake.model import quoted
from ratelake.session import materialize

KEY = "__order"
TIE = "__tie"
RANGE = "__range"
LEAD_IN = "__lead_in"
# Order columns that their number does not replace, from the first to the last.
BY = "__by"
# The sorted partition that a range was cut from.
GROUP = "__group"

# A range of this many rows is comfortable for one task.
ROWS_PER_RANGE = 1_000_000
# Rows that one task sorts (and may spill) before they are cut into ranges, and the most
# such tasks; beyond that tasks grow, ranges do not.
ROWS_PER_SORT = 4_000_000
MOST_SORTS = 20_000
# Ranges are numbered partition by partition; a partition has fewer than this.
NUMBERS = 1 << 33


def order_names(order_by: str | Sequence[str]) -> list[str]:
    return [order_by] if isinstance(order_by, str) else list(order_by)


def kept_order(df: DataFrame, order_by: str | Sequence[str]) -> list[str]:
    """The order columns that rows of a range must be compared by; none if one number says it all."""
    names = order_names(order_by)
    exact = len(names) == 1 and not isinstance(df.schema[names[0]].dataType, (T.DecimalType, T.StringType))
    return [] if exact else names


def with_ranges(
    df: DataFrame,
    order_by: str | Sequence[str],
    rows_per_range: int = ROWS_PER_RANGE,
    distinct_order: bool = False,
    partition_by: Sequence[str] = (),
) -> tuple[DataFrame, Column | None]:
    """Add the sort number, a tie breaker and the range each row falls in.

    The second result is true for rows that are cut, or None if nothing is: an
    input, or a series, of at most ``rows_per_range`` rows stays whole, as range 0.

    Ranges follow each other in one total order of the rows: by all order columns, then
    a hash of the row; rows that are equal in every column are interchangeable and are
    spread by a salt. ``distinct_order`` states that a series has no ties, which saves the
    hashing; it is for a single order column only, and rows tied in spite of it are in no
    defined order. With several order columns, decimals or texts, rows are compared by the
    columns themselves; the first one's number only comes first.

    One pass counts the rows (or those of each series). Rows to be cut are sorted by
    Spark's range partitioning, which samples them first, and written once to the shared
    folder; everything later reads that copy. ``df`` is read for each of these, so write a
    costly input out first. Nothing but a row count reaches the driver.
    """
    lead, kept = order_names(order_by)[0], kept_order(df, order_by)
    key = order_number(quoted(lead), df.schema[lead].dataType)
    tie = F.lit(0).cast("bigint") if distinct_order and not kept else F.xxhash64(*[quoted(c) for c in df.columns])
    keyed = df.withColumns({KEY: key, TIE: tie} | {f"{BY}{i}": quoted(c) for i, c in enumerate(kept)})
    whole = keyed.withColumn(RANGE, F.lit(0).cast("bigint"))
    if not partition_by:
        rows = df.count()
        return (_cut(keyed, rows, rows_per_range, (), len(kept)), F.lit(True)) if rows > rows_per_range else (whole, None)
    # Ordinary series need no cutting. Series are told apart by hash: a collision only cuts a short one as well.
    series = F.xxhash64(*[quoted(c) for c in partition_by])
    sizes = df.groupBy(series.alias("__series")).agg(F.count("*").alias("__rows")).filter(F.col("__rows") > rows_per_range)
    # At most one row per rows_per_range rows of the input.
    sizes = materialize(sizes, "long-series")
    rows = sizes.agg(F.sum("__rows")).first()[0]
    if not rows:
        return whole, None
    long_ones = sizes.select("__series")
    marked = keyed.withColumn("__series", series)
    long = marked.join(long_ones, "__series", "left_semi").drop("__series")
    short = marked.join(long_ones, "__series", "left_anti").drop("__series")
    cut = _cut(long, rows, rows_per_range, partition_by, len(kept))
    return cut.unionByName(short.withColumn(RANGE, F.lit(0).cast("bigint"))), F.col(RANGE) > 0


def _cut(keyed: DataFrame, rows: int, rows_per_range: int, partition_by: Sequence[str], kept: int) -> DataFrame:
    """The rows in order, cut by position; a written copy."""
    width = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    sorts = max(-(-rows // ROWS_PER_SORT), min(width, -(-rows // rows_per_range)))
    order = [
        *[quoted(c).asc_nulls_last() for c in partition_by],
        F.col(KEY),
        *[F.col(f"{BY}{i}").asc_nulls_last() for i in range(kept)],
        F.col(TIE),
        F.col("__salt"),
    ]
    sorted_rows = (
        keyed.withColumn("__salt", F.rand(11))
        .repartitionByRange(min(sorts, MOST_SORTS), *order)
        .sortWithinPartitions(*order)
        # Partition in the upper bits, place in the partition in the 33 lower ones.
        .withColumn("__place", F.monotonically_increasing_id())
    )
    place = F.col("__place").bitwiseAND(F.lit(NUMBERS - 1))
    number = F.floor(F.col("__place") / F.lit(NUMBERS)) * F.lit(NUMBERS) + F.floor(place / F.lit(rows_per_range)) + 1
    return materialize(sorted_rows.withColumn(RANGE, number.cast("bigint")).drop("__salt", "__place"), "ordered")


def range_window(partition_by: Sequence[str], kept: int = 0):
    """Rows of one range in order, its lead-in row first; ``kept`` is the number of kept order columns."""
    return Window.partitionBy(*[quoted(c) for c in partition_by], F.col(RANGE)).orderBy(
        F.col(LEAD_IN).desc(), F.col(KEY), *[F.col(f"{BY}{i}").asc_nulls_last() for i in range(kept)], F.col(TIE)
    )


def before_ranges(per_range: DataFrame, partition_by: Sequence[str], columns: Sequence[str], total: bool = False) -> DataFrame:
    """What is known before each range, from one row per range: last values, or with ``total`` running totals.

    Done on two levels, so that no task scans all ranges: over the groups of ranges that
    were sorted together, and inside each group.
    """
    keys = list(partition_by)
    # The row per range is used twice.
    per_range = materialize(per_range.withColumn(GROUP, F.floor(F.col(RANGE) / F.lit(NUMBERS))), "per-range")

    def fold(name: str, window) -> Column:
        if total:
            return F.coalesce(F.sum(quoted(name)).over(window), F.lit(0))
        return F.last(quoted(name), ignorenulls=True).over(window)

    def of_group(name: str) -> Column:
        held = F.when(quoted(name).isNotNull(), F.col(RANGE))
        return F.sum(quoted(name)) if total else F.max_by(quoted(name), held)

    def earlier(by: Sequence[str], order: str):
        return Window.partitionBy(*[quoted(c) for c in by]).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)

    groups = per_range.groupBy(*[quoted(c) for c in keys], GROUP).agg(*[of_group(c).alias(c) for c in columns])
    upto_group = groups.select(
        F.col(GROUP).alias("__of"),
        *[quoted(c).alias(f"__key{i}") for i, c in enumerate(keys)],
        *[fold(c, earlier(keys, GROUP)).alias(f"__upto{i}") for i, c in enumerate(columns)],
    )
    inside = per_range.select(
        *[quoted(c) for c in keys], RANGE, GROUP, *[fold(c, earlier([*keys, GROUP], RANGE)).alias(c) for c in columns]
    )
    same = F.col(GROUP) == F.col("__of")
    for i, c in enumerate(keys):
        same &= quoted(c).eqNullSafe(F.col(f"__key{i}"))

    def both(i: int, name: str) -> Column:
        upto = F.col(f"__upto{i}")
        return quoted(name) + upto if total else F.coalesce(quoted(name), upto)

    return inside.join(upto_group, same).select(*[quoted(c) for c in keys], RANGE, *[both(i, c).alias(c) for i, c in enumerate(columns)])


def row_numbers(
    df: DataFrame,
    order_by: str | Sequence[str],
    partition_by: Sequence[str] = (),
    name: str = "row_number",
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Dense row numbers from 1, over all rows or per series, range by range."""
    keys = list(partition_by)
    ranged, cut_rows = with_ranges(df, order_by, rows_per_range, partition_by=keys)
    rows = ranged.withColumns({LEAD_IN: F.lit(False), "__step": F.lit(1).cast("bigint")})
    if cut_rows is not None:
        sizes = ranged.filter(cut_rows).groupBy(*keys, RANGE).agg(F.count("*").alias("__step"))
        offsets = before_ranges(sizes, keys, ["__step"], total=True)
        rows = rows.unionByName(offsets.withColumn(LEAD_IN, F.lit(True)), allowMissingColumns=True)
    running = range_window(keys, len(kept_order(df, order_by))).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        rows.withColumn(name, F.sum("__step").over(running))
        .filter(~F.col(LEAD_IN))
        .select(*[quoted(c) for c in df.columns], name)
    )


def over_previous_rows(
    df: DataFrame,
    order_by: str | Sequence[str],
    columns: dict,
    reach: int,
    partition_by: Sequence[str] = (),
    chunk_rows: int = 100_000,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Add window columns that look back at most ``reach`` rows.

    ``columns`` maps a name to a function from an ordered window to a Column.
    Rows are numbered, cut into chunks of equal size, and the last ``reach`` rows
    of a chunk are also given to the next one. No chunk outgrows a task, however
    long the series is.
    """
    size = max(chunk_rows, reach)
    numbered = row_numbers(df, order_by, partition_by, "__n", rows_per_range)
    home = F.floor((F.col("__n") - 1) / F.lit(size)).cast("bigint")
    lends = F.pmod(F.col("__n") - 1, F.lit(size)) >= F.lit(size - reach)
    chunked = numbered.withColumn("__home", home).withColumn(
        "__chunk", F.explode(F.when(lends, F.array(home, home + 1)).otherwise(F.array(home)))
    )
    window = Window.partitionBy(*[quoted(c) for c in partition_by], F.col("__chunk")).orderBy("__n")
    return (
        chunked.withColumns({name: build(window) for name, build in columns.items()})
        .filter(F.col("__chunk") == F.col("__home"))
        .drop("__n", "__home", "__chunk")
    )
