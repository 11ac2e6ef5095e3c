"""Rows close in several columns, close on disk.

Sorting by (a, b) lets a filter on ``a`` skip row groups, but not one on ``b``. Here each
column is cut into ranges of about equal row counts, and the bits of the range numbers are
interleaved: rows that are near in every column get near places, so a filter on any of them
skips files and row groups by their minimum and maximum.

Only the order of rows depends on this, never what is stored.
"""

from __future__ import annotations

from collections.abc import Sequence
from os.path import commonprefix

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelake.model import quoted

# Equal slots between a column's least and greatest value, counted to find its ranges.
SLOTS = 4096
# Ranges of a column: 2 ** BITS. The bits of at most seven columns fit into a place.
BITS = 8
MOST_COLUMNS = 7
# Leading bytes of a text that take part in its number.
TEXT_BYTES = 6


def place(df: DataFrame, columns: Sequence[str]) -> Column:
    """A whole number per row that keeps rows near in all ``columns`` near each other.

    Two aggregates over ``df`` find the columns' bounds and the rows per slot; the driver
    gets ``SLOTS`` counts per column at most, whatever the size of the table. NULL, NaN and
    infinities come first. Texts take part with their leading bytes after those all of them share.
    """
    if not 1 < len(columns) <= MOST_COLUMNS:
        raise ValueError(f"two to {MOST_COLUMNS} columns can be interleaved, not {len(columns)}")
    slots = _slots(df, columns)
    counted = df.select(F.posexplode(F.array(*slots)).alias("c", "slot")).groupBy("c", "slot").count()
    weights: list[dict[int, int]] = [{} for _ in columns]
    for r in counted.collect():
        weights[r["c"]][r["slot"]] = r["count"]
    ranges = [F.element_at(F.lit(_ranges(w)), s + 1) for w, s in zip(weights, slots)]
    return interleaved(ranges, BITS)


def interleaved(numbers: Sequence[Column], bits: int) -> Column:
    """The lowest ``bits`` bits of each number in turn, the highest first."""
    result = F.lit(0).cast("bigint")
    width = len(numbers)
    for i, number in enumerate(numbers):
        for b in range(bits):
            bit = F.shiftright(number.cast("bigint"), b).bitwiseAND(F.lit(1).cast("bigint"))
            result = result.bitwiseOR(F.shiftleft(bit, b * width + width - 1 - i))
    return result


def _ranges(weight: dict[int, int]) -> list[int]:
    """The range of each slot, so that ranges hold about equally many rows."""
    total, before, found = max(sum(weight.values()), 1), 0, []
    for slot in range(SLOTS + 1):
        found.append((before << BITS) // total if before < total else (1 << BITS) - 1)
        before += weight.get(slot, 0)
    return found


def _slots(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Slot 0 for what has no place, 1 to ``SLOTS`` from the least value to the greatest."""
    kinds = [df.schema[c].dataType for c in columns]
    values = [quoted(c) if isinstance(k, T.StringType) else _number(quoted(c), k) for c, k in zip(columns, kinds)]
    ends = df.agg(*[f(v) for v in values for f in (F.min, F.max)]).first()
    slots = []
    for i, (value, kind) in enumerate(zip(values, kinds)):
        low, high = ends[2 * i], ends[2 * i + 1]
        if isinstance(kind, T.StringType) and low is not None:
            least, most = low.encode(), high.encode()
            shared = len(commonprefix([least, most]))
            value = _text_number(value, shared)
            low, high = (float(int.from_bytes(t[shared:][:TEXT_BYTES].ljust(TEXT_BYTES, b"\0"))) for t in (least, most))
        if low is None or low == high:
            slots.append(F.when(value.isNull(), 0).otherwise(1))
            continue
        # Halved before they are subtracted: two doubles can be further apart than a double reaches.
        share = (value / 2 - F.lit(low / 2)) / F.lit(high / 2 - low / 2)
        slot = F.least(F.floor(share * SLOTS) + 1, F.lit(SLOTS)).cast("int")
        slots.append(F.coalesce(slot, F.lit(0)))
    return slots


def _number(value: Column, kind: T.DataType) -> Column:
    """The value as a finite double; NULL, NaN and infinities have no place."""
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp")).cast("double")
    if not isinstance(kind, (T.NumericType, T.BooleanType)):
        raise ValueError(f"rows cannot be clustered by a {kind.simpleString()} column")
    number = value.cast("double")
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def _text_number(value: Column, shared: int) -> Column:
    digits = F.hex(F.substring(value.cast("binary"), shared + 1, TEXT_BYTES))
    return F.conv(F.rpad(digits, 2 * TEXT_BYTES, "0"), 16, 10).cast("double")
