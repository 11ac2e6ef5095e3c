"""Continuous ingestion: new landing files are upserted as they arrive.

A micro-batch may hold a few of the series only, and any part of their dates. So the
table keeps what was observed: a batch changes the columns it has observations for and
leaves the others alone. Gaps are filled when the table is read (:func:`filled`), which
gives the rows of a batch run over the same files.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ratelake.functions.parsing import parse_date
from ratelake.model import DATE_COLUMN, DEFAULT_DATA_SOURCE, TIMESTAMP_COLUMN, SeriesSpec, quoted
from ratelake.operators.audit import audit_columns
from ratelake.operators.fill import forward_fill
from ratelake.plans.prepare import type_columns
from ratelake.sinks.store import TableStore
from ratelake.sources.observations import CORRUPT, ROW_TAG, VALUE_FIELD, landing_reader

DEFECT = "defect"
BATCH = "batch"


def stream_landing(
    spark: SparkSession, root: str, files_per_batch: int | None = None, row_tag: str = ROW_TAG
) -> DataFrame:
    """Observations of newly landed files; ``defect`` names what is wrong with a record, else it is NULL."""
    reader = landing_reader(spark.readStream, row_tag)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    day = parse_date(quoted(DATE_COLUMN))
    defect = F.when(F.col(CORRUPT).isNotNull(), "malformed record").when(day.isNull(), "no valid date")
    raw = reader.load(root).withColumn(DEFECT, defect).withColumn("date_text", quoted(DATE_COLUMN))
    return raw.withColumn(DATE_COLUMN, day).select("series", "month", DATE_COLUMN, VALUE_FIELD, "date_text", DEFECT)


def upsert_stream(
    stream: DataFrame,
    store: TableStore,
    table: str,
    key: str,
    checkpoint: str,
    shape: Callable[[DataFrame], DataFrame] = lambda batch: batch,
    newer_by: str | Sequence[str] | None = None,
    available_now: bool = True,
    stage_batch: bool = False,
    presence: dict[str, str] | None = None,
    quarantine: str | None = None,
) -> StreamingQuery:
    """Start a query that merges every micro-batch into ``table``.

    ``shape`` turns a batch into table rows with at most one row per key. The
    last batch wins, or with ``newer_by`` the row with the greatest values. A batch
    replayed after a failure merges to the same rows. ``checkpoint`` must be on
    storage that outlives the driver; it also is the high-water mark of the run.
    ``stage_batch`` writes a batch out first, for a ``shape`` that reads it often.
    ``presence`` is handed to the upsert. Rows with a ``defect`` are not merged; with
    ``quarantine`` they are appended to that table, each batch once.
    """

    def load(rows: DataFrame, batch: int) -> None:
        good = rows
        if DEFECT in rows.columns:
            good = rows.filter(F.col(DEFECT).isNull()).drop(DEFECT, "date_text")
            if quarantine:
                _keep(store, quarantine, rows.filter(F.col(DEFECT).isNotNull()), batch)
        store.upsert(table, shape(good), key, newer_by=newer_by, presence=presence)

    def merge(batch: DataFrame, number: int) -> None:
        if not stage_batch:
            load(batch, number)
            return
        with store.staged(batch) as rows:
            load(rows, number)

    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _keep(store: TableStore, table: str, bad: DataFrame, batch: int) -> None:
    """Append a batch's defective records, unless an earlier try of the batch has done so."""
    rows = bad.withColumn(BATCH, F.lit(batch).cast("bigint"))
    store.ensure_table(table, rows.schema, description="Defective records of a stream")
    if store.scan(table, {BATCH: batch}).isEmpty():
        store.append(table, rows)


def quarantine_counts(store: TableStore, table: str) -> DataFrame:
    """Defective records by series and defect."""
    return store.scan(table).groupBy("series", DEFECT).agg(F.count("*").alias("records"))


def held(spec: SeriesSpec) -> str:
    """Name of the flag that tells whether a row holds an observation of the series."""
    return f"__has_{spec.column}"


def presence_of(specs: Sequence[SeriesSpec]) -> dict[str, str]:
    return {s.column: held(s) for s in specs}


def rate_rows(
    specs: Sequence[SeriesSpec], now: datetime, number_format: str = "plain"
) -> Callable[[DataFrame], DataFrame]:
    """Batch shape for rate tables: one row per date with the batch's observations and flags for them.

    Where a batch repeats a date of a series the first month wins, as in a batch run, and
    of one month the smallest text; a later batch is a correction and wins over earlier ones.
    """

    def shape(batch: DataFrame) -> DataFrame:
        def own(spec: SeriesSpec, what):
            return F.when(F.col("series") == F.lit(spec.api_name), what)

        first = [
            F.min_by(VALUE_FIELD, own(s, F.struct("month", VALUE_FIELD))).alias(s.column) for s in specs
        ]
        flags = [F.coalesce(F.bool_or(own(s, F.lit(True))), F.lit(False)).alias(held(s)) for s in specs]
        wide = batch.groupBy(DATE_COLUMN).agg(*first, *flags)
        known = wide.filter(F.greatest(*[F.col(f"`{held(s)}`") for s in specs], F.lit(False)))
        typed = type_columns(known.drop(*presence_of(specs).values()), number_format)
        flagged = known.select(F.col(DATE_COLUMN).alias("__date"), *presence_of(specs).values())
        joined = typed.join(flagged, quoted(DATE_COLUMN) == F.col("__date")).drop("__date")
        return audit_columns(joined, now, DEFAULT_DATA_SOURCE, None)

    return shape


def filled(store: TableStore, table: str, specs: Sequence[SeriesSpec]) -> DataFrame:
    """The table with each series carried across its gaps, as a batch run over the same files fills it."""
    columns = [s.column for s in specs]
    return forward_fill(store.scan(table), columns, distinct_order=True)


def latest_per_key(key: str, order_by: Sequence[str]) -> Callable[[DataFrame], DataFrame]:
    """Batch shape that keeps the newest row of each key, reduced before the shuffle."""

    def shape(batch: DataFrame) -> DataFrame:
        rest = [c for c in batch.columns if c != key]
        newest = F.max_by(F.struct(*[quoted(c) for c in rest]), F.struct(*[quoted(c) for c in order_by]))
        picked = batch.groupBy(quoted(key)).agg(newest.alias("__row"))
        return picked.select(key, *[F.col("__row").getField(c).alias(c) for c in rest])

    return shape
