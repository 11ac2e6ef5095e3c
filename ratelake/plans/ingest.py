"""The ingestion run: landed observations to the date-partitioned table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from contextlib import ExitStack
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake.functions.parsing import is_coerced
from ratelake.model import (
    DATE_COLUMN,
    DEFAULT_DATA_SOURCE,
    TIMESTAMP_COLUMN,
    VALUE_FIELD,
    SeriesSpec,
    catalogue,
    quoted,
    value_columns,
)
from ratelake.plans.prepare import prepare
from ratelake.sinks.store import TableStore
from ratelake.sources.observations import SeriesSource, quarantine
from ratelake.sources.series import merge_range, range_observations, usable

# Modes and their windows.
MODES = ("incremental", "backfill", "full")
FULL_START = datetime(1990, 1, 1)
DEFAULT_BACKFILL_DAYS = 7
SAMPLE_ROWS = 5


@dataclass(frozen=True)
class IngestConfig:
    """What to load and where.

    Without ``merge_key`` rows are appended. Without ``data_source`` rows carry the
    class name of their source. ``quarantine_table`` keeps the defective records.
    """

    database: str = "data_ingestion"
    table: str = "raw_data"
    location: str | None = None
    partition_field: str | None = DATE_COLUMN
    cluster_fields: Sequence[str] = ()
    merge_key: str | None = DATE_COLUMN
    series: Sequence[str] = ("usd", "eur", "uf")
    series_map: Mapping[str, Mapping[str, str]] | None = None
    number_format: str = "plain"
    strict: bool = False
    seed_from_table: bool = False
    align_days: bool = False
    data_source: str | None = DEFAULT_DATA_SOURCE
    quarantine_table: str | None = None
    metadata: Mapping[str, object] = field(default_factory=dict)

    def specs(self) -> list[SeriesSpec]:
        """The requested series that exist; unknown ones are skipped."""
        known = catalogue(self.series_map)
        return [known[n] for n in self.series if n in known]


def mode_window(mode: str, now: datetime, backfill_days: int = DEFAULT_BACKFILL_DAYS) -> tuple[datetime, datetime]:
    """Date window of a run: one day, N days, or everything."""
    if mode == "incremental":
        return now - timedelta(days=1), now
    if mode == "backfill":
        return now - timedelta(days=backfill_days), now
    if mode == "full":
        return FULL_START, now
    raise ValueError(f"Invalid mode: {mode}")


def mode_windows(now: Column, backfill_days: int = DEFAULT_BACKFILL_DAYS) -> Column:
    """The three windows of one moment as an array of ``(mode, start_ts, end_ts)``."""

    def window(mode: str, start: Column) -> Column:
        return F.struct(F.lit(mode).alias("mode"), start.alias("start_ts"), now.alias("end_ts"))

    return F.array(
        window("incremental", now - F.make_dt_interval(F.lit(1))),
        window("backfill", now - F.make_dt_interval(F.lit(backfill_days))),
        window("full", F.lit(str(FULL_START)).cast("timestamp_ntz")),
    )


def run_ingest(
    spark: SparkSession,
    source: SeriesSource,
    config: IngestConfig,
    mode: str,
    now: datetime,
    backfill_days: int = DEFAULT_BACKFILL_DAYS,
    preparation: Callable[..., DataFrame] = prepare,
) -> DataFrame | None:
    """Read, merge, prepare and load one window; returns the table, lazily.

    None means that the window held no observations, in which case the rate table
    is neither created nor changed. Re-running a window changes nothing there but
    the stamp.
    ``preparation`` may replace :func:`prepare`; it gets the same arguments.
    """
    start, end = mode_window(mode, now, backfill_days)
    specs = config.specs()
    store = TableStore(spark, config.database, config.location)
    if not specs:
        return None
    with ExitStack() as stages:

        def stage(df: DataFrame) -> DataFrame:
            return stages.enter_context(store.staged(df))

        # Written once: parsing the landing files must not be repeated, and the
        # fill below looks at the merged rows several times.
        read = stage(range_observations(spark, source, specs, start, end))
        if config.quarantine_table:
            keep_defective(store, config.quarantine_table, read, now)
        seen = usable(read, start, end, config.strict)
        wide = stage(merge_range(seen, specs, start, end, config.align_days, stage=lambda rows: rows))
        if wide.isEmpty():
            return None
        seed = None
        if config.seed_from_table and store.exists(config.table):
            seed = last_values(store.scan(config.table, end=start.date() - timedelta(days=1)), specs)
        ready = preparation(
            wide,
            now,
            config.data_source or type(source).__name__,
            config.metadata,
            config.number_format,
            seed=seed,
        )
        # Names only: bounded by the number of series asked for.
        arrived = {r["series"] for r in seen.select("series").distinct().collect()}
        load(store, config, mode, ready, [s.column for s in specs if s.api_name not in arrived])
    return store.scan(config.table)


def keep_defective(store: TableStore, table: str, observations: DataFrame, now: datetime) -> None:
    """Append the defective records, with the time of the run, for someone to look at."""
    bad = quarantine(observations).drop("seq").withColumn(TIMESTAMP_COLUMN, F.lit(now).cast("timestamp"))
    store.ensure_table(table, bad.schema, TIMESTAMP_COLUMN, description="Defective observations")
    store.append(table, bad)


def load(
    store: TableStore, config: IngestConfig, mode: str, ready: DataFrame, failed: Sequence[str] = ()
) -> None:
    """Create the table if needed, then truncate, upsert or append.

    ``failed`` names the columns of series that could not be read: an upsert
    leaves them alone instead of overwriting stored values by NULL.
    """
    store.ensure_table(
        config.table,
        ready.schema,
        config.partition_field,
        config.cluster_fields,
        required=[config.partition_field] if config.partition_field else [],
        description="Rate series",
    )
    if mode == "full":
        store.truncate(config.table, ready)
    elif config.merge_key:
        store.upsert(config.table, ready.drop(*failed), config.merge_key)
    else:
        store.append(config.table, ready)


def last_values(history: DataFrame, specs: Sequence[SeriesSpec], order_by: str = DATE_COLUMN) -> DataFrame:
    """One row with each series' latest known value: what a gap at the start continues from."""
    return history.agg(
        *[
            F.max_by(quoted(s.column), F.when(quoted(s.column).isNotNull(), quoted(order_by))).alias(s.column)
            for s in specs
        ]
    )


def sample(store: TableStore, table: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """A few rows for a log; which ones is not defined."""
    return store.scan(table, limit=rows)


def ingest_metrics(observations: DataFrame, number_format: str = "plain") -> DataFrame:
    """Per series: records, defects, and values that became NULL on parsing."""
    text = F.col(VALUE_FIELD)
    return observations.groupBy("series").agg(
        F.count("*").alias("records"),
        F.count_if(F.col("defect").isNotNull()).alias("defects"),
        F.count_if(F.coalesce(is_coerced(text, number_format), F.lit(False))).alias("coerced"),
    )


def fill_counts(df: DataFrame) -> DataFrame:
    """Rows and NULLs per value column of a wide table, in one pass."""
    return df.agg(
        F.count("*").alias("rows"),
        *[F.count_if(quoted(c).isNull()).alias(f"{c}_nulls") for c in value_columns(df)],
    )
