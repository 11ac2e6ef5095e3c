"""Corrections as they arrive: the newest row of each key is held in streaming state.

Merging every micro-batch into a table means to look its keys up there. Here Spark's state
store knows the newest row of each key already: a batch gives out the keys whose rows it has
seen, each with the newest one so far, and these are appended as the batch's own part of a
log. No batch reads the table. The current rows are the newest per key in the log, whatever
the order of files was; compacting the log now and then keeps reading cheap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ratelake.model import quoted
from ratelake.session import settings
from ratelake.sinks.store import TableStore

BASE = "base"
# State on local disk with its changes in the checkpoint, so that it may outgrow memory.
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def newest_per_key(
    rows: DataFrame, keys: Sequence[str], order_by: Sequence[str], within: Sequence[str] = ()
) -> DataFrame:
    """The row of each key with the greatest ``order_by``; NULLs in it are smallest.

    Equal ones are told apart by all other columns, so the result does not depend on the
    order of rows. ``within`` adds grouping columns that are not given out.
    """
    rest = [c for c in rows.columns if c not in keys and c not in within]
    order = [*order_by, *[c for c in rest if c not in order_by]]
    best = F.max(F.struct(*[quoted(c).alias(f"o{i}") for i, c in enumerate(order)]))
    place = {c: f"o{i}" for i, c in enumerate(order)}
    picked = rows.groupBy(*[quoted(c) for c in [*keys, *within]]).agg(best.alias("__best"))
    return picked.select(*[quoted(c) if c in keys else F.col("__best")[place[c]].alias(c) for c in rows.columns if c not in within])


def state_stream(
    stream: DataFrame,
    store: TableStore,
    table: str,
    keys: Sequence[str],
    order_by: Sequence[str],
    checkpoint: str,
    event_time: str | None = None,
    horizon: str | None = None,
    window: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Start a query that logs, batch by batch, the newest row of every key that the batch touches.

    ``order_by`` says which of two rows of a key is newer. Without ``event_time`` the state
    holds one row for every key. With it, rows are held by key and ``window`` of event time,
    and windows further back than ``horizon`` behind the latest event are forgotten. Spark
    refuses rows that come later than that; :func:`refused_rows` counts them, and loading
    their files once more as a batch (:func:`add_rows`) brings them in, since the log takes
    rows in any order. ``checkpoint`` must be on storage that outlives the driver. Columns
    of the order must be comparable (no maps).
    """
    if bool(event_time) != bool(horizon):
        raise ValueError("event_time and horizon go together")
    held = stream
    within: list[str] = []
    if event_time:
        moment = quoted(event_time).cast("timestamp")
        held = stream.withColumn("__moment", moment).withWatermark("__moment", horizon)
        held = held.withColumn("__window", F.window("__moment", window or horizon)).drop("__moment")
        within = ["__window"]
    newest = newest_per_key(held, keys, order_by, within)
    store.ensure_table(table, stream.schema, description="Newest rows per key, as a log of batches")

    def log(batch: DataFrame, number: int) -> None:
        store.write_part(table, f"{number:012d}", batch)

    writer = newest.writeStream.outputMode("update").foreachBatch(log).option("checkpointLocation", checkpoint)
    with settings(stream.sparkSession, ROCKSDB):
        return (writer.trigger(availableNow=True) if available_now else writer).start()


def refused_rows(query: StreamingQuery) -> int:
    """Rows that came behind the horizon, by the progress reports the query still has."""
    return sum(o.numRowsDroppedByWatermark for p in query.recentProgress for o in p.stateOperators)


def add_rows(store: TableStore, table: str, rows: DataFrame, name: str) -> None:
    """Rows from elsewhere, such as a backfill, under a name of their own; the newest per key decides."""
    store.write_part(table, f"added-{name}", rows)


def current_rows(store: TableStore, table: str, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key; reduced before the shuffle."""
    return newest_per_key(store.scan(table), keys, order_by)


def compact(store: TableStore, table: str, keys: Sequence[str], order_by: Sequence[str]) -> None:
    """Fold the log into one part. May be repeated: rows that are in both count once."""
    folded = [p for p in store.partitions(table) if p != BASE]
    store.write_part(table, BASE, current_rows(store, table, keys, order_by))
    store.drop_parts(table, folded)
