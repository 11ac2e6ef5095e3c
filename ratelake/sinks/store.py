"""Date-partitioned tables on plain Parquet, kept in one catalog database.

Tables carry a physical partition column derived from a date column (a month, or
a day), because a date filter alone prunes nothing on a derived partition. The
store adds the matching partition filter itself and hides the column on reading.

A table may also be split by the hash of a key into a fixed number of buckets, a second
partition column. An upsert on that key then reads, joins and rewrites only the buckets
its rows fall into, and a lookup by key reads one.

Writes replace whole partitions, and only those that change. Spark commits a
write after all tasks are done, so lost executors are harmless; but a table has
no transaction log, so allow one writer at a time, and repeat a run whose driver
died while it was committing (upsert, truncate and delete may be repeated).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from contextlib import contextmanager
from datetime import date, datetime, timedelta
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelake.model import DATE_COLUMN, RATE_SCHEMA, TIMESTAMP_COLUMN, conform, quoted, require_values
from ratelake.operators.filters import equals_all
from ratelake.session import SPREAD_FILES, settings
from ratelake.sinks.clustering import place

PARTITION = "_part"
BUCKET = "_bucket"
PLACE = "_place"
UNDATED = "undated"
UNPARTITIONED = "none"
FORMATS = {"month": "yyyy-MM", "day": "yyyy-MM-dd"}
OPTION = "ratelake."
# Rows that are looked at to cut an interleaved write into tasks, times three, or Spark's own 100 a
# task if those are more. A cut beside the end of a field's range widens a file to both ranges.
CUT_SAMPLE = 100_000
SAMPLE_SIZE = "spark.sql.execution.rangeExchange.sampleSizePerPartition"
# A partition, and the bucket in it (0 in a table without buckets).
Cell = tuple[str, int]


class TableStore:
    """Tables of one database. ``location`` is a folder every executor can reach."""

    def __init__(self, spark: SparkSession, database: str = "data_ingestion", location: str | None = None):
        self.spark, self.database, self.location = spark, database, location

    # -- definition ---------------------------------------------------------

    def ensure_database(self) -> None:
        where = f" LOCATION '{self.location}'" if self.location else ""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}`{where}")

    def name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(f"{self.database}.{table}")

    def ensure_table(
        self,
        table: str,
        schema: T.StructType,
        partition_field: str | None = None,
        cluster_fields: Sequence[str] = (),
        required: Sequence[str] = (),
        granularity: str = "month",
        description: str = "",
        bucket_key: str | None = None,
        buckets: int = 0,
        interleave: bool = False,
    ) -> None:
        """Create the table, or bring an existing one to the wanted partitioning.

        Rows are sorted by ``cluster_fields`` inside each file. With ``interleave`` they are
        laid out by all of these fields alike, across the files of a partition, so that a
        filter on any of them skips files and row groups; this costs two passes over what is
        written, from a staged copy.

        With ``bucket_key`` it is also split into ``buckets`` parts by the hash of that
        column: as many as give a part of a month a size that is cheap to rewrite. A table
        with another partition unit, or other buckets, is rewritten, never dropped.
        """
        if bool(bucket_key) != (buckets > 0) or (bucket_key and bucket_key not in schema.names):
            raise ValueError("bucket_key names a column and goes with a positive number of buckets")
        self.ensure_database()
        if self.exists(table):
            have = self.layout(table)
            other_unit = partition_field and have["granularity"] not in (UNPARTITIONED, granularity)
            other_buckets = bucket_key and (have["bucket_key"], have["buckets"]) != (bucket_key, buckets)
            if other_unit or other_buckets:
                unit = granularity if other_unit else have["granularity"]
                self.repair_layout(table, unit, (bucket_key or have["bucket_key"], buckets or have["buckets"]))
            return
        if interleave and len(cluster_fields) < 2:
            raise ValueError("interleave needs two cluster fields at least")
        options = {
            "interleave": "true" if interleave else "",
            "partition_field": partition_field or "",
            "granularity": granularity if partition_field else UNPARTITIONED,
            "cluster_fields": ",".join(cluster_fields),
            "required": ",".join(required),
            "bucket_key": bucket_key or "",
            "buckets": str(buckets),
        }
        parts = f"`{PARTITION}` string" + (f", `{BUCKET}` int" if bucket_key else "")
        names = f"`{PARTITION}`" + (f", `{BUCKET}`" if bucket_key else "")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        properties = ", ".join(f"'{OPTION}{k}' = '{v}'" for k, v in options.items())
        text = description.replace("'", "''")
        self.spark.sql(
            f"CREATE TABLE {self.name(table)} ({columns}, {parts}) USING parquet "
            f"PARTITIONED BY ({names}) COMMENT '{text}' TBLPROPERTIES ({properties})"
        )

    def ensure_rate_table(self, table: str = "exchange_rates") -> None:
        """The fixed six-column table: one partition per day, clustered by date."""
        self.ensure_table(
            table,
            RATE_SCHEMA,
            partition_field=DATE_COLUMN,
            cluster_fields=(DATE_COLUMN,),
            required=(DATE_COLUMN, TIMESTAMP_COLUMN),
            granularity="day",
            description="One row per day, one column per series",
        )

    def layout(self, table: str) -> dict[str, Any]:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.name(table)}").collect()
        found = {r["key"].removeprefix(OPTION): r["value"] for r in rows if r["key"].startswith(OPTION)}
        return {
            "partition_field": found.get("partition_field") or None,
            "granularity": found.get("granularity", UNPARTITIONED),
            "cluster_fields": [c for c in found.get("cluster_fields", "").split(",") if c],
            "required": [c for c in found.get("required", "").split(",") if c],
            "bucket_key": found.get("bucket_key") or None,
            "buckets": int(found.get("buckets") or 0),
            "interleave": bool(found.get("interleave")),
        }

    def schema(self, table: str) -> T.StructType:
        return T.StructType([f for f in self.spark.table(self.name(table)).schema if f.name not in (PARTITION, BUCKET)])

    def partitions(self, table: str) -> list[str]:
        """Partition names from the catalog: one per month or day, no data is read."""
        return sorted({part for part, _ in self.cells(table)})

    def cells(self, table: str) -> list[Cell]:
        """What is written and replaced as a whole: months or days, and in a bucketed table their buckets."""
        rows = self.spark.sql(f"SHOW PARTITIONS {self.name(table)}").collect()
        found = [[level.split("=", 1)[1] for level in r[0].split("/")] for r in rows]
        return sorted((f[0], int(f[1]) if len(f) > 1 else 0) for f in found)

    def repair_layout(self, table: str, granularity: str = "month", bucketing: tuple[str | None, int] | None = None) -> None:
        """Rewrite the table with another partition unit or other buckets and swap it in; no row is lost."""
        have = self.layout(table)
        key, buckets = bucketing or (have["bucket_key"], have["buckets"])
        fresh, old = f"{table}__{granularity}", f"{table}__old"
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(fresh)}")
        self.ensure_table(
            fresh,
            self.schema(table),
            have["partition_field"],
            have["cluster_fields"],
            have["required"],
            granularity,
            self.spark.catalog.getTable(f"{self.database}.{table}").description or "",
            key,
            buckets,
            have["interleave"],
        )
        self.append(fresh, self.scan(table))
        self.spark.sql(f"ALTER TABLE {self.name(table)} RENAME TO {self.name(old)}")
        self.spark.sql(f"ALTER TABLE {self.name(fresh)} RENAME TO {self.name(table)}")
        self.spark.sql(f"DROP TABLE {self.name(old)}")

    # -- reading ------------------------------------------------------------

    def scan(
        self,
        table: str,
        filters: Mapping[str, Any] | None = None,
        limit: int | None = None,
        start: date | datetime | None = None,
        end: date | datetime | None = None,
    ) -> DataFrame:
        """Rows by equality filters and a date range; ``limit`` 0 or None means all."""
        layout, rows = self.layout(table), self._read(table)
        field = layout["partition_field"]
        first, last = start, end
        if filters and field in filters and isinstance(filters[field], date):
            first = last = filters[field]
        if field:
            unit = layout["granularity"]
            if first is not None:
                rows = rows.filter(F.col(PARTITION) >= F.lit(_part_of(first, unit)))
            if last is not None:
                rows = rows.filter(F.col(PARTITION) <= F.lit(_part_of(last, unit)))
            if start is not None:
                rows = rows.filter(quoted(field) >= F.lit(start))
            if end is not None:
                rows = rows.filter(quoted(field) <= F.lit(end))
        elif start is not None or end is not None:
            raise ValueError(f"{table} has no partition field to take a date range on")
        condition = equals_all(filters or {})
        if condition is not None:
            rows = rows.filter(condition)
        key = layout["bucket_key"]
        if filters and filters.get(key) is not None:
            value = F.lit(filters[key]).cast(rows.schema[key].dataType)
            rows = rows.filter(F.col(BUCKET) == _bucket_of(value, layout["buckets"]))
        rows = rows.drop(PARTITION, BUCKET)
        return rows.limit(limit) if limit else rows

    def latest_date(self, table: str, column: str = DATE_COLUMN) -> Any:
        """The greatest date, or None for an empty table. Errors surface.

        On the partition field only the last partition is read.
        """
        rows = self._read(table)
        if column == self.layout(table)["partition_field"]:
            dated = [p for p in self.partitions(table) if p != UNDATED]
            if not dated:
                return None
            rows = rows.filter(F.col(PARTITION) == F.lit(dated[-1]))
        return rows.agg(F.max(quoted(column))).first()[0]

    # -- writing ------------------------------------------------------------

    def append(self, table: str, df: DataFrame) -> None:
        with settings(df.sparkSession, _write_settings("static")):
            with self._shaped(table, df) as rows:
                rows.write.mode("append").insertInto(self.name(table))

    def truncate(self, table: str, df: DataFrame) -> None:
        """Replace the whole content."""
        with settings(df.sparkSession, _write_settings("static")):
            with self._shaped(table, df) as rows:
                rows.write.mode("overwrite").insertInto(self.name(table), overwrite=True)

    def write_part(self, table: str, part: str, df: DataFrame) -> None:
        """Replace what was written under this name before, and nothing else; for tables without a partition field.

        A repeated write, say of a micro-batch after a failure, leaves the same rows.
        """
        layout = self.layout(table)
        if layout["partition_field"] or layout["bucket_key"]:
            raise ValueError(f"{table} has a layout of its own")
        rows = require_values(conform(df, self.schema(table)), layout["required"])
        seen = Observation(f"rows-{uuid.uuid4().hex[:8]}")
        named = rows.withColumn(PARTITION, F.lit(part)).observe(seen, F.count(F.lit(1)).alias("rows"))
        with settings(df.sparkSession, _write_settings("dynamic")):
            named.write.mode("overwrite").insertInto(self.name(table), overwrite=True)
        if not seen.get["rows"]:
            self._drop(table, [(part, 0)])

    def replace_partitions(self, table: str, df: DataFrame) -> None:
        """Put ``df`` in place of the partitions it has rows for; the others stay."""
        self._replace(table, df, ())

    def drop_parts(self, table: str, parts: Sequence[str]) -> None:
        self._drop(table, [(part, 0) for part in parts])

    def write_empty(self, table: str, df: DataFrame) -> None:
        """Load only into a table without rows."""
        if not self._read(table).isEmpty():
            raise ValueError(f"{table} is not empty")
        self.append(table, df)

    def upsert(
        self,
        table: str,
        df: DataFrame,
        key: str = DATE_COLUMN,
        allow_null_key: bool = False,
        newer_by: str | Sequence[str] | None = None,
        presence: Mapping[str, str] | None = None,
    ) -> None:
        """Update rows that match on ``key``, insert the others.

        A matched row takes every column of the source, NULLs included; columns
        the source lacks keep their value. A NULL key never matches: it is
        rejected, or with ``allow_null_key`` inserted. A key that the source
        repeats and the table holds is an error. With ``newer_by``, one column or
        several in order of weight, a matched row is replaced only by a source row
        that is not older. ``presence`` names for some columns a boolean column of
        the source that tells whether this row holds them: where it does not, the
        stored value stays. These boolean columns are not stored.
        """
        spark, layout, schema = df.sparkSession, self.layout(table), self.schema(table)
        presence = dict(presence or {})
        newer_by = [newer_by] if isinstance(newer_by, str) else list(newer_by or ())
        unknown = [c for c in df.columns if c not in schema.names and c not in presence.values()]
        if unknown or key not in df.columns:
            raise ValueError(f"cannot upsert into {table}: unknown columns {unknown}, key {key}")
        flags = [T.StructField(f, T.BooleanType()) for f in presence.values()]
        own = T.StructType([*[f for f in schema if f.name in df.columns], *flags])
        source = conform(df, own)
        if not allow_null_key:
            source = require_values(source, [key])
        with self.staged(source) as staged:
            self._merge_staged(spark, table, layout, schema, staged, key, newer_by, presence)

    def _merge_staged(self, spark, table, layout, schema, staged, key, newer_by, presence) -> None:
        field, unit = layout["partition_field"], layout["granularity"]
        target, split = self._read(table, spark), layout["bucket_key"]
        keys = staged.filter(quoted(key).isNotNull()).select(quoted(key).alias("__key"))
        # Where inserts can land: without the partition field all of them are undated.
        part = _part_column(field, unit) if field in staged.columns else F.lit(UNDATED)
        own_bucket = split == key
        bucket = _bucket_of(quoted(key), layout["buckets"]) if own_bucket else F.lit(0)
        source_cells = _cells(staged.select(part.alias(PARTITION), bucket.alias(BUCKET)))
        source_parts = sorted({p for p, _ in source_cells})
        if own_bucket:
            # The key decides the bucket: no other one can hold a match.
            target = target.filter(F.col(BUCKET).isin(sorted({b for _, b in source_cells})))
        if key == field:
            target = target.filter(F.col(PARTITION).isin(source_parts))
        held = [F.col(PARTITION), (F.col(BUCKET) if own_bucket else F.lit(0)).alias(BUCKET)]
        pairs = _matching(target.select(quoted(key), *held), key, keys.distinct())
        if key == field and not split:
            # The key decides the partition as well, and every touched one gets rows again.
            matched = pairs.select(key)
            self._refuse_repeats(table, matched, key, keys)
            self._rewrite_merged(table, schema, target, staged, matched, key, newer_by, presence, source_cells, [])
            return
        # The one pass over the table's keys, or those of its buckets; at most one row per source key and cell.
        with self.staged(pairs.distinct()) as matched:
            touched = _cells(matched)
            if split and not own_bucket:
                # A row may move to any bucket of these partitions.
                parts = {*source_parts, *(p for p, _ in touched)}
                touched = [c for c in self.cells(table) if c[0] in parts]
            self._refuse_repeats(table, matched, key, keys)
            self._rewrite_merged(table, schema, target, staged, matched, key, newer_by, presence, source_cells, touched)

    def _refuse_repeats(self, table, matched, key, keys) -> None:
        """A key may repeat in the source only when the table does not hold it."""
        repeated = keys.groupBy("__key").count().filter("count > 1").select("__key")
        if repeated.isEmpty():
            return
        clash = _matching(matched, key, repeated).limit(1).collect()
        if clash:
            raise ValueError(f"upsert source repeats key {clash[0][key]!r} that {table} holds")

    def _rewrite_merged(
        self, table, schema, target, staged, matched, key, newer_by, presence, source_cells, touched
    ) -> None:
        known = matched.select(quoted(key).alias("__held")).distinct()
        inserts = staged.join(known, quoted(key) == F.col("__held"), "left_anti")
        by_bucket = self.layout(table)["bucket_key"] == key
        affected = target.filter(_in_cells(sorted(set(source_cells) | set(touched)), by_bucket))
        marked = staged.select(
            F.lit(True).alias("__present"), *[quoted(c).alias(f"__new_{c}") for c in staged.columns]
        )
        joined = affected.join(marked, quoted(key) == F.col(f"`__new_{key}`"), "left")
        takes = F.col("__present").isNotNull()
        if newer_by:
            # Structs compare field by field, NULL before everything else.
            old = F.struct(*[quoted(c) for c in newer_by])
            new = F.struct(*[F.col(f"`__new_{c}`").alias(c) for c in newer_by])
            takes &= new >= old

        def merged(column: str) -> Column:
            if column not in staged.columns:
                return quoted(column)
            held = F.col(f"`__new_{presence[column]}`") if column in presence else F.lit(True)
            return F.when(takes & held, F.col(f"`__new_{column}`")).otherwise(quoted(column))

        updated = joined.select(*[merged(c).alias(c) for c in schema.names])
        inserts = inserts.drop(*presence.values())
        self._replace(table, updated.unionByName(inserts, allowMissingColumns=True), touched)

    def delete_range(
        self,
        table: str,
        start: date | datetime,
        end: date | datetime | None = None,
        column: str = DATE_COLUMN,
        align_days: bool = False,
    ) -> None:
        """Remove rows with ``column`` from the start of day ``start`` to the start of day ``end``.

        The time of day of the bounds is ignored. On a date column both days go; on
        a timestamp column rows of the last day go only at midnight, unless
        ``align_days`` asks for the whole day. Partitions that lie inside the range
        are dropped without being read; only those at its ends are rewritten.
        """
        first, last = _day(start), _day(end if end is not None else start)
        layout, target = self.layout(table), self._read(table)
        gone = quoted(column).between(F.lit(first), F.lit(last))
        if align_days:
            gone = quoted(column).cast("date").between(F.lit(first), F.lit(last))
        if column == layout["partition_field"]:
            unit = layout["granularity"]
            exact = isinstance(target.schema[column].dataType, T.DateType)
            hit = [c for c in self.cells(table) if _part_of(first, unit) <= c[0] <= _part_of(last, unit)]
            inside = [c for c in hit if exact and first <= _part_start(c[0]) and _part_end(c[0]) <= last]
            self._drop(table, inside)
            touched = [c for c in hit if c not in inside]
        else:
            touched = _cells(target.filter(gone))
        if touched:
            kept = target.filter(_in_cells(touched, BUCKET in target.columns) & F.coalesce(~gone, F.lit(True)))
            self._replace(table, kept.drop(PARTITION, BUCKET), touched)

    @contextmanager
    def staged(self, df: DataFrame):
        """A written copy of ``df`` beside the tables, dropped afterwards.

        It cuts the lineage, so that a costly plan runs once, and as a file table
        it keeps column pruning and a known size for the join choice.
        """
        self.ensure_database()
        table = f"stage_{uuid.uuid4().hex[:12]}"
        try:
            df.write.format("parquet").saveAsTable(f"{self.database}.{table}")
            yield df.sparkSession.table(self.name(table))
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")

    # -- internals ----------------------------------------------------------

    def _read(self, table: str, spark: SparkSession | None = None) -> DataFrame:
        """The table as it is now: a stream writes from a session of its own, and
        file lists are remembered per session."""
        spark = spark or self.spark
        spark.catalog.refreshTable(self.name(table))
        return spark.table(self.name(table))

    @contextmanager
    def _shaped(self, table: str, df: DataFrame):
        """Table columns and types, checked, partitioned and clustered for writing.

        The rebalance hint sizes output files by data: small partitions share a
        task, and a partition with a large share of the rows is split.
        """
        layout = self.layout(table)
        rows = require_values(conform(df, self.schema(table)), layout["required"])
        placed = rows.withColumn(PARTITION, _part_column(layout["partition_field"], layout["granularity"]))
        parts = [PARTITION]
        if layout["bucket_key"]:
            placed = placed.withColumn(BUCKET, _bucket_of(quoted(layout["bucket_key"]), layout["buckets"]))
            parts.append(BUCKET)
        fields = layout["cluster_fields"]
        if not layout["interleave"]:
            spread = placed.hint("rebalance", *parts)
            yield spread.sortWithinPartitions(*parts, *[quoted(c) for c in fields])
            return
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        with self.staged(placed) as copy, settings(df.sparkSession, {SAMPLE_SIZE: str(max(100, CUT_SAMPLE // tasks))}):
            ordered = copy.withColumn(PLACE, place(copy, fields))
            # The hash lets a place that many rows share go to several tasks.
            spread = ordered.repartitionByRange(*parts, PLACE, F.xxhash64(*[quoted(c) for c in copy.columns]))
            yield spread.sortWithinPartitions(*parts, PLACE).drop(PLACE)

    def _replace(self, table: str, df: DataFrame, touched: Iterable[Cell]) -> None:
        """Overwrite the cells ``df`` has rows for; drop touched ones it left empty."""
        spark, seen = df.sparkSession, Observation(f"parts-{uuid.uuid4().hex[:8]}")
        with self._shaped(table, df) as rows, settings(spark, _write_settings("dynamic")):
            # At most one name per cell, gathered while writing.
            bucket = F.col(BUCKET) if BUCKET in rows.columns else F.lit(0)
            cell = F.struct(F.col(PARTITION).alias("part"), bucket.alias("bucket"))
            watched = rows.observe(seen, F.collect_set(cell).alias("cells"))
            watched.write.mode("overwrite").insertInto(self.name(table), overwrite=True)
        written = {(c["part"], c["bucket"]) for c in seen.get["cells"] or []}
        self._drop(table, [c for c in touched if c not in written])

    def _drop(self, table: str, cells: Iterable[Cell]) -> None:
        split = self.layout(table)["bucket_key"]
        level = (lambda c: f", `{BUCKET}` = {c[1]}") if split else (lambda c: "")
        listed = ", ".join(f"PARTITION (`{PARTITION}` = '{c[0]}'{level(c)})" for c in cells)
        if listed:
            self.spark.sql(f"ALTER TABLE {self.name(table)} DROP IF EXISTS {listed}")


def _matching(target: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    return target.join(keys, quoted(key) == F.col("__key"), "left_semi")


def _cells(rows: DataFrame) -> list[Cell]:
    """Distinct cells of rows: bounded by the number of months or days times that of buckets."""
    bucket = F.col(BUCKET) if BUCKET in rows.columns else F.lit(0)
    return sorted((r[0], r[1]) for r in rows.select(F.col(PARTITION), bucket.cast("int").alias(BUCKET)).distinct().collect())


def _in_cells(cells: Sequence[Cell], by_bucket: bool) -> Column:
    """A filter on partition columns only, so that other cells are not listed or read."""
    found = F.col(PARTITION).isin(sorted({p for p, _ in cells}))
    if not by_bucket:
        return found
    name = F.concat_ws("/", F.col(PARTITION), F.col(BUCKET).cast("string"))
    return found & F.col(BUCKET).isin(sorted({b for _, b in cells})) & name.isin([f"{p}/{b}" for p, b in cells])


def _bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _part_column(field: str | None, unit: str) -> Column:
    if not field:
        return F.lit(UNDATED)
    return F.coalesce(F.date_format(quoted(field), FORMATS[unit]), F.lit(UNDATED))


def _part_of(moment: date | datetime, unit: str) -> str:
    return f"{moment:%Y-%m}" if unit == "month" else f"{moment:%Y-%m-%d}"


def _part_start(part: str) -> date:
    return date.fromisoformat(part if len(part) == 10 else part + "-01")


def _part_end(part: str) -> date:
    start = _part_start(part)
    if len(part) == 10:
        return start
    return (start + timedelta(days=32)).replace(day=1) - timedelta(days=1)


def _day(moment: date | datetime) -> date:
    return moment.date() if isinstance(moment, datetime) else moment


def _write_settings(mode: str) -> dict[str, str]:
    return {"spark.sql.sources.partitionOverwriteMode": mode, **SPREAD_FILES}
