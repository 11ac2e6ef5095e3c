"""Any client of observations as a Spark data source, for batch and streaming reads.

A client is a small picklable object. Its ``slices`` says what can be asked for and its
``fetch`` gets one slice; Spark calls ``fetch`` in tasks, one or more slices to each, so
no observation passes through the driver. Filters on ``series`` and ``month`` are applied
to the slices: those that do not match are never fetched.

This module travels to the executors by value. A client defined elsewhere must be
importable there, or be defined where the program starts.
"""

from __future__ import annotations

import operator
import sys
import time
from collections.abc import Iterator, Sequence
from typing import NamedTuple, Protocol
from xml.etree import ElementTree

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
)

from ratelake.functions.parsing import is_bad_date
from ratelake.model import DATE_COLUMN, VALUE_FIELD, SeriesSpec
from ratelake.sources.observations import ROW_TAG, wanted

PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
SCHEMA = f"series string, month string, file string, seq bigint, {DATE_COLUMN} string, {VALUE_FIELD} string, defect string"
NAMES = ("series", "month", "file", "seq", DATE_COLUMN, VALUE_FIELD, "defect")
ARROW = pa.schema([(n, pa.int64() if n == "seq" else pa.string()) for n in NAMES])
BATCH = 10_000
COMPARE = {
    EqualTo: operator.eq,
    GreaterThan: operator.gt,
    GreaterThanOrEqual: operator.ge,
    LessThan: operator.lt,
    LessThanOrEqual: operator.le,
}


class Slice(NamedTuple):
    """What one call of a client fetches. ``version`` grows when its content changes."""

    series: str
    month: str
    file: str
    version: int


class SeriesClient(Protocol):
    def slices(self) -> Sequence[Slice]:
        """All that can be fetched now."""

    def fetch(self, part: Slice) -> Iterator[tuple[str | None, str | None, str | None]]:
        """Date text, value text and defect of each observation, in order."""


class FolderClient:
    """XML files below ``root/series=<name>/month=<yyyy-MM>/``, on any file system that pyarrow knows.

    Files are read piece by piece, never whole. A file changed in the last
    ``settle_seconds`` is left for a later read: where modification times are coarse, a
    stream could otherwise pass over a file that appears within the same tick.
    """

    def __init__(self, root: str, row_tag: str = ROW_TAG, settle_seconds: float = 0):
        self.root, self.row_tag, self.settle_seconds = root, row_tag, settle_seconds

    def slices(self) -> list[Slice]:
        system, folder = self._open()
        latest = time.time_ns() - int(self.settle_seconds * 1e9) if self.settle_seconds else None
        found = []
        for info in system.get_file_info(fs.FileSelector(folder, recursive=True, allow_not_found=True)):
            levels = info.path[len(folder) :].strip("/").split("/")
            named = len(levels) == 3 and levels[0].startswith("series=") and levels[1].startswith("month=")
            if not (named and info.is_file and levels[2].endswith(".xml")):
                continue
            if latest is None or info.mtime_ns <= latest:
                found.append(Slice(levels[0][7:], levels[1][6:], info.path, info.mtime_ns))
        return sorted(found)

    def fetch(self, part: Slice) -> Iterator[tuple[str | None, str | None, str | None]]:
        system, _ = self._open()
        with system.open_input_stream(part.file) as stream:
            try:
                top = None
                for event, element in ElementTree.iterparse(stream, ("start", "end")):
                    top = element if top is None else top
                    if event == "end" and element.tag == self.row_tag:
                        yield self._text(element, DATE_COLUMN), self._text(element, VALUE_FIELD), None
                        # What was read is let go, or the tree would hold the whole file.
                        element.clear()
                        top.clear()
            except ElementTree.ParseError:
                yield None, None, "malformed XML"

    @staticmethod
    def _text(element, tag: str) -> str | None:
        found = element.find(tag)
        return None if found is None else found.text

    def _open(self):
        if "://" in self.root:
            return fs.FileSystem.from_uri(self.root)
        return fs.LocalFileSystem(), self.root.removeprefix("file:")


def fetched(client: SeriesClient, parts: Sequence[Slice]) -> Iterator[pa.RecordBatch]:
    """Rows of some slices in batches; ``seq`` counts within a slice."""
    rows: list[tuple] = []
    for part in parts:
        for seq, (day, value, defect) in enumerate(client.fetch(part)):
            rows.append((part.series, part.month, part.file, seq, day, value, defect))
            if len(rows) == BATCH:
                yield _batch(rows)
                rows = []
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), ARROW)], schema=ARROW)


def _grouped(parts: Sequence[Slice], size: int) -> list[InputPartition]:
    """One Spark partition for up to ``size`` slices, as plain tuples."""
    return [InputPartition([tuple(p) for p in parts[i : i + size]]) for i in range(0, len(parts), size)]


def _slices(partition: InputPartition | None) -> list[Slice]:
    """Spark passes None where there was no slice at all."""
    return [Slice(*p) for p in partition.value] if partition else []


class SeriesReader(DataSourceReader):
    def __init__(self, client: SeriesClient, size: int):
        self.client, self.size = client, size
        self.tests: list[tuple[str, object, object]] = []

    def pushFilters(self, filters):
        """Keep what the slices' names decide; all else goes back to Spark."""
        for f in filters:
            name = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
            if name not in ("series", "month"):
                yield f
            elif isinstance(f, In):
                self.tests.append((name, operator.contains, tuple(f.value)))
            elif type(f) in COMPARE:
                self.tests.append((name, COMPARE[type(f)], f.value))
            elif not isinstance(f, IsNotNull):
                yield f

    def _passes(self, part: Slice) -> bool:
        for name, test, value in self.tests:
            mine = getattr(part, name)
            if not (test(value, mine) if test is operator.contains else test(mine, value)):
                return False
        return True

    def partitions(self):
        return _grouped([p for p in self.client.slices() if self._passes(p)], self.size)

    def read(self, partition):
        return fetched(self.client, _slices(partition))


class SeriesStreamReader(DataSourceStreamReader):
    """New and changed slices per micro-batch. A changed slice comes again as a whole."""

    def __init__(self, client: SeriesClient, size: int):
        self.client, self.size, self.seen = client, size, 0

    def initialOffset(self):
        return {"version": 0}

    def latestOffset(self):
        # Slices may vanish; the offset must not go back.
        self.seen = max([self.seen, *(p.version for p in self.client.slices())])
        return {"version": self.seen}

    def partitions(self, start, end):
        fresh = [p for p in self.client.slices() if start["version"] < p.version <= end["version"]]
        return _grouped(fresh, self.size)

    def read(self, partition):
        return fetched(self.client, _slices(partition))


def register_source(spark: SparkSession, name: str, client: SeriesClient) -> None:
    """Make ``spark.read.format(name)`` and ``spark.readStream.format(name)`` read from ``client``.

    The option ``slicesPerPartition`` puts several slices into one task (1 by default).
    Turns Spark's filter pushdown for Python sources on, as the source relies on it.
    """

    class Plugged(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return SCHEMA

        def _size(self):
            return max(1, int(self.options.get("slicesPerPartition", 1)))

        def reader(self, schema):
            return SeriesReader(client, self._size())

        def streamReader(self, schema):
            return SeriesStreamReader(client, self._size())

    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(Plugged)


class PluggedSource:
    """A registered client as a source for ``read_series``, ``read_range`` or an ingestion run."""

    def __init__(self, name: str, exact_months: bool = False, slices_per_partition: int = 1):
        self.name, self.exact_months, self.slices_per_partition = name, exact_months, slices_per_partition

    def observations(
        self, spark: SparkSession, specs: Sequence[SeriesSpec], months: tuple[str | None, str | None] = (None, None)
    ) -> DataFrame:
        raw = spark.read.format(self.name).option("slicesPerPartition", self.slices_per_partition).load()
        return dated(raw.filter(wanted([s.api_name for s in specs], months)))


def dated(raw: DataFrame) -> DataFrame:
    """Rows of a plugged source, with bad dates named as defects; for batch and streaming reads."""
    bad = F.when(is_bad_date(F.col(DATE_COLUMN)), F.lit("bad date"))
    return raw.withColumn("defect", F.coalesce("defect", bad))


# Readers run where this package need not be installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
