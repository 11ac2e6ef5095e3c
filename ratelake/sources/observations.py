"""XML observations: from files in a landing folder, or from a text column.

Landing layout: ``<root>/series=<api name>/month=<yyyy-MM>/*.xml``. The folder
names are partition columns, so a series or month filter prunes the file list.

Every reader returns the same long shape::

    series, month, file, seq, Fecha (text), Valor (text), defect

``defect`` names what is wrong with a record and is NULL for a good one. ``seq``
orders the records of one file.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake.functions.parsing import is_bad_date, parse_date
from ratelake.model import DATE_COLUMN, VALUE_FIELD, SeriesSpec
from ratelake.session import SPREAD_FILES, settings

CORRUPT = "_corrupt_record"
# Element names of the payload.
ROW_TAG = "Obs"
ROOT_TAG = "ObservacionesSeries"

LONG_COLUMNS = ("series", "month", "file", "seq", DATE_COLUMN, VALUE_FIELD, "defect")
LANDING_SCHEMA = f"{DATE_COLUMN} string, {VALUE_FIELD} string, {CORRUPT} string, series string, month string"


class SeriesSource(Protocol):
    """Anything that yields observations in the long shape, lazily."""

    def observations(
        self, spark: SparkSession, specs: Sequence[SeriesSpec], months: tuple[str | None, str | None]
    ) -> DataFrame: ...


class LandingSource:
    """Observations from XML files below ``root``.

    ``exact_months`` states that a month folder holds no later month's dates, so
    that long ranges prune at their start too.
    """

    def __init__(self, root: str, row_tag: str = ROW_TAG, pairing: str = "record", exact_months: bool = False):
        self.root, self.row_tag, self.pairing = root, row_tag, pairing
        self.exact_months = exact_months

    def observations(self, spark, specs, months=(None, None)) -> DataFrame:
        names = [s.api_name for s in specs]
        if self.pairing == "positional":
            return read_documents(spark, self.root, names, months, self.row_tag)
        return read_landing(spark, self.root, names, months, self.row_tag)


class FrameSource:
    """Observations that are already in a DataFrame of the long shape."""

    def __init__(self, frame: DataFrame):
        self.frame = frame

    def observations(self, spark, specs, months=(None, None)) -> DataFrame:
        return self.frame.filter(wanted([s.api_name for s in specs], months))


def write_landing(df: DataFrame, root: str, rows_per_file: int = 1_000_000, mode: str = "append") -> None:
    """Write ``(series, month, Fecha, Valor)`` text rows as landing files.

    The rebalance hint groups a month's rows and splits a month that is too big,
    so neither many tiny files nor one huge one come out.
    """
    rows = df.select("series", "month", DATE_COLUMN, VALUE_FIELD).hint("rebalance", "series", "month")
    with settings(df.sparkSession, SPREAD_FILES):
        (
            rows.write.format("xml")
            .option("rootTag", ROOT_TAG)
            .option("rowTag", ROW_TAG)
            .option("maxRecordsPerFile", rows_per_file)
            .partitionBy("series", "month")
            .mode(mode)
            .save(root)
        )


def landing_reader(reader, row_tag: str = ROW_TAG):
    """XML options for a batch or a streaming reader."""
    return (
        reader.format("xml")
        .schema(LANDING_SCHEMA)
        .option("rowTag", row_tag)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
    )


def landing_shape(raw: DataFrame) -> DataFrame:
    """Raw landing rows to the long shape."""
    return raw.select(
        "series",
        "month",
        F.col("_metadata.file_path").alias("file"),
        # Rows of one file are read in order by one task.
        F.monotonically_increasing_id().alias("seq"),
        DATE_COLUMN,
        VALUE_FIELD,
        _defect(F.col(CORRUPT).isNotNull()).alias("defect"),
    )


def read_landing(
    spark: SparkSession,
    root: str,
    series: Sequence[str] | None = None,
    months: tuple[str | None, str | None] = (None, None),
    row_tag: str = ROW_TAG,
) -> DataFrame:
    """Observations paired record by record; a record without a value has a NULL value."""
    raw = landing_reader(spark.read, row_tag).load(root)
    return landing_shape(raw.filter(wanted(series, months)))


def read_documents(
    spark: SparkSession,
    root: str,
    series: Sequence[str] | None = None,
    months: tuple[str | None, str | None] = (None, None),
    row_tag: str = ROW_TAG,
) -> DataFrame:
    """Observations paired by position over each whole file."""
    texts = (
        spark.read.schema("value string, series string, month string").text(root, wholetext=True)
        .filter(wanted(series, months))
        .select("series", "month", F.col("_metadata.file_path").alias("file"), "value")
    )
    return parse_documents(texts, "value", "positional", row_tag)


def parse_documents(df: DataFrame, column: str, pairing: str = "record", row_tag: str = ROW_TAG) -> DataFrame:
    """Observations from a column of XML documents with ``series, month, file`` beside it.

    ``record`` pairs within each record. ``positional`` pairs the n-th date with
    the n-th value of the document: surplus values are dropped, and a shortage
    makes the document defective.
    """
    keep = [c for c in ("series", "month", "file") if c in df.columns]
    parsed = F.from_xml(
        F.col(column),
        f"`{row_tag}` array<struct<{DATE_COLUMN}:string,{VALUE_FIELD}:string>>, {CORRUPT} string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )
    opened = df.select(*keep, F.col(column).alias("__xml"), parsed.alias("__doc"))
    broken = F.col(f"__doc.{CORRUPT}").isNotNull()
    if pairing == "record":
        records, short = F.col(f"__doc.{row_tag}"), F.lit(False)
    elif pairing == "positional":
        opened = opened.select(
            *keep, "__doc", _texts(DATE_COLUMN).alias(DATE_COLUMN), _texts(VALUE_FIELD).alias(VALUE_FIELD)
        )
        wanted = F.size(DATE_COLUMN)
        short = wanted > F.size(VALUE_FIELD)
        records = F.slice(F.arrays_zip(DATE_COLUMN, VALUE_FIELD), F.lit(1), wanted)
    else:
        raise ValueError(f"unknown pairing: {pairing}")
    # A broken document keeps one row, so that it can be quarantined.
    nothing = F.array(F.lit(None).cast(f"struct<{DATE_COLUMN}:string,{VALUE_FIELD}:string>"))
    listed = opened.select(
        *keep,
        broken.alias("__broken"),
        short.alias("__short"),
        F.posexplode(F.when(broken, nothing).otherwise(records)).alias("seq", "__obs"),
    )
    flat = listed.select(
        *keep,
        F.col("seq").cast("bigint").alias("seq"),
        F.col(f"__obs.{DATE_COLUMN}").alias(DATE_COLUMN),
        F.col(f"__obs.{VALUE_FIELD}").alias(VALUE_FIELD),
        "__broken",
        "__short",
    )
    defect = F.when(F.col("__short"), F.lit("fewer values than dates")).otherwise(_defect(F.col("__broken")))
    return flat.withColumn("defect", defect).drop("__broken", "__short")


def _texts(tag: str) -> Column:
    """All texts of an element in document order; an empty element gives empty text."""
    found = F.regexp_extract_all(
        F.col("__xml"), F.lit(rf"<{tag}(?:\s[^>]*)?(?:/>|>([^<]*)</{tag}\s*>)"), F.lit(1)
    )
    return F.transform(found, lambda t: F.coalesce(t, F.lit("")))


def _defect(corrupt: Column) -> Column:
    return F.when(corrupt, F.lit("malformed XML")).when(is_bad_date(F.col(DATE_COLUMN)), F.lit("bad date"))


def wanted(series: Sequence[str] | None, months: tuple[str | None, str | None]) -> Column:
    condition = F.lit(True) if series is None else F.col("series").isin(*series)
    first, last = months
    if first is not None:
        condition &= F.col("month") >= F.lit(first)
    if last is not None:
        condition &= F.col("month") <= F.lit(last)
    return condition


def quarantine(observations: DataFrame) -> DataFrame:
    """The defective records, to be stored and looked at."""
    return observations.filter(F.col("defect").isNotNull())


def accepted(observations: DataFrame, strict: bool = False, isolate_by: Sequence[str] = ("series",)) -> DataFrame:
    """The usable observations, dates typed.

    By default only defective records are left out. With ``strict`` one defect
    drops everything sharing its ``isolate_by`` values: the whole series, or one
    series in one month.
    """
    good = observations.filter(F.col("defect").isNull())
    if strict:
        # Reduced to the failing names first; the plan broadcasts them if small.
        failed = quarantine(observations).select(*isolate_by).distinct()
        good = good.join(failed, list(isolate_by), "left_anti")
    return good.withColumn(DATE_COLUMN, parse_date(F.col(DATE_COLUMN))).drop("defect")


def landing_inventory(spark: SparkSession, root: str, pattern: str = "*.xml", prefix: str | None = None) -> DataFrame:
    """Path, size and time of landed files; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path", "length", "modificationTime")
    )
    return files.filter(F.contains(F.col("path"), F.lit("/" + prefix))) if prefix else files
