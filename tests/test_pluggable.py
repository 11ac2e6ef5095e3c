"""Clients registered as Spark data sources."""

import os
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from ratelake.model import SeriesSpec
from ratelake.sources.observations import accepted, quarantine
from ratelake.sources.pluggable import FolderClient, PluggedSource, Slice, dated, fetched, register_source

# Workers cannot import test modules.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
UF, EURO = SeriesSpec("uf", "uf", "uf_v"), SeriesSpec("euro", "euro", "euro_v")


class CountingClient:
    """Made-up rates; every fetch leaves a file, so that a test can count them."""

    def __init__(self, folder):
        self.folder = str(folder)

    def slices(self):
        return [Slice(s, f"2024-{m:02}", f"{s}{m}", m) for s in ("euro", "uf") for m in range(1, 13)]

    def fetch(self, part):
        open(os.path.join(self.folder, part.file), "w").close()
        for day in (1, 2):
            yield f"{part.month}-{day:02}", f"{day},5", None


@pytest.fixture
def counted(spark, tmp_path):
    register_source(spark, "counted", CountingClient(tmp_path))
    return tmp_path


def test_months_and_series_are_picked_before_fetching(spark, counted):
    seen = PluggedSource("counted").observations(spark, [UF], ("2024-03", "2024-05"))
    assert seen.rdd.getNumPartitions() == 3
    assert {r.month for r in seen.collect()} == {"2024-03", "2024-04", "2024-05"}
    assert sorted(os.listdir(counted)) == ["uf3", "uf4", "uf5"]


@pytest.mark.parametrize(
    ("condition", "slices"),
    [
        ("series = 'uf'", 12),
        ("month > '2024-10'", 4),
        ("month < '2024-02'", 2),
        ("month IN ('2024-01', '2024-07') AND series = 'euro'", 2),
        ("series = 'none'", 0),
        ("Fecha = '2024-01-01'", 24),
        ("series = 'uf' OR month = '2024-01'", 24),
    ],
)
def test_pushed_filters_change_no_result(spark, counted, condition, slices):
    read = spark.read.format("counted").load()
    got = read.filter(condition)
    everything = spark.createDataFrame(read.collect(), read.schema)
    # Spark makes one empty partition of none.
    assert got.rdd.getNumPartitions() == max(slices, 1)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, everything.filter(condition).collect()), key=repr)


def test_slices_share_a_task(spark, counted):
    read = spark.read.format("counted").option("slicesPerPartition", 5).load()
    assert read.rdd.getNumPartitions() == 5 and read.count() == 48


def test_folder_gives_what_the_built_in_reader_gives(spark, landing):
    landing.observations("uf", "2024-01", ("2024-01-01", "1,5"), ("2024-01-02", None), ("02/01/24", "3"))
    landing.observations("uf", "2024-02", ("2024-02-01", "1 &amp; 2"))
    landing.add("euro", "2024-01", "<ObservacionesSeries><Obs><Fecha>2024-01-01</Fecha><Valor>9</Valor></Obs><Obs>")
    landing.add("euro", "2024-02", "<ObservacionesSeries/>")
    open(os.path.join(landing.root, "note.txt"), "w").close()
    register_source(spark, "folder", FolderClient(landing.root))
    seen = PluggedSource("folder").observations(spark, [UF, EURO])
    rows = [(r.series, r.Fecha.isoformat(), r.Valor) for r in accepted(seen).collect()]
    assert sorted(rows, key=repr) == [
        ("euro", "2024-01-01", "9"), ("uf", "2024-01-01", "1,5"), ("uf", "2024-01-02", None), ("uf", "2024-02-01", "1 & 2"),
    ]
    bad = [(r.series, r.defect) for r in quarantine(seen).collect()]
    assert sorted(bad) == [("euro", "malformed XML"), ("uf", "bad date")]


def test_missing_folder_and_settling(tmp_path, landing):
    assert FolderClient(str(tmp_path / "none")).slices() == []
    landing.observations("uf", "2024-01", ("2024-01-01", "1"))
    assert FolderClient(landing.root, settle_seconds=3600).slices() == []
    assert len(FolderClient("file:" + landing.root).slices()) == 1
    assert list(fetched(FolderClient(landing.root), [])) == []


def test_stream_resumes_and_brings_changed_files_again(spark, landing, tmp_path):
    register_source(spark, "resumed", FolderClient(landing.root))

    def run():
        rows = dated(spark.readStream.format("resumed").load())
        query = rows.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "progress"))
        query.trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
        got = spark.read.schema(rows.schema).parquet(str(tmp_path / "out"))
        return {(r.Fecha, r.Valor): r.n for r in got.groupBy("Fecha", "Valor").agg(F.count("*").alias("n")).collect()}

    landing.observations("uf", "2024-01", ("2024-01-01", "1"))
    assert run() == {("2024-01-01", "1"): 1}
    assert run() == {("2024-01-01", "1"): 1}
    landing.observations("uf", "2024-02", ("2024-02-01", "2"))
    landing.observations("uf", "2024-01", ("2024-01-01", "7"))
    assert run() == {("2024-01-01", "1"): 1, ("2024-01-01", "7"): 1, ("2024-02-01", "2"): 1}
