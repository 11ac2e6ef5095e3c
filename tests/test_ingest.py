"""The ingestion run and its streaming form."""

from datetime import date, datetime

import pytest
from pyspark.sql import types as T

from ratelake.model import DEFAULT_SERIES, RATE_SCHEMA
from ratelake.plans.ingest import IngestConfig, ingest_metrics, run_ingest, sample
from ratelake.plans.prepare import prepare
from ratelake.session import work_path
from ratelake.sources.observations import FrameSource, LandingSource
from ratelake.streaming.ingest import filled as read_filled
from ratelake.streaming.ingest import (
    latest_per_key,
    presence_of,
    quarantine_counts,
    rate_rows,
    stream_landing,
    upsert_stream,
)

NOW = datetime(2024, 1, 20, 10, 32)


@pytest.fixture
def config(store):
    return lambda **changes: IngestConfig(database=store.database, location=store.location, **changes)


@pytest.fixture
def filled(landing):
    landing.observations("dolar", "2024-01", ("2024-01-15", "900,50"), ("2024-01-17", "902"), ("2024-01-19", "904"))
    landing.observations("euro", "2024-01", ("2024-01-16", "1.000,0"), ("2024-01-17", "1002"))
    landing.observations("uf", "2024-01", ("2024-01-15", "36000,1"))
    return landing


def values(df):
    return sorted((r["Fecha"].day, r["usdclp_obs"], r["eurclp_obs"], r["ufclp"]) for r in df.collect())


FULL = [
    (15, 900.5, None, 36000.1),
    (16, 900.5, None, 36000.1),
    (17, 902.0, 1002.0, 36000.1),
    (19, 904.0, 1002.0, 36000.1),
]


def test_full_run_truncates_and_a_rerun_changes_nothing(spark, config, filled):
    source = LandingSource(filled.root)
    for _ in range(2):
        assert values(run_ingest(spark, source, config(), "full", NOW)) == FULL
    stored = run_ingest(spark, source, config(number_format="es"), "full", NOW)
    assert stored.schema.names == RATE_SCHEMA.names
    assert values(stored)[1][2] == 1000.0


def test_backfill_upserts_and_without_a_key_appends(spark, config, filled):
    source = LandingSource(filled.root)
    run_ingest(spark, source, config(), "full", NOW)
    again = run_ingest(spark, source, config(), "backfill", NOW, backfill_days=5)
    # The fill starts over in the window: the first days lose the values carried in before.
    assert values(again) == FULL[:1] + [(16, None, None, None), (17, 902.0, 1002.0, None), (19, 904.0, 1002.0, None)]
    appended = run_ingest(spark, source, config(merge_key=None), "backfill", NOW, backfill_days=5)
    assert appended.count() == 7


def test_backfill_can_continue_from_the_table(spark, config, filled):
    source = LandingSource(filled.root)
    run_ingest(spark, source, config(), "full", NOW)
    seeded = run_ingest(spark, source, config(seed_from_table=True), "backfill", NOW, backfill_days=4)
    assert values(seeded) == FULL


def test_a_failed_series_keeps_its_stored_values(spark, config, filled):
    run_ingest(spark, LandingSource(filled.root), config(), "full", NOW)
    filled.observations("euro", "2024-01", ("16/01/2024", "1"), ("2024-01-17", "2"))
    again = run_ingest(spark, LandingSource(filled.root), config(strict=True), "backfill", NOW, backfill_days=5)
    stored = {r["Fecha"].day: r["eurclp_obs"] for r in again.collect()}
    assert stored == {15: None, 16: None, 17: 1002.0, 19: 1002.0}


def test_nothing_in_the_window(spark, config, store, filled):
    assert run_ingest(spark, LandingSource(filled.root), config(), "incremental", datetime(2024, 3, 1)) is None
    assert not store.exists("raw_data")
    assert run_ingest(spark, LandingSource(filled.root), config(series=("nope",)), "full", NOW) is None


def test_defective_records_can_be_kept(spark, config, store, landing, rows):
    landing.observations("dolar", "2024-01", ("2024-01-15", "900"), ("15.01.2024", "901"))
    landing.add("euro", "2024-01", "<R><Obs><Fecha>2024-")
    run_ingest(spark, LandingSource(landing.root), config(quarantine_table="bad", data_source=None), "full", NOW)
    assert rows(store.scan("bad"), "series", "Fecha", "defect") == sorted(
        [("dolar", "15.01.2024", "bad date"), ("euro", None, "malformed XML")], key=repr
    )
    assert {r["data_source"] for r in store.scan("raw_data").collect()} == {"LandingSource"}


def test_preparation_can_be_replaced(spark, config, filled):
    def stamped_only(wide, now, source, metadata, number_format, seed=None):
        return prepare(wide, now, source, {"custom": 1}, number_format, seed)

    result = run_ingest(spark, LandingSource(filled.root), config(), "full", NOW, preparation=stamped_only)
    assert {r["custom"] for r in result.collect()} == {1}


def test_any_source_with_the_long_shape_will_do(spark, config, store):
    frame = spark.createDataFrame(
        [("dolar", "2024-01", "f", 0, "2024-01-19", "1", None), ("other", "2024-01", "f", 0, "2024-01-19", "1", None)],
        "series string, month string, file string, seq bigint, Fecha string, Valor string, defect string",
    )
    result = run_ingest(spark, FrameSource(frame), config(), "backfill", NOW)
    assert values(result) == [(19, 1.0, None, None)]
    assert sample(store, "raw_data").count() == 1
    assert [tuple(r) for r in ingest_metrics(frame).orderBy("series").collect()] == [("dolar", 1, 0, 0), ("other", 1, 0, 0)]


def test_stream_of_landing_files_lets_later_corrections_win(spark, store, landing):
    schema = T.StructType(list(RATE_SCHEMA))
    store.ensure_table("rates", schema, "Fecha", required=["Fecha"])
    progress = work_path(spark, "progress")

    def run():
        upsert_stream(
            stream_landing(spark, landing.root),
            store,
            "rates",
            "Fecha",
            progress,
            rate_rows(DEFAULT_SERIES, NOW),
            stage_batch=True,
            presence=presence_of(DEFAULT_SERIES),
            quarantine="bad",
        ).awaitTermination()
        return values(read_filled(store, "rates", DEFAULT_SERIES))

    landing.observations("dolar", "2024-01", ("2024-01-15", "900"), ("2024-01-16", "901"))
    landing.observations("euro", "2024-01", ("2024-01-15", "1000"))
    landing.add("uf", "2024-01", "<R><Obs><Fecha>2024-")
    assert run() == [(15, 900.0, 1000.0, None), (16, 901.0, 1000.0, None)]
    landing.observations("dolar", "2024-01", ("2024-01-16", "999"), name="fix.xml")
    assert run() == [(15, 900.0, 1000.0, None), (16, 999.0, 1000.0, None)]
    assert run() == [(15, 900.0, 1000.0, None), (16, 999.0, 1000.0, None)]
    assert [tuple(r) for r in quarantine_counts(store, "bad").collect()] == [("uf", "malformed record", 1)]


@pytest.mark.parametrize("order", [("dolar", "euro"), ("euro", "dolar")])
def test_stream_gives_the_rows_of_the_batch_run(spark, config, store, landing, order):
    """One file for each batch: a batch that lacks a series must not touch its column."""
    store.ensure_table("rates", T.StructType(list(RATE_SCHEMA)), "Fecha", required=["Fecha"])
    readings = {
        "dolar": [("2024-01-15", "900"), ("2024-01-17", "x"), ("2024-01-18", "902")],
        "euro": [("2024-01-15", "1000"), ("2024-01-16", "1001"), ("bad", "1")],
    }
    progress = work_path(spark, "progress")
    for name in order:
        landing.observations(name, "2024-01", *readings[name])
        stream = stream_landing(spark, landing.root, files_per_batch=1)
        upsert_stream(
            stream, store, "rates", "Fecha", progress, rate_rows(DEFAULT_SERIES, NOW),
            presence=presence_of(DEFAULT_SERIES), quarantine="bad",
        ).awaitTermination()
    streamed = values(read_filled(store, "rates", DEFAULT_SERIES))
    assert streamed == values(run_ingest(spark, LandingSource(landing.root), config(table="once"), "full", NOW))
    assert [tuple(r) for r in quarantine_counts(store, "bad").collect()] == [("euro", "no valid date", 1)]


def test_incremental_runs_without_a_partition_field_keep_earlier_days(spark, config, landing):
    landing.observations("dolar", "2024-01", *[(f"2024-01-{d}", str(800 + d)) for d in (15, 16, 17)])
    for day in (15, 16, 17):
        moment = datetime(2024, 1, day, 10, 32)
        result = run_ingest(spark, LandingSource(landing.root), config(partition_field=None, merge_key="Fecha"), "incremental", moment)
    assert values(result) == [(15, 815.0, None, None), (16, 816.0, None, None), (17, 817.0, None, None)]


def test_late_batches_do_not_undo_newer_rows(spark, store, tmp_path, rows):
    folder, schema = str(tmp_path / "in"), "user int, ts timestamp, v int"
    first = spark.createDataFrame([(1, datetime(2024, 2, 1), 10), (1, datetime(2024, 1, 1), 9), (2, datetime(2024, 1, 1), 5)], schema)
    store.ensure_table("latest", first.schema, "ts")
    progress = work_path(spark, "progress")
    for batch in (first, spark.createDataFrame([(1, datetime(2024, 1, 15), 11), (2, datetime(2024, 1, 2), 6)], schema)):
        batch.coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(schema).parquet(folder)
        upsert_stream(
            stream, store, "latest", "user", progress, latest_per_key("user", ["ts"]), newer_by="ts"
        ).awaitTermination()
    assert rows(store.scan("latest"), "user", "v") == [(1, 10), (2, 6)]


def test_key_dates_are_dates(spark, config, filled):
    result = run_ingest(spark, LandingSource(filled.root), config(), "full", NOW)
    assert {r["Fecha"] for r in result.collect()} == {date(2024, 1, d) for d in (15, 16, 17, 19)}
