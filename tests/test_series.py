"""Reading series: the ported cases, then ranges, failure isolation and requests."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelake.model import DEFAULT_SERIES, catalogue
from ratelake.plans.ingest import mode_window
from ratelake.sources.observations import (
    LandingSource,
    accepted,
    landing_inventory,
    parse_documents,
    quarantine,
    read_landing,
)
from ratelake.sources.requests import is_bulk, request_grid
from ratelake.sources.series import read_many, read_range, read_series

NOW = datetime(2024, 1, 16, 10, 32)


def test_series_usd(spark, landing):
    landing.observations("dolar", "2024-01", ("2024-01-15", "900.50"), ("2024-01-16", "901.20"))
    result = read_series(spark, LandingSource(landing.root), "usd", NOW, "2024", "01", onwards=False)
    assert result.columns == ["Fecha", "usdclp_obs"]
    assert isinstance(result.schema["Fecha"].dataType, T.DateType)
    assert result.count() == 2
    assert result.filter(F.col("usdclp_obs").isNull()).count() == 0


def test_unknown_series_is_an_error(spark, landing):
    with pytest.raises(ValueError, match="Invalid currency type"):
        read_series(spark, LandingSource(landing.root), "invalid", NOW)


def test_month_defaults_to_now(spark, landing, rows):
    landing.observations("euro", "2023-12", ("2023-12-15", "990,00"))
    landing.observations("euro", "2024-01", ("2024-01-15", "1000.00"))
    result = read_series(spark, LandingSource(landing.root), "eur", NOW, year="2023")
    assert rows(result) == [(date(2024, 1, 15), "1000.00")]


def test_catalogue_can_be_replaced():
    known = catalogue({"yen": {"api": "yen_api", "column": "jpy_obs"}})
    assert list(known) == ["yen"] and known["yen"].column == "jpy_obs"


def test_record_pairing_keeps_a_missing_value_in_its_record(spark, landing, rows):
    landing.observations("dolar", "2024-01", ("2024-01-15", "900,50"), ("2024-01-16", None))
    seen = read_landing(spark, landing.root)
    assert rows(accepted(seen), "Fecha", "Valor") == [(date(2024, 1, 15), "900,50"), (date(2024, 1, 16), None)]


def test_positional_pairing_rejects_a_shortage_of_values(spark, landing):
    landing.observations("dolar", "2024-01", ("2024-01-15", "900,50"), ("2024-01-16", None))
    landing.observations("euro", "2024-01", ("2024-01-15", "1000"))
    seen = LandingSource(landing.root, pairing="positional").observations(spark, DEFAULT_SERIES)
    assert {r["series"] for r in quarantine(seen).collect()} == {"dolar"}
    assert {r["series"] for r in accepted(seen, strict=True).collect()} == {"euro"}


def test_positional_pairing_shifts_values_and_drops_a_surplus(spark, rows):
    xml = (
        "<R><Obs><Fecha>2024-01-15</Fecha></Obs><Obs><Fecha>2024-01-16</Fecha><Valor>1</Valor></Obs>"
        "<Obs><Valor>2</Valor></Obs><Obs><Valor/></Obs></R>"
    )
    df = spark.createDataFrame([("dolar", "2024-01", "f", xml)], "series string, month string, file string, x string")
    seen = parse_documents(df, "x", "positional")
    assert rows(seen, "Fecha", "Valor", "defect") == [("2024-01-15", "1", None), ("2024-01-16", "2", None)]


def test_truncated_file_is_quarantined_alone(spark, landing, rows):
    landing.add("dolar", "2024-01", "<R><Obs><Fecha>2024-")
    landing.observations("euro", "2024-01", ("2024-01-15", "1000"))
    seen = read_landing(spark, landing.root)
    assert rows(quarantine(seen), "series", "defect") == [("dolar", "malformed XML")]
    assert rows(accepted(seen), "series") == [("euro",)]


def test_one_bad_date_fails_the_series_only_when_strict(spark, landing, rows):
    landing.observations("dolar", "2024-01", ("2024-01-15", "900"), ("16/01/2024", "901"))
    landing.observations("euro", "2024-01", ("2024-01-15", "1000"))
    source = LandingSource(landing.root)
    loose = read_many(spark, source, ["usd", "eur"], NOW)
    assert rows(loose) == [(date(2024, 1, 15), "900", "1000")]
    strict = read_many(spark, source, ["usd", "eur", "nope"], NOW, strict=True)
    assert strict.columns == ["Fecha", "eurclp_obs"] and strict.count() == 1
    assert list(read_many(spark, source, ["usd", "eur"], NOW, merge=False, strict=True)) == ["eur"]
    assert read_many(spark, source, ["usd"], NOW, strict=True) is None
    assert read_many(spark, source, ["nope"], NOW, merge=False) == {}


def test_range_start_with_a_time_of_day_excludes_its_day(spark, landing, rows):
    landing.observations("dolar", "2024-01", *[(f"2024-01-{d}", str(d)) for d in (14, 15, 16)])
    source, usd = LandingSource(landing.root), DEFAULT_SERIES[:1]
    start = datetime(2024, 1, 15, 10, 32)
    assert rows(read_range(spark, source, usd, start, NOW), "Fecha") == [(date(2024, 1, 16),)]
    aligned = read_range(spark, source, usd, start, NOW, align_days=True)
    assert rows(aligned, "Fecha") == [(date(2024, 1, 15),), (date(2024, 1, 16),)]


def test_earlier_month_wins_with_its_whole_row(spark, landing, rows):
    landing.observations("dolar", "2024-01", ("2024-01-31", "1"), ("2024-01-31", "8"))
    landing.observations("dolar", "2024-02", ("2024-01-31", "2"), ("2024-02-01", "3"))
    landing.observations("euro", "2024-02", ("2024-01-31", "9"))
    result = read_range(spark, LandingSource(landing.root), DEFAULT_SERIES[:2], datetime(2024, 1, 1), datetime(2024, 2, 20))
    assert rows(result) == [(date(2024, 1, 31), "1", None), (date(2024, 2, 1), "3", None)]


def test_long_range_multiplies_repeated_dates(spark, landing, rows):
    landing.observations("dolar", "2024-01", ("2024-01-31", "1"), ("2024-01-31", "2"))
    landing.observations("euro", "2024-01", ("2024-01-31", "9"), ("2024-01-30", "7"))
    result = read_range(spark, LandingSource(landing.root), DEFAULT_SERIES[:2], datetime(2023, 1, 1), datetime(2024, 2, 20))
    assert rows(result) == [
        (date(2024, 1, 30), None, "7"),
        (date(2024, 1, 31), "1", "9"),
        (date(2024, 1, 31), "2", "9"),
    ]


def test_ninety_days_is_the_last_month_by_month_range(spark):
    start = datetime(2024, 1, 1)
    assert not is_bulk(start, datetime(2024, 3, 31, 23))
    assert is_bulk(start, datetime(2024, 4, 1))
    paths = [r["path"] for r in request_grid(spark, start, datetime(2024, 3, 31), DEFAULT_SERIES[:1]).collect()]
    assert paths == ["dolar/2024/01", "dolar/2024/02", "dolar/2024/03"]
    bulk = request_grid(spark, start, datetime(2024, 4, 1)).collect()
    assert sorted(r["path"] for r in bulk) == [f"{n}/posteriores/1900/01" for n in ("dolar", "euro", "uf")]


def test_last_month_is_requested_whatever_the_time_of_day(spark):
    grid = request_grid(spark, datetime(2024, 1, 20, 12), datetime(2024, 3, 1, 6), DEFAULT_SERIES[:1])
    assert grid.count() == 3


def test_mode_windows():
    assert mode_window("incremental", NOW) == (datetime(2024, 1, 15, 10, 32), NOW)
    assert mode_window("backfill", NOW) == (datetime(2024, 1, 9, 10, 32), NOW)
    assert mode_window("backfill", NOW, 2) == (datetime(2024, 1, 14, 10, 32), NOW)
    assert mode_window("full", NOW) == (datetime(1990, 1, 1), NOW)
    with pytest.raises(ValueError, match="Invalid mode"):
        mode_window("weekly", NOW)


def test_inventory_lists_by_prefix(spark, landing):
    landing.observations("dolar", "2024-01", ("2024-01-15", "1"))
    landing.observations("euro", "2024-01", ("2024-01-15", "1"))
    assert landing_inventory(spark, landing.root).count() == 2
    one = landing_inventory(spark, landing.root, prefix="series=euro").collect()
    assert len(one) == 1 and one[0]["length"] > 0


def test_month_filter_prunes_landing_files(spark, landing):
    for month in ("2024-01", "2024-02", "2024-03"):
        landing.observations("dolar", month, (f"{month}-15", "1"))
    seen = read_landing(spark, landing.root, ["dolar"], ("2024-02", "2024-02"))
    plan = seen._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(series" in plan and "month" in plan.split("PartitionFilters:")[1]
    assert {r["month"] for r in seen.collect()} == {"2024-02"}
