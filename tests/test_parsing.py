from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ratelake.functions.dates import next_month, whole_days
from ratelake.functions.parsing import is_bad_date, is_coerced, parse_date, parse_decimal
from ratelake.plans.prepare import prepare

DATES = {
    "2024-01-02": (date(2024, 1, 2), False),
    "2024-1-2": (date(2024, 1, 2), False),
    "": (None, False),
    " 2024-01-02": (None, True),
    "2024-01-02T00:00": (None, True),
    "2024-13-01": (None, True),
    "2024": (None, True),
    None: (None, False),
}

NUMBERS = {
    "900,50": 900.5,
    "1.234,56": None,
    " 900.5 ": 900.5,
    "1e3": 1000.0,
    "1.0d": None,
    "1_000": None,
    "nan": None,
    "None": None,
    "0x1A": None,
    "": None,
    "-7": -7.0,
    "+.5": 0.5,
    "inf": float("inf"),
    None: None,
}


def test_dates(spark):
    df = spark.createDataFrame([(t,) for t in DATES], "t string")
    got = df.select("t", parse_date(F.col("t")), is_bad_date(F.col("t"))).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == DATES


def test_numbers(spark):
    df = spark.createDataFrame([(t,) for t in NUMBERS], "t string")
    got = {r[0]: r[1] for r in df.select("t", parse_decimal(F.col("t"))).collect()}
    assert got == NUMBERS


def test_spanish_thousands_are_an_option(spark):
    df = spark.createDataFrame([("1.234,56",), ("900,5",), ("x",)], "t string")
    got = df.select(parse_decimal(F.col("t"), "es"), is_coerced(F.col("t")), is_coerced(F.col("t"), "es")).collect()
    assert [tuple(r) for r in got] == [(1234.56, True, False), (900.5, False, False), (None, True, True)]
    with pytest.raises(ValueError):
        parse_decimal(F.col("t"), "fr")


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=32), min_size=1, max_size=50))
def test_any_number_survives_the_comma(spark, values):
    df = spark.createDataFrame([(v, repr(float(v)).replace(".", ",")) for v in values], "v double, t string")
    assert all(r[0] == r[1] for r in df.select("v", parse_decimal(F.col("t"))).collect())


def test_month_step_and_day_difference(spark):
    df = spark.createDataFrame([(date(2024, 1, 31), datetime(2024, 1, 1, 12), datetime(2024, 1, 3, 11))], "d date, a timestamp, b timestamp")
    got = df.select(next_month(F.col("d")), whole_days(F.col("a"), F.col("b"))).first()
    assert tuple(got) == (date(2024, 2, 1), 1)


def test_prepare_types_fills_and_stamps(spark):
    text = spark.createDataFrame(
        [("2024-01-03", None, "3"), ("2024-01-01", "1.234,5", "1,5"), ("2024-01-02", "2,5", None)],
        "Fecha string, a string, b string",
    )
    got = prepare(text, datetime(2024, 2, 1), "somewhere", {"run": 5}).orderBy("Fecha").collect()
    assert [(r["Fecha"].day, r["a"], r["b"]) for r in got] == [(1, None, 1.5), (2, 2.5, 1.5), (3, 2.5, 3.0)]
    assert {(r["ingestion_timestamp"], r["data_source"], r["run"]) for r in got} == {
        (datetime(2024, 2, 1), "somewhere", 5)
    }


def test_prepare_fails_on_bad_dates(spark):
    text = spark.createDataFrame([("01/02/2024", "1")], "Fecha string, a string")
    with pytest.raises(PySparkException, match="not a yyyy-mm-dd date"):
        prepare(text, datetime(2024, 2, 1)).collect()
