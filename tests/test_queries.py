"""Every registered query against its SQL in DuckDB, on whole tables."""

import math
import os

import duckdb
import pytest

from ratelake.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("RATELAKE_TEST_DIR", "/root/testdata/sf0.001")
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(SF_DIR):
        name = file.removesuffix(".parquet")
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{file}'")
    return con


def comparable(value):
    return "NaN" if isinstance(value, float) and math.isnan(value) else value


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = sorted((tuple(comparable(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name not in ORACLES:
        assert got
        return
    answer = duck.sql(ORACLES[name])
    assert sorted(answer.columns) == columns
    types = dict(zip(answer.columns, map(str, answer.types)))
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    at = [answer.columns.index(c) for c in columns]
    assert got == sorted((tuple(comparable(r[i]) for i in at) for r in answer.fetchall()), key=repr)
