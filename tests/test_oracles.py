"""Every registered query against its SQL counterpart on the given tables."""

import math
import os

import duckdb
import pytest

from pulseboard.catalog import catalog
from pulseboard.oracles import oracles

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
QUERIES = catalog()
ORACLES = oracles()


# Spark's types and their counterparts.
SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def plain(value):
    return "nan" if isinstance(value, float) and math.isnan(value) else value


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(plain(r[i]) for i in order) for r in records),
        key=lambda r: tuple((v is None, str(v)) for v in r),
    )


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    events = f"{SF_DIR}/events.parquet"
    files = f"{events}/*.parquet" if os.path.isdir(events) else events
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{files}'")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    expected = duck.sql(ORACLES[name])
    types = {name: SAME_TYPE[kind] for name, kind in result.dtypes}
    assert types == dict(zip(expected.columns, map(str, expected.types), strict=True))
    got = rows(result.columns, result.collect())
    want = rows(expected.columns, expected.fetchall())
    assert len(got) > 0
    assert got == want
