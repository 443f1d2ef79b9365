"""Every registered query against its SQL oracle, on whole tables."""

import os

import duckdb
import pytest

from tidewell.catalog.oracles import ORACLES
from tidewell.catalog.queries import QUERIES
from tidewell.operators import joins

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for file in os.listdir(SF_DIR):
        connection.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SF_DIR}/{file}'")
    return connection


SQL_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "date": "DATE",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()


JOINING = [
    "cdc_delete",
    "cdc_incremental",
    "cdc_replay",
    "cdc_replay_orders",
    "cdc_update",
    "city_features_gaps",
    "features_top10",
    "login_rate_by_city",
    "lookup_state",
    "rank_by_city",
    "stream_apply",
    "summary_by_state",
    "users_by_city",
]


@pytest.mark.parametrize("name", JOINING)
def test_query_equals_oracle_at_scale(name, at_scale, duck, monkeypatch):
    """Lookups are written, none is small enough to broadcast, and the heavier keys are taken as hot."""
    monkeypatch.setattr(joins, "HOT_FLOOR", 4)
    check(name, at_scale, duck)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(name, spark, duck):
    check(name, spark, duck)


def check(name, spark, duck):
    result = QUERIES[name](spark, SF_DIR)
    expected = duck.execute(ORACLES[name])
    columns = [column[0] for column in expected.description]
    types = {column[0]: str(column[1]) for column in expected.description}
    assert {name: SQL_TYPES[kind] for name, kind in result.dtypes} == types
    got = comparable(result.columns, [tuple(row) for row in result.collect()])
    want = comparable(columns, expected.fetchall())
    assert len(want) > 0
    assert got == want
