"""Every registered query against its SQL on the small tables."""

import math
import os

import duckdb
import pytest

from __spark_entry__ import SMOKE_DIR, entry, oracle_sql, queries
from catalogue import ENTRIES

DATA = os.environ.get("CATALOGUE_DIR", SMOKE_DIR)
# The SQL type each Spark type is expected to face.
TYPES = {
    "bigint": {"BIGINT"}, "int": {"INTEGER"}, "double": {"DOUBLE"}, "string": {"VARCHAR"}, "date": {"DATE"},
    "timestamp_ntz": {"TIMESTAMP"}, "boolean": {"BOOLEAN"},
}


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in os.listdir(DATA):
        connection.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{DATA}/{name}'")
    return connection


def comparable(rows):
    def cell(value):
        if value is None:
            return "-"
        return f"{value:.12g}" if isinstance(value, float) and not math.isnan(value) else str(value)

    return sorted(tuple(map(cell, row)) for row in rows)


def test_each_query_has_sql():
    assert set(ENTRIES) <= set(queries())
    assert set(ENTRIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(ENTRIES))
def test_query_equals_sql(spark, db, name):
    ours = queries()[name](spark, DATA)
    names = sorted(ours.columns)
    theirs = db.sql(oracle_sql()[name])
    assert sorted(theirs.columns) == names
    facing = dict(zip(theirs.columns, map(str, theirs.types), strict=True))
    assert {c: facing[c] for c, t in ours.dtypes if facing[c] not in TYPES[t]} == {}
    expected = theirs.project(", ".join(f'"{c}"' for c in names)).fetchall()
    rows = [tuple(r) for r in ours.select(*(f"`{c}`" for c in names)).collect()]
    assert len(rows) > 0
    assert comparable(rows) == comparable(expected)


def test_entry(spark):
    assert entry(spark).count() == 3
