"""The registered queries with SQL against that SQL, on the small tables."""

import os

import duckdb
import pytest

from __spark_entry__ import SMOKE_DIR, oracle_sql, queries
from tidemark.llm.queries import ENTRIES

DATA = os.environ.get("CATALOGUE_DIR", SMOKE_DIR)


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in os.listdir(DATA):
        connection.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{DATA}/{name}'")
    return connection


def test_all_are_registered():
    assert set(ENTRIES) <= set(queries()) and "pipeline" in queries()


@pytest.mark.parametrize("name", [name for name, (_, sql) in ENTRIES.items() if sql])
def test_query_equals_sql(spark, db, name):
    ours = queries()[name](spark, DATA)
    names = sorted(ours.columns)
    theirs = db.sql(oracle_sql()[name])
    assert sorted(theirs.columns) == names
    expected = theirs.project(", ".join(f'"{c}"' for c in names)).fetchall()
    got = [tuple(r) for r in ours.select(*names).collect()]
    assert len(got) > 0
    assert sorted(map(str, got)) == sorted(map(str, expected))
