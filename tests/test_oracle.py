"""Every query against its SQL counterpart on the given tables."""

import os
from collections import Counter

import pytest

import __spark_entry__ as contract
from daybook.oracles import SQL
from daybook.queries import QUERIES

duckdb = pytest.importorskip("duckdb")

SF_DIR = os.environ.get("DAYBOOK_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def in_name_order(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, db, name):
    result = contract.queries()[name](spark, SF_DIR)
    expected = db.execute(contract.oracle_sql()[name])
    names = [column[0] for column in expected.description]
    assert sorted(result.columns) == sorted(names)
    ours = in_name_order(result.columns, result.collect())
    theirs = in_name_order(names, expected.fetchall())
    assert ours, "no rows compared"
    assert (ours - theirs, theirs - ours) == (Counter(), Counter())


def test_preview_returns_rows(spark):
    assert contract.queries()["preview"](spark, SF_DIR).count() == 10


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_query_has_sql_but_preview():
    assert set(QUERIES) - set(SQL) == {"preview"}
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())
