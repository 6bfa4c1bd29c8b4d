"""Every registered query against its SQL twin, as the driver does it."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from energylake.queries import REGISTRY

DATA = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in sorted(os.listdir(DATA)):
        con.execute(f"create view {file.split('.')[0]} as select * from '{DATA}/{file}'")
    return con


def canonical(names, rows):
    """Sorted column names, and rows in that column order, sorted as text."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(
        (tuple(row[i] for i in order) for row in rows), key=repr)


def test_entry(spark):
    rows = entry(spark).collect()
    assert rows and all(r["mean_per_unit"] > 0 for r in rows)


def test_every_query_has_sql():
    assert set(REGISTRY) <= set(queries())
    assert set(REGISTRY) <= set(oracle_sql())


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query(spark, duck, name):
    got = queries()[name](spark, DATA)
    want = duck.execute(oracle_sql()[name])
    names, rows = canonical(got.columns, got.collect())
    want_names, want_rows = canonical([d[0] for d in want.description], want.fetchall())
    assert names == want_names
    assert len(rows) == len(want_rows) > 0
    wrong = [(a, b) for a, b in zip(rows, want_rows) if repr(a) != repr(b)]
    assert not wrong, (len(wrong), len(rows), wrong[:3])
