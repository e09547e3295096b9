"""Every registered query against its SQL at the smallest scale."""

import os
import threading

import compare
import pytest

import __spark_entry__ as contract
from askgraph.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    return compare.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, db, name):
    names, rows = compare.spark_rows(contract.queries()[name](spark, FOLDER))
    other_names, other_rows = compare.duck_rows(db, contract.oracle_sql()[name])
    assert names == other_names
    assert len(rows) == len(other_rows)
    assert rows == other_rows


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_sql_ends_when_read_in_part(name):
    """Joins may be planned otherwise below a limit; at the next scale a bad plan doesn't end."""
    folder = "/root/testdata/sf0.01"
    if os.path.isdir(folder):
        db = compare.connect(folder)
        timer = threading.Timer(60, db.interrupt)
        timer.start()
        db.execute(f"select * from ({contract.oracle_sql()[name]}) q limit 5").fetchall()
        timer.cancel()


def test_every_query_has_sql():
    assert set(QUERIES) <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["user_id", "neighbor_id", "weight"]
    assert df.count() == 16756
