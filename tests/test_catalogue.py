"""Every registered query against its SQL."""

import pytest

import compare
from chunkloom.catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        assert rows
        return
    found = con.execute(ORACLES[name])
    problem = compare.difference(df.columns, rows, [d[0] for d in found.description], found.fetchall())
    assert problem is None, problem


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
