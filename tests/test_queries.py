"""Every registered query beside its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from checks.compare import connect, difference
from starfit.plans import registry


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(registry.queries()) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, sf_dir, con, name):
    ours = entry.queries()[name](spark, sf_dir).toPandas()
    theirs = con.execute(entry.oracle_sql()[name]).fetch_df()
    assert difference(ours, theirs) is None


def test_entry(spark, sf_dir):
    rows = entry.entry(spark).orderBy("step").collect()
    assert [r.step for r in rows] == [1, 2, 3, 4, 5, 6, 7]
