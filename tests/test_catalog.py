import pytest
from conftest import against_sql

from lodestream.plans import catalog

ORACLES = catalog.oracle_sql()
QUERIES = catalog.queries()


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_query_equals_its_sql(spark, sf_dir, name):
    ours, theirs = against_sql(spark, sf_dir, QUERIES[name], ORACLES[name])
    assert ours == theirs


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_query_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
