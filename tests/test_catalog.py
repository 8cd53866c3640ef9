import pytest

from gleaner.plans.catalog import ORACLES, QUERIES
from tests.conftest import norm, oracle


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, small, name):
    got = [r.asDict() for r in QUERIES[name](spark, small).collect()]
    assert norm(got) == norm(oracle(ORACLES[name], small))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, small, name):
    assert QUERIES[name](spark, small).columns


def test_entry(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() >= 0
