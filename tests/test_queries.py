"""Every registered query against its SQL on the given tables."""

import pytest
from oracle import differences

import __spark_entry__ as contract

QUERIES = contract.queries()
ORACLES = contract.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf):
    if name in ORACLES:
        assert differences(spark, sf, QUERIES[name], ORACLES[name]) == ""
    else:
        assert QUERIES[name](spark, sf).count() > 0


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["event_type", "day", "v"]
    assert df.count() > 0
