"""Every registered query on the smallest tables, beside its SQL where there is some."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    if name in ORACLES:
        assert difference(df, duck.sql(ORACLES[name])) is None
    else:
        assert df.count() > 0
