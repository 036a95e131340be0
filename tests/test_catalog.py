"""Every registered query beside its SQL on the smallest data."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, differences

SF = "/root/testdata/sf0.001"
QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, duck, name):
    assert name in QUERIES
    assert differences(spark, duck, name, QUERIES[name], SQL[name], SF) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_without_sql(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["idx", "title", "date", "url"]
    assert df.count() > 0


def test_no_vacuous_sql(duck):
    """A comparison of two empty results would prove nothing."""
    empty = [name for name, sql in SQL.items() if not duck.execute(sql).fetchone()]
    assert not empty
