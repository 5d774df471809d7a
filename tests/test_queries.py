"""Every registered query gives the rows of its SQL."""

import pytest
from compare import connect, duck_result, spark_result

import __spark_entry__ as driver
from rowscribe.plans.catalog import QUERIES
from rowscribe.plans.oracle import ORACLE


@pytest.fixture(scope="module")
def duck(sf_dir):
    with connect(sf_dir) as con:
        yield con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= driver.queries().items()
    assert ORACLE.items() <= driver.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    expected = duck_result(duck, ORACLE[name])
    assert spark_result(QUERIES[name](spark, sf_dir)) == expected
    assert expected[1]


def test_entry(spark):
    rows = driver.entry(spark)
    assert rows.columns == ["conv_id", "text"]
    assert rows.count() == 20
