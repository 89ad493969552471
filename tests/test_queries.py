"""Every registered query against its SQL on the smallest tables, and the driver's contract."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from fareflow.plans import QUERIES
from tests.conftest import SMALL
from tools.check import compare, connect


@pytest.fixture(scope="module")
def duck():
    connection = connect(SMALL)
    yield connection
    connection.close()


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns[:3] == ["revenue_zone", "revenue_month", "service_type"]
    assert df.count() > 0


# Few enough trips that a query for single days, bases or zones may find none.
MAY_BE_EMPTY = {
    "fhv_base_in_range", "fhv_both_unlocated", "max_tip_from_zone", "passengers_on_day",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    problem = compare(duck, queries()[name](spark, SMALL), oracle_sql()[name])
    if name in MAY_BE_EMPTY and problem == "EMPTY":
        return
    assert problem is None
