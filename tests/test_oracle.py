"""Every registered query against its SQL on the smallest tables; those without SQL must give rows."""

import pytest
from oracle_check import connect, difference

from millrace.plans import REGISTRY
from millrace.plans.registry import Tables

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", REGISTRY)
def test_query(spark, duck, name):
    found = REGISTRY[name].run(Tables(spark, FOLDER))
    assert difference(found, duck, REGISTRY[name].sql) is None


def test_entry(spark):
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).columns == ["order_date", "order_count", "revenue"]
