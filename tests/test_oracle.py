"""Every registered query against its SQL on the smallest tables."""

import pytest

from tools.check import compare, connect
from workload.oracle import ORACLE
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees(spark, con, name):
    assert compare(spark, con, SF, name) is None


def test_entry(spark):
    import __spark_entry__ as driver

    rows = driver.entry(spark).collect()
    assert len(rows) == 10 and rows[0].vulnerability_rank == 1
