"""Every registered query against its SQL, on the smallest test tables."""

from pathlib import Path

import pytest

import __spark_entry__ as contract
from workload.check import canonical, connect
from workload.registry import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="needs the test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    result = contract.queries()[name](spark, SF)
    sql = duck.execute(contract.oracle_sql()[name])
    names = [d[0] for d in sql.description]
    assert sorted(result.columns) == sorted(names)
    assert canonical(result.columns, result.collect()) == canonical(names, sql.fetchall())


def test_entry(spark):
    assert contract.entry(spark).columns == ["invoice_date", "spend"]
