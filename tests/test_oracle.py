"""Every registered query against its SQL in a second engine, whole tables."""

import os

import pytest
from compare import compare, oracle

from __spark_entry__ import entry
from tallyloom.plans.oracle import ORACLES
from tallyloom.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return oracle(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, name):
    count, problems = compare(QUERIES[name](spark, SF_DIR), connection, ORACLES[name])
    assert not problems
    assert count > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_is_the_detailed_report(spark):
    report = entry(spark)
    assert report.columns[:3] == ["month", "year", "month_num"]
    assert report.count() > 0
