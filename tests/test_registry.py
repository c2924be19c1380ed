"""Every registered query against its oracle on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle_check import compare, connect

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no benchmark tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    build = entry.queries()[name]
    if name in entry.oracle_sql():
        assert compare(spark, duck, build, entry.oracle_sql()[name], SF_DIR) is None
    else:
        assert build(spark, SF_DIR).count() >= 0


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns[:4] == ["ingest_date", "district", "bedrooms", "currency"]
    assert frame.count() > 0
