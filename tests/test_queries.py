"""Every registered query against its SQL, over the smallest given tables."""

from pathlib import Path

import pytest

import __spark_entry__ as driver
from tests.check_oracle import compare, connect
from workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="the given tables are not here")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(driver.oracle_sql()))
def test_query_equals_its_sql(spark, connection, name):
    ours, theirs, _ = compare(spark, connection, SF_DIR, name)
    assert ours == theirs


def test_every_query_of_the_library_has_sql():
    assert set(QUERIES) <= set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).columns == ["unid", "text", "meta_source", "meta_lang", "meta_size"]
