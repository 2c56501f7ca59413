"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as registry
from catalogue.oracles import ORACLES
from catalogue.queries import QUERIES
from check import compare, oracle_connection

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")



@pytest.fixture(scope="module")
def con():
    return oracle_connection(DATA)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, con, name):
    assert compare(spark, con, DATA, name) == ""


def test_only_images_lack_sql():
    assert set(QUERIES) - set(ORACLES) == {"image_table"}  # its bytes are checked by image_pixels


def test_entry_has_a_stable_schema(spark):
    df = registry.entry(spark)
    assert df.columns[0] == "date" and df.columns[-1] == "polygon_id" and df.count() > 0
