"""Every registered query against its SQL, at the smallest scale."""

import os

import pytest

from workload import compare
from workload.oracles import ORACLES
from workload.spark_queries import QUERIES

FOLDER = "/root/testdata/sf0.001"

# At this scale no segment has more than ten orders a week, so there is no second page.
EMPTY_HERE = ("page_fanout", "listing_gaps")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")


@pytest.fixture(scope="module")
def connection():
    return compare.connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, connection, name):
    problem = compare.difference(spark, connection, FOLDER, name)
    assert problem in ((None, "no rows") if name in EMPTY_HERE else (None,))
