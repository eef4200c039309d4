"""Every registered query on the smallest tables: equal to its SQL oracle, or at least some rows."""

import os

import pytest

from panelspark.queries import oracles, runners
from tests.oracle import compare, connect

ROOT = os.environ.get("PANELSPARK_TESTDATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(ROOT), reason="test tables are not mounted")

# At this size a class of the panel can be too small for the yearly models.
QUERIES = runners()


@pytest.fixture(scope="module")
def con():
    return connect(ROOT)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"ml_model_results", "ml_year_models"}))
def test_query(spark, con, name):
    assert compare(spark, con, QUERIES[name], oracles().get(name), ROOT) == ""
