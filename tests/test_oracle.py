import pytest

import check
import workload.files  # noqa: F401 - registers its queries
from workload.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check.connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    ok, note = check.compare(spark, con, SF, name)
    assert ok, note


def test_most_queries_have_check_sql():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == {"stl_by_key", "forecast_by_key", "kmeans_sweep", "kmeans_final", "pca_2d"}
