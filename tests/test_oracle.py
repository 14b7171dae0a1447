"""Every named query against its check SQL on the small tables (set STAYLINE_SF for another size)."""

import os

import pytest

from oracle import all_sql
from stayline.plans import registry
from tools.check import compare, oracle_connection

FOLDER = f"/root/testdata/sf{os.environ.get('STAYLINE_SF', '0.001')}"
QUERIES, CHECKS = registry.queries(), all_sql()
ROWS_ONLY = {"ml_scores", "ml_metrics", "ml_drivers", "segments", "model_history"}


@pytest.fixture(scope="module")
def con():
    return oracle_connection(FOLDER)


def test_only_the_stated_queries_have_no_check():
    assert set(QUERIES) - set(CHECKS) == ROWS_ONLY
    assert set(CHECKS) <= set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    if name in CHECKS:
        assert compare(df, con, CHECKS[name]) == []
    else:
        assert df.count() > 0


def test_compare_notices_differences(spark, con):
    df = spark.range(2).selectExpr("id", "id * 0.5D AS x")
    same = "SELECT CAST(0 AS BIGINT) AS id, 0e0 AS x UNION ALL SELECT 1, 0.5e0"
    assert compare(df, con, same) == []
    assert compare(df, con, same.replace("0.5e0", "0.6e0"))
    assert compare(df, con, same.replace("BIGINT", "INTEGER"))
    assert compare(df, con, same + " UNION ALL SELECT 1, 0.5e0")
    assert compare(df, con, same.replace("AS x", "AS y"))
