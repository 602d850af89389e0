import os

import pytest

from lakework.plans import file_queries, kept_queries, queries, temporal_queries  # noqa: F401 - importing adds queries
from tests.oracle import SF_DIR, actual, expected

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_equals_its_sql(spark, name):
    assert actual(queries.QUERIES[name](spark, SF_DIR)) == expected(queries.ORACLES[name])


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["conv_id", "text_md5", "n_lines", "first_role"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_plans(spark):
    """Filters and columns reach the scan; a latest-wins is an aggregation without a window."""
    plan = queries.QUERIES["runs_topk"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in plan and "TakeOrderedAndProject" in plan and "o_custkey" not in plan
    plan = queries.QUERIES["log_latest_wins"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "props" not in plan
