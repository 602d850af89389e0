import os

import pytest

from lakework.llm import queries
from tests.oracle import SF_DIR, actual, expected

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    assert actual(queries.QUERIES[name](spark, SF_DIR)) == expected(queries.ORACLES[name])


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_is_whole(spark, name):
    if name == "op12_wavelet_spelling":
        return  # its rows are words
    table, key = {"op6_url_expressions": ("pages", "page_id"), "op9_warc_revisits": ("pages", "page_id"), "op11_recursive_turns": ("conversations", "conv_id")}.get(name, ("documents", "doc_id"))
    found = queries.QUERIES[name](spark, SF_DIR)
    ids = {r[0] for r in found.select(key).distinct().collect()}
    every = {r[0] for r in spark.read.parquet(f"{SF_DIR}/{table}.parquet").select(key).collect()}
    assert ids <= every if name == "op7_poisson_mixing" else ids == every
