import os

import pytest

import __spark_entry__ as entry
import check
from airpanel.catalog import ORACLES, QUERIES

TESTDATA = "/root/testdata/sf0.001"
SOME = ["aqi", "clean_panel", "rolling_mean", "chrono_split", "comparison_table", "save_graph", "engineer_panel"]


def test_every_query_has_sql():
    assert set(QUERIES) - set(ORACLES) == set()
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(TESTDATA), reason="no test tables")
def test_queries_match_their_sql(spark):
    names = list(QUERIES) if os.environ.get("CHECK_ALL") else SOME
    assert check.compare(spark, TESTDATA, names) == []
