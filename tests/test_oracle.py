"""Every catalogue query against its DuckDB twin (or rows only) at sf0.001."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck

SLOW = {"forest_model", "forest_metrics", "stream_batch_metrics"}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", [k for k in queries() if k not in SLOW])
def test_query_matches_oracle(spark, con, key):
    ok, msg = compare(spark, key, SF_SMALL, con)
    assert ok, msg


def test_every_sql_key_is_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns == ["page", "rank"]
    assert df.count() > 0


def test_no_python_udfs_in_plans(spark):
    from quarry.plans.explain import has_python_eval

    for key in ("close_pairs", "trending_tags", "link_lists", "class_metrics", "csv_strict_scan"):
        assert not has_python_eval(queries()[key](spark, SF_SMALL)), key
