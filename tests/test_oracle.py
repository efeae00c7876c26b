"""Every registered query against its DuckDB oracle SQL (sf0.001)."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tools.check_oracle import TABLES, compare


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_oracle():
    """Every query of the library itself; ``tests/llm`` holds the others against brute force."""
    assert set(entry.queries()) - set(entry.optional_queries()) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, key):
    res = compare(spark, con, key, SF_SMALL)
    assert res["cols_equal"], res
    assert res["spark_rows"] == res["oracle_rows"] > 0, res
    assert res["exact"], res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:4] == ["Patient_id", "Date", "entry_resource_code_coding_display", "Start_time"]
