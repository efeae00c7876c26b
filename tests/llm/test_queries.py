"""Every query over sf0.001 against DuckDB where SQL can express it."""

import duckdb
import pytest

from equilibra.llm import queries

SF = "/root/testdata/sf0.001"


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(map(repr, ([None if x != x else x for x in r] for r in frame.astype(object).itertuples(index=False))))


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    ours, theirs = queries.queries()[name](spark, SF).toPandas(), con.sql(queries.oracle_sql()[name]).df()
    assert rows(ours) == rows(theirs)
