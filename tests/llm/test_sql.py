"""The queries of the operators that SQL can state, against DuckDB."""

import duckdb
import pytest

from lexweave.llm import queries
from tests.test_entry import canonical

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query(spark, name):
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for t in ("documents", "pages", "benchmark", "labels"):
        con.sql(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    got, want = queries.QUERIES[name](spark, FOLDER).toPandas(), con.sql(queries.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and canonical(got) == canonical(want)
