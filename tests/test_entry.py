"""Every query with SQL against DuckDB at the smallest size."""

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry
from lexweave.plans import catalog

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.sql(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return con


def canonical(df):
    def one(v):
        if pd.isna(v):
            return None
        if isinstance(v, (bool, np.bool_)):
            return str(bool(v))
        return f"{float(v):.6f}" if isinstance(v, (int, float, np.number)) else str(v)  # columns with nulls come as floats

    df = df[sorted(df.columns)]
    return sorted((tuple(map(one, row)) for row in df.itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query(spark, duck, name):
    got, want = entry.queries()[name](spark, FOLDER).toPandas(), duck.sql(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


def test_contract(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
