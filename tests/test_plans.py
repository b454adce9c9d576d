"""Every registered query against its DuckDB twin on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from docket import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def cell(v):
    if pd.isna(v):
        return None
    return f"{float(v):.9g}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


def same(spark_rows, duck_rows):
    assert sorted(spark_rows.columns) == sorted(duck_rows.columns)
    columns = sorted(spark_rows.columns)
    as_rows = lambda df: sorted([tuple(map(cell, r)) for r in df[columns].itertuples(index=False)], key=str)
    assert as_rows(spark_rows) == as_rows(duck_rows)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, con, name):
    rows = registry.queries()[name](spark, SF).toPandas()
    if name in registry.oracles():
        same(rows, con.sql(registry.oracles()[name]).df())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 40
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
