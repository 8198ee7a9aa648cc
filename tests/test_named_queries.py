"""Every named query against its SQL on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from docweave.plans import named

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{DATA}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def rows(df):
    columns = sorted(df.columns)
    return columns, sorted(tuple("" if pd.isna(v) else f"{v:.6g}" if isinstance(v, float) else str(v) for v in r) for r in df[columns].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(named.queries()))
def test_query(spark, sql, name):
    found = named.queries()[name](spark, DATA)
    if name in named.oracle_sql():
        assert rows(found.toPandas()) == rows(sql.execute(named.oracle_sql()[name]).df())
    else:
        assert found.count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
