"""Every query of the library with SQL is held against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from corvid.plans import catalog

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def rows(frame):
    cols = sorted(frame.columns)
    return cols, sorted(tuple(repr(round(v, 6)) if isinstance(v, float) else str(v) for v in r) for r in frame[cols].itertuples(index=False))


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")
@pytest.mark.parametrize("name", sorted(catalog.oracles()))  # the others: test_graph_brute.py
def test_query(spark, duck, name):
    got = catalog.queries()[name](spark, DATA)
    assert rows(got.toPandas()) == rows(duck.execute(catalog.oracles()[name]).fetch_df())
