"""Every core query with SQL against DuckDB on the smallest tables, where they are there."""

import math
import os

import pandas as pd
import pytest

duckdb = pytest.importorskip("duckdb")
from garimpo import queries as core  # noqa: E402

DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")


def rows(df):
    def plain(v):
        if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
            return "null"
        return f"{float(v):.6g}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    return sorted(tuple(map(plain, r)) for r in df[sorted(df.columns)].astype(object).itertuples(index=False))


@pytest.fixture(scope="module")
def views():
    con = duckdb.connect()
    for f in os.listdir(DIR):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{DIR}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(core.oracle_sql()))
def test_query_equals_sql(spark, views, name):
    got, want = core.queries()[name](spark, DIR).toPandas(), views.execute(core.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry_and_names(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
