"""Every query that has SQL gives DuckDB's rows."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from sigloom.plans import ORACLES, QUERIES
from sigloom.session import TABLES

SF = "/root/testdata/sf0.001"


def rows(df: pd.DataFrame) -> list:
    def plain(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
            return None
        return round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else v if isinstance(v, str) else str(v)

    return sorted((tuple(plain(v) for v in r) for r in df[sorted(df.columns)].astype(object).itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, db, name):
    ours = QUERIES[name](spark, SF).toPandas()
    theirs = db.execute(ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
