"""Every query against its SQL, on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__
from quotemill.plans.catalogue import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def plain(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
        return None
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    return float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v


def rows(df: pd.DataFrame) -> list:
    return sorted((tuple(plain(v) for v in r) for r in df[sorted(df.columns)].astype(object).itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, con, name):
    got, want = __spark_entry__.queries()[name](spark, SF).toPandas(), con.sql(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry_and_registration(spark):
    assert __spark_entry__.entry(spark).columns[:2] == ["trade_date", "symbol"]
    assert set(ORACLE) <= set(QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_archive_round_trip(spark):
    rows = QUERIES["archive_scan"](spark, SF).collect()
    got, short = [r for r in rows if r["security"] != "short line"], [r for r in rows if r["security"] == "short line"]
    assert short and all(r["close"] is None and r["extras"] == "{}" for r in short)  # a row that lacks fields stays
    suppliers = {r["s_name"]: r for r in spark.read.parquet(f"{SF}/supplier.parquet").collect()}
    assert {r["security"] for r in got} == set(suppliers)
    for r in got:
        assert r["close"] == pytest.approx(1000 + round(abs(suppliers[r["security"]]["s_acctbal"]), 2) % 1000)
        assert str(r["trade_date"]) == "2025-10-03" and r["extras"] == f'{{"PREV_CL_PR":"{suppliers[r["security"]]["s_nationkey"]}"}}'
