"""Every registered query against its DuckDB oracle on the smallest scale: same
columns, same row count, same multiset of values (floats compared to 9 digits)."""

import decimal
import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from kestrel.plans.catalog import QUERIES
from kestrel.plans.oracle import ORACLE
from kestrel.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, (float, decimal.Decimal)):
        return f"{float(v):.9g}"
    if isinstance(v, pd.Timestamp):
        v = v.to_pydatetime()
    return v.isoformat(sep=" ") if hasattr(v, "isoformat") else str(v)


def _bag(df: pd.DataFrame):
    cols = sorted(df.columns)
    return sorted("|".join(_norm(r[c]) for c in cols) for r in df[cols].to_dict("records"))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    got = E.queries()[name](spark, SF).toPandas()
    want = duck.execute(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert _bag(got) == _bag(want)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["id", "final"]
    assert df.count() >= 0
