"""Every query with SQL against DuckDB on the same tables."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from txspark.plans.catalogue import ORACLES, QUERIES
from txspark.plans.fixtures import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def canonical(df: pd.DataFrame) -> list[tuple]:
    def value(v):
        if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
            return ""
        if isinstance(v, bool):
            return str(v)
        if isinstance(v, (int, float)) or type(v).__module__ == "numpy" or type(v).__name__ == "Decimal":
            return str(bool(v)) if type(v).__name__ == "bool" else f"{round(float(v), 5) + 0.0:.5f}"
        return str(v)

    return sorted(tuple(value(v) for v in row) for row in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, duck, name):
    got, want = QUERIES[name](spark, SF).toPandas(), duck.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    a, b = canonical(got), canonical(want)
    assert len(a) == len(b) and len(a) > 0
    wrong = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
    assert not wrong, wrong[:3]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())
