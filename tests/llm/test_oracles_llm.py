"""Operators that SQL can express whole, against DuckDB."""

import duckdb
import pytest

from txspark.llm.oracles import ORACLES
from txspark.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = QUERIES[name](spark, SF).toPandas(), con.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    key = [c for c in ("lang", "source", "part", "rank") if c in got.columns and "doc_id" not in got.columns] or [got.columns[0]]
    got, want = (df[sorted(df.columns)].sort_values(key).reset_index(drop=True) for df in (got, want))
    assert len(got) == len(want)
    for c in got.columns:
        close = (got[c] == want[c]) if got[c].dtype != float else (abs(got[c] - want[c]) < 1e-8)
        assert close.all(), (c, got[~close].head(3), want[~close].head(3))
