"""Registration of queries with their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txspark.plans.fixtures import Inputs, with_fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
NOISE, DIGITS = 9, 6


def rounded(df: DataFrame) -> DataFrame:
    """Doubles at nine and then at six digits, with one zero: the first step takes the noise of sums away, so that ties round alike."""
    return df.select(*[(F.round(F.round(F.col(f"`{f.name}`"), NOISE), DIGITS) + F.lit(0.0)).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`") for f in df.schema.fields])


def query(oracle: str | None = None):
    """Register a function of ``Inputs`` under its name."""

    def register(build: Callable[[Inputs], DataFrame]):
        QUERIES[build.__name__] = lambda spark, sf_dir: rounded(build(Inputs(spark, sf_dir)))
        if oracle:
            ORACLES[build.__name__] = with_fixtures(oracle)
        return build

    return register
