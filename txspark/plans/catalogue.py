"""All queries of the reference's operators, and the flagship among them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txspark.plans import annotation_queries, feature_queries, file_queries, model_queries, track_queries  # noqa: F401  they register themselves
from txspark.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "flagship"]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean, maximum and coverage of a signal and the names of overlapping entries of every interval."""
    return QUERIES["interval_profile"](spark, sf_dir)
