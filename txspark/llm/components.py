"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txspark.llm.staging import Scratch, few_rows


def connected_components(edges: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """``(id, component)`` for every id of ``edges(a, b)``; the component is its smallest id.

    Alternates large-star and small-star steps, so the rounds grow with the logarithm
    of the largest component. A hub's neighbours are reduced by a combining minimum, and the
    join back to them is an equi-join that adaptive execution may split. Self loops,
    repeated edges and both directions are allowed; no edges give no rows; null ends are ignored.
    """
    pairs = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    now = scratch.put(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{name}-0")
    state = _digest(now)
    turn = 0
    while True:
        turn += 1
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # written first, so that the join with a hub's neighbours is free to broadcast it or to split the hub
        least = scratch.put(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), f"{name}-least-{turn}")
        large = both.join(few_rows(least), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = scratch.put(large, f"{name}-large-{turn}")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(few_rows(least, large), "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = scratch.put(small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), f"{name}-{turn}")
        scratch.drop(f"{name}-large-{turn}", f"{name}-least-{turn}", f"{name}-{turn - 1}")
        was, state = state, _digest(after)
        now = after
        if was == state:
            break
    stars = now.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return stars.unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def _digest(edges: DataFrame):
    """Number of edges and a sum over their hashes: equal for equal sets."""
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)
