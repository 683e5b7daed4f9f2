"""Gapless ranks over a distributed order, without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A table is cut into about this many slices, of LEAST to MOST rows.
SLICES, LEAST, MOST = 1024, 500, 200_000


def with_ranks(df: DataFrame, total: int, cell: str, tie: list[Column | str], name: str) -> DataFrame:
    """Add ``name``: the place of a row, from 0 without gaps, in the order of ``cell``, then of slices of the cell.

    ``cell`` is a non-null integer column with a bounded number of values, ``total`` the number of rows. A cell with
    more rows than a slice is cut into slices by a hash of ``tie``, which also orders the rows of a slice, so a hot cell is
    dealt over many tasks. Only the counts of slices, not rows, pass through a window without partitions.
    ``df`` must give the same rows each time it is read.
    """
    rows = min(max(total // SLICES, LEAST), MOST)
    sizes = df.groupBy(cell).agg(F.ceil(F.count("*") / F.lit(rows)).cast("long").alias("_slices"))
    # a row for each cell, which are few by contract
    cut = df.join(F.broadcast(sizes), cell).withColumn("_part", F.struct(cell, F.pmod(F.xxhash64(*tie), "_slices").alias("slice"))).drop("_slices")
    counts = cut.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*tie))
    return cut.withColumn("_place", place).join(starts, "_part").withColumn(name, F.col("_start") + F.col("_place") - 1).drop("_part", "_start", "_place")
