"""Running totals over a distributed order, without one task that sees all rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txspark.session import stored


def in_slices(df: DataFrame, column: str, slices: int | None = None) -> DataFrame:
    """``df`` as a written table with ``_slice``: numbers of ranges of ``column``, in its order.

    A range partitioning, by cuts that Spark samples, makes the slices; their number is that of the shuffle partitions unless given. The table is
    written once, so that no later step computes ``df`` again or samples other cuts.
    """
    ranged = df.repartitionByRange(slices, column) if slices else df.repartitionByRange(column)
    return stored(ranged.withColumn("_slice", F.spark_partition_id()), "slices")


def running(cut: DataFrame, column: str, values: dict[str, Column], fold: Callable[[Column], Column], join: Callable[[Column, Column], Column], descending: bool = False) -> DataFrame:
    """``cut`` with a column for each of ``values``: its fold over all rows up to this one in the order of ``column``, whose values differ.

    ``cut`` comes from ``in_slices``. A slice is ordered by one task; what the slices before it add up to is a row for each slice, which alone
    passes a window without partitions and is broadcast.
    """
    turn = (lambda c: F.col(c).desc()) if descending else F.col
    own = cut.groupBy("_slice").agg(*[fold(v).alias(n) for n, v in values.items()])
    earlier = Window.orderBy(turn("_slice")).rowsBetween(Window.unboundedPreceding, -1)
    before = own.select("_slice", *[fold(F.col(n)).over(earlier).alias(f"_before_{n}") for n in values])
    within = Window.partitionBy("_slice").orderBy(turn(column)).rowsBetween(Window.unboundedPreceding, 0)
    both = cut.join(F.broadcast(before), "_slice")  # a row for each slice
    return both.select(*cut.columns, *[F.when(F.col(f"_before_{n}").isNull(), fold(v).over(within)).otherwise(join(F.col(f"_before_{n}"), fold(v).over(within))).alias(n) for n, v in values.items()])
