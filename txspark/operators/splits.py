"""Reproducible stratified splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SIZES = (0.7, 0.15, 0.15)
SEED = 99


def check_sizes(sizes: tuple[float, float, float]) -> None:
    train, *rest = sizes
    if not 0 < train < 1 or any(not 0 <= x < 1 for x in rest) or abs(sum(sizes) - 1) > 1e-6:
        raise ValueError(f"sizes {sizes}: train within (0, 1), the others within [0, 1), together 1")


def stratified_split(df: DataFrame, label: str | None, sizes: tuple[float, float, float] = SIZES, seed: int = SEED, key: str = "transcript_id") -> DataFrame:
    """``df`` with ``split``: train, validation or test, in the same shares of each label (SPL1).

    Rows are ordered by md5 of seed and id. Ranks within a label come from counts of hash prefixes and from ranks within a
    prefix, so no task sees a whole label. Cuts are at the rounded shares. Without a label, or with one value of it, there is one stratum.
    """
    check_sizes(sizes)
    hashed = df.withColumn("_h", F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary"))).withColumn("_p", F.substring("_h", 1, 3))
    stratum = F.col(label).cast("string") if label else F.lit("")
    hashed = hashed.withColumn("_l", F.coalesce(stratum, F.lit("")))
    counts = hashed.groupBy("_l", "_p").agg(F.count("*").alias("_n"))
    by = Window.partitionBy("_l")
    starts = counts.select("_l", "_p", F.sum("_n").over(by).alias("_all"), (F.sum("_n").over(by.orderBy("_p")) - F.col("_n")).alias("_start"))
    rank = F.row_number().over(Window.partitionBy("_l", "_p").orderBy("_h", key)) + F.col("_start")
    first, second = F.round(F.col("_all") * sizes[0]), F.round(F.col("_all") * (sizes[0] + sizes[1]))
    split = F.when(F.col("_r") <= first, "train").when(F.col("_r") <= second, "validation").otherwise("test")
    return hashed.join(starts, ["_l", "_p"]).withColumn("_r", rank).withColumn("split", split).select(*df.columns, "split")


def label_distribution(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """Rows of each label, null included, and their share of the table or of each ``by`` (AGG1)."""
    keys = [by] if by else []
    counts = df.groupBy(*keys, F.col(label).cast("string").alias("label")).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy(*keys)), 4))
