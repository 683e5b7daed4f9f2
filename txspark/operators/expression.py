"""Expression tables and differential expression."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txspark.operators.ordered import in_slices, running
from txspark.session import stored


def sample_fpkm(records: DataFrame) -> DataFrame:
    """Mean FPKM of each transcript and sample; values that are no numbers are skipped (AGG2)."""
    keys = [c for c in ("transcript_id", "gene_id", "sample_id") if c in records.columns]
    value = F.expr("try_cast(FPKM AS double)")
    return records.where("transcript_id IS NOT NULL").withColumn("_v", value).where("_v IS NOT NULL").groupBy(*keys).agg(F.avg("_v").alias("fpkm"))


def restrict_ids(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of the wanted transcripts (JN8)."""
    return df.join(ids.select("transcript_id"), "transcript_id", "left_semi")


def fpkm_matrix(long: DataFrame, samples: list[str] | None = None) -> DataFrame:
    """A column for each sample (JN6)."""
    return long.groupBy("transcript_id").pivot("sample_id", samples).agg(F.avg("fpkm"))


def fpkm_summary(long: DataFrame) -> DataFrame:
    """Mean and population deviation over the samples of a transcript (AGG3)."""
    return long.groupBy("transcript_id").agg(F.avg("fpkm").alias("fpkm_mean"), F.stddev_pop("fpkm").alias("fpkm_std"))


def variance_filter(long: DataFrame, least: float = 1.0) -> DataFrame:
    """Transcripts whose sample variance of FPKM exceeds ``least`` (AGG7)."""
    return long.groupBy("transcript_id").agg(F.var_samp("fpkm").alias("variance")).where(F.col("variance") > least)


def check_design(samples: DataFrame, fpkm: DataFrame) -> DataFrame:
    """Samples of the sheet without data; fails if the sheet lacks a column (DGE7)."""
    lacking = [c for c in ("sample_id", "condition") if c not in samples.columns]
    if lacking:
        raise ValueError(f"the sample sheet lacks {lacking}")
    return samples.select("sample_id").distinct().join(fpkm.select("sample_id"), "sample_id", "left_anti")


def _f_tail(f: np.ndarray, d1: np.ndarray, d2: np.ndarray) -> np.ndarray:
    """P(F > f) through the continued fraction of the regularised incomplete beta function (Lentz)."""
    from math import lgamma

    x = d2 / (d2 + d1 * f)
    a, b = d2 / 2, d1 / 2
    swap = x > (a + 1) / (a + b + 2)
    a, b, x = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, 1 - x, x)
    log_beta = np.array([lgamma(p + q) - lgamma(p) - lgamma(q) for p, q in zip(a, b, strict=True)])
    with np.errstate(divide="ignore", invalid="ignore"):
        front = np.exp(log_beta + a * np.log(x) + b * np.log1p(-x)) / a
    tiny = 1e-300
    c, d = np.ones_like(x), 1 - (a + b) * x / (a + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    for m in range(1, 300):
        for coefficient in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + coefficient * d
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1 + coefficient / np.where(np.abs(c) < tiny, tiny, c)
            c = np.where(np.abs(c) < tiny, tiny, c)
            h = h * d * c
    p = np.where(x <= 0, 0.0, front * h)
    return np.where(swap, 1 - p, p)


def f_tail(numerator: int, frame: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in frame:
        ok = part["f"].notna() & (part["f"] >= 0) & (part["d2"] > 0)
        p = np.full(len(part), np.nan)
        good = part[ok]
        finite = np.minimum(good["f"].to_numpy(float), 1e300)
        p[ok.to_numpy()] = _f_tail(finite, np.full(len(good), float(numerator)), good["d2"].to_numpy(float))
        yield part.assign(pval=p)


def dge_statistics(fpkm: DataFrame, samples: DataFrame, level: str = "transcript") -> DataFrame:
    """(feature, id, fc, f, d2): F of the nested linear models of log2(FPKM + 1) with and without the condition (DGE1, DGE2, DGE4).

    Both models have the library size of the sample, the log2 of its summed FPKM, as covariate. With two conditions the
    residuals follow from sums over the samples of a feature, by partialling the covariate out of value and condition alike,
    so this is one aggregation. The fold change is 2 to the coefficient of the second condition. Genes are sums of their transcripts. At least
    four samples are needed.
    """
    key = "transcript_id" if level == "transcript" else "gene_id"
    rows = fpkm.groupBy(F.col(key).alias("id"), "sample_id").agg(F.sum("fpkm").alias("fpkm"))
    size = fpkm.groupBy("sample_id").agg(F.log2(F.sum("fpkm") + 1).alias("z"))
    names = samples.select("condition").distinct().orderBy("condition")
    second = names.agg(F.max("condition").alias("last"), F.count("*").alias("n")).first()
    if second["n"] != 2:
        raise ValueError(f"{second['n']} conditions; the comparison needs two")
    design = samples.select("sample_id", (F.col("condition") == second["last"]).cast("double").alias("x"))
    data = rows.join(size, "sample_id").join(design, "sample_id").withColumn("y", F.log2(F.col("fpkm") + 1))
    s = lambda e: F.sum(F.expr(e))
    sums = data.groupBy("id").agg(F.count("*").alias("n"), *[s(e).alias(a) for a, e in (("sy", "y"), ("sx", "x"), ("sz", "z"), ("syy", "y*y"), ("sxx", "x*x"), ("szz", "z*z"), ("sxy", "x*y"), ("sxz", "x*z"), ("syz", "y*z"))])
    centred = lambda a, b: f"(s{a}{b} - s{a}*s{b}/n)"
    c = sums.selectExpr("id", "n", *[f"{centred(a, b)} AS {a}{b}" for a, b in ("yy", "xx", "zz", "xy", "xz", "yz")])
    flat = "zz < 1e-12"
    c = c.selectExpr("id", "n", f"yy - IF({flat}, 0, yz*yz/zz) AS r0", f"xx - IF({flat}, 0, xz*xz/zz) AS vx", f"xy - IF({flat}, 0, xz*yz/zz) AS vxy")
    c = c.selectExpr("id", "n", "r0", "IF(vx < 1e-12, NULL, vxy/vx) AS beta", "IF(vx < 1e-12, NULL, greatest(r0 - vxy*vxy/vx, 0)) AS r1")
    f = "CASE WHEN n < 4 OR beta IS NULL THEN NULL WHEN r1 < 1e-12 THEN IF(r0 < 1e-12, 0, 1e300) ELSE (r0 - r1) / (r1 / (n - 3)) END"
    return c.selectExpr(f"'{level}' AS feature", "id", "pow(2, beta) AS fc", f"CAST({f} AS double) AS f", "CAST(n - 3 AS double) AS d2")


def bh_adjust(df: DataFrame, p: str = "pval", name: str = "qval", slices: int | None = None) -> DataFrame:
    """Benjamini-Hochberg q-values; null p has null q (DGE3).

    Equal p are one row before the ordered windows, which see (p, count) of a slice of the p-values each. The table is written once and read from there.
    """
    df = stored(df, "tested")  # it is read twice
    counts = df.where(F.col(p).isNotNull()).groupBy(F.col(p).cast("double").alias("_p")).agg(F.count("*").alias("_n"))
    cut = in_slices(counts, "_p", slices)
    total = cut.agg(F.sum("_n")).first()[0] or 0
    ranked = running(cut, "_p", {"_rank": F.col("_n")}, F.sum, lambda a, b: a + b)
    q = running(ranked, "_p", {"_q": F.col("_p") * F.lit(total) / F.col("_rank")}, F.min, F.least, descending=True)
    q = q.select("_p", F.least(F.lit(1.0), "_q").alias(name))
    return df.join(q, df[p] == q["_p"], "left").drop("_p")


def dge_test(fpkm: DataFrame, samples: DataFrame, level: str = "transcript") -> DataFrame:
    """(feature, id, fc, pval, qval) of each transcript or gene (DGE1 to DGE4); sort with ``sort_by_p`` at the sink."""
    schema = "feature string, id string, fc double, f double, d2 double, pval double"
    tested = dge_statistics(fpkm, samples, level).mapInPandas(lambda it: f_tail(1, it), schema)
    clean = tested.withColumn("pval", F.nanvl("pval", F.lit(None).cast("double")))
    return bh_adjust(clean).select("feature", "id", "fc", "pval", "qval")


def ma_table(dge: DataFrame, mean: DataFrame | None = None) -> DataFrame:
    """log10(fc + 1), log2(fc + 0.1) and whether q < 0.05, of rows where all are finite (DGE5)."""
    out = dge.select("id", F.log10(F.col("fc") + 1).alias("a"), F.log2(F.col("fc") + 0.1).alias("m"), (F.col("qval") < 0.05).alias("significant"))
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    return out.where(finite("a") & finite("m") & F.col("significant").isNotNull())


def significant(dge: DataFrame, q: float = 0.05, column: str = "qval") -> DataFrame:
    """Rows with a q-value under ``q`` (PRJ17)."""
    return dge.where(F.col(column) < q)


def significant_count(dge: DataFrame, q: float = 0.05) -> DataFrame:
    """One row: their number (DGE6)."""
    return dge.agg(F.count_if(F.col("qval") < q).alias("n_significant"))


def dge_summary(fpkm: DataFrame, samples: DataFrame, kept: DataFrame) -> DataFrame:
    """One row of counts before and after the filter, with status ``skipped`` for a single condition (AGG8)."""
    one = F.lit(1).alias("_k")
    left = fpkm.agg(F.count("*").alias("input_rows"), F.count_distinct("transcript_id").alias("transcripts"), F.count_distinct("gene_id").alias("genes")).select("*", one)
    right = kept.agg(F.count_distinct("transcript_id").alias("kept")).select("*", one)
    conditions = samples.agg(F.count_distinct("condition").alias("conditions")).select("*", one)
    status = F.when(F.col("conditions") < 2, "skipped").otherwise("completed")
    return left.join(right, "_k").join(conditions, "_k").withColumn("status", status).drop("_k")


def sort_by_p(dge: DataFrame) -> DataFrame:
    """By p-value, nulls last (SRT2)."""
    return dge.orderBy(F.col("pval").asc_nulls_last(), "id")
