"""Standard and min-max scaling with statistics that are a small table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("standard", "minmax")
STATS = T.StructType([T.StructField(n, t) for n, t in (("position", T.IntegerType()), ("feature", T.StringType()), ("kind", T.StringType()), ("center", T.DoubleType()), ("scale", T.DoubleType()))])


def numeric_columns(df: DataFrame, skip: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.LongType, T.IntegerType, T.ShortType)) and f.name not in skip]


def fit_scaler(df: DataFrame, kind: str = "standard", label: str | None = None, keys: tuple[str, ...] = ("transcript_id", "split")) -> DataFrame:
    """(position, feature, kind, center, scale) from one aggregation over all numeric columns (SCL1, SCL2).

    Standard: mean and population deviation; min-max: minimum and range. A scale of zero counts as one.
    """
    if kind not in KINDS:
        raise ValueError(f"unknown scaler {kind!r}; one of {KINDS}")
    names = numeric_columns(df, (*keys, label) if label else keys)
    c = {n: F.col(f"`{n}`") for n in names}
    pair = (lambda n: (F.avg(c[n]), F.stddev_pop(c[n]))) if kind == "standard" else (lambda n: (F.min(c[n]), F.max(c[n]) - F.min(c[n])))
    row = df.agg(*[x.cast("double") for n in names for x in pair(n)]).first() if names else ()
    stats = [(i, n, kind, row[2 * i], 1.0 if not row[2 * i + 1] else row[2 * i + 1]) for i, n in enumerate(names)]
    return df.sparkSession.createDataFrame(stats, STATS)


def apply_scaler(df: DataFrame, stats: DataFrame, strict: bool = True) -> DataFrame:
    """(x - center) / scale for each column of the statistics (SCL4).

    A missing column fails if ``strict``; otherwise it is added as 0 before scaling, and other numeric columns stay as they are.
    """
    known = {r["feature"]: (r["center"], r["scale"]) for r in stats.collect()}
    missing = [n for n in known if n not in df.columns]
    if missing and strict:
        raise ValueError(f"columns of the scaler are missing: {missing}")
    scaled = lambda n, x: ((x.cast("double") - F.lit(known[n][0])) / F.lit(known[n][1])).alias(n)
    return df.select(*[scaled(c, F.col(f"`{c}`")) if c in known else F.col(f"`{c}`") for c in df.columns], *[scaled(n, F.lit(0.0)) for n in missing])


def scale_splits(df: DataFrame, kind: str = "standard", label: str | None = None) -> tuple[DataFrame, DataFrame]:
    """All rows scaled with the statistics of ``split = 'train'``, and these statistics (SCL3)."""
    stats = fit_scaler(df.where("split = 'train'"), kind, label)
    return apply_scaler(df, stats), stats
