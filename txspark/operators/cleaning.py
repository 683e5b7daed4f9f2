"""Rules that turn an assembled feature table into a clean one."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txspark.functions.scalars import sanitize_name, strip_rank_suffix

#: Column families: statistics of tracks are 0 where missing; structure and k-mer columns must be there.
ZERO_PREFIXES = ("min_", "max_", "mean_", "std_", "sum_", "cov_")
STRUCTURE_PREFIX = "ss_"


def _is_kmer(name: str) -> bool:
    return name.startswith(("0", "1")) or "mer_SVD" in name or "mer_svd" in name


def handle_missing(df: DataFrame, keys: tuple[str, ...] = ("transcript_id",)) -> DataFrame:
    """Fill, drop and filter by column family in one projection and one filter (PRJ11). NaN counts as missing."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    columns, needed = [], []
    for name, kind in kinds.items():
        col = F.col(f"`{name}`")
        if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
            col = F.nanvl(col, F.lit(None).cast(kind))
        if name.startswith(ZERO_PREFIXES):
            col = F.coalesce(col, F.lit(0).cast(kind))
        elif isinstance(kind, T.StringType) and name not in keys and not name.startswith(STRUCTURE_PREFIX):
            col = F.coalesce(col, F.lit(""))
        if name.startswith(STRUCTURE_PREFIX) or _is_kmer(name):
            needed.append(name)
        columns.append(col.alias(name))
    out = df.select(*columns).na.drop(subset=needed) if needed else df.select(*columns)
    return out.where("ss_mfe < 0") if "ss_mfe" in kinds else out


def clean_promoters(df: DataFrame, column: str = "entries_epdnew") -> DataFrame:
    """The promoter column without rank suffixes, if it is there (PRJ12)."""
    return df.withColumn(column, strip_rank_suffix(F.col(column))) if column in df.columns else df


def _renamed(df: DataFrame, names: dict[str, str], what: str) -> DataFrame:
    new = list(names.values())
    twice = sorted({n for n in new if new.count(n) > 1})
    if twice:
        raise ValueError(f"{what} gives several columns the names {twice}")
    return df.select(*[F.col(f"`{old}`").alias(n) for old, n in names.items()])


def sanitize_columns(df: DataFrame) -> DataFrame:
    """Column names of letters, digits and single underscores; a collision fails (PRJ13)."""
    return _renamed(df, {c: sanitize_name(c) for c in df.columns}, "sanitising")


def canonical_columns(df: DataFrame, label: str | None = None, keys: tuple[str, ...] = ("transcript_id",)) -> DataFrame:
    """Lower-case names in alphabetical order after the keys and the label; a collision fails (PRJ14)."""
    front = [c for c in (*keys, label) if c in df.columns]
    rest = {c: c.lower() for c in df.columns if c not in front}
    ordered = {c: c for c in front} | dict(sorted(rest.items(), key=lambda x: x[1]))
    return _renamed(df, ordered, "lower-casing")


def boolean_label(df: DataFrame, label: str) -> DataFrame:
    """The label as boolean if its values are 0 and 1 only, else as it is (PRJ15)."""
    if isinstance(df.schema[label].dataType, (T.BooleanType, T.StringType)):
        return df
    fits = df.agg(F.bool_and(F.col(label).isin(0, 1))).first()[0]
    return df.withColumn(label, F.col(label).cast("boolean")) if fits else df


def drop_features(dfs: list[DataFrame], names: list[str]) -> list[DataFrame]:
    """All tables without the named columns; unknown names are ignored (PRJ18)."""
    return [df.drop(*names) for df in dfs]


def dedup_rows(df: DataFrame, label: str | None = None, order: str = "transcript_id") -> DataFrame:
    """The row with the smallest id among those with equal features, whatever their labels (DED1)."""
    features = [c for c in df.columns if c not in (label, order)]
    first = F.row_number().over(Window.partitionBy(*features).orderBy(order))
    return df.withColumn("_n", first).where("_n = 1").drop("_n")


def union_labelled(positive: DataFrame, negative: DataFrame, label: str = "y") -> DataFrame:
    """Both tables with a label; their column sets must agree (SET1)."""
    a, b = set(positive.columns), set(negative.columns)
    if a != b:
        raise ValueError(f"columns only in the first table: {sorted(a - b)}; only in the second: {sorted(b - a)}")
    return positive.withColumn(label, F.lit(True)).unionByName(negative.withColumn(label, F.lit(False)))
