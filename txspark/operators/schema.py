"""The contract between a feature table and a model: profile, difference, enforcement, validation."""

from __future__ import annotations

import json
from enum import Enum

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txspark.session import stored

FLOATS, INTS = ("float", "double"), ("short", "integer", "long", "byte")


class Mode(Enum):
    """STRICT: order, types and extras are errors. PERMISSIVE: reorders and warns. COERCE: casts (SCH7)."""

    STRICT = "strict"
    PERMISSIVE = "permissive"
    COERCE = "coerce"


def fields_of(df: DataFrame, skip: tuple[str, ...] = ("transcript_id",)) -> dict[str, str]:
    return {f.name: f.dataType.typeName() for f in df.schema.fields if f.name not in skip}


def _family(kind: str) -> str:
    return "float" if kind in FLOATS else "int" if kind in INTS else kind


def _names(spark: SparkSession, fields: dict[str, str], column: str) -> DataFrame:
    return spark.createDataFrame([(n, t, i) for i, (n, t) in enumerate(fields.items())], f"feature string, {column} string, {column}_position int")


def schema_diff(df: DataFrame, schema: dict[str, str], skip: tuple[str, ...] = ("transcript_id",)) -> DataFrame:
    """(feature, issue, expected, actual): missing, extra and mismatched columns; widths of one family agree (SCH1, SET3)."""
    spark = df.sparkSession
    both = _names(spark, schema, "expected").join(_names(spark, fields_of(df, skip), "actual"), "feature", "full_outer")
    family = lambda c: F.when(F.col(c).isin(*FLOATS), "float").when(F.col(c).isin(*INTS), "int").otherwise(F.col(c))
    issue = F.when(F.col("actual").isNull(), "missing").when(F.col("expected").isNull(), "extra").when(family("expected") != family("actual"), "dtype")
    return both.withColumn("issue", issue).where("issue IS NOT NULL").select("feature", "issue", "expected", "actual")


def enforce_schema(df: DataFrame, schema: dict[str, str], keys: tuple[str, ...] = ("transcript_id",)) -> DataFrame:
    """Exactly the columns of the schema, in order and cast; missing ones are false, 0 or '' (SCH2)."""

    def one(name: str, kind: str) -> Column:
        if name in df.columns:
            return F.col(f"`{name}`").cast(kind).alias(name)
        return F.lit(False if kind == "boolean" else "" if kind == "string" else 0).cast(kind).alias(name)

    return df.select(*[c for c in keys if c in df.columns], *[one(n, t) for n, t in schema.items()])


#: Bits of an order-preserving key that one round of ``exact_quantiles`` tells apart: a feature has at most 2**16 counts in a round.
ROUND_BITS = 16


@F.pandas_udf(T.LongType())
def _order_key(v: pd.Series) -> pd.Series:
    """Keys of doubles that lie in their order, as signed integers; NaN comes last and both zeros are one."""
    bits = (v.to_numpy(float) + 0.0).view(np.int64)
    return pd.Series(np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits))


def exact_quantiles(long: DataFrame, levels: list[float]) -> DataFrame:
    """(feature, level, value): quantiles by linear interpolation of (feature, v), without a task that sees all values of a feature (AGG4).

    A distributed selection for all features and levels at once: values are counted by the first bits of a key that keeps their order, running counts name the
    bucket of each wanted rank, and only values of wanted buckets go into the next round, which looks at further bits. After four rounds a bucket is one value.
    Features without values have no rows.
    """
    rows = long.where("v IS NOT NULL").select("feature", "v", _order_key("v").alias("_key"))
    wanted = None
    for shift in range(64 - ROUND_BITS, -1, -ROUND_BITS):
        bucket = F.shiftright("_key", shift).alias("_bucket")
        if wanted is not None:
            # a row for each feature and bucket: at most two for each level
            kept = F.broadcast(wanted.select("feature", F.col("_bucket").alias("_kept")).distinct())
            rows = rows.join(kept, "feature").where(F.shiftright("_key", shift + ROUND_BITS) == F.col("_kept")).drop("_kept")
            rows = stored(rows, "quantiles") if shift == 64 - 2 * ROUND_BITS else rows  # the few that are left
        counts = rows.groupBy("feature", bucket).agg(F.count("*").alias("_n"), F.min("v").alias("_v"))
        if wanted is None:
            counts = stored(counts, "quantiles")
            order = Window.partitionBy("feature").orderBy("_bucket")
            rank = F.array(*[F.struct(F.lit(q).alias("level"), (F.lit(q) * (F.col("_all") - 1)).alias("_h")) for q in levels])
            want = counts.groupBy("feature").agg(F.sum("_n").alias("_all")).select("feature", F.explode(rank).alias("x")).select("feature", "x.*")
            sides = F.explode(F.array_distinct(F.array(F.floor("_h"), F.ceil("_h"))))
            want = want.select("feature", "level", "_h", sides.alias("_rank")).withColumn("_of", F.lit(None).cast("long"))
            placed = counts.withColumn("_upto", F.sum("_n").over(order)).withColumn("_of", F.lit(None).cast("long"))
        else:
            within = F.shiftright("_bucket", ROUND_BITS)
            placed = counts.withColumn("_of", within)
            placed = placed.withColumn("_upto", F.sum("_n").over(Window.partitionBy("feature", "_of").orderBy("_bucket")))
            want = wanted.select("feature", "level", "_h", F.col("_left").alias("_rank"), F.col("_bucket").alias("_of"))
        want = want.withColumnsRenamed({"feature": "_feature", "_of": "_in"})
        on = (F.col("feature") == F.col("_feature")) & F.col("_of").eqNullSafe(F.col("_in"))
        found = placed.join(F.broadcast(want), on).where((F.col("_rank") < F.col("_upto")) & (F.col("_rank") >= F.col("_upto") - F.col("_n")))
        wanted = stored(found.select("feature", "level", "_h", "_bucket", (F.col("_rank") - (F.col("_upto") - F.col("_n"))).alias("_left"), "_v"), "quantiles")
    low, high = F.min("_v"), F.max("_v")
    part = F.first("_h") - F.floor(F.first("_h"))
    return wanted.groupBy("feature", "level").agg(F.when(low == high, low).otherwise(low + (high - low) * part).alias("value"))


def profile(df: DataFrame, types: dict[str, str] | None = None, approximate: bool = False) -> DataFrame:
    """A row of statistics for each feature (AGG4).

    Continuous: count of nulls, percentage, min, max, mean, sample deviation, and the 5th, 25th, 50th, 75th and 95th percentiles by linear
    interpolation, exact (by sketch, in one pass, if ``approximate``). Nominal: distinct values and the percentage of true ones.
    """
    types = types or {n: "nominal" if t in ("boolean", "string") else "continuous" for n, t in fields_of(df).items()}
    cont, nominal = ([n for n, t in types.items() if t == k] for k in ("continuous", "nominal"))
    n = F.count("*")
    parts = []
    if cont:
        long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("double").alias("v")) for c in cont])).alias("x")).select("x.*")
        levels, names = [0.05, 0.25, 0.5, 0.75, 0.95], ["p05", "p25", "median", "p75", "p95"]
        found = [F.count_if(F.col("v").isNull()).alias("null_count"), (100.0 * F.count_if(F.col("v").isNull()) / n).alias("null_percent"), F.min("v").alias("min"), F.max("v").alias("max"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std")]
        if approximate:
            stats = long.groupBy("feature").agg(*found, F.percentile_approx("v", F.array(*[F.lit(q) for q in levels]), F.lit(10_000)).alias("q"))
        else:
            quantiles = exact_quantiles(long, levels).groupBy("feature").agg(*[F.max(F.when(F.col("level") == q, F.col("value"))).alias(a) for q, a in zip(levels, names, strict=True)])
            # a row for each feature
            stats = long.groupBy("feature").agg(*found).join(F.broadcast(quantiles), "feature", "left").withColumn("q", F.array(*names)).drop(*names)
        parts.append(stats.select("feature", F.lit("continuous").alias("type"), "null_count", "null_percent", "min", "max", "mean", "std", *[F.col("q")[i].alias(a) for i, a in enumerate(names)], F.lit(None).cast("long").alias("n_distinct"), F.lit(None).cast("double").alias("percent_true")))
    if nominal:
        long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("string").alias("v")) for c in nominal])).alias("x")).select("x.*")
        stats = long.groupBy("feature").agg(F.count_if(F.col("v").isNull()).alias("null_count"), (100.0 * F.count_if(F.col("v").isNull()) / n).alias("null_percent"), F.count_distinct("v").alias("n_distinct"), (100.0 * F.count_if(F.col("v") == "true") / F.greatest(F.count("v"), F.lit(1))).alias("percent_true"))
        none = [F.lit(None).cast("double").alias(a) for a in ("min", "max", "mean", "std", "p05", "p25", "median", "p75", "p95")]
        parts.append(stats.select("feature", F.lit("nominal").alias("type"), "null_count", "null_percent", *none, "n_distinct", "percent_true"))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, value, n) of nominal columns (AGG4)."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns])).alias("x")).select("x.*")
    return long.groupBy("feature", "value").agg(F.count("*").alias("n"))


def extract_schema(df: DataFrame, name: str = "model", version: str = "1") -> dict:
    """Names, types, Spark types and statistics of a training table as one document, with the layout that cleaning reads (SCH8)."""
    fields = fields_of(df)
    stats = {r["feature"]: {k: v for k, v in r.asDict().items() if k != "feature" and v is not None} for r in profile(df).collect()}
    return {"model_name": name, "model_version": version, "feature_names": list(fields), "feature_types": {n: stats[n]["type"] for n in fields}, "feature_dtypes": fields, "statistics": stats, "inputs": fields}


def save_schema(spark: SparkSession, schema: dict, path: str) -> None:
    spark.createDataFrame([(json.dumps(schema, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_schema(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


ISSUES = "feature string, check string, level string, n long, percent double, detail string"


def validate(df: DataFrame, schema: dict[str, str], mode: Mode = Mode.STRICT, stats: dict[str, tuple[float, float]] | None = None, tolerance: float = 0.1, allow_extra: bool = False, skip: tuple[str, ...] = ("transcript_id",)) -> tuple[DataFrame, DataFrame | None]:
    """Issues of a table, and the table in the schema's order and types if it may be used (SCH3 to SCH7).

    Names, order and types are compared without the data; nulls, ranges (outside [min - t * span, max + t * span]), booleans and failed casts are
    counted in one pass over it. The table comes back if no issue is an error, or always in the permissive mode unless columns are missing.
    """
    own, wanted, issues = fields_of(df, skip), list(schema), []
    missing, extra = [n for n in wanted if n not in own], [n for n in own if n not in schema]
    issues += [(n, "missing", "ERROR", None, None, f"expected {schema[n]}") for n in missing]
    extra_level = "ERROR" if mode is Mode.STRICT and not allow_extra else "WARNING"
    issues += [(n, "extra", extra_level, None, None, f"found {own[n]}") for n in extra]
    common = [n for n in own if n in schema]
    if common != [n for n in wanted if n in own]:
        issues.append((None, "order", "ERROR" if mode is Mode.STRICT else "INFO", None, None, "columns are not in the schema's order"))
    casts = {}
    for n in common:
        have, want = _family(own[n]), _family(schema[n])
        if own[n] != schema[n] and (have != want or mode is Mode.COERCE):
            if mode is Mode.STRICT:
                issues.append((n, "dtype", "ERROR", None, None, f"{own[n]} for {schema[n]}"))
            elif mode is Mode.PERMISSIVE and (have, want) != ("int", "float"):
                issues.append((n, "dtype", "WARNING", None, None, f"{own[n]} for {schema[n]}"))
            elif mode is Mode.COERCE:
                casts[n] = F.expr(f"try_cast(`{n}` AS {schema[n]})")
    tests: list[tuple[str, str, Column, Column]] = []
    for n in common:
        c = F.col(f"`{n}`")
        tests.append((n, "null", c.isNull(), F.lit(True)))
        if stats and n in stats:
            low, high = stats[n]
            span = (high - low) * tolerance
            tests.append((n, "range", (c < low - span) | (c > high + span), c.isNotNull()))
        if schema[n] == "boolean":
            tests.append((n, "boolean", ~F.lower(c.cast("string")).isin("true", "false", "0", "1", "0.0", "1.0"), c.isNotNull()))
        if n in casts:
            tests.append((n, "cast", c.isNotNull() & casts[n].isNull(), c.isNotNull()))
    if tests:
        row = df.agg(*[x for _, _, bad, of in tests for x in (F.count_if(bad), F.count_if(of))]).first()
        for i, (n, check, _, _) in enumerate(tests):
            bad, of = row[2 * i], row[2 * i + 1]
            if check == "cast":
                issues.append((n, "dtype", "ERROR" if bad else "INFO", bad, None, f"{own[n]} cast to {schema[n]}"))
            elif bad:
                issues.append((n, check, "ERROR" if check == "boolean" else "WARNING", bad, 100.0 * bad / max(of, 1), None))
    failed = any(i[2] == "ERROR" for i in issues)
    usable = not missing and (not failed or mode is Mode.PERMISSIVE)
    out = None
    if usable:
        keys = [c for c in skip if c in df.columns]
        out = df.select(*keys, *[casts.get(n, F.col(f"`{n}`")).alias(n) for n in wanted], *[F.col(f"`{n}`") for n in extra if allow_extra])
    return df.sparkSession.createDataFrame(issues, ISSUES), out
