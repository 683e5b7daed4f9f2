"""From documents to packed sequences: language ID, near-duplicates, secrets, mixing, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that ``run`` writes as Parquet and reads again. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txspark.llm.langid import UNKNOWN, fit, identify
from txspark.llm.minhash import near_duplicates
from txspark.llm.mixing import apply_mixture, fit_domains, fit_mixture, label_documents, score_domains
from txspark.llm.packing import pack
from txspark.llm.secrets import redact
from txspark.llm.staging import Scratch, few_rows
from txspark.session import ship_package

#: Weights of the domains in the mixture; no domain but the toxic one, whose target is 0, falls below what it has.
SHARES = {"high": 0.81, "low": 0.185, "toxic": 0.0}
CAPACITY = 1024


def _row(docs: DataFrame) -> Column:
    """All columns as one value, so that none of the caller's has a name of ours."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language cannot be told; ``lang`` becomes the predicted language.

    Null and empty texts and those without a letter go; rows with a null ``lang`` are not learned from. Repeated rows are judged each and alike, an
    empty table gives none, and other columns stay whatever their names.
    """
    # numbered columns, so that none of the caller's has a name of ours; a text crosses to Python once
    number = {c: c if c == "text" else f"c{k}" for k, c in enumerate(docs.columns)}
    told = identify(docs.select(*[F.col(f"`{c}`").alias(n) for c, n in number.items()]), fit(docs)).where(F.col("lang_pred") != UNKNOWN)
    return told.select(*[F.col("lang_pred" if c == "lang" else n).alias(c) for c, n in number.items()])


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of near-duplicates: the smallest doc_id, then the least hash of the text, then the least row.

    A document is a pair of doc_id and text, so rows that repeat it are one, and different texts of one doc_id are judged each.
    Null and empty texts are like nothing, so each such doc_id keeps a row; an empty table gives none; other columns stay whatever their names.
    """
    scratch = Scratch(spark, "dropped")
    pair = ["doc_id", "_text"]
    rows = docs.select("doc_id", F.xxhash64("text").alias("_text"), "text", _row(docs))
    pairs = scratch.put(rows.groupBy(*pair).agg(F.count("*").alias("n")), "pairs")
    several = pairs.groupBy("doc_id").agg(F.min("_text").alias("least"), F.max("_text").alias("most")).where("least < most")
    # the further texts of a doc_id get ids beyond all others
    top = pairs.agg(F.max("doc_id")).first()[0] or 0
    more = pairs.join(several, "doc_id").where("_text > least").select(*pair, (F.lit(top) + 1 + F.monotonically_increasing_id()).alias("_id"))
    more = scratch.put(more, "further")
    if more.isEmpty():
        named = rows.withColumn("_id", F.col("doc_id"))
        gone = near_duplicates(named.select(F.col("_id").alias("doc_id"), "text")).where("NOT kept").select(F.col("doc_id").alias("_id"))
    else:
        named = rows.join(few_rows(more), pair, "left").withColumn("_id", F.coalesce("_id", "doc_id"))
        groups = near_duplicates(named.select(F.col("_id").alias("doc_id"), "text")).select(F.col("doc_id").alias("_id"), "component_id")
        placed = scratch.put(groups.join(few_rows(more), "_id", "left").withColumn("doc_id", F.coalesce("doc_id", "_id")), "placed")
        # the first text of a doc_id has no hash here, and null comes before all hashes
        kept = placed.groupBy("component_id").agg(F.min(F.struct("doc_id", "_text", "_id"))["_id"].alias("_id"))
        gone = placed.join(kept, "_id", "left_anti").select("_id")
    left = named.drop("text").join(few_rows(scratch.put(gone.distinct(), "ids")), "_id", "left_anti")
    again = scratch.put(pairs.where("n > 1").select(*pair), "repeated")
    if again.isEmpty():
        return left.select("row.*")
    same = lambda how: left.join(few_rows(again), pair, how)
    one = same("left_semi").groupBy(*pair).agg(F.min("row").alias("row"))
    return same("left_anti").select("row").unionByName(one.select("row")).select("row.*")


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put a mark in the place of each secret; all documents stay.

    Null and empty texts stay as they are, repeated rows are treated alike, an empty table gives none; other columns stay whatever their names.
    """
    return redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or drop documents by their rates for SHARES: a row for each copy. Those that labels mark toxic go, whatever their rate.

    Null and empty texts have the domains' prior shares as posteriors. Rows that repeat a doc_id and text are drawn alike, so ties need no order. Without labels
    all rates are 1; an empty table gives none; other columns stay whatever their names.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    domains = fit_domains(label_documents(docs, labels))
    toxic = Scratch(spark, "toxic").put(labels.where("toxic = 1").select("doc_id").distinct(), "ids")
    rest = docs.join(few_rows(toxic), "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
    mixture = fit_mixture(score_domains(rest, domains), domains, SHARES, keep=("high", "low"))
    drawn = apply_mixture(rest.select("doc_id", "text", _row(rest)), mixture).where("copies > 0")
    return drawn.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of CAPACITY tokens.

    Null and empty texts are their end token alone; repeated rows are packed each; an empty table gives no piece; columns but doc_id and text are not read.
    """
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), CAPACITY)


STAGES = [("language", language), ("near_duplicates", deduplicate), ("secrets", hide_secrets), ("mixing", mix), ("packing", pack_sequences)]

#: Language ID, MinHash and tokenising are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the whole table of documents."""
    ship_package(spark)
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.put(stage(spark, docs, sf_dir), name)
        if k:
            scratch.drop(STAGES[k - 1][0])
    return docs
