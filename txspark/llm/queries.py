"""One thin query for each operator over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txspark.llm.oracles import ORACLES
from txspark.session import ship_package

__all__ = ["ORACLES", "QUERIES"]


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _remainder(modulus: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus))


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from txspark.llm.secrets import scan_secrets, span_string

    spans = F.col("secret_spans")
    base = F.filter(spans, lambda s: s["kind"] < 3)
    count = lambda k: F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long")
    found = scan_secrets(_read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(span_string(base).cast("binary"), 256).alias("base_sha256"), span_string(spans).alias("spans"),
    )


def op2_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from txspark.llm.mixing import fit_domains, fit_mixture, label_documents, rate_scored, score_domains

    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    domains = fit_domains(label_documents(docs, _read(spark, sf_dir, "labels")))
    scored = score_domains(docs, domains)
    return rate_scored(scored, fit_mixture(scored, domains, {"high": 0.8, "low": 0.19, "toxic": 0.01}))


def op3_ngram_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from txspark.llm.ngrams import score_texts

    docs = _read(spark, sf_dir, "documents")
    return score_texts(docs.select("doc_id", "text", (_remainder(7) != 2).alias("train")))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from txspark.llm.minhash import near_duplicates

    return near_duplicates(_read(spark, sf_dir, "documents"), 75)


def op5_suffix_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from txspark.llm.substrings import remove_repeats

    return remove_repeats(_read(spark, sf_dir, "documents"))


def op6_int8_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from txspark.llm.embeddings import near_vectors

    return near_vectors(_read(spark, sf_dir, "embeddings"), 0.9)


def op7_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from txspark.llm.sharding import shard_documents

    return shard_documents(_read(spark, sf_dir, "documents"), 8)


def op8_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from txspark.llm.packing import pack

    return pack(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 1024)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from txspark.llm.langid import fit, identify

    docs = _read(spark, sf_dir, "documents")
    model = fit(docs.where(_remainder(3) != 1))
    return identify(docs.select("doc_id", (_remainder(3) == 1).alias("held_out"), "text"), model).drop("text")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from txspark.llm.quality import METRICS, judge_quality

    judged = judge_quality(_read(spark, sf_dir, "documents"))
    return judged.withColumns({c: F.round(c, 9) for c in METRICS})


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from txspark.llm.pieces import encode_texts

    coded = encode_texts(_read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), digest(ids).alias("ids_sha256"), digest(F.col("decoded")).alias("decoded_sha256"), "agrees")


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from txspark.llm.divergence import audit_sources

    return audit_sources(_read(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from txspark.llm.phrases import mine_phrases

    return mine_phrases(_read(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_secrets, op2_soft_mixing, op3_ngram_scores, op4_minhash, op5_suffix_index, op6_int8_vectors, op7_hilbert_shards, op8_harmonic_packing, op9_language_id, op10_quality_rules, op11_sentencepiece, op12_source_divergence, op13_collocations)}
