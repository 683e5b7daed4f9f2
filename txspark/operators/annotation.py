"""Filters, deduplication and derived records of annotation tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txspark.functions.scalars import normalize_chrom

CANONICAL = ("2L", "2R", "3L", "3R", "4", "X", "Y")


def by_feature(df: DataFrame, feature: str = "transcript") -> DataFrame:
    """Records of one feature type (PRJ1)."""
    return df.where(F.col("feature") == feature)


def annotation_to_intervals(df: DataFrame, feature: str = "transcript") -> DataFrame:
    """chromosome, start, end, transcript_id, score '.', strand of the records with an id (PRJ2); fails if there is none."""
    rows = by_feature(df, feature).where("transcript_id IS NOT NULL")
    if rows.isEmpty():
        raise ValueError(f"no {feature} record has a transcript_id")
    return rows.select(normalize_chrom(F.col("chromosome")).alias("chromosome"), "start", "end", "transcript_id", F.lit(".").alias("score"), "strand")


def on_chromosomes(df: DataFrame, names: tuple[str, ...] = CANONICAL) -> DataFrame:
    """Records of the named chromosomes (PRJ3)."""
    return df.where(F.col("chromosome").isin(*names))


def by_biotype(df: DataFrame, biotype: str, min_len: int) -> DataFrame:
    """Records whose gene and transcript are of one biotype and longer than ``min_len`` (PRJ4)."""
    return df.where((F.col("gene_biotype") == biotype) & (F.col("transcript_biotype") == biotype) & (F.col("end") - F.col("start") > min_len))


def novel_only(df: DataFrame, pattern: str = "^MSTRG*") -> DataFrame:
    """Records of assembled transcripts, told by their ids (PRJ5)."""
    return df.where(F.col("transcript_id").rlike(pattern))


def exons_of(annotation: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Exons of the given transcripts (JN7)."""
    return by_feature(annotation, "exon").join(transcripts.select("transcript_id"), "transcript_id", "left_semi").select(*annotation.columns)


def dedup_positions(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each position by ``order`` (DED2)."""
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_n", first).where("_n = 1").drop("_n")


def dedup_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: rows before and after, and the percentage removed (DED2)."""
    one = lambda df, name: df.agg(F.count("*").alias(name)).withColumn("_k", F.lit(1))
    gone = F.when(F.col("rows_before") > 0, F.round(100.0 * (F.col("rows_before") - F.col("rows_after")) / F.col("rows_before"), 4)).otherwise(0.0)
    return one(before, "rows_before").join(one(after, "rows_after"), "_k").select("rows_before", "rows_after", gone.alias("percent_removed"))


def union_records(a: DataFrame, b: DataFrame) -> DataFrame:
    """All records of both tables (SET2)."""
    return a.unionByName(b, allowMissingColumns=True)


def splice_junctions(annotation: DataFrame) -> DataFrame:
    """Distinct introns between consecutive exons of a transcript (SEQ12)."""
    along = Window.partitionBy("transcript_id").orderBy("start", "end")
    nexts = by_feature(annotation, "exon").withColumn("_next", F.lead("start").over(along))
    return nexts.where("_next > end").select("chromosome", F.col("end").alias("start"), F.col("_next").alias("end"), "strand").distinct()
