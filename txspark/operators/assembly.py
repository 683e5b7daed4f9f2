"""The wide feature table: one row for each transcript from its parts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_by_id(df: DataFrame, order: list[str], key: str = "transcript_id") -> DataFrame:
    """The first row of each id (DED3)."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_n = 1").drop("_n")


def add_length(df: DataFrame) -> DataFrame:
    """``length`` = end - start, unless it is there (PRJ9)."""
    return df if "length" in df.columns or not {"start", "end"} <= set(df.columns) else df.withColumn("length", F.col("end") - F.col("start"))


def drop_non_features(df: DataFrame) -> DataFrame:
    """Without places, structure columns but the energy, and columns of the interval file (PRJ10)."""
    gone = [c for c in df.columns if (c.startswith("ss_") and c != "ss_mfe") or c in ("chromosome", "start", "end") or c.startswith("bed_")]
    return df.drop(*gone)


def assemble_features(intervals: DataFrame, track: DataFrame | None = None, structure: DataFrame | None = None, kmers: DataFrame | None = None) -> DataFrame:
    """Inner joins by transcript_id of the intervals' ids with the tables that are given (JN2).

    Ids of intervals are taken once; a table with repeated ids multiplies rows. Structure columns get the prefix ``ss_``. Of
    columns with one name, in lower case, the first stays; ``length`` stays and ``bed_*`` goes.
    """
    base = first_by_id(add_length(intervals), ["start", "end"]).select("transcript_id", "length")
    if structure is not None:
        structure = structure.select("transcript_id", *[F.col(c).alias(c if c.startswith("ss_") else f"ss_{c}") for c in structure.columns if c != "transcript_id"])
    parts, seen = [base], {"transcript_id", "length"}
    for df in (track, structure, kmers):
        if df is not None:
            own = [c for c in df.columns if c.lower() not in seen and not c.lower().startswith("bed_")]
            own = list({c.lower(): c for c in reversed(own)}.values())[::-1]
            parts.append(df.select("transcript_id", *[F.col(c).alias(c.lower()) for c in own]))
            seen |= {c.lower() for c in own}
    return reduce(lambda a, b: a.join(b, "transcript_id"), parts)


def attach_metadata(predictions: DataFrame, annotation: DataFrame, sequences: DataFrame | None = None) -> DataFrame:
    """chromosome, start, end, strand and, if given, sequence columns by id; predictions stay (JN3)."""
    out = predictions.join(first_by_id(annotation.select("transcript_id", "chromosome", "start", "end", "strand"), ["start", "end"]), "transcript_id", "left")
    return out if sequences is None else out.join(first_by_id(sequences, [sequences.columns[1]]), "transcript_id", "left")


def attach_expression(predictions: DataFrame, summary: DataFrame) -> DataFrame:
    """Expression columns by id; predictions stay (JN4)."""
    return predictions.join(summary, "transcript_id", "left")


def attach_dge(predictions: DataFrame, dge: DataFrame) -> DataFrame:
    """Fold change, p and q as dge_fc, dge_pval, dge_qval; a table without transcript_id changes nothing (JN5)."""
    if "transcript_id" not in dge.columns:
        return predictions
    return predictions.join(dge.select("transcript_id", F.col("fc").alias("dge_fc"), F.col("pval").alias("dge_pval"), F.col("qval").alias("dge_qval")), "transcript_id", "left")
