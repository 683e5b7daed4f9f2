"""Sequences of transcripts and intervals from a chunked genome, and tables attached to sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txspark.functions.scalars import revcomp, to_rna


def chunk_genome(genome: DataFrame, size: int = 1 << 16) -> DataFrame:
    """(chromosome, chunk, piece) of (chromosome, sequence): fixed pieces, so that no task needs a whole chromosome."""
    places = F.sequence(F.lit(0), F.floor((F.length("sequence") - 1) / size))
    return genome.where(F.length("sequence") > 0).select("chromosome", "sequence", F.explode(places).alias("chunk")).select("chromosome", "chunk", F.substring("sequence", F.col("chunk") * size + 1, F.lit(size)).alias("piece"))


def _pieces(iv: DataFrame, chunks: DataFrame, size: int) -> DataFrame:
    touched = F.sequence(F.floor(F.col("start") / size), F.floor((F.col("end") - 1) / size))
    rows = iv.where("start < end").withColumn("chunk", F.explode(touched)).join(chunks, ["chromosome", "chunk"])
    low, high = F.greatest("start", F.col("chunk") * size), F.least("end", (F.col("chunk") + 1) * size)
    return rows.withColumns({"_at": low, "_piece": F.substring("piece", low - F.col("chunk") * size + 1, high - low)})


def _joined(rows: DataFrame, key: list[str], strand: Column, rna: bool) -> DataFrame:
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_at", "_piece"))), lambda x: x["_piece"]), "")
    whole = rows.groupBy(*key).agg(F.upper(text).alias("sequence"), F.first(strand).alias("_strand"))
    turned = F.when(F.col("_strand") == "-", revcomp(F.col("sequence"))).otherwise(F.col("sequence"))
    return whole.select(*key, (to_rna(turned) if rna else turned).alias("sequence"))


def spliced_sequences(annotation: DataFrame, genome: DataFrame, spliced: bool = True, rna: bool = True, size: int = 1 << 16) -> DataFrame:
    """(transcript_id, sequence): the exons of a transcript in order, or its whole span; reversed on the minus strand (JN9)."""
    part = annotation.where((F.col("feature") == ("exon" if spliced else "transcript")) & F.col("transcript_id").isNotNull())
    rows = part.select("transcript_id", "chromosome", "start", "end", "strand").distinct()
    return _joined(_pieces(rows, chunk_genome(genome, size), size), ["transcript_id"], F.col("strand"), rna)


def interval_sequences(intervals: DataFrame, genome: DataFrame, rna: bool = True, size: int = 1 << 16) -> DataFrame:
    """(name, sequence) of whole intervals; without a name column the place is the name (JN10)."""
    place = F.concat("chromosome", F.lit(":"), F.col("start"), F.lit("-"), F.col("end"))
    name = F.coalesce("transcript_id", place) if "transcript_id" in intervals.columns else place
    strand = F.col("strand") if "strand" in intervals.columns else F.lit("+")
    rows = intervals.select(name.alias("transcript_id"), "chromosome", "start", "end", strand.alias("strand"))
    return _joined(_pieces(rows, chunk_genome(genome, size), size), ["transcript_id"], F.col("strand"), rna)


def unique_ids(df: DataFrame) -> DataFrame:
    """Later rows of one id, by file and position, are named <file>_<id>_dup<n> (SEQ7). ``df`` has file, pos and transcript_id."""
    n = F.row_number().over(Window.partitionBy("transcript_id").orderBy("file", "pos")) - 1
    new = F.concat_ws("_", "file", "transcript_id", F.concat(F.lit("dup"), F.col("_n")))
    return df.withColumn("_n", n).withColumn("transcript_id", F.when(F.col("_n") == 0, F.col("transcript_id")).otherwise(new)).drop("_n")


def attach_structure(sequences: DataFrame, results: DataFrame) -> DataFrame:
    """Folding results by transcript_id with the prefix ``ss_``; energies that are no numbers, and missing rows, are null (SEQ13)."""
    energy = F.expr("try_cast(mfe AS double)").alias("ss_mfe")
    return sequences.join(results.select("transcript_id", energy, F.col("structure").alias("ss_structure")), "transcript_id", "left")
