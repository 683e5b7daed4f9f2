"""Sample sheets, sample discovery and read layouts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_BYTES = 100


def sample_name(path):
    """The sample of a read file: without folder, extension and mate number (SRC9)."""
    name = F.regexp_replace(path, "^.*/", "")
    for pattern in (r"(?i)\.(fastq|fq)(\.gz)?$", r"[_.][12]$", r"(?i)[_.]R[12]$"):
        name = F.regexp_replace(name, pattern, "")
    return name


def discover_samples(listing: DataFrame) -> DataFrame:
    """Sorted distinct samples of a listing (path, length) (SRC9)."""
    return listing.select(sample_name(F.col("path")).alias("sample_id")).distinct().orderBy("sample_id")


def detect_layouts(listing: DataFrame) -> DataFrame:
    """(sample_id, layout): PAIRED with both mates, SINGLE with a plain file, else UNKNOWN; only files over 100 bytes count (SRC10)."""
    file = F.regexp_replace("path", "^.*/", "")
    there = F.col("length") > LEAST_BYTES
    mate = lambda n: F.max(F.when(there & file.rlike(rf"(?i)_{n}\.(fastq|fq)(\.gz)?$"), 1).otherwise(0))
    plain = F.max(F.when(there & ~file.rlike(r"(?i)_[12]\.(fastq|fq)(\.gz)?$"), 1).otherwise(0))
    found = listing.groupBy(sample_name(F.col("path")).alias("sample_id")).agg(mate(1).alias("one"), mate(2).alias("two"), plain.alias("plain"))
    layout = F.when((F.col("one") == 1) & (F.col("two") == 1), "PAIRED").when(F.col("plain") == 1, "SINGLE").otherwise("UNKNOWN")
    return found.select("sample_id", layout.alias("layout"))


def declared_layouts(df: DataFrame) -> DataFrame:
    """(sample_id, declared) of a mapping with ``paired``; other words than the known ones fail (SRC10)."""
    word = F.lower(F.trim(F.col("paired").cast("string")))
    known = F.when(word.isin("true", "1", "yes", "paired"), "PAIRED").when(word.isin("false", "0", "no", "single"), "SINGLE")
    return df.select("sample_id", F.coalesce(known, F.raise_error(F.concat(F.lit("unknown layout: "), F.coalesce(word, F.lit("null")))).cast("string")).alias("declared"))


def reconcile_layouts(listing: DataFrame, declared: DataFrame) -> DataFrame:
    """(sample_id, declared, detected, agrees) of every declared sample (SRC10)."""
    both = declared_layouts(declared).join(detect_layouts(listing), "sample_id", "left")
    found = F.coalesce("layout", F.lit("UNKNOWN"))
    return both.select("sample_id", "declared", found.alias("detected"), (F.col("declared") == found).alias("agrees"))
