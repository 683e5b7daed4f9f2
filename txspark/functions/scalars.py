"""Column expressions for sequences, chromosome names and comma lists."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_rna(seq: Column) -> Column:
    """Upper case, T as U, without surrounding blanks (SEQ1)."""
    return F.translate(F.upper(F.trim(seq)), "T", "U")


def valid_sequence(seq: Column) -> Column:
    """Whether a sequence has at least one base and no other character; null is not valid (SEQ2)."""
    return F.coalesce(F.trim(seq).rlike("^[ATGCUatgcuNn]+$"), F.lit(False))


def revcomp(seq: Column) -> Column:
    """Reverse complement of DNA letters (SEQ3)."""
    return F.reverse(F.translate(seq, "ACGTNacgtn", "TGCANtgcan"))


def to_binary(seq: Column) -> Column:
    """Weak bases as 0, strong ones as 1; other characters vanish, so k-mers span them (SEQ4)."""
    return F.translate(F.regexp_replace(F.upper(seq), "[^ATUGC]", ""), "ATUGC", "00011")


def normalize_chrom(name: Column) -> Column:
    """A ``chr`` prefix where it is missing (PRJ6)."""
    return F.when(name.startswith("chr"), name).otherwise(F.concat(F.lit("chr"), name))


def strip_rank_suffix(tokens: Column) -> Column:
    """A comma list with trimmed tokens, no empty ones, and without ``_<number>`` at their ends; null gives '' (PRJ12)."""
    parts = F.filter(F.transform(F.split(F.coalesce(tokens, F.lit("")), ","), lambda t: F.trim(t)), lambda t: t != "")
    return F.array_join(F.transform(parts, lambda t: F.regexp_replace(t, "_[0-9]+$", "")), ",")


def sanitize_name(name: str) -> str:
    """A column name of letters, digits and single underscores (PRJ13)."""
    return re.sub("__+", "_", re.sub("[^a-zA-Z0-9_]", "_", name)).strip("_") or "feature"
