"""Half-open intervals: expansion, clipping and the overlap join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Width of the finest bins where the caller names none. Those that a join uses are as long as its typical interval or longer.
BIN = 16


def expand_intervals(df: DataFrame, upstream: int = 0, downstream: int = 0, sizes: DataFrame | None = None) -> DataFrame:
    """Move start down and end up, within 0 and the chromosome's length; an interval that would be empty stays (PRJ7).

    ``sizes`` has a row (chromosome, length) for each known chromosome; it is a small table and joins by Spark's own
    choice. Strand plays no part.
    """
    low, high = F.greatest(F.col("start") - upstream, F.lit(0)), F.col("end") + downstream
    rows = df
    if sizes is not None:
        rows = df.join(sizes.select("chromosome", F.col("length").alias("_length")), "chromosome", "left")
        high = F.least(high, F.coalesce("_length", high))
    fine = low < high
    return rows.withColumns({"start": F.when(fine, low).otherwise(F.col("start")), "end": F.when(fine, high).otherwise(F.col("end"))}).select(*df.columns)


def clip_intervals(df: DataFrame, sizes: DataFrame) -> DataFrame:
    """Intervals within [0, length) of known chromosomes; those that end up empty are dropped (PRJ8)."""
    known = df.join(sizes.select("chromosome", F.col("length").alias("_length")), "chromosome")
    cut = known.withColumns({"start": F.greatest("start", F.lit(0)), "end": F.least("end", "_length")})
    return cut.where("start < end").select(*df.columns)


#: Levels of bins, each FAN times as wide as the one before.
LEVELS, FAN = 11, 4


def _level(start: str, end: str, bin_size: int) -> Column:
    """The finest level whose bins are as long as the interval, so that it touches two of them at most; the last level for all longer ones."""
    length = F.col(end) - F.col(start)
    return reduce(lambda rest, k: F.when(length <= bin_size * FAN**k, F.lit(k)).otherwise(rest), range(LEVELS - 2, -1, -1), F.lit(LEVELS - 1))


def interval_levels(df: DataFrame, bin_size: int = BIN) -> dict[int, int]:
    """How many intervals of a table belong to each level that occurs: LEVELS numbers at most."""
    rows = df.where("start < end").groupBy(_level("start", "end", bin_size).alias("level")).agg(F.count("*").alias("n"))
    return {r["level"]: r["n"] for r in rows.collect()}


def typical_level(levels: dict[int, int]) -> int:
    """The level that three quarters of the intervals do not exceed, 0 without any."""
    upto, most = 0, sum(levels.values()) * 3 / 4
    for level in sorted(levels):
        upto += levels[level]
        if upto >= most:
            return level
    return 0


def _width(bin_size: int) -> Column:
    return F.lit(bin_size) * F.pow(F.lit(FAN), F.col("_bin_level")).cast("long")


def in_bins(df: DataFrame, start: str, end: str, coarser: list[int], level: str, bin_size: int, finest: int = 0) -> DataFrame:
    """A row for each bin (_bin_level, _bin) that an interval touches at its own level, at ``finest`` if that is coarser, which comes as column ``level``, and at those of ``coarser`` levels that are coarser."""
    own = df.where(F.col(start) < F.col(end)).withColumn(level, F.greatest(_level(start, end, bin_size), F.lit(finest)))
    above = F.filter(F.array(*[F.lit(k) for k in coarser]), lambda k: k > F.col(level)) if coarser else F.array().cast("array<int>")
    placed = own.withColumn("_bin_level", F.explode(F.concat(F.array(F.col(level)), above)))
    return placed.withColumn("_bin", F.explode(F.sequence(F.floor(F.col(start) / _width(bin_size)), F.floor((F.col(end) - 1) / _width(bin_size)))))


def overlap_join(a: DataFrame, b: DataFrame, bin_size: int = BIN, on: tuple[str, ...] = ("chromosome",), levels: dict[int, int] | None = None, b_levels: dict[int, int] | None = None) -> DataFrame:
    """Pairs of intervals of one chromosome (or one value of all ``on`` columns) that share a base (JN1).

    Bins are nested: an interval belongs to the finest level whose bins are as long as it is, where it touches one or two. A pair meets at the coarser one
    of its two levels, so each side shows itself at its own level and at those coarser ones that the other has (``levels`` of ``a`` and ``b_levels``, found by one
    pass each if not given): a few rows for any interval, however long. No level is finer than that which three quarters of ``a`` do not exceed: shorter ones meet no more rows there than others do, and
    ``b``, mostly the larger side, need not show itself at finer levels for them. The join on (chromosome, level, bin) is a sort-merge equi-join that adaptive
    execution can split where it is skewed; it is never a broadcast, since Spark's estimate of a side knows nothing of its rows by bin, and the driver would hold them all. A pair is reported only in the first bin that both touch, so no distinct is
    needed. Columns of ``b`` but those of ``on`` come as ``b_<name>``. Empty intervals overlap nothing.
    """
    levels = interval_levels(a, bin_size) if levels is None else levels
    b_levels = interval_levels(b, bin_size) if b_levels is None else b_levels
    finest = typical_level(levels)
    shown = lambda of: sorted({max(k, finest) for k in of})
    left = in_bins(a, "start", "end", shown(b_levels), "_level_a", bin_size, finest)
    other = b.select(*on, *[F.col(c).alias(f"b_{c}") for c in b.columns if c not in on])
    right = in_bins(other, "b_start", "b_end", shown(levels), "_level_b", bin_size, finest)
    pairs = left.hint("merge").join(right, [*on, "_bin_level", "_bin"])
    meet = F.col("_bin_level") == F.greatest("_level_a", "_level_b")
    touch = (F.col("start") < F.col("b_end")) & (F.col("b_start") < F.col("end"))
    width = _width(bin_size)
    once = F.col("_bin") == F.greatest(F.floor(F.col("start") / width), F.floor(F.col("b_start") / width))
    return pairs.where(meet & touch & once).select(*a.columns, *[c for c in other.columns if c not in on])
