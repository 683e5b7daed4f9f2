"""Sharding along a Hilbert curve through the metadata of documents (native)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txspark.llm.ranks import with_ranks
from txspark.llm.staging import Scratch, few_rows

#: Bits of each dimension; the curve has 2 ** (bits * dimensions) cells.
BITS = 5


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def hilbert_index(dims: list[Column], bits: int = BITS) -> Column:
    """Place on the Hilbert curve of a point with ``len(dims)`` coordinates of ``bits`` bits each.

    Works bit by bit from the highest (the transposed form of J. Skilling, 2004): rotate and
    reflect the lower bits of the cell, then Gray-decode and interleave. Coordinates are integers from
    0 to 2**bits - 1; a null coordinate counts as 0.
    """
    n = len(dims)
    point = F.array(*[F.coalesce(d.cast("int"), F.lit(0)) for d in dims])
    high = F.array(*[F.lit(1 << b) for b in range(bits - 1, 0, -1)])

    def at_bit(x: Column, q: Column) -> Column:
        def at_dim(y: Column, i: Column) -> Column:
            low = q - F.lit(1)
            swap = F.get(y, F.lit(0)).bitwiseXOR(F.get(y, i)).bitwiseAND(low)
            reflected = F.transform(y, lambda v, k: F.when(k == 0, v.bitwiseXOR(low)).otherwise(v))
            swapped = F.transform(y, lambda v, k: F.when((k == 0) | (k == i), v.bitwiseXOR(swap)).otherwise(v))
            return F.when(F.get(y, i).bitwiseAND(q) != 0, reflected).when(i == 0, y).otherwise(swapped)

        return F.aggregate(F.array(*[F.lit(i) for i in range(n)]), x, at_dim)

    def gray(x: Column) -> Column:
        """Each coordinate xor all before it."""
        return F.transform(x, lambda _, i: F.aggregate(F.slice(x, F.lit(1), i + 1), F.lit(0), lambda a, v: a.bitwiseXOR(v)))

    def undone(x: Column) -> Column:
        last = F.get(x, F.lit(n - 1))
        flip = F.aggregate(high, F.lit(0), lambda t, q: F.when(last.bitwiseAND(q) != 0, t.bitwiseXOR(q - F.lit(1))).otherwise(t))
        return _let(flip, lambda t: F.transform(x, lambda v: v.bitwiseXOR(t)))

    def interleaved(x: Column) -> Column:
        places = F.array(*[F.lit(b) for b in range(bits - 1, -1, -1)])
        return F.aggregate(places, F.lit(0).cast("long"), lambda out, b: F.aggregate(x, out, lambda o, v: o * 2 + F.getbit(v, b).cast("long")))

    return _let(_let(_let(F.aggregate(high, point, at_bit), gray), undone), interleaved)


def ordered_codes(df: DataFrame, column: str, bits: int) -> DataFrame:
    """``(column, code)`` for each value of a string column: codes of ``bits`` bits that grow with the value and cut the rows evenly.

    The code of a value is the share of the rows that come before it in order. Only distinct values with their counts pass
    the window without partitions.
    """
    counts = df.groupBy(column).agg(F.count("*").alias("_n"))
    before = Window.orderBy(column).rowsBetween(Window.unboundedPreceding, -1)
    share = F.coalesce(F.sum("_n").over(before), F.lit(0)) / F.sum("_n").over(Window.partitionBy())
    return counts.select(column, F.floor(share * (1 << bits)).cast("int").alias(f"{column}_code"))


def shard_documents(docs: DataFrame, shards: int = 8, bits: int = BITS) -> DataFrame:
    """Cut the curve order of all documents into ``shards`` runs whose row counts differ by one at most.

    Dimensions: size (logarithm), language and source, each quantised to ``bits`` bits in an order-preserving way, so that a shard spans
    a narrow range of each and a reader can skip shards by the least and largest value of any of them. Rows of one curve cell are ordered by
    slices, then the CRC-32 of the text and doc_id. Null text has size 1 and CRC 0; null language or source counts as the empty
    string; repeated rows are separate rows; an empty table gives none; other columns are ignored.

    Returns doc_id, size, text_crc32, law (``rows``), shard, slot, grown_shard (null) and curve.
    """
    scratch = Scratch(docs.sparkSession, "shards")
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long")
    level = F.least(F.floor(F.log2(F.col("size").cast("double"))), F.lit((1 << bits) - 1))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), size.alias("size"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"), named("lang"), named("source"))
    base = scratch.put(base, "metadata")
    for c in ("lang", "source"):
        base = base.join(few_rows(scratch.put(ordered_codes(base, c, bits), c)), c)
    rows = scratch.put(base.select("doc_id", "size", "text_crc32", hilbert_index([level, F.col("lang_code"), F.col("source_code")], bits).alias("curve")), "curve")
    total = rows.count()
    few, more = divmod(total, shards)  # the first `more` shards have few + 1 rows
    rank, wide = F.col("_rank"), more * (few + 1)
    shard = F.when(rank < wide, F.floor(rank / (few + 1))).otherwise(more + F.floor((rank - wide) / max(few, 1)))
    first = F.col("shard") * few + F.least("shard", F.lit(more))
    return (
        with_ranks(rows, total, "curve", ["text_crc32", "doc_id"], "_rank")
        .withColumn("shard", shard.cast("int"))
        .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (rank - first).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "curve")
    )
