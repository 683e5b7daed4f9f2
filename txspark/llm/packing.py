"""Packing of tokenised documents into sequences of fixed length."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txspark.llm.ranks import with_ranks
from txspark.llm.staging import Scratch

#: The split pattern of the byte-level BPE of ``byte_bpe_50k.json``.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


#: A piece stays whole if as many of it as a sequence holds leave no more than this share of the sequence; pieces under capacity / SHORT always do.
SLACK, SHORT = 1 / 32, 32


@lru_cache(maxsize=1)
def encoder(path: str) -> Callable[[str], list[int]]:
    """Ids as ``Tokenizer.from_file(path).encode(text, add_special_tokens=False)`` gives them, for a byte-level BPE file.

    The merges are read as ranks for an encoder that takes a third of the time; ranks of such a file are its ids, without the special
    tokens. Texts that name a special token, and those that the faster encoder cannot take (very long runs of white space), go through the tokenizer itself.
    """
    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    special = {t["content"] for t in model.get("added_tokens", [])}
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in model["model"]["vocab"].items() if token not in special}
    fast = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    named = re.compile("|".join(map(re.escape, sorted(special))) or r"(?!)")

    @lru_cache(maxsize=1)
    def whole() -> Tokenizer:
        return Tokenizer.from_file(path)

    def encode(text: str) -> list[int]:
        if not named.search(text):
            try:
                return fast(text)
            except BaseException as error:  # the panic of a native library is no Exception
                if type(error).__name__ != "PanicException":
                    raise
        return whole().encode(text, add_special_tokens=False).ids

    return encode


def piece_lengths(n: int, capacity: int) -> list[int]:
    """Cut n ids into whole sequences and a rest, which loses the largest reciprocal of the capacity below it until what is left fits its class."""
    out, rest = [capacity] * (n // capacity), n % capacity
    while rest:
        k = capacity // rest
        if capacity - k * rest <= capacity * SLACK or rest * SHORT < capacity:
            return [*out, rest]
        out.append(capacity // (k + 1))
        rest -= out[-1]
    return out


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 1024) -> DataFrame:
    """Harmonic packing: pieces whose length lies in a reciprocal class share sequences of a fixed number of pieces.

    A document is its ids and a closing id 0, cut by ``piece_lengths``. Pieces longer than capacity / (k + 1), up to capacity / k, form
    class k, in which each sequence takes k pieces wherever they come from, by their rank in the class; ranks need only counts of
    slices of a class. The last, partial sequences of all classes (at most one for each class, so at most 64) are joined first-fit.

    Null text has no ids but the closing one; empty text likewise; repeated rows are packed each; other columns are ignored;
    an empty table gives no rows. Returns doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer_path)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = np.array([*(encode(text) if text else ()), 0], dtype="<u4")
                at = 0
                for length in piece_lengths(len(ids), capacity):
                    rows.append((doc_id, at, length, zlib.crc32(ids[at : at + length].tobytes()), len(ids), capacity // length))
                    at += length
            yield pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "class"])

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, class long"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(cut, schema)
    pieces = Scratch(docs.sparkSession, "packing").put(rows, "pieces")
    counts = {r["class"]: r["n"] for r in pieces.groupBy("class").agg(F.count("*").alias("n")).collect()}
    plan = docs.sparkSession.createDataFrame(_layout(counts, capacity), "class long, _base long, _full long, _last long, _before long")
    own = F.col("_rank") - F.col("_before")
    sequence = F.when(own < F.col("_full") * F.col("class"), F.col("_base") + F.floor(own / F.col("class"))).otherwise(F.col("_last"))
    placed = (
        with_ranks(pieces, sum(counts.values()), "class", ["doc_id", "start", "ids_crc32"], "_rank")
        .join(F.broadcast(plan), "class")  # a row for each class: at most 64
        .withColumn("sequence_id", sequence.cast("long"))
    )
    # a sequence has at most ``capacity`` pieces
    before = Window.partitionBy("sequence_id").orderBy("_rank").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"))


def _layout(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """For each class: first sequence, number of full ones, where its last pieces go, and the ranks before it."""
    out, base, before, rests = {}, 0, 0, []
    for k in sorted(counts):
        full, rest = divmod(counts[k], k)
        out[k] = [base, full, -1, before]
        base, before = base + full, before + counts[k]
        if rest:
            rests.append((rest * (capacity // k), k))  # no piece of the class is longer
    open_to: list[int] = []
    for need, k in sorted(rests, reverse=True):
        at = next((at for at, used in enumerate(open_to) if used + need <= capacity), len(open_to))
        if at == len(open_to):
            open_to.append(0)
        out[k][2] = base + at
        open_to[at] += need
    return [(k, *row) for k, row in out.items()]
