"""How the sources of a language differ in their use of terms."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txspark.llm.staging import Scratch, few_rows
from txspark.llm.words import text_slices

LEAST_DOCS = 30
SCALE = 1_000_000_000
PRIOR = 5
TOP_TERMS = 50
#: Characters of text that are packed and sorted at a time; a text is never cut.
SLICE_CHARS = 16_000_000
#: Sources in a side of a tile, and terms in a block of a language, near enough.
TILE, BLOCK = 256, 4096

#: Letters of ASCII and all bytes of other characters.
IS_TERM = np.zeros(256, bool)
IS_TERM[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: The first k bytes of a word of eight.
FIRST = np.array([((1 << 8 * k) - 1) << (64 - 8 * k) for k in range(9)], np.uint64)


def radix_order(words: list[np.ndarray]) -> np.ndarray:
    """Stable order of rows by uint64 columns, the first weighs most: passes over digits of 16 bits from the last, each a counting sort; digits that are all equal need none."""
    order = None
    for word in reversed(words):
        for shift in range(0, 64, 16):
            digit = (word >> np.uint64(shift)).astype(np.uint16)
            if len(digit) == 0 or (digit == digit[0]).all():
                continue
            step = np.argsort(digit if order is None else digit[order], kind="stable")
            order = step if order is None else order[step]
    return np.arange(len(words[0])) if order is None else order


def _runs(changes: np.ndarray, group: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First rows of the runs of one term and group, their lengths and their numbers of documents, in rows sorted by term, then document."""
    fresh = changes | np.append(True, group[1:] != group[:-1])
    starts = np.flatnonzero(fresh)
    new_doc = np.cumsum(fresh | np.append(True, doc[1:] != doc[:-1]))
    ends = np.append(starts[1:], len(doc))
    return starts, ends - starts, new_doc[ends - 1] - new_doc[starts] + 1


def count_terms(texts: list[str], groups: np.ndarray) -> Iterator[tuple[np.ndarray, list[str], np.ndarray, np.ndarray]]:
    """(group, term, occurrences, documents) of texts that are sorted by group, in arrays, a part for each length bucket.

    Terms of up to 8 bytes are one big-endian uint64, those of up to 16 two, padded with the zero byte, which no term has; a radix sort brings equal ones
    together. Longer ones lie in buckets of doubling width, each sorted by its bytes. Sorting is stable, so the documents of a term stay in order.
    """
    encoded = [t.encode("utf-8", "surrogatepass").lower() for t in texts]  # bytes: lowers A-Z alone
    data = b"\0".join(encoded) + bytes(16)
    raw = np.frombuffer(data, np.uint8)
    inside = np.concatenate([[False], IS_TERM[raw], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    first = np.cumsum([0, *[len(e) + 1 for e in encoded[:-1]]])
    doc = np.searchsorted(first, starts, "right") - 1
    size = ends - starts
    eight = np.ndarray(len(raw) - 7, ">u8", data, strides=(1,))  # eight bytes from each place on
    for low, high in ((0, 8), (8, 16)):
        at = np.flatnonzero((size > low) & (size <= high))
        if not len(at):
            continue
        words = [eight[starts[at] + k].astype(np.uint64) & FIRST[np.clip(size[at] - k, 0, 8)] for k in range(0, high, 8)]
        order = radix_order(words)
        at, words = at[order], [w[order] for w in words]
        changes = np.ones(len(at), bool)
        changes[1:] = np.logical_or.reduce([w[1:] != w[:-1] for w in words])
        yield _named(data, starts, ends, at, changes, groups, doc)
    width = 16
    while (size > width).any():
        at = np.flatnonzero((size > width) & (size <= 2 * width))
        width *= 2
        if not len(at):
            continue
        own = np.array([data[s:e] for s, e in zip(starts[at].tolist(), ends[at].tolist(), strict=True)], f"S{width}")
        order = np.argsort(own, kind="stable")
        at, own = at[order], own[order]
        yield _named(data, starts, ends, at, np.append(True, own[1:] != own[:-1]), groups, doc)


def _named(data: bytes, starts: np.ndarray, ends: np.ndarray, at: np.ndarray, changes: np.ndarray, groups: np.ndarray, doc: np.ndarray):
    own_doc = doc[at]
    own_group = groups[own_doc]
    runs, n, docs = _runs(changes, own_group, own_doc)
    term = [data[s:e].decode("utf-8", "surrogatepass") for s, e in zip(starts[at[runs]].tolist(), ends[at[runs]].tolist(), strict=True)]
    return own_group[runs], term, n, docs


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of each term and the documents that have it, and a row with a null term for each language and source.

    A task packs, sorts and counts slices of its texts, and the counts are added up before and after one shuffle by language, source and term.
    """

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part in text_slices(frame, SLICE_CHARS):
                part = part.sort_values(["lang", "source"], kind="stable")
                group, keys = pd.factorize(pd.MultiIndex.from_frame(part[["lang", "source"]]))
                langs, sources = keys.get_level_values(0).to_numpy(), keys.get_level_values(1).to_numpy()
                yield pd.DataFrame({"lang": langs, "source": sources, "term": None, "n": 0, "docs": 0})
                for own, term, n, held in count_terms(part["text"].tolist(), group):
                    yield pd.DataFrame({"lang": langs[own], "source": sources[own], "term": term, "n": n, "docs": held})

    plain = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    found = plain.mapInPandas(count, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: Column | str, total: str, size: str) -> Column:
    """1 + floor(SCALE * (n + PRIOR) / (total + PRIOR * size)), exact."""
    return F.expr(f"1 + (CAST({SCALE} AS decimal(10, 0)) * CAST({n} + {PRIOR} AS decimal(20, 0))) div CAST({total} + {PRIOR} * {size} AS decimal(20, 0))")


def _tile(frame: pd.DataFrame) -> pd.DataFrame:
    """Sums over the terms of a block of the differences between all sources of one tile and all of another."""
    heads, cells = frame[frame["term"].isnull()], frame[frame["term"].notnull()]
    terms, names = pd.factorize(cells["term"])
    sides = {}
    for side in ("a", "b"):
        own = heads[heads["side"] == side]
        matrix = np.repeat(own["p"].to_numpy(np.int64)[:, None], len(names), axis=1)
        here = (cells["side"] == side).to_numpy()
        matrix[pd.Index(own["source"]).get_indexer(cells["source"][here]), terms[here]] = cells["p"][here]
        sides[side] = own["source"].to_numpy(), own["p"].to_numpy(np.int64), matrix
    missing = int(heads["n_terms"].iloc[0]) - len(names) if len(heads) else 0
    out = []
    (a, base_a, left), (b, base_b, right) = sides["a"], sides["b"]
    for i, name in enumerate(a):
        value = np.abs(right - left[i]).sum(axis=1) + missing * np.abs(base_b - base_a[i])
        out.append(pd.DataFrame({"lang": heads["lang"].iloc[0], "source": name, "item": b, "value": value}))
    if not out:  # a tile without sources
        return pd.DataFrame({c: np.zeros(0, object) for c in ("lang", "source", "item")} | {"value": np.zeros(0, np.int64)})
    found = pd.concat(out, ignore_index=True)
    return found[found["source"] != found["item"]]


def source_distances(groups: DataFrame, cells: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(lang, source, item, value): the sum over all kept terms of the differences in share, for each ordered pair of sources of a language.

    ``groups`` has lang, source, base (the share of a term that does not occur) and size (kept terms of the language); ``cells`` has lang, source, term, p;
    ``vocabulary`` has lang and term. Sources are dealt into tiles and terms into blocks, so that a task compares TILE sources with TILE others over about BLOCK terms.
    """
    per_lang = groups.groupBy("lang").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"), F.greatest(F.ceil(F.max("size") / BLOCK), F.lit(1)).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block")
    in_block = vocabulary.join(few_rows(per_lang), "lang").groupBy("lang", block).agg(F.count("*").alias("n_terms"))
    tile = F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int").alias("own")
    heads = groups.join(few_rows(per_lang), "lang").select("lang", "source", F.lit(None).cast("string").alias("term"), F.coalesce("base", F.lit(0)).alias("p"), tile, "tiles", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    heads = heads.join(in_block, ["lang", "block"], "left").fillna(0, ["n_terms"])
    rows = cells.join(few_rows(per_lang), "lang").select("lang", "source", "term", "p", tile, "tiles", block, F.lit(0).cast("long").alias("n_terms"))
    both = heads.select(*rows.columns).unionByName(rows)
    # a tile is the left side for itself and all after it, the right side for itself and all before it
    part = lambda side, first, last, ta, tb: both.select("*", F.explode(F.sequence(first, last)).alias("other")).select("lang", "source", "term", "p", "block", "n_terms", F.lit(side).alias("side"), F.col(ta).alias("ta"), F.col(tb).alias("tb"))
    dealt = part("a", F.col("own"), F.col("tiles") - 1, "own", "other").unionByName(part("b", F.lit(0), F.col("own"), "other", "own"))
    sums = dealt.groupBy("lang", "block", "ta", "tb").applyInPandas(_tile_with_tags, "lang string, source string, item string, value long, mirrored boolean")
    mirrored = sums.where("mirrored").select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    return sums.drop("mirrored").unionByName(mirrored).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _tile_with_tags(frame: pd.DataFrame) -> pd.DataFrame:
    found = _tile(frame)
    found["mirrored"] = np.full(len(found), frame["ta"].iloc[0] != frame["tb"].iloc[0])
    return found


def audit_sources(docs: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: how far each source is from the others of its language, and the terms that it overuses.

    Terms are runs of ASCII letters and of any characters beyond ASCII, A-Z in lower case. A language keeps those in at least ``least_docs`` of its documents; each
    source gives a kept term the share 1 + floor(10**9 * (count + 5) / (N + 5 * V)). Part ``pair`` ranks the other sources of the language by the summed difference of
    shares, part ``term`` the first ``top_terms`` terms by which the share of a source exceeds that of its language. Larger values come first, ties by item in byte order.

    Null text, language or source counts as ''. A source without kept terms takes part with its base shares, and a language without any has only pairs of value 0; a
    source that is alone in its language has no pairs. Repeated rows are documents each; other columns are ignored; an empty table gives none.
    """
    scratch = Scratch(docs.sparkSession, "divergence")
    counts = scratch.put(term_counts(docs), "counts")
    vocabulary = scratch.put(counts.where("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("held")).where(F.col("held") >= least_docs).drop("held"), "vocabulary")
    kept = scratch.put(counts.where("term IS NOT NULL").join(few_rows(vocabulary), ["lang", "term"]).drop("docs"), "kept")
    langs = vocabulary.groupBy("lang").agg(F.sum("lang_n").alias("lang_total"), F.count("*").alias("size"))
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    # the largest of a null and counts: each source once, whether it has terms or not
    groups = counts.where("term IS NULL").select("lang", "source").join(sums, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["total", "lang_total", "size"])
    groups = scratch.put(groups.withColumn("base", F.when(F.col("size") > 0, _share("0", "total", "size"))), "groups")
    shares = kept.join(few_rows(groups.drop("base")), ["lang", "source"]).withColumn("p", _share("n", "total", "size"))

    over = shares.withColumn("value", F.col("p") - _share("lang_n", "lang_total", "size")).where("value > 0").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    pairs = source_distances(groups, shares.select("lang", "source", "term", "p"), vocabulary).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    return pairs.withColumn("rank", rank).unionByName(over.withColumn("rank", rank).where(F.col("rank") <= top_terms))
