"""Near-duplicate documents: one-permutation MinHash, banded buckets and star-shaped candidate edges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txspark.llm.components import connected_components
from txspark.llm.staging import Scratch, few_rows
from txspark.llm.words import mix, text_slices, tokenise, window_hashes, word_hashes

WIDTH = 5
#: Bins of the one permutation, and bands of BINS / BANDS of them. At a similarity of 0.75 a pair shares no
#: bucket with a probability of (1 - 0.75 ** 4) ** 32, which is 5e-6.
BINS, BANDS = 128, 32
#: Centres of a bucket: the first of its documents in each of this many fixed orders.
CENTRES = 3
#: Pairs whose sketches agree in fewer bins than this share are not confirmed; 0.75 lies over six deviations above.
LEAST_AGREEMENT = 0.5
#: Characters of text that a task turns into words at a time.
BATCH_CHARS = 2_000_000
#: Documents, and shingles, of one side of a tile in which sets are compared each with each, near enough.
TILE, TILE_SHINGLES = 256, 400_000
#: Shingles of the documents that meet one centre in a group, and of all documents of a group, near enough.
CHUNK_SHINGLES, GROUP_SHINGLES = 150_000, 600_000
#: Shingles in this many sets of a tile or more are counted by a matrix product, this many shingles at a time.
COMMON, COLUMNS = 16, 4096


def shingle_sets(texts, width: int = WIDTH) -> list[np.ndarray]:
    """The sorted distinct 64-bit hashes of the shingles of each text.

    A text of fewer words has its whole sequence as one shingle; one without words, or null, has none.
    """
    codes, words, lengths = tokenise(texts)
    hashes = word_hashes(words)[codes]
    windows = window_hashes(hashes, width)
    out, at = [], 0
    for n in lengths.tolist():
        if n >= width:
            own = np.sort(windows[at : at + n - width + 1])
            out.append(own[np.concatenate(([True], own[1:] != own[:-1]))])
        else:
            out.append(mix(window_hashes(hashes[at : at + n], n) ^ np.uint64(n)) if n else np.zeros(0, np.uint64))
        at += n
    return out


def _donors() -> np.ndarray:
    """For each attempt, the bin that an empty bin takes its value from: a fixed random choice for each bin and attempt."""
    grid = np.arange(BINS * 4096, dtype=np.uint64).reshape(4096, BINS)
    return (mix(grid + np.uint64(0x51ED270B)) % np.uint64(BINS)).astype(np.intp)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One-permutation MinHash with optimal densification, a row for each non-empty set.

    The hashes are dealt to bins by their top bits; a bin's value is its least hash. An empty bin copies that of the first
    full one among a random sequence of bins of its own, which all sets share, so each bin agrees with
    a probability of the Jaccard similarity (A. Shrivastava, 2017).
    """
    shift = np.uint64(64 - BINS.bit_length() + 1)
    edges = np.arange(BINS, dtype=np.uint64) << shift
    sig = np.zeros((len(sets), BINS), np.uint64)
    full = np.zeros((len(sets), BINS), bool)
    for row, own in enumerate(sets):
        at = np.searchsorted(own, edges)
        full[row] = np.diff(np.append(at, len(own))) > 0
        sig[row] = own[np.minimum(at, len(own) - 1)]
    donors = _donors()
    todo = np.flatnonzero(~full.all(axis=1))
    empty, have, values = ~full[todo], full[todo], sig[todo]
    for turn in donors:
        if not len(todo):
            break
        take = empty & have[:, turn]
        values[take] = values[:, turn][take]
        # values[:, turn] may hold a copied value only where have is false, which take excludes
        empty &= ~take
        left = empty.any(axis=1)
        sig[todo[~left]] = values[~left]
        todo, empty, have, values = todo[left], empty[left], have[left], values[left]
    for row, gaps, have_row, value in zip(todo, empty, have, values, strict=True):  # a set that found no donor in any attempt
        value[gaps] = value[np.flatnonzero(have_row)[0]]
        sig[row] = value
    return sig


def band_keys(sig: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each row."""
    rows = sig.reshape(len(sig), BANDS, BINS // BANDS)
    place = np.arange(BINS, dtype=np.uint64).reshape(1, BANDS, BINS // BANDS)
    return mix(mix(rows ^ mix(place + np.uint64(1))).sum(axis=2, dtype=np.uint64))


def _describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """doc_id, size and key of the set, four bits of each bin, band keys."""
    for batch in (own for frame in batches for own in text_slices(frame, BATCH_CHARS)):
        sets = shingle_sets(batch["text"].tolist())
        some = np.array([len(s) > 0 for s in sets], bool)
        sig = signatures([s for s in sets if len(s)])
        low = (mix(sig) & np.uint64(15)).astype(np.uint8)
        sketch = iter((low[:, 0::2] << 4) | low[:, 1::2])
        bands = iter(band_keys(sig).view(np.int64))
        yield pd.DataFrame(
            {
                "doc_id": batch["doc_id"].to_numpy(),
                "n_shingles": [len(s) for s in sets],
                "set_key": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                "sketch": [next(sketch).tobytes() if x else None for x in some],
                "bands": [next(bands) if x else None for x in some],
            }
        )


def _confirm(least_percent: int):
    """Keep the pairs of a group of texts whose full shingle sets are similar enough. Rows are texts, each with the centre it meets and whether it is it."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        ids, codes = np.unique(rows["doc_id"].to_numpy(np.int64), return_inverse=True)
        first = np.unique(codes, return_index=True)[1]
        sets = shingle_sets(rows["text"].iloc[first].tolist())
        places, keep = {i: k for k, i in enumerate(ids.tolist())}, []
        for a, b in zip(*(rows.loc[~rows["is_centre"], c].tolist() for c in ("doc_id", "centre")), strict=True):
            x, y = sets[places[a]], sets[places[b]]
            x, y = (x, y) if len(x) < len(y) else (y, x)
            both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
            if 100 * both >= least_percent * (len(x) + len(y) - both):
                keep.append((a, b))
        return pd.DataFrame(keep, columns=["a", "b"]).astype("int64")

    return run


def _agreement(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The share of agreeing bins of each pair of sketches, corrected for chance."""
    for batch in batches:
        x = np.frombuffer(b"".join(batch["sketch_a"]), np.uint8) ^ np.frombuffer(b"".join(batch["sketch_b"]), np.uint8)
        same = ((x >> 4) == 0).astype(np.int16) + ((x & 15) == 0)
        share = same.reshape(len(batch), BINS // 2).sum(axis=1) / BINS
        yield batch[["a", "b", "n_a", "n_b"]].assign(alike=(share - 1 / 16) * 16 / 15)


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The bytes of the sorted shingle set of each text."""
    for batch in (own for frame in batches for own in text_slices(frame, BATCH_CHARS)):
        sets = [s.tobytes() for s in shingle_sets(batch["text"].tolist())]
        yield pd.DataFrame({"doc_id": batch["doc_id"].to_numpy(), "shingles": sets})


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many hashes each pair of sets has in common. Rare hashes are counted pair by pair, common ones by products of 0/1 matrices."""
    n = len(sets)
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    code = np.unique(np.concatenate(sets), return_inverse=True)[1] if len(row) else np.zeros(0, np.int64)
    order = np.argsort(code, kind="stable")
    row, often = row[order], np.bincount(code)
    start = np.cumsum(often) - often
    flat = np.zeros(n * n, np.int64)
    for times in range(2, COMMON):
        at = start[often == times]
        held = row[at[:, None] + np.arange(times)]
        for i in range(times):
            for j in range(times):
                flat += np.bincount(held[:, i] * n + held[:, j], minlength=n * n) if i != j and len(at) else 0
    shared = flat.reshape(n, n)
    common = np.flatnonzero(often >= COMMON)
    for k in range(0, len(common), COLUMNS):
        own = common[k : k + COLUMNS]
        have = np.zeros((n, len(own)), np.float32)
        for c, (a, m) in enumerate(zip(start[own].tolist(), often[own].tolist(), strict=True)):
            have[row[a : a + m], c] = 1
        shared = shared + np.rint(have @ have.T).astype(np.int64)
    return shared


def _tile_links(least_percent: int):
    """Links that join what the pairs of a tile join: pairs of its two sides, of different groups, whose sets are similar enough."""

    def run(tile: pd.DataFrame) -> pd.DataFrame:
        ids, group, side = (tile[c].to_numpy(np.int64) for c in ("doc_id", "component", "side"))
        sets = [np.frombuffer(s, np.uint64) for s in tile["shingles"]]
        size = np.array([len(s) for s in sets], np.int64)
        shared = shared_counts(sets)
        linked = 100 * shared >= least_percent * (size[:, None] + size[None, :] - shared)
        linked &= (group[:, None] != group[None, :]) & ((side[:, None] != side[None, :]) | (side[:, None] == 0))
        seen, out = np.zeros(len(ids), bool), []
        for first in range(len(ids)):
            todo = [] if seen[first] else [first]
            seen[first] = True
            while todo:
                x = todo.pop()
                new = np.flatnonzero(linked[x] & ~seen)
                seen[new] = True
                out += [(ids[x], ids[y]) for y in new]
                todo += new.tolist()
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return run


def _rest(texts: DataFrame, reps: DataFrame, groups: DataFrame, scratch: Scratch, least_percent: int) -> DataFrame | None:
    """Links between documents that share a bucket and still lie in different groups, each such pair compared on full sets.

    Buckets whose documents are of more than one group are open. Documents that a chain of open buckets joins form a cluster; pairs of
    its largest group are linked already. The others meet each other, and those of the largest group, in tiles. None if no bucket is open.
    """
    component = F.coalesce("component", "doc_id").alias("component")
    placed = reps.join(groups.select(F.col("id").alias("doc_id"), "component"), "doc_id", "left").select("doc_id", "n_shingles", component, "bands")
    placed = scratch.put(placed, "placed")
    member = placed.select("doc_id", "component", F.explode("bands").alias("bucket"))
    opened = member.groupBy("bucket").agg(F.min("component").alias("one"), F.max("component").alias("other"), F.min("doc_id").alias("low")).where("one < other")
    opened = scratch.put(opened.select("bucket", "low"), "open-buckets")
    if opened.isEmpty():
        return None
    chains = scratch.put(member.join(few_rows(opened), "bucket").select(F.col("doc_id").alias("a"), F.col("low").alias("b")).distinct(), "chains")
    cluster = connected_components(chains, scratch, "clusters").select(F.col("id").alias("doc_id"), F.col("component").alias("cluster"))
    rows = scratch.put(placed.drop("bands").join(few_rows(cluster), "doc_id"), "rest")
    sizes = rows.groupBy("cluster", "component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("s"))
    blocks = lambda n, s: F.ceil(F.greatest(n / TILE, s / TILE_SHINGLES)).cast("int")
    of = sizes.groupBy("cluster").agg(F.max(F.struct("n", "component", "s")).alias("most"), F.sum("n").alias("n"), F.sum("s").alias("s"))
    of = of.select("cluster", F.col("most.component").alias("largest"), blocks(F.col("most.n"), F.col("most.s")).alias("n_large"), blocks(F.col("n") - F.col("most.n"), F.col("s") - F.col("most.s")).alias("n_other"))
    draw = lambda n: F.pmod(F.xxhash64("doc_id"), F.col(n)).cast("int")
    # blocks of the others come first, then those of the largest group
    numbered = rows.join(few_rows(of, rows), "cluster").withColumn("block", F.when(F.col("component") == F.col("largest"), F.col("n_other") + draw("n_large")).otherwise(draw("n_other")))
    meets = F.when(F.col("block") < F.col("n_other"), F.sequence(F.lit(0), F.col("n_other") + F.col("n_large") - 1)).otherwise(F.sequence(F.lit(0), F.col("n_other") - 1))
    tiles = numbered.select("doc_id", "component", "cluster", "block", F.explode(meets).alias("with"))
    tiles = tiles.select("doc_id", "component", "cluster", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), F.when(F.col("block") == F.col("with"), 0).when(F.col("block") < F.col("with"), 1).otherwise(2).alias("side"))
    sets = texts.join(few_rows(rows.select("doc_id")), "doc_id", "left_semi").mapInPandas(_sets, "doc_id long, shingles binary")
    # a document has a row for each tile that it is in, which Spark's estimate of the size of tiles does not know
    return tiles.hint("merge").join(scratch.put(sets, "sets"), "doc_id").groupBy("cluster", "i", "j").applyInPandas(_tile_links(least_percent), "a long, b long")


def near_duplicates(docs: DataFrame, least_percent: int = 75) -> DataFrame:
    """Group the documents whose sets of five-word shingles have a Jaccard similarity of ``least_percent`` or more.

    Documents with equal sets form a class that is compared through its smallest doc_id. Class representatives that share a
    band's bucket are joined to the bucket's few centres only, so the candidate pairs grow with the documents and not with the square of a
    bucket. First each representative's most similar candidate is confirmed on the full sets, then the candidates
    that still lie in different groups. Last, documents that share a bucket and still lie in different groups are all compared on the full
    sets, in tiles, so that no pair which shares a bucket is lost to the choice of centres. Groups are the components of confirmed links.

    Null or empty text, or text without words, has an empty set and is linked with nothing. Rows that repeat a doc_id must
    repeat its text, and give one row; an empty table gives none; other columns are ignored. Returns doc_id, n_shingles, component_id
    (smallest doc_id of the group), kept (whether it is this one).
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "minhash")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, n_shingles long, set_key binary, sketch binary, bands array<long>"
    described = scratch.put(texts.mapInPandas(_describe, schema), "described")
    classes = scratch.put(described.where("set_key IS NOT NULL").groupBy("set_key").agg(F.min("doc_id").alias("rep")), "classes")
    often = scratch.put(described.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"), "often")
    once = _once(texts, often)
    # equal rows have equal sketches; tables of about as many rows as documents are joined by a shuffle, however small their files look
    reps = scratch.put(_once(described, often).join(classes.select(F.col("rep").alias("doc_id")).hint("merge"), "doc_id", "left_semi").select("doc_id", "n_shingles", "sketch", "bands"), "reps")

    member = reps.select("doc_id", F.explode("bands").alias("bucket"))
    first = [F.min(F.struct(F.xxhash64("doc_id", F.lit(k)).alias("order"), F.col("doc_id").alias("id")))["id"] for k in range(1, CENTRES)]
    centres = member.groupBy("bucket").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), *[c.alias(f"c{k}") for k, c in enumerate(first)]).where("low < high")
    star = member.join(centres, "bucket").select("doc_id", F.explode(F.array_distinct(F.array("low", *[f"c{k}" for k in range(CENTRES - 1)]))).alias("centre"))
    edges = star.where("doc_id <> centre").select(F.col("doc_id").alias("a"), F.col("centre").alias("b")).distinct()

    slim = reps.select("doc_id", "n_shingles", "sketch")
    side = lambda x: slim.select(F.col("doc_id").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("sketch").alias(f"sketch_{x}"))
    # edges are written first, so that a centre of very many is a hot key of a plain join, which adaptive execution splits
    sized = scratch.put(edges, "edges").hint("merge").join(side("a"), "a").hint("merge").join(side("b"), "b").where(100 * F.least("n_a", "n_b") >= least_percent * F.greatest("n_a", "n_b"))
    alike = sized.select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b").mapInPandas(_agreement, "a long, b long, n_a long, n_b long, alike double").where(F.col("alike") >= LEAST_AGREEMENT)
    candidates = scratch.put(alike, "candidates")
    scratch.drop("edges")

    best = candidates.groupBy("a").agg(F.max(F.struct("alike", "b", "n_a", "n_b")).alias("x")).select("a", "x.b", "x.n_a", "x.n_b")
    best = scratch.put(best, "best")
    links = scratch.put(_confirmed(once, best, least_percent, scratch), "links-1")
    groups = few_rows(connected_components(links, scratch, "groups-1"))
    of = lambda x: groups.select(F.col("id").alias(x), F.col("component").alias(f"of_{x}"))
    open_pairs = candidates.drop("alike").join(of("a"), "a", "left").join(of("b"), "b", "left").where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b", "n_a", "n_b")
    open_pairs = scratch.put(open_pairs.join(few_rows(best.select("a", "b")), ["a", "b"], "left_anti"), "open")
    scratch.free_shuffles()
    links = links.unionByName(scratch.put(_confirmed(once, open_pairs, least_percent, scratch), "links-2"))
    groups = few_rows(connected_components(links, scratch, "groups-2"))
    more = _rest(once, reps, groups, scratch, least_percent)
    if more is not None:
        groups = few_rows(connected_components(links.unionByName(scratch.put(more, "links-3")), scratch, "groups-3"))
    scratch.free_shuffles()

    component = classes.join(groups.withColumnRenamed("id", "rep"), "rep", "left").select("set_key", F.coalesce("component", "rep").alias("component"))
    plain = _once(described.select("doc_id", "n_shingles", "set_key"), often)
    out = plain.join(component, "set_key", "left").withColumn("component_id", F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


def _once(rows: DataFrame, often: DataFrame) -> DataFrame:
    """One row of each doc_id. Only the ids in ``often`` have several, and only their rows are dealt anew."""
    if often.isEmpty():
        return rows
    ids = few_rows(often)
    return rows.join(ids, "doc_id", "left_anti").unionByName(rows.join(ids, "doc_id", "left_semi").dropDuplicates(["doc_id"]))


def _confirmed(texts: DataFrame, pairs: DataFrame, least_percent: int, scratch: Scratch) -> DataFrame:
    """The pairs ``(a, b)`` that hold on full sets.

    The documents that meet one centre b are cut into chunks of about CHUNK_SHINGLES, and the centre's text travels once to each chunk; chunks are
    joined to groups of about GROUP_SHINGLES, so that a centre of very many documents is dealt over as many groups.
    """
    load = pairs.groupBy("b").agg((F.ceil(F.sum("n_a") / CHUNK_SHINGLES)).cast("long").alias("chunks"))
    several = scratch.put(load.where("chunks > 1"), "several")
    size = pairs.agg(F.sum(F.col("n_a") + F.col("n_b"))).first()[0] or 0
    keyed = pairs.join(few_rows(several), "b", "left").select("a", "b", F.pmod(F.xxhash64("a"), F.coalesce("chunks", F.lit(1))).alias("chunk"))
    keyed = keyed.select("a", "b", F.pmod(F.xxhash64("b", "chunk"), F.lit(-(-size // GROUP_SHINGLES) or 1)).alias("group"), "chunk")
    centres = keyed.select(F.col("b").alias("doc_id"), F.col("b").alias("centre"), "group", F.lit(True).alias("is_centre")).distinct()
    members = scratch.put(keyed.select(F.col("a").alias("doc_id"), F.col("b").alias("centre"), "group", F.lit(False).alias("is_centre")).unionByName(centres), "members")
    return texts.join(few_rows(members), "doc_id").groupBy("group").applyInPandas(_confirm(least_percent), "a long, b long")
