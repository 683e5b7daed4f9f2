"""Near-duplicate embeddings: products of int8 tiles with error bounds, recomputed in double precision where they may pass."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txspark.llm.components import connected_components
from txspark.llm.staging import Scratch

#: Vectors of a tile's side.
TILE = 4096
LEVELS = 127.0


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, a scale for each vector, and the length of what the codes miss of it.

    x = scale * code + rest, and |rest| is computed, not estimated, so it bounds the error of any product.
    """
    scale = np.abs(unit).max(axis=1, initial=0) / LEVELS
    scale = np.where(scale > 0, scale, 1.0)
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    rest = np.linalg.norm(unit - scale[:, None] * codes, axis=1)
    return codes, scale, rest


def normalise(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision, without overflow of the squares."""
    x = vectors.astype(np.float64)
    x = x / np.abs(x).max(axis=1, initial=0, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def tile_links(x: np.ndarray, y: np.ndarray | None, least: float, step: int = 512) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of x and y (of x above the diagonal, if y is None) with a cosine of ``least`` or more, a band of rows at a time.

    With codes q, scales s and rests of length r, |x.y - s_x s_y q_x.q_y| <= r_x + r_y + r_x r_y for vectors of length 1.
    Products of int8 codes stay exact in single precision up to 1040 dimensions; double precision serves beyond. Pairs whose
    lower bound reaches ``least`` hold; those whose upper bound alone does are computed again from the vectors.
    """
    kind = np.float32 if x.shape[1] <= 1040 else np.float64
    qx, sx, rx = quantise(x)
    qy, sy, ry = (qx, sx, rx) if y is None else quantise(y)
    other = x if y is None else y
    rounding = 1e-6  # of the scales and bounds in single precision
    wide = qy.astype(kind).T
    for at in range(0, len(x), step):
        own = slice(at, at + step)
        near = (qx[own].astype(kind) @ wide) * sx[own, None].astype(kind) * sy[None, :].astype(kind)
        error = (rx[own, None] + ry[None, :] + rx[own, None] * ry[None, :] + rounding).astype(kind)
        i, j = np.nonzero(near + error >= least)
        if y is None:
            above = j > i + at
            i, j = i[above], j[above]
        sure = near[i, j] - error[i, j] >= least
        for part in range(0, len(i), 1 << 15):
            k = slice(part, part + (1 << 15))
            open_ = np.flatnonzero(~sure[k]) + part
            sure[open_] = np.einsum("nd,nd->n", x[i[open_] + at], other[j[open_]]) >= least
        yield i[sure] + at, j[sure]


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning set of edges of a tile's links: each id to the least id of its component in the tile."""
    ids, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(ids))
    while True:
        low = label.copy()
        np.minimum.at(low, u, label[v])
        np.minimum.at(low, v, label[u])
        low = low[low]
        if (low == label).all():
            return ids[label != np.arange(len(ids))], ids[label[label != np.arange(len(ids))]]
        label = low


def _tile(least: float, kind: str):
    """Links between the one or two blocks of a tile: counts for each vector, and edges of a spanning forest."""

    def run(key: tuple, blocks: pd.DataFrame) -> pd.DataFrame:
        blocks = blocks.sort_values("side")
        ids = [np.frombuffer(b, np.int64) for b in blocks["ids"]]
        copies = [np.frombuffer(b, np.int64) for b in blocks["copies"]]
        unit = [normalise(np.frombuffer(b, kind).reshape(len(i), -1)) for b, i in zip(blocks["matrix"], ids, strict=True)]
        x, y = unit[0], unit[1] if len(unit) > 1 else None
        counts = [np.zeros(len(i), np.int64) for i in ids]
        edges = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for i, j in tile_links(x, y, least):
            counts[0] += np.bincount(i, copies[-1][j], len(ids[0])).astype(np.int64)
            counts[-1] += np.bincount(j, copies[0][i], len(ids[-1])).astype(np.int64)
            edges.append(_forest(ids[0][i], ids[-1][j]))
        a, b = _forest(*(np.concatenate(e) for e in zip(*edges, strict=True)))
        all_ids, all_counts = np.concatenate(ids), np.concatenate(counts)
        some = all_counts > 0
        rows = pd.DataFrame({"a": all_ids[some], "b": all_ids[some], "n": all_counts[some]})
        return pd.concat([rows, pd.DataFrame({"a": a, "b": b, "n": np.zeros(len(a), np.int64)})])

    return run


def near_vectors(vectors: DataFrame, least: float = 0.9, tile: int = TILE) -> DataFrame:
    """Link all vectors with a cosine of ``least`` or more, and group them.

    Equal vectors form a class of which one is compared. The others are dealt to blocks of about ``tile`` vectors; each pair of
    blocks is one tile, and a task holds two blocks at a time. A tile returns a count of links for each of its vectors and a
    spanning forest, so a large group of near copies costs no more rows than vectors. All pairs of different vectors are
    compared, so the work, though spread over all tasks, grows with the square of their number.

    Vectors that are null, empty, zero or hold a null or a non-finite component link with nothing; vectors of different
    lengths link with nothing of another length. Rows that repeat a vec_id and its vector count once; an empty table gives no
    rows; other columns are ignored. Returns vec_id, n_links, component_id (smallest vec_id of the group) and kept.
    """
    scratch = Scratch(vectors.sparkSession, "vectors")
    v = F.col("embedding")
    kind = "f4" if vectors.schema["embedding"].dataType.elementType.typeName() == "float" else "f8"
    finite = lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))
    usable = F.coalesce(F.size(v) > 0, F.lit(False)) & F.forall(v, finite) & F.exists(v, lambda x: x != 0)
    rows = scratch.put(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(usable, v).alias("v")).distinct(), "rows")
    classes = scratch.put(rows.where("v IS NOT NULL").groupBy("v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "classes")
    blocks = {r["dim"]: -(-r["n"] // tile) for r in classes.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).collect()}

    def packed(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
        matrix = np.stack(own["v"].to_list()).astype(kind)
        return pd.DataFrame({"dim": [key[0]], "block": [key[1]], "ids": [own["rep"].to_numpy(np.int64).tobytes()], "copies": [own["copies"].to_numpy(np.int64).tobytes()], "matrix": [matrix.tobytes()]})

    number = F.lit(1)
    for dim, n in blocks.items():
        number = F.when(F.size("v") == dim, F.lit(n)).otherwise(number)
    dealt = classes.withColumns({"dim": F.size("v"), "block": F.pmod(F.xxhash64("rep"), number)})
    packs = dealt.groupBy("dim", "block").applyInPandas(packed, "dim int, block long, ids binary, copies binary, matrix binary")
    packs = scratch.put(packs, "blocks")
    of = F.lit(1)
    for dim, n in blocks.items():
        of = F.when(F.col("dim") == dim, F.lit(n)).otherwise(of)
    block = F.col("block")
    # block i meets i, i + 1, ... i + of / 2 around the circle; for an even number, the far ones only once
    ahead = F.transform(F.sequence(F.lit(0), F.floor(of / 2)), lambda k: F.struct(block.alias("i"), F.pmod(block + k, of).alias("j"), F.lit(0).alias("side"), k.alias("k")))
    behind = F.transform(F.sequence(F.lit(0), F.floor(of / 2)), lambda k: F.struct(F.pmod(block - k, of).alias("i"), block.alias("j"), F.lit(1).alias("side"), k.alias("k")))
    places = packs.withColumn("t", F.explode(F.concat(ahead, F.filter(behind, lambda t: t["k"] > 0)))).where((F.col("t.k") * 2 < of) | (F.col("t.i") < F.col("t.j")) | (F.col("t.k") == 0))
    tiles = places.select("dim", "t.i", "t.j", "t.side", "ids", "copies", "matrix")
    found = scratch.put(tiles.groupBy("dim", "i", "j").applyInPandas(_tile(least, kind), "a long, b long, n long"), "found")
    links = found.where("n > 0").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    groups = connected_components(found.where("n = 0").select("a", "b"), scratch).withColumnRenamed("id", "rep")
    known = classes.join(links, "rep", "left").join(groups, "rep", "left")
    known = known.select("v", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component"))
    out = rows.join(known, "v", "left").withColumn("component_id", F.coalesce("component", "vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))
