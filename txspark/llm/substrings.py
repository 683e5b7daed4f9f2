"""Exact removal of repeated substrings, with a logarithmic family of sparse suffix indexes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txspark.llm.staging import Scratch, few_rows
from txspark.llm.words import mix

#: Length of the repeated strings, and of the prefix by which suffixes are told apart first.
LENGTH, PREFIX = 200, 32
#: Windows of a block, the step between an anchor's windows and single ones.
BLOCK = 16
#: Bytes of text that are hashed at a time, near enough. A window's key has PLACE_BITS bits of its hash, and a place in the others.
BATCH_BYTES, PLACE_BITS = 2_000_000, 40
#: Batches in which a whole table enters the index.
BATCHES = 4

_A, _B = np.uint64(0x9FB21C651E98DF25), np.uint64(0xD6E8FEB86659FD93)


def _pair(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """A hash of two hashes, in order."""
    return mix(x * _A ^ (y * _B + (y >> np.uint64(29))))


class _Hashes:
    """Hashes of all substrings of PREFIX and 128 bytes of a byte string, by doubling."""

    def __init__(self, data: np.ndarray):
        self.n = len(data)
        padded = np.concatenate([data, np.zeros(LENGTH + 64, np.uint8)])
        h = mix(np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, 8)[: self.n + LENGTH]).view("<u8").ravel())
        self.by: dict[int, np.ndarray] = {}
        for k in (8, 16, 32, 64):
            h = _pair(h[: len(h) - k], h[k:])
            if 2 * k in (PREFIX, 128):
                self.by[2 * k] = h

    def at(self, length: int, places: np.ndarray) -> np.ndarray:
        """Hashes of the substrings of ``length`` (128 to 256) at the places: two overlapping halves of 128."""
        h = self.by[128]
        return _pair(h[places], h[places + (length - 128)])


def _texts(frame: pd.DataFrame) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """The rows of a frame in batches: their numbers, joined bytes, and where each text starts, with the end."""
    rows, parts, size = [], [], 0

    def batch():
        starts = np.cumsum([0, *map(len, parts)])
        return rows, np.frombuffer(b"".join(parts), np.uint8), starts

    for k, text in enumerate(frame["text"]):
        data = text.encode("utf-8", "surrogatepass") if text else b""
        if rows and size + len(data) > BATCH_BYTES:
            yield batch()
            rows, parts, size = [], [], 0
        rows.append(k)
        parts.append(data)
        size += len(data)
    if rows:
        yield batch()


def _anchors_of(hashes: _Hashes, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first and last start of each run of windows of LENGTH bytes that share the anchor.

    The anchor of a window is the place in it whose prefix has the least hash, the leftmost if several; it follows from the window's bytes
    alone, so equal windows have their anchors at the same distance. No window crosses the end of a text.
    """
    windows = np.concatenate([np.arange(a, b - LENGTH + 1) for a, b in zip(starts[:-1], starts[1:], strict=True) if b - a >= LENGTH] or [np.zeros(0, np.int64)])
    if not len(windows):
        return windows, windows, windows
    low = np.uint64((1 << (64 - PLACE_BITS)) - 1)
    n = len(hashes.by[PREFIX])
    places = LENGTH - PREFIX + 1
    most = np.zeros(n - places + 1, np.int64)
    for begin in range(0, len(most), int(low) + 2 - places):  # as many places at a time as a key can tell apart
        part = hashes.by[PREFIX][begin : begin + int(low) + 1]
        width, least = 1, (part & ~low) | np.arange(len(part), dtype=np.uint64)
        while width < places:
            step = min(width, places - width)
            least = np.minimum(least[: len(least) - step], least[step:])
            width += step
        most[begin : begin + len(least)] = (least & low).astype(np.int64) + begin
    anchor = most[windows]
    text = np.searchsorted(starts, windows, side="right")
    new = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(windows)) - 1
    return anchor[first], windows[first], windows[last]


UNIT = "key long, hull long, doc_id long, anchor int, first int, windows int"


def _units(hashes: _Hashes, key: np.ndarray, doc: np.ndarray, base: np.ndarray, anchor: np.ndarray, first: np.ndarray, last: np.ndarray) -> pd.DataFrame:
    """``hull`` stands for all bytes of all windows of a unit and their places around the anchor."""
    ends = _pair(hashes.at(LENGTH, first), hashes.at(LENGTH, last))
    hull = _pair(ends, ((anchor - first) << 16 | (last - first)).astype(np.uint64))
    return pd.DataFrame({"key": key.view(np.int64), "hull": hull.view(np.int64), "doc_id": doc, "anchor": (anchor - base).astype(np.int32), "first": (first - base).astype(np.int32), "windows": (last - first + 1).astype(np.int32)})


def _anchors(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        ids = frame["doc_id"].to_numpy(np.int64)
        for rows, data, starts in _texts(frame):
            hashes = _Hashes(data)
            anchor, first, last = _anchors_of(hashes, starts)
            own = np.searchsorted(starts, first, side="right") - 1
            yield _units(hashes, hashes.by[PREFIX][anchor], ids[np.array(rows)[own]], starts[own], anchor, first, last)


def _split(block: int):
    """Cut the units of each text, in the column ``units``, at multiples of ``block`` windows before the anchor."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            ids, units = frame["doc_id"].to_numpy(np.int64), frame["units"].tolist()
            for rows, data, starts in _texts(frame):
                hashes = _Hashes(data)
                # text, its start, anchor, window: a row for each window
                table = np.array([(k, starts[k], u["anchor"], u["first"], u["windows"]) for k, r in enumerate(rows) for u in units[r]], np.int64).reshape(-1, 5)
                unit = np.repeat(np.arange(len(table)), table[:, 4])
                window = np.arange(len(unit)) - np.repeat(np.cumsum(table[:, 4]) - table[:, 4], table[:, 4]) + table[unit, 3] + table[unit, 1]
                anchor = table[unit, 2] + table[unit, 1]
                part = (anchor - window) // block
                new = np.concatenate(([True], (unit[1:] != unit[:-1]) | (part[1:] != part[:-1]))) if len(unit) else np.zeros(0, bool)
                at = np.flatnonzero(new)
                last = window[np.append(at[1:], len(unit)) - 1] if len(at) else at
                first, anchor, part, text = window[at], anchor[at], part[at], table[unit[at], 0]
                # the bytes that all windows of a block share, whether the unit has them all or not
                core = hashes.at(LENGTH - block + 1, anchor - part * block)
                yield _units(hashes, _pair(core, part.astype(np.uint64)), ids[np.array(rows, np.int64)[text]], starts[text], anchor, first, last)

    return run


class SuffixIndex:
    """Sparse suffixes in levels of doubling size.

    A batch enters as a table of the distinct prefixes of its anchored suffixes in sorted order, with their number and whether their
    surroundings differ. Levels made of equally many batches are merged by key into one of the next size, so each suffix is
    rewritten a logarithmic number of times, and a scan reads a logarithmic number of sorted tables.
    """

    def __init__(self, scratch: Scratch, name: str):
        self.scratch, self.name, self.levels, self.written = scratch, name, [], 0

    def _level(self, rows: DataFrame, size: int) -> tuple[int, str, DataFrame]:
        self.written += 1
        name = f"{self.name}-{self.written}"
        return size, name, self.scratch.put(rows.sortWithinPartitions("key"), name)

    def add(self, units: DataFrame) -> None:
        batch = units.groupBy("key").agg(F.count("*").alias("n"), F.min("hull").alias("low"), F.max("hull").alias("high"))
        self.levels.append(self._level(batch, 1))
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (size, one, a), (_, two, b) = self.levels.pop(), self.levels.pop()
            self.levels.append(self._level(_merged([a, b]), 2 * size))
            self.scratch.drop(one, two)

    def repeated(self) -> DataFrame:
        """Keys that occur at least twice in all that was added, and whether their hulls differ."""
        tables = [df for _, _, df in self.levels]
        rows = tables[0] if len(tables) == 1 else _merged(tables)
        return rows.where("n > 1").select("key", (F.col("low") != F.col("high")).alias("mixed"))


def _merged(tables: list[DataFrame]) -> DataFrame:
    union = tables[0]
    for df in tables[1:]:
        union = union.unionByName(df)
    return union.groupBy("key").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))


def _classify(units: DataFrame, repeated: DataFrame, scratch: Scratch, name: str) -> tuple[DataFrame, DataFrame]:
    """Units all of whose windows occur elsewhere, and one unit of each hull of the keys whose hulls differ."""
    known = scratch.put(units.join(few_rows(repeated), "key"), f"{name}-known")
    mixed = known.where("mixed")
    hulls = scratch.put(mixed.groupBy("key", "hull").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "anchor", "first", "windows")).alias("one")), f"{name}-hulls")
    same = hulls.where("n > 1").select("key", "hull")
    whole = known.where("NOT mixed").select("doc_id", "first", "windows").unionByName(mixed.join(same, ["key", "hull"], "left_semi").select("doc_id", "first", "windows"))
    return whole, hulls.select("one.*")


def _with_text(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """Texts joined to the one row that ``rows`` has for some of them; other texts are dropped before they are sent."""
    near = texts.join(few_rows(rows.select("doc_id")), "doc_id", "left_semi")
    return near.join(rows, "doc_id")


def _remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What is left of each text when its ranges are taken out."""
    for batch in batches:
        rows = []
        for doc_id, text, ranges in zip(batch["doc_id"], batch["text"], batch["ranges"], strict=True):
            data = text.encode("utf-8", "surrogatepass") if text else b""
            left, at, spans, end = [], 0, 0, -1
            for first, stop in sorted((r["first"], r["stop"]) for r in ranges) if ranges is not None else ():
                if first > end:
                    spans += 1
                    left.append(data[at:first])
                end = at = max(end, stop)
            left.append(data[at:])
            kept = b"".join(left)
            rows.append((doc_id, len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
        yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def remove_repeats(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """Take out each byte covered by a string of LENGTH bytes that also starts elsewhere in the table, or in the same text.

    Windows of LENGTH bytes are grouped by their anchor; suffixes at anchors, one in about 85, enter the index by batches.
    A key that occurs once has no repeated window. If all its surroundings agree, all windows at it repeat. Otherwise the windows are cut into
    blocks and these into single windows, each time with one unit for each different surrounding only, and compared in
    the same way, so the result is exact up to collisions of hashes of 64 bits under equal keys of 64 bits.

    Null or empty text has no bytes; texts shorter than LENGTH stay whole; all copies of a repeated string go; an empty table gives no rows; other
    columns are ignored. Rows that repeat a doc_id must repeat its text; they remove each other, as any copies do. Returns doc_id, n_bytes, n_removed, n_spans, kept_sha256.
    """
    scratch = Scratch(docs.sparkSession, "substrings")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    units = scratch.put(texts.mapInPandas(_anchors, UNIT), "anchors")
    index = SuffixIndex(scratch, "level")
    for k in range(batches):
        index.add(units.where(F.pmod(F.xxhash64("doc_id"), F.lit(batches)) == k))
    found, units = _classify(units, index.repeated(), scratch, "anchors")
    for block in (BLOCK, 1):
        per_text = units.groupBy("doc_id").agg(F.collect_list(F.struct("anchor", "first", "windows")).alias("units"))
        parts = scratch.put(_with_text(texts, scratch.put(per_text, f"units-{block}")).mapInPandas(_split(block), UNIT), f"parts-{block}")
        index = SuffixIndex(scratch, f"parts-{block}-level")
        index.add(parts)
        whole, units = _classify(parts, index.repeated(), scratch, f"parts-{block}")
        found = found.unionByName(whole)
    ranges = found.groupBy("doc_id").agg(F.collect_set(F.struct("first", (F.col("first") + F.col("windows") + F.lit(LENGTH - 1)).alias("stop"))).alias("ranges"))
    ranges = scratch.put(ranges, "ranges")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    none = F.lit(None).cast("array<struct<first:int,stop:int>>").alias("ranges")
    whole = texts.join(few_rows(ranges.select("doc_id")), "doc_id", "left_anti").select("doc_id", "text", none)
    return _with_text(texts, ranges).unionByName(whole).mapInPandas(_remove, schema)
