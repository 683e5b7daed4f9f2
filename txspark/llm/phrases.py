"""Phrases whose words occur together more often than apart."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txspark.llm.staging import Scratch, few_rows
from txspark.llm.words import PLACES, mix, text_slices

ORDER = 5
LEAST = 100
TOP = 2000
#: Runs of two up to so many words are counted by hash before the windows are, 1 for none; their keys have so many bits more than the number of words in the table.
PRUNED, SPARE_BITS = 1, 3
#: Characters of text whose windows are counted at a time; a text is never cut.
SLICE_CHARS = 32_000_000
#: Bits of a filter for each key, hashes of a key, and the most bits of a filter: it is broadcast, and its size is bounded by them alone.
BITS_PER_KEY, HASHES, MOST_BITS = 16, 4, 1 << 26

#: A-Z in lower case, marks that end a piece as line feeds, tabs as spaces.
_BYTES = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz\n\n\n\n\n\n\n\n\n ")


class Filter:
    """A Bloom filter as an array of uint64, of keys without their lowest ``drop`` bits: keys that it lacks are certainly absent."""

    def __init__(self, words: np.ndarray, drop: int = 0):
        self.words, self.drop = words, drop

    def holds(self, keys: np.ndarray) -> np.ndarray:
        keys = keys >> np.uint64(self.drop)
        found = np.ones(len(keys), bool)
        for k in range(HASHES):
            at = _place(keys, k, len(self.words) * 64)
            found &= (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
        return found


def _place(keys: np.ndarray, k: int, bits: int) -> np.ndarray:
    return (mix(keys * PLACES[k]) & np.uint64(bits - 1)).astype(np.int64)


def build_filter(keys: DataFrame, drop: int = 0) -> Filter:
    """A filter of the ``key`` column: tasks make words of bits, which are joined by or; at most MOST_BITS bits reach the driver, however many keys there are."""
    n = keys.count()
    bits = 64
    while bits < min(n * BITS_PER_KEY, MOST_BITS):
        bits *= 2

    def words(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            own = frame["key"].to_numpy(np.int64).view(np.uint64)
            at = np.unique(np.concatenate([_place(own, k, bits) for k in range(HASHES)]))
            index, starts = np.unique(at >> 6, return_index=True)
            if len(index):
                yield pd.DataFrame({"i": index, "w": np.bitwise_or.reduceat(np.uint64(1) << (at & 63).astype(np.uint64), starts).view(np.int64)})

    found = keys.select("key").mapInPandas(words, "i long, w long").groupBy("i").agg(F.bit_or("w").alias("w")).toPandas()
    out = np.zeros(bits // 64, np.uint64)
    out[found["i"].to_numpy(np.int64)] = found["w"].to_numpy(np.int64).view(np.uint64)
    return Filter(out, drop)


class _Codes(dict):
    """Words by the order in which they are first asked for, from 1."""

    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self) + 1
        return code


def word_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Codes of all words in order, whether each is the last of its piece, and the words by code, text by text."""
    codes, parts, lasts = _Codes(), [], []
    for text in texts:
        data = text.encode("utf-8", "surrogatepass").translate(_BYTES) + b"\n"
        words = data.split()
        parts.append(np.fromiter(map(codes.__getitem__, words), np.int32, len(words)))
        raw = np.frombuffer(data, np.uint8)
        inside = (raw != 32) & (raw != 10)
        piece = np.cumsum(raw == 10, dtype=np.int32)[np.flatnonzero(inside[:-1] & ~inside[1:])]
        lasts.append(np.append(piece[1:] != piece[:-1], True) if len(piece) else np.zeros(0, bool))
    join = lambda xs, kind: np.concatenate(xs) if xs else np.zeros(0, kind)
    return join(parts, np.int32), join(lasts, bool), [b"", *codes]


def run_keys(columns: list[np.ndarray]) -> np.ndarray:
    """A key for each row of word ids, which depends on their places."""
    return mix(sum(mix(c.astype(np.uint64)) * p for c, p in zip(columns, PLACES, strict=False)))


class Lexicon:
    """Frequent words by id, from 1, of all languages: an id tells its language. Windows of ids are packed into as few int64 as hold ``order`` of them."""

    def __init__(self, words: list[tuple[str, str]], order: int):
        self.words, self.order = words, order
        self.bits = max(len(words).bit_length(), 1)
        # the two words that windows are dealt by lie apart, so that rows beside each other differ in one place only and compress well
        per = 62 // self.bits
        self.widths = [min(2, order), *(min(per, order - start) for start in range(2, order, per))]
        self.packs = [f"p{i}" for i in range(len(self.widths))]

    def ids(self) -> dict[str, dict[bytes, int]]:
        out: dict[str, dict[bytes, int]] = {}
        for i, (lang, word) in enumerate(self.words, 1):
            out.setdefault(lang, {})[word.encode("utf-8", "surrogatepass")] = i
        return out

    def word(self, packs: list[np.ndarray], k: int) -> np.ndarray:
        """The ids at place ``k``, 0 where a window is shorter."""
        for pack, width in zip(packs, self.widths, strict=True):
            if k < width:
                return (pack >> (self.bits * (width - 1 - k))) & ((1 << self.bits) - 1)
            k -= width
        raise IndexError(k)

    def prefix(self, packs: list[np.ndarray], size: int) -> list[np.ndarray]:
        """Windows cut after ``size`` words."""
        out = []
        for pack, width in zip(packs, self.widths, strict=True):
            drop = self.bits * (width - min(max(size, 0), width))
            out.append((pack >> drop) << drop)
            size -= width
        return out


def slice_windows(texts: list[str], known: dict[bytes, int], lexicon: Lexicon, filters: list[Filter]) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct lead windows of two words or more in texts of one language, packed and sorted, and their counts.

    A window starts at each word of the lexicon. It ends with its piece, before a word that the lexicon lacks, or before the first run of k + 2 words that the k-th filter lacks.
    """
    here, last, names = word_codes(texts)
    here = np.fromiter((known.get(w, 0) for w in names), np.int32, len(names))[here]
    columns, at, packs = [here], np.zeros(0, np.int64), []
    sizes = iter(lexicon.widths)
    room = next(sizes) - 1
    for k in range(1, lexicon.order):
        after = np.append(columns[-1][1:], np.int32(0))
        both = (columns[-1] > 0) & (after > 0)
        if k == 1:
            both &= ~last
        if k <= len(filters):
            # words of the run but its last lie in all columns so far
            on = np.flatnonzero(both)
            both[on] = filters[k - 1].holds(run_keys([*(c[on] for c in columns), after[on]]))
        after[~both] = 0
        columns = [*columns, after] if k < len(filters) else [after]
        if k == 1:
            at = np.flatnonzero(both)
            packs.append(here[at].astype(np.int64))
        if not room:
            packs.append(np.zeros(len(at), np.int64))
            room = next(sizes)
        packs[-1] = (packs[-1] << lexicon.bits) | after[at]
        room -= 1
    if not len(at):
        return packs, np.zeros(0, np.int64)
    by = np.lexsort(packs[::-1]) if len(packs) > 1 else np.argsort(packs[0], kind="stable")
    packs = [p[by] for p in packs]
    first = np.flatnonzero(_fresh(packs))
    return [p[first] for p in packs], np.diff(np.append(first, len(by)))


def _fresh(columns: list[np.ndarray]) -> np.ndarray:
    """Whether each of the sorted rows differs from the one before it."""
    out = np.ones(len(columns[0]), bool)
    out[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return out


def _by_language(docs: DataFrame, rows: Callable, schema: str) -> DataFrame:
    """What ``rows`` makes of the texts of each language in each slice; it is built once in a task."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own_rows = rows()
        for frame in frames:
            for part in text_slices(frame, SLICE_CHARS):
                for lang, own in part.groupby("lang", sort=True):
                    yield own_rows(lang, own["text"].tolist())

    return docs.mapInPandas(count, schema)


def _frequent_words(docs: DataFrame, least: int) -> DataFrame:
    """(lang, word, n) of words with n at least ``least``, and a row with a null word for each language: all of its words."""

    def rows(lang, texts):
        codes, _, names = word_codes(texts)
        n = np.bincount(codes, minlength=len(names))
        words = [None, *(w.decode("utf-8", "surrogatepass") for w in names[1:])]
        return pd.DataFrame({"lang": np.full(len(words), lang, object), "word": np.array(words, object), "n": np.append(len(codes), n[1:])})

    return _by_language(docs, lambda: rows, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")).where(F.col("word").isNull() | (F.col("n") >= least))


def _windows(docs: DataFrame, lexicon: Lexicon, filters: list[Filter], rows: Callable, schema: str) -> DataFrame:
    """What ``rows`` makes of the windows of each slice of each language."""
    shared = docs.sparkSession.sparkContext.broadcast((lexicon, [(f.words, f.drop) for f in filters]))

    def build():
        own, words = shared.value
        ids, own_filters = own.ids(), [Filter(*f) for f in words]
        return lambda lang, texts: rows(own, *slice_windows(texts, ids.get(lang, {}), own, own_filters))

    return _by_language(docs, build, schema)


def _frequent_runs(docs: DataFrame, words: list[tuple[str, str]], size: int, filters: list[Filter], drop: int, least: int) -> DataFrame:
    """(key, n) of runs of ``size`` words that pass, by hash without its lowest ``drop`` bits, with n at least ``least``: runs of one key are added up."""

    def rows(lexicon, packs, n):
        columns = [lexicon.word(packs, k) for k in range(size)] if packs else [np.zeros(0, np.int64)] * size
        whole = columns[-1] > 0
        return pd.DataFrame({"key": (run_keys([c[whole] for c in columns]) >> np.uint64(drop)).view(np.int64), "n": n[whole]})

    return _windows(docs, Lexicon(words, size), filters, rows, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def prefix_counts(frames: Iterator[pd.DataFrame], lexicon: Lexicon, least: int) -> Iterator[pd.DataFrame]:
    """(lang, size, phrase, f) of all prefixes of two words or more with f at least ``least``, of windows sorted by their packs, whichever way these are cut into frames.

    Equal prefixes lie side by side, so that only the last of each size is kept from one frame to the next.
    """
    sizes = range(2, lexicon.order + 1)
    last: dict[int, tuple[list[np.ndarray], np.ndarray]] = {}

    def found(size: int, packs: list[np.ndarray], f: np.ndarray) -> pd.DataFrame:
        packs, f = [p[f >= least] for p in packs], f[f >= least]
        ids = zip(*(lexicon.word(packs, k).tolist() for k in range(size)), strict=True)
        words = [[lexicon.words[i - 1] for i in row] for row in ids]
        return pd.DataFrame({"lang": np.array([w[0][0] for w in words], object), "size": np.full(len(f), size, np.int32), "phrase": np.array([" ".join(x[1] for x in w) for w in words], object), "f": f})

    for frame in frames:
        whole, n = [frame[p].to_numpy(np.int64) for p in lexicon.packs], frame["n"].to_numpy(np.int64)
        for size in sizes:
            held = lexicon.word(whole, size - 1) > 0
            if not held.any():
                continue
            packs, f = lexicon.prefix([p[held] for p in whole], size), n[held]
            if size in last:
                packs, f = [np.append(a, b) for a, b in zip(last[size][0], packs, strict=True)], np.append(last[size][1], f)
            first = np.flatnonzero(_fresh(packs))
            packs, f = [p[first] for p in packs], np.add.reduceat(f, first)
            last[size] = [p[-1:] for p in packs], f[-1:]
            if (f[:-1] >= least).any():
                yield found(size, [p[:-1] for p in packs], f[:-1])
    for size, (packs, f) in last.items():
        yield found(size, packs, f)


def phrase_counts(docs: DataFrame, scratch: Scratch, order: int = ORDER, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, size, phrase, f) of all phrases of 1 to ``order`` words with f >= least, and (lang, n).

    Each frequent word is the start of one window with the frequent words that follow, up to the end of the piece. Windows are distinct in their slice, packed into integers, dealt
    by their first two words and sorted, and one pass over them sums all their prefixes: these are all phrases. Rows grow with the words of the input, as no run of words is
    pruned by its own count unless PRUNED says so: how many runs pass such a test grows faster than the input, from few in a small table to nearly all in a large one.
    """
    ones = scratch.put(_frequent_words(docs, least), "words")
    singles = ones.where("word IS NOT NULL")
    # at most one in ``least`` of all words, far fewer in any language
    words = [(r["lang"], r["word"]) for r in singles.select("lang", "word").orderBy("lang", "word").toLocalIterator()]
    lexicon, filters = Lexicon(words, order), []
    if PRUNED > 1:
        total = ones.where("word IS NULL").agg(F.sum("n")).first()[0] or 0
        # some keys for each word of the table: less would join many rare runs to frequent ones, more would only make longer rows
        drop = max(0, 64 - int(total).bit_length() - SPARE_BITS)
        for size in range(2, min(PRUNED, order) + 1):
            runs = scratch.put(_frequent_runs(docs, words, size, filters, drop, least), f"runs-{size}")
            filters.append(build_filter(runs, drop))
    rows = lambda lexicon, packs, n: pd.DataFrame({**dict(zip(lexicon.packs, packs or [n] * len(lexicon.packs), strict=True)), "n": n})
    schema = ", ".join(f"{p} long" for p in lexicon.packs) + ", n int"
    windows = _windows(docs, lexicon, filters, rows, schema)
    two = F.shiftright(F.col("p0"), lexicon.bits * (lexicon.widths[0] - 2))
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    longer = windows.repartition(two).sortWithinPartitions(*lexicon.packs).mapInPandas(lambda frames: prefix_counts(frames, shared.value, least), "lang string, size int, phrase string, f long")
    counts = singles.select("lang", F.lit(1).alias("size"), F.col("word").alias("phrase"), F.col("n").alias("f")).unionByName(longer)
    return scratch.put(counts, "phrases"), ones.where("word IS NULL").select("lang", "n")


def mine_phrases(docs: DataFrame, order: int = ORDER, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best collocations of each language.

    Text, with A-Z in lower case, is split at marks and line ends into pieces and these at spaces and tabs into words. A candidate is a phrase of 2 to ``order`` words that
    occurs a >= least times. Cutting it in two parts that occur l and r times gives the score floor(1000 * a * n / (l * r)) with n words in the language; the lowest cut
    counts, ties to the shortest first part. Candidates within a longer one that occurs as often are dropped: then one of them has just one word more, since
    counts cannot rise with length. The ``top`` of each language are returned by score, then a, falling, then phrase in byte order.

    Null text counts as empty, null language as ``und``; a language without candidates has no rows. Repeated rows count each; other columns are ignored; an empty table gives none.
    """
    scratch = Scratch(docs.sparkSession, "phrases")
    plain = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    counts, totals = phrase_counts(plain, scratch, order, least)
    longer = counts.where("size > 1")
    words = F.split("phrase", " ")
    longest = longer.where("size > 2")
    within = longest.select("lang", F.explode(F.array(F.slice(words, 1, F.col("size") - 1), F.slice(words, 2, F.col("size") - 1))).alias("part"), F.col("f").alias("a")).select("lang", F.array_join("part", " ").alias("phrase"), "a").distinct()
    left = longer.withColumnRenamed("f", "a").join(within, ["lang", "phrase", "a"], "left_anti")
    cuts = left.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("*", F.array_join(F.slice(words, F.lit(1), F.col("k")), " ").alias("head"), F.array_join(F.slice(words, F.col("k") + 1, F.size(words)), " ").alias("tail"))
    known = few_rows(counts.select("lang", "phrase", "f"))
    part = lambda name, f: known.withColumnsRenamed({"phrase": name, "f": f})
    cuts = cuts.join(part("head", "l"), ["lang", "head"]).join(part("tail", "r"), ["lang", "tail"]).join(few_rows(totals), "lang")
    exact = lambda x: f"CAST({x} AS decimal(38, 0))"
    scored = cuts.withColumn("score", F.expr(f"(CAST(1000 * a AS decimal(19, 0)) * CAST(n AS decimal(18, 0))) div {exact('CAST(l AS decimal(18, 0)) * CAST(r AS decimal(18, 0))')}"))
    lowest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("x")).select("lang", "phrase", "x.*")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase"))
    return lowest.withColumn("rank", rank).where(F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
