"""Binary k-mer profiles, TF-IDF weights and truncated singular value decomposition."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txspark.functions.scalars import to_binary
from txspark.session import stored


def _check(k_min: int, k_max: int) -> None:
    if not 1 <= k_min <= k_max:
        raise ValueError(f"1 <= k_min <= k_max does not hold for {k_min} and {k_max}")


#: Characters of a piece of a sequence, and pieces of an id that are counted together.
PIECE, PART = 1 << 16, 64
#: Cells of a dense matrix of counts, and characters, that a task holds at a time.
CELLS, CHARS = 1 << 21, 1 << 22


def _pieces(df: DataFrame, k_max: int) -> DataFrame:
    """(transcript_id, _at, code): the recoded sequences in pieces, dealt over the tasks, so that a long one is the work of many.

    Windows start at the characters 0 and 1; the k_max - 1 bases that follow a piece are written 3 and 4 and only complete them.
    """
    coded = df.select("transcript_id", to_binary(F.col("sequence")).alias("_s")).where("_s <> ''")
    n = F.floor((F.length("_s") - 1) / PIECE)
    placed = coded.select("transcript_id", "_s", F.explode(F.sequence(F.lit(0), n.cast("int"))).alias("_at"))
    own, after = F.substring("_s", F.col("_at") * PIECE + 1, F.lit(PIECE)), F.substring("_s", (F.col("_at") + 1) * PIECE + 1, F.lit(k_max - 1))
    return placed.select("transcript_id", "_at", F.concat(own, F.translate(after, "01", "34")).alias("code"))


def _joined(pieces: DataFrame, *key: Column) -> DataFrame:
    """A row for each key with the text of its pieces, between which stands a 2, which no window spans."""
    return pieces.groupBy("transcript_id", *key).agg(F.array_join(F.collect_list("code"), "2").alias("code"))


def _windows(texts: list[str], k_min: int, k_max: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(k, row, code) of the windows of each length: the number of the text and the k-mer as a binary number."""
    raw = np.frombuffer("2".join(texts).encode() + b"2" * k_max, np.uint8) - 48
    row = np.repeat(np.arange(len(texts), dtype=np.int64), [len(t) + 1 for t in texts])
    at = np.flatnonzero(raw[: len(row)] < 2)
    bits = raw % 3
    code = np.zeros(len(at), np.int64)
    for k in range(1, k_max + 1):
        bit = bits[at + (k - 1)]
        if (bit == 2).any():
            fine = bit < 2
            at, code, bit = at[fine], code[fine], bit[fine]
        code = code * 2 + bit
        if k >= k_min:
            yield k, row[at], code


def _slices(texts: list[str], k_max: int) -> Iterator[tuple[int, int, list[str]]]:
    """(first, last, texts): runs of texts whose counts fit in CELLS; a text longer than CHARS comes in several."""
    most, start, held = max(1, CELLS >> (k_max + 1)), 0, 0
    for i, text in enumerate(texts):
        if i > start and (i - start == most or held + len(text) > CHARS):
            yield start, i, texts[start:i]
            start, held = i, 0
        held += len(text)
        if len(text) > CHARS:
            for cut in range(0, len(text), CHARS):
                yield i, i + 1, [text[cut : cut + CHARS] + text[cut + CHARS : cut + CHARS + k_max - 1].translate({48: "3", 49: "4"})]
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts), texts[start:]


def _counted(texts: list[str], k_min: int, k_max: int) -> Iterator[tuple[int, int, dict[int, np.ndarray]]]:
    """(first, last, counts): a matrix of texts x 2**k for each length of a run of texts."""
    before = None
    for first, last, part in _slices(texts, k_max):
        found = {k: np.zeros((last - first, 1 << k), np.int64) for k in range(k_min, k_max + 1)}
        for k, row, code in _windows(part, k_min, k_max):
            found[k] = np.bincount((row << k) | code, minlength=(last - first) << k).reshape(last - first, 1 << k)
        if before and before[0] == first:  # more of a long text
            found = {k: m + before[2][k] for k, m in found.items()}
        elif before:
            yield before
        before = first, last, found
    if before:
        yield before


#: Texts up to this length have far fewer windows than there are k-mers: their windows are looked up one by one, and no matrix of counts is filled.
SHORT, WINDOWS = 160, 1 << 19


def _short(texts: list[str], k_min: int, k_max: int) -> tuple[Iterator[tuple[np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]], list[int]]:
    """(rows, windows) of runs of the short texts, and the numbers of the others. ``windows`` holds for each length the place in ``rows`` and the k-mer of each window, by place."""
    size = np.array([len(t) for t in texts], np.int64)
    few = np.flatnonzero(size <= SHORT)

    def runs() -> Iterator[tuple[np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]]:
        run = (np.cumsum(size[few] + 1) - 1) * (k_max - k_min + 1) // WINDOWS
        for own in np.split(few, np.flatnonzero(np.diff(run)) + 1):
            if len(own):
                yield own, {k: (row, code) for k, row, code in _windows([texts[i] for i in own], k_min, k_max)}

    return runs(), np.flatnonzero(size > SHORT).tolist()


def _cells(row: np.ndarray, code: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, code, count) of the different k-mers of each text, from its windows."""
    key = np.sort((row << k) | code)
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    own = key[first]
    return own >> k, own & ((1 << k) - 1), np.diff(np.append(first, len(key)))


def _row_sums(x: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows of a matrix by ascending numbers below n."""
    out = np.zeros((n, x.shape[1]))
    if len(row):
        start = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        out[row[start]] = np.add.reduceat(x, start, axis=0)
    return out


COUNTS = "transcript_id string, at array<int>, cnt array<bigint>"


def _lists(ids: pd.Series, row: np.ndarray, at: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """A row of COUNTS for each id that has k-mers, from cells in any order."""
    order = np.argsort(row, kind="stable")
    sizes = np.bincount(row, minlength=len(ids))
    has = np.flatnonzero(sizes)
    offsets = pa.array(np.append(0, np.cumsum(sizes[has])), pa.int32())
    columns = [pa.array(ids.iloc[has].tolist(), pa.string()), pa.ListArray.from_arrays(offsets, pa.array(at[order], pa.int32())), pa.ListArray.from_arrays(offsets, pa.array(n[order], pa.int64()))]
    return pa.RecordBatch.from_arrays(columns, ["transcript_id", "at", "cnt"])


def _count_rows(coded: DataFrame, k_min: int, k_max: int) -> DataFrame:
    """COUNTS of rows with a text: the numbers of its k-mers, 2**k and the k-mer read as a binary number, ascending, and how often they occur."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("transcript_id").to_pandas(), batch.column("code").to_pylist()
            for first, last, found in _counted(texts, k_min, k_max):
                cells = [(k, np.flatnonzero(m)) for k, m in found.items()]
                row = np.concatenate([c >> k for k, c in cells])
                at = np.concatenate([(c & ((1 << k) - 1)) | (1 << k) for k, c in cells])
                yield _lists(ids.iloc[first:last], row, at, np.concatenate([found[k].ravel()[c] for k, c in cells]))

    return coded.select(F.col("transcript_id").cast("string").alias("transcript_id"), "code").mapInArrow(count, COUNTS)


def kmer_lists(df: DataFrame, k_min: int = 3, k_max: int = 12) -> DataFrame:
    """COUNTS of sequences: a row for each id that has k-mers, all lengths together.

    The pieces of an id meet in one task, PART of them at a time; only where a sequence is longer than that, the counts of its parts are added up by a second shuffle.
    """
    _check(k_min, k_max)
    texts = stored(_joined(_pieces(df, k_max), F.floor(F.col("_at") / PART).alias("_part")), "texts")
    parts = _count_rows(texts, k_min, k_max)
    if texts.where("_part > 0").isEmpty():
        return parts
    cells = parts.select("transcript_id", F.explode(F.arrays_zip("at", "cnt")).alias("x")).groupBy("transcript_id", "x.at").agg(F.sum("x.cnt").alias("cnt"))
    listed = cells.groupBy("transcript_id").agg(F.array_sort(F.collect_list(F.struct("at", "cnt"))).alias("x"))
    return listed.select("transcript_id", F.col("x.at").alias("at"), F.col("x.cnt").alias("cnt"))


def _spelled(rows: DataFrame, value: str) -> DataFrame:
    """(transcript_id, k, kmer, value) of rows by k-mer number."""
    word = F.bin("at")
    return rows.select("transcript_id", (F.length(word) - 1).alias("k"), F.substring(word, 2, 64).alias("kmer"), value)


def count_kmers(df: DataFrame, k_min: int = 3, k_max: int = 12) -> DataFrame:
    """(transcript_id, k, kmer, cnt) of the recoded sequences: overlapping windows of each length (SEQ5).

    Tasks count the windows of their texts in arrays, and a k-mer of an id is written once (``kmer_lists``): what is shuffled are the sequences alone.
    """
    cells = kmer_lists(df, k_min, k_max).select("transcript_id", F.explode(F.arrays_zip("at", "cnt")).alias("x"))
    return _spelled(cells.select("transcript_id", "x.at", "x.cnt"), "cnt")


def count_words(df: DataFrame, k_min: int = 3, k_max: int = 12) -> DataFrame:
    """(k, kmer, cnt) over all sequences: a task gives a row for each k-mer of the vocabulary at most, whatever its input."""
    _check(k_min, k_max)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(2 << k_max, np.int64)
        for batch in batches:
            for _, _, part in _slices(batch.column("code").to_pylist(), k_max):
                for k, _, code in _windows(part, k_min, k_max):
                    sums[1 << k : 2 << k] += np.bincount(code, minlength=1 << k)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(sums[at], pa.int64())], ["at", "cnt"])

    dealt = _pieces(df, k_max).repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "transcript_id", "_at").select("code")
    totals = dealt.mapInArrow(count, "at int, cnt bigint").groupBy("at").agg(F.sum("cnt").alias("cnt"))
    return _spelled(totals.withColumn("transcript_id", F.lit(None).cast("string")), "cnt").drop("transcript_id")


def kmer_vocabulary(spark: SparkSession, k_min: int = 3, k_max: int = 12) -> DataFrame:
    """(k, kmer): all binary strings of the lengths, 8184 for 3 to 12 (SEQ6)."""
    _check(k_min, k_max)
    lengths = spark.range(k_min, k_max + 1).select(F.col("id").cast("int").alias("k"))
    codes = F.explode(F.sequence(F.lit(0), F.pow(F.lit(2), F.col("k")).cast("int") - 1))
    return lengths.select("k", codes.alias("c")).select("k", F.lpad(F.bin("c"), F.col("k"), F.lit("0")).alias("kmer"))


def tfidf(kmers: DataFrame) -> DataFrame:
    """Counts times ln((1 + n) / (1 + df)) + 1, each id's row scaled to length 1 over all lengths together (SEQ8)."""
    n = kmers.agg(F.count_distinct("transcript_id").alias("n")).withColumn("_k", F.lit(1))
    idf = kmers.groupBy("k", "kmer").agg(F.count_distinct("transcript_id").alias("df")).withColumn("_k", F.lit(1)).join(F.broadcast(n), "_k")
    weighed = kmers.join(idf.select("k", "kmer", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf")), ["k", "kmer"]).withColumn("w", F.col("cnt") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("transcript_id")))
    return weighed.select("transcript_id", "k", "kmer", (F.col("w") / norm).alias("weight"))


def _held(lists: DataFrame, size: int) -> tuple[int, np.ndarray]:
    """The number of rows, and how many of them hold each k-mer: one row of sums for each task and k-mer of the vocabulary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(size, np.int64)  # no k-mer has the number 0: there are the rows
        for batch in batches:
            sums[0] += batch.num_rows
            sums += np.bincount(batch.column("at").flatten().to_numpy(), minlength=size)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(sums[at], pa.int64())], ["at", "n"])

    return _totals(lists.select("at").mapInArrow(count, "at int, n bigint"), size)


def _totals(sums: DataFrame, size: int) -> tuple[int, np.ndarray]:
    found = np.zeros(size, np.int64)
    for r in sums.groupBy("at").agg(F.sum("n").alias("n")).collect():  # a row for each k-mer of the vocabulary
        found[r["at"]] = r["n"]
    return int(found[0]), np.append(0, found[1:])


def _idf(n: int, held: np.ndarray) -> np.ndarray:
    return np.where(held > 0, np.log((1 + n) / (1 + held)) + 1, 0.0)


def kmer_weights(df: DataFrame, k_min: int = 3, k_max: int = 12) -> DataFrame:
    """(transcript_id, k, kmer, weight): ``tfidf`` of ``count_kmers``, from rows that hold all k-mers of an id, so that neither documents of a k-mer nor lengths need a shuffle of k-mers."""
    lists = stored(kmer_lists(df, k_min, k_max), "kmers")
    shared = df.sparkSession.sparkContext.broadcast(_idf(*_held(lists, 2 << k_max)))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("at")
            row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            at = lists.flatten()
            w = batch.column("cnt").flatten().to_numpy() * shared.value[at.to_numpy()]
            norm = np.sqrt(np.bincount(row, w * w, batch.num_rows))
            yield pa.RecordBatch.from_arrays([batch.column("transcript_id"), pa.ListArray.from_arrays(lists.offsets, at), pa.ListArray.from_arrays(lists.offsets, pa.array(w / norm[row], pa.float64()))], ["transcript_id", "at", "weight"])

    weighed = lists.mapInArrow(weigh, "transcript_id string, at array<int>, weight array<double>")
    return _spelled(weighed.select("transcript_id", F.explode(F.arrays_zip("at", "weight")).alias("x")).select("transcript_id", "x.at", "x.weight"), "weight")


#: Directions of a round beyond those wanted, most rounds, and the relative change of the eigenvalues at which they end.
SPARE, ROUNDS, CLOSE = 2, 40, 1e-11
#: Up to this many columns more than wanted, all directions are multiplied at once.
WHOLE = 10
SCORES = "transcript_id string, block int, component int, score double"
#: Weights that a task multiplies at a time.
CHUNK = 200_000


def sparse_rows(rows: DataFrame, columns: dict[int, list[str]], weight: str) -> DataFrame:
    """(transcript_id, block, at, w): a sparse row for each id and block, written once: places among the block's columns and weights."""
    # a row for each k-mer of the vocabulary
    places = rows.sparkSession.createDataFrame([(b, c, i) for b, own in columns.items() for i, c in enumerate(own)], "block int, kmer string, place int")
    held = rows.select("transcript_id", "block", "kmer", F.col(weight).cast("double").alias("w")).join(F.broadcast(places), ["block", "kmer"])
    listed = held.groupBy("transcript_id", "block").agg(F.collect_list(F.struct("place", "w")).alias("x"))
    return stored(listed.select("transcript_id", "block", F.col("x.place").alias("at"), F.col("x.w").alias("w")), "sparse")


def _chunks(frame: pd.DataFrame) -> Iterator[tuple[int, pd.DataFrame, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of rows of one block with their places, weights and row numbers, of about CHUNK weights each."""
    for block, own in frame.groupby("block", sort=True):
        sizes = own["at"].map(len).to_numpy(np.int64)
        for _, part in own.groupby((np.cumsum(sizes) - sizes) // CHUNK, sort=True):
            n = part["at"].map(len).to_numpy(np.int64)
            yield int(block), part, np.concatenate(part["at"].to_list()), np.concatenate(part["w"].to_list()), np.repeat(np.arange(len(part)), n)


def _times(q: np.ndarray, at: np.ndarray, w: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """The product of sparse rows and a dense matrix."""
    return np.stack([np.bincount(row, w * q[at, c], n) for c in range(q.shape[1])], axis=1)


def _gram_times(rows: DataFrame, q: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """A'A q of each block: tasks multiply their rows twice and give one dense sum each, of columns x directions, which alone is shuffled and reaches the driver."""
    wide = max(m.shape[1] for m in q.values())
    shared = rows.sparkSession.sparkContext.broadcast(q)

    def multiply(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = {b: np.zeros_like(m) for b, m in shared.value.items()}
        for frame in frames:
            for b, part, at, w, row in _chunks(frame):
                z = _times(shared.value[b], at, w, row, len(part))
                for c in range(z.shape[1]):
                    sums[b][:, c] += np.bincount(at, w * z[row, c], len(sums[b]))
        for b, m in sums.items():
            full = np.zeros((len(m), wide))
            full[:, : m.shape[1]] = m
            yield pd.DataFrame({"block": b, "place": np.arange(len(m)), **{f"y{c}": full[:, c] for c in range(wide)}})

    columns = [f"y{c}" for c in range(wide)]
    found = rows.mapInPandas(multiply, f"block int, place int, {', '.join(f'{c} double' for c in columns)}").groupBy("block", "place").agg(*[F.sum(c).alias(c) for c in columns]).toPandas()
    out = {b: np.zeros_like(m) for b, m in q.items()}
    for b, own in found.groupby("block"):
        out[b][own["place"].to_numpy()] = own[columns].to_numpy()[:, : q[b].shape[1]]
    return out


def right_vectors(rows: DataFrame, sizes: dict[int, int], wanted: dict[int, int], times: Callable[[DataFrame, dict], dict] | None = None) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Singular values and right singular vectors of each block by block Lanczos iteration, all blocks in the same jobs.

    ``rows`` are sparse rows as of ``sparse_rows``, or any table for which ``times`` gives A'A q of the blocks of q. Random directions, SPARE more than wanted, are multiplied by A'A; what the
    product adds to the directions so far is multiplied in the next round, until the leading eigenvalues of the small matrix q'A'A q of all directions stand still, or nothing is added. A block with few columns starts
    from all of them and is exact after one product. The largest entry of a vector is positive.
    """
    rng = np.random.default_rng(99)
    q = {}
    for b, m in sizes.items():
        q[b] = np.eye(m) if m <= wanted[b] + WHOLE else np.linalg.qr(rng.standard_normal((m, wanted[b] + SPARE)))[0]
    open_, done, before, basis, image = dict(q), {}, {}, {}, {}
    for _ in range(ROUNDS):
        product = times(rows, open_) if times else _gram_times(rows.where(F.col("block").isin(list(open_))), open_)
        for b in list(open_):
            basis[b] = np.hstack([basis[b], open_[b]]) if b in basis else open_[b]
            image[b] = np.hstack([image[b], product[b]]) if b in image else product[b]
            small = basis[b].T @ image[b]
            values, turns = np.linalg.eigh((small + small.T) / 2)
            order = np.argsort(-values)[: wanted[b]]
            top = np.maximum(values[order], 0)
            v = basis[b] @ turns[:, order]
            v = v * np.where(v[np.abs(v).argmax(axis=0), np.arange(v.shape[1])] < 0, -1.0, 1.0)
            done[b] = np.sqrt(top), v
            new = product[b]
            scale = max(np.linalg.norm(new, axis=0).max(), 1e-300)
            for _ in range(2):  # twice is enough
                new = new - basis[b] @ (basis[b].T @ new)
            new, sizes_, _ = np.linalg.svd(new, full_matrices=False)
            new = new[:, sizes_ > 1e-13 * scale]
            new = np.linalg.qr(new - basis[b] @ (basis[b].T @ new))[0][:, : sizes[b] - basis[b].shape[1]]
            still = b in before and np.abs(top - before[b]).max() <= CLOSE * max(top.max(), 1e-300)
            if still or not new.shape[1]:
                del open_[b]
            else:
                before[b], open_[b] = top, new
        if not open_:
            break
    return done


def _svd(rows: DataFrame, columns: dict[int, list[str]], n: dict[int, int], weight: str) -> DataFrame:
    """(transcript_id, block, component, score) of the blocks of a sparse matrix; a block of one column passes through, a matrix without columns has no rows."""
    columns = {b: own for b, own in columns.items() if own}
    if not columns:
        return rows.sparkSession.createDataFrame([], SCORES)
    sparse = sparse_rows(rows, columns, weight)
    vectors = right_vectors(sparse, {b: len(c) for b, c in columns.items()}, {b: max(1, min(n[b], len(c) - 1)) for b, c in columns.items()})
    shared = rows.sparkSession.sparkContext.broadcast({b: v for b, (_, v) in vectors.items()})

    def project(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for b, part, at, w, row in _chunks(frame):
                z = _times(shared.value[b], at, w, row, len(part))
                yield pd.DataFrame({"transcript_id": np.repeat(part["transcript_id"].to_numpy(), z.shape[1]), "block": b, "component": np.tile(np.arange(z.shape[1]), len(part)), "score": z.ravel()})

    return sparse.mapInPandas(project, SCORES)


def svd_by_k(kmers: DataFrame, n: int | dict[int, int] = 1, weight: str = "weight") -> DataFrame:
    """(transcript_id, name, score): truncated SVD for each length, named <k>mer_SVD<i>, i from 1 (SEQ9).

    Components of a length: at most one less than its columns; a single column passes through. All lengths share their jobs.
    """
    columns = {r["k"]: sorted(r["c"]) for r in kmers.groupBy("k").agg(F.collect_set("kmer").alias("c")).collect()}
    scores = _svd(kmers.withColumn("block", F.col("k").cast("int")), columns, {k: n.get(k, 1) if isinstance(n, dict) else n for k in columns}, weight)
    return scores.select("transcript_id", F.concat(F.col("block"), F.lit("mer_SVD"), F.col("component") + 1).alias("name"), "score")


def svd_global(kmers: DataFrame, n: int, weight: str = "weight") -> DataFrame:
    """(transcript_id, name, score): truncated SVD over all lengths, named SVD_<i>, i from 0 (SEQ10)."""
    columns = {0: sorted(r["kmer"] for r in kmers.select("kmer").distinct().collect())}
    scores = _svd(kmers.withColumn("block", F.lit(0)), columns, {0: n}, weight)
    return scores.select("transcript_id", F.concat(F.lit("SVD_"), "component").alias("name"), "score")


def component_weights(scores: DataFrame) -> DataFrame:
    """(transcript_id, name, score) with scores times ln((1 + n) / (1 + df)) + 1, each id's row scaled to length 1; df counts scores that are not 0."""
    n = scores.agg(F.count_distinct("transcript_id").alias("n")).withColumn("_k", F.lit(1))
    idf = scores.groupBy("name").agg(F.count_if(F.col("score") != 0).alias("df")).withColumn("_k", F.lit(1)).join(F.broadcast(n), "_k")
    # a row for each component
    weighed = scores.join(F.broadcast(idf.select("name", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf"))), "name").withColumn("w", F.col("score") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("transcript_id")))
    return weighed.select("transcript_id", "name", F.when(norm > 0, F.col("w") / norm).otherwise(F.col("w")).alias("score"))


def reduce_kmers(kmers: DataFrame, n: int | dict[int, int] = 1, order: str = "tfidf_svd", by_k: bool = True) -> DataFrame:
    """A wide table of components by transcript: weights of k-mers first, or, in the order ``svd_tfidf``, weights of the components (SEQ11)."""
    if order not in ("tfidf_svd", "svd_tfidf"):
        raise ValueError(f"unknown order {order!r}")
    kmers = stored(kmers, "kmers")  # read several times
    rows, weight = (stored(tfidf(kmers), "weights"), "weight") if order == "tfidf_svd" else (kmers, "cnt")
    scores = svd_by_k(rows, n, weight) if by_k else svd_global(rows, n if isinstance(n, int) else 1, weight)
    scores = component_weights(scores) if order == "svd_tfidf" else scores
    return _wide(scores)


def _wide(scores: DataFrame) -> DataFrame:
    scores = stored(scores, "scores")  # its names are found before the columns are
    return scores.groupBy("transcript_id").pivot("name").agg(F.first("score"))


class Profiles:
    """k-mer counts of sequences for a decomposition. What is stored is the recoded text of each id, a row each, not its many k-mers: every pass counts them again in arrays."""

    def __init__(self, df: DataFrame, k_min: int = 3, k_max: int = 12, weighted: bool = True):
        _check(k_min, k_max)
        self.k_min, self.k_max = k_min, k_max
        texts = stored(_joined(_pieces(df, k_max)).where(F.length("code") >= k_min).select(F.col("transcript_id").cast("string").alias("transcript_id"), "code"), "texts")
        n, self.held = self._held(texts)
        self.idf = _idf(n, self.held) if weighted else np.ones(2 << k_max)
        self.texts = stored(self._with_norms(texts), "texts") if weighted else texts.withColumn("norm", F.lit(1.0))

    def _held(self, texts: DataFrame) -> tuple[int, np.ndarray]:
        k_min, k_max = self.k_min, self.k_max

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros(2 << k_max, np.int64)
            for batch in batches:
                texts = batch.column("code").to_pylist()
                runs, long = _short(texts, k_min, k_max)
                for own, windows in runs:
                    sums[0] += len(np.unique(windows[k_min][0]))
                    for k, (row, code) in windows.items():
                        sums[1 << k : 2 << k] += np.bincount(_cells(row, code, k)[1], minlength=1 << k)
                for _, _, found in _counted([texts[i] for i in long], k_min, k_max):
                    sums[0] += int(found[k_min].any(axis=1).sum())
                    for k, m in found.items():
                        sums[1 << k : 2 << k] += np.count_nonzero(m, axis=0)
            at = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(sums[at], pa.int64())], ["at", "n"])

        return _totals(texts.select("code").mapInArrow(count, "at int, n bigint"), 2 << k_max)

    def _with_norms(self, texts: DataFrame) -> DataFrame:
        k_min, k_max, shared = self.k_min, self.k_max, texts.sparkSession.sparkContext.broadcast(self.idf)

        def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts, squares = batch.column("code").to_pylist(), np.zeros(batch.num_rows)
                runs, long = _short(texts, k_min, k_max)
                for own, windows in runs:
                    for k, (row, code) in windows.items():
                        row, code, n = _cells(row, code, k)
                        squares[own] += np.bincount(row, (n * shared.value[code + (1 << k)]) ** 2, len(own))
                for first, last, found in _counted([texts[i] for i in long], k_min, k_max):
                    for k, m in found.items():
                        squares[long[first:last]] += ((m * shared.value[1 << k : 2 << k]) ** 2).sum(axis=1)
                yield pa.RecordBatch.from_arrays([batch.column("transcript_id"), batch.column("code"), pa.array(np.sqrt(squares))], ["transcript_id", "code", "norm"])

        return texts.mapInArrow(lengths, "transcript_id string, code string, norm double")

    def components(self, n: int | dict[int, int] = 1, by_k: bool = True) -> tuple[DataFrame, list[str]]:
        """A row for each id with a column for each component, and their names; a component is null where the id has no k-mer of the block."""
        spark, k_min, k_max, idf = self.texts.sparkSession, self.k_min, self.k_max, self.idf
        lengths = {k: [k] for k in range(k_min, k_max + 1)} if by_k else {0: list(range(k_min, k_max + 1))}
        columns = {b: np.concatenate([np.flatnonzero(self.held[1 << k : 2 << k]) + (1 << k) for k in own]) for b, own in lengths.items()}
        columns = {b: own for b, own in columns.items() if len(own)}
        wanted = {b: max(1, min((n.get(b, 1) if isinstance(n, dict) else n), len(own) - 1)) for b, own in columns.items()}
        if not columns:
            return self.texts.select("transcript_id").limit(0), []
        names = [f"{b}mer_SVD{i + 1}" if by_k else f"SVD_{i}" for b in columns for i in range(wanted[b])]

        def spread(q: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
            """q by the number of the k-mer, times its factor."""
            out = {b: np.zeros((2 << k_max, m.shape[1])) for b, m in q.items()}
            for b, m in q.items():
                out[b][columns[b]] = m * idf[columns[b], None]
            return out

        def times(rows: DataFrame, q: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
            shared, wide = spark.sparkContext.broadcast(spread(q)), max(m.shape[1] for m in q.values())

            def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                own = shared.value
                sums = {b: np.zeros_like(m) for b, m in own.items()}
                for batch in batches:
                    norm, texts, used = batch.column("norm").to_numpy(), batch.column("code").to_pylist(), [k for b in own for k in lengths[b]]
                    runs, long = _short(texts, min(used), max(used))
                    for rows_, windows in runs:
                        for b, scores in _short_scores(windows, {b: lengths[b] for b in own}, own, len(rows_)).items():
                            scores = scores / (norm[rows_, None] ** 2)
                            for k in lengths[b]:
                                row, code = windows[k]
                                for c in range(scores.shape[1]):
                                    sums[b][1 << k : 2 << k, c] += np.bincount(code, scores[row, c], 1 << k)
                    for first, last, z, found in _scores([texts[i] for i in long], {b: lengths[b] for b in own}, own, k_max):
                        for b, scores in z.items():
                            scores = scores / (norm[long[first:last], None] ** 2)
                            for k in lengths[b]:
                                sums[b][1 << k : 2 << k] += found[k].T @ scores
                for b, m in sums.items():
                    full = np.zeros((len(m), wide))
                    full[:, : m.shape[1]] = m
                    held = np.flatnonzero(full.any(axis=1))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(held), b), pa.int32()), pa.array(held, pa.int32()), *[pa.array(full[held, c]) for c in range(wide)]], ["block", "place", *ys])

            ys = [f"y{c}" for c in range(wide)]
            schema = f"block int, place int, {', '.join(f'{y} double' for y in ys)}"
            total = rows.select("code", "norm").mapInArrow(multiply, schema).groupBy("block", "place").agg(*[F.sum(y).alias(y) for y in ys]).toPandas()
            out = {b: np.zeros((2 << k_max, m.shape[1])) for b, m in q.items()}
            for b, part in total.groupby("block"):
                out[b][part["place"].to_numpy()] = part[ys].to_numpy()[:, : q[b].shape[1]]
            return {b: m[columns[b]] * idf[columns[b], None] for b, m in out.items()}

        vectors = right_vectors(self.texts, {b: len(own) for b, own in columns.items()}, wanted, times)
        shared = spark.sparkContext.broadcast(spread({b: v for b, (_, v) in vectors.items()}))

        def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = shared.value
            for batch in batches:
                norm, texts = batch.column("norm").to_numpy(), batch.column("code").to_pylist()
                values = np.full((batch.num_rows, len(names)), np.nan)
                runs, long = _short(texts, k_min, k_max)
                for rows_, windows in runs:
                    z, at = _short_scores(windows, lengths, own, len(rows_)), 0
                    for b in columns:
                        has = np.unique(np.concatenate([windows[k][0] for k in lengths[b]]))
                        values[rows_[has], at : at + wanted[b]] = z[b][has] / norm[rows_[has], None]
                        at += wanted[b]
                for first, last, z, found in _scores([texts[i] for i in long], {b: lengths[b] for b in own}, own, k_max):
                    at = 0
                    for b in columns:
                        has = np.logical_or.reduce([found[k].any(axis=1) for k in lengths[b]])
                        values[long[first:last], at : at + wanted[b]] = np.where(has[:, None], z[b] / norm[long[first:last], None], np.nan)
                        at += wanted[b]
                some = ~np.isnan(values).all(axis=1)
                yield pa.RecordBatch.from_arrays([batch.column("transcript_id").filter(pa.array(some)), *[pa.array(values[some, c], pa.float64(), from_pandas=True) for c in range(len(names))]], ["transcript_id", *names])

        fields = ", ".join(["transcript_id string", *[f"`{c}` double" for c in names]])
        return self.texts.mapInArrow(project, fields), names


def _scores(texts: list[str], lengths: dict[int, list[int]], q: dict[int, np.ndarray], k_max: int) -> Iterator[tuple[int, int, dict[int, np.ndarray], dict[int, np.ndarray]]]:
    """(first, last, products, counts) of a run of texts: counts as doubles by length, and their products with the directions of each block."""
    used = [k for own in lengths.values() for k in own]
    for first, last, found in _counted(texts, min(used), max(used)):
        found = {k: found[k].astype(np.float64) for k in used}
        yield first, last, {b: sum(found[k] @ q[b][1 << k : 2 << k] for k in own) for b, own in lengths.items()}, found


def _short_scores(windows: dict[int, tuple[np.ndarray, np.ndarray]], lengths: dict[int, list[int]], q: dict[int, np.ndarray], n: int) -> dict[int, np.ndarray]:
    """Products of the counts of n short texts with the directions of each block: sums over their windows."""
    return {b: sum(_row_sums(m[windows[k][1] + (1 << k)], windows[k][0], n) for k in lengths[b]) for b, m in q.items()}


def sequence_components(df: DataFrame, k_min: int = 3, k_max: int = 12, n: int | dict[int, int] = 1, by_k: bool = True) -> DataFrame:
    """(transcript_id, name, score): ``svd_by_k`` or ``svd_global`` of the k-mer weights of sequences, without a table of k-mers."""
    return _long(*Profiles(df, k_min, k_max).components(n, by_k))


def _long(wide: DataFrame, names: list[str]) -> DataFrame:
    if not names:
        return wide.select("transcript_id", F.lit("").alias("name"), F.lit(0.0).alias("score"))
    return wide.select("transcript_id", F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").alias("score")) for c in names])).alias("x")).select("transcript_id", "x.*").where("score IS NOT NULL")


def reduce_sequences(df: DataFrame, k_min: int = 3, k_max: int = 12, n: int | dict[int, int] = 1, order: str = "tfidf_svd", by_k: bool = True) -> DataFrame:
    """``reduce_kmers`` of the k-mers of sequences, without a table of k-mers (SEQ11)."""
    if order not in ("tfidf_svd", "svd_tfidf"):
        raise ValueError(f"unknown order {order!r}")
    wide, names = Profiles(df, k_min, k_max, order == "tfidf_svd").components(n if by_k or isinstance(n, int) else 1, by_k)
    return _wide(component_weights(_long(wide, names))) if order == "svd_tfidf" else wide


def kmer_wide(kmers: DataFrame, vocabulary: list[str], value: str = "cnt") -> DataFrame:
    """A column for each k-mer of the vocabulary, zeros kept (SNK6)."""
    return kmers.groupBy("transcript_id").pivot("kmer", vocabulary).agg(F.sum(value)).fillna(0)
