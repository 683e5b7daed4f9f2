"""Writers of tables, sequences, intervals, annotation, splits and k-mers, and resuming."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txspark.operators.kmers import kmer_vocabulary, kmer_wide
from txspark.session import stored
from txspark.sources.readers import NO_SEQUENCE

CODECS = ("snappy", "gzip", "brotli", "zstd", "lz4", "none")


def write_table(df: DataFrame, path: str, fmt: str | None = None) -> bool:
    """Write by extension: csv and txt with commas, tsv with tabs, parquet; other names as csv; an empty table is not written (SNK1, SNK9)."""
    kind = (fmt or path.rsplit(".", 1)[-1]).lower()
    if df.isEmpty():
        return False
    if kind in ("parquet", "pq"):
        df.write.mode("overwrite").parquet(path)
    else:
        df.write.mode("overwrite").option("header", "true").option("sep", "\t" if kind == "tsv" else ",").csv(path)
    return True


def fasta_lines(name: Column, sequence: Column) -> Column:
    """One record with lines of 60 characters (SNK2)."""
    return F.concat(F.lit(">"), name, F.lit("\n"), F.regexp_replace(sequence, "(.{60})(?=.)", "$1\n"))


def write_sequences(df: DataFrame, path: str) -> None:
    """FASTA (SNK2); a null sequence is marked in its header."""
    null = F.concat(F.lit(">"), F.col("transcript_id"), F.lit(NO_SEQUENCE))
    df.select(F.coalesce(fasta_lines(F.col("transcript_id"), F.col("sequence")), null).alias("value")).write.mode("overwrite").text(path)


def bed_rows(df: DataFrame) -> DataFrame:
    """Six columns, score '.' (SNK3)."""
    return df.select("chromosome", "start", "end", "transcript_id", F.lit(".").alias("score"), F.coalesce("strand", F.lit(".")).alias("strand"))


def write_intervals(df: DataFrame, path: str) -> None:
    """BED without a header (SNK3)."""
    bed_rows(df).write.mode("overwrite").csv(path, sep="\t", header=False)


def gtf_lines(df: DataFrame) -> DataFrame:
    """``value``: GTF lines of records, 1-based and closed (SNK4)."""
    pairs = F.array_join(F.transform(F.map_entries("attributes"), lambda e: F.concat(e["key"], F.lit(' "'), e["value"], F.lit('";'))), " ")
    dot = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("."))
    return df.select(F.concat_ws("\t", "chromosome", dot("source"), dot("feature"), F.col("start") + 1, "end", dot("score"), dot("strand"), dot("frame"), pairs).alias("value"))


def write_annotation(df: DataFrame, path: str) -> None:
    """GTF text (SNK4)."""
    gtf_lines(df).write.mode("overwrite").text(path)


def write_splits(df: DataFrame, folder: str, suffix: str) -> None:
    """A cleaned table with ``split`` as one Parquet table with a folder for each split (SNK5)."""
    df.write.mode("overwrite").partitionBy("split").parquet(f"{folder}/cleaned_dataset_{suffix}.parquet")


def read_split(spark: SparkSession, folder: str, suffix: str, split: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/cleaned_dataset_{suffix}.parquet").where(F.col("split") == split).drop("split")


def write_kmers(kmers: DataFrame, path: str, layout: str = "sparse", k_min: int = 3, k_max: int = 12, codec: str = "zstd") -> None:
    """Sparse: the long table by length; dense: a column for each k-mer of the vocabulary, as csv or parquet by the path (SNK6)."""
    if codec not in CODECS:
        raise ValueError(f"unknown codec {codec!r}")
    if layout == "sparse":
        kmers.write.mode("overwrite").option("compression", codec).partitionBy("k").parquet(path)
        return
    names = [r["kmer"] for r in kmer_vocabulary(kmers.sparkSession, k_min, k_max).orderBy("kmer").collect()]
    wide = kmer_wide(kmers, names)
    if path.endswith(".csv"):
        wide.write.mode("overwrite").csv(path, header=True)
    else:
        wide.write.mode("overwrite").option("compression", codec).parquet(path)


def read_kmers(spark: SparkSession, path: str) -> DataFrame:
    """A sparse profile; a k-mer whose length is not its k fails (SNK6)."""
    df = spark.read.parquet(path).select("transcript_id", F.col("k").cast("int").alias("k"), "kmer", "cnt")
    if not df.where(F.length("kmer") != F.col("k")).isEmpty():
        raise ValueError(f"{path} holds k-mers of another length than their k")
    return df


def save_scaler(stats: DataFrame, path: str) -> None:
    """Statistics of a scaler (SNK7): a row for each column."""
    stats.coalesce(1).write.mode("overwrite").json(path)


def load_scaler(spark: SparkSession, path: str) -> DataFrame:
    from txspark.operators.scaling import STATS

    return spark.read.schema(STATS).json(path).orderBy("position")


def resume(inputs: DataFrame, done: DataFrame | None, key: str, compute: Callable[[DataFrame], DataFrame], needed: list[str]) -> DataFrame:
    """Rows that an earlier run finished, and ``compute`` of the others (INC1).

    Rows count as finished by key if no needed column is null. ``compute`` may end in a ``mapInPandas`` of an outside scorer.
    """
    if done is None or not set(needed) <= set(done.columns):
        return compute(inputs)
    ready = done.na.drop(subset=needed)
    todo = inputs.join(ready.select(key), key, "left_anti")
    return ready.join(inputs.select(key), key, "left_semi").unionByName(compute(todo))


def fingerprint(df: DataFrame, columns: list[str]) -> Column:
    """A hash of the content of some columns, in which null differs from every text."""
    return F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(columns)]), {"ignoreNullFields": "false"}), 256)


def resume_changed(inputs: DataFrame, folder: str, key: str, compute: Callable[[DataFrame], DataFrame], needed: list[str], batches: int = 1) -> DataFrame:
    """``compute`` of all rows of ``inputs``, of which only those are computed that no earlier run in ``folder`` has computed from the same content (INC1).

    A manifest holds the key and the fingerprint of the ``needed`` columns of each finished row, and the batch that it is in. What it lacks is cut into
    ``batches`` by the key's hash; the results of a batch are written first and its manifest last, so that a run that is stopped loses at most its open batch, and rows
    of a batch that is not in the manifest do not count. ``compute`` keeps the key, which is unique and not null, and gives one row for each.
    """
    spark = inputs.sparkSession
    rows, manifest = f"{folder}/rows", f"{folder}/manifest"
    path = spark._jvm.org.apache.hadoop.fs.Path(manifest)
    there = lambda: path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    marked = inputs.withColumn("_content", fingerprint(inputs, needed))
    done = spark.read.parquet(manifest).select(key, "_content", "_batch") if there() else None
    todo = marked.join(done, [key, "_content"], "left_anti") if done is not None else marked
    run = uuid.uuid4().hex
    for i in range(batches):
        own = todo.where(F.pmod(F.xxhash64(key), F.lit(batches)) == i) if batches > 1 else todo
        own = stored(own, "batch")  # what is to do is fixed before the manifest grows
        if own.isEmpty():
            continue
        compute(own.drop("_content")).join(own.select(key, "_content"), key).withColumn("_batch", F.lit(f"{run}-{i}")).write.mode("append").parquet(rows)
        own.select(key, "_content", F.lit(f"{run}-{i}").alias("_batch")).write.mode("append").parquet(manifest)
    if not there():  # no row ever
        return compute(inputs)
    current = marked.select(key, "_content").join(spark.read.parquet(manifest), [key, "_content"])
    return spark.read.parquet(rows).join(current, [key, "_content", "_batch"], "left_semi").drop("_content", "_batch")


def write_batches(df: DataFrame, path: str, key: str, batch_size: int) -> None:
    """Parquet files of at most ``batch_size`` rows, cut by ranges of the key (INC1)."""
    df.repartitionByRange(key).write.mode("overwrite").option("maxRecordsPerFile", batch_size).parquet(path)
