"""Readers of annotation, interval, sequence, track, feature and sample files."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txspark.functions.scalars import normalize_chrom, to_rna
from txspark.operators.expression import sample_fpkm
from txspark.operators.tracks import STATS

#: Ends the header of a record whose sequence is null, not empty.
NO_SEQUENCE = " [sequence=null]"
PROMOTED = ("transcript_id", "gene_id", "gene_biotype", "transcript_biotype", "FPKM")


def parse_attributes(text: Column) -> Column:
    """A map of the ``key "value"`` pairs; of a repeated key the first value counts (SRC1)."""
    keys = F.regexp_extract_all(text, F.lit(r'(\w+) "([^"]*)"'), F.lit(1))
    values = F.regexp_extract_all(text, F.lit(r'(\w+) "([^"]*)"'), F.lit(2))
    pairs = F.arrays_zip(keys.alias("k"), values.alias("v"))
    first = F.filter(pairs, lambda p, i: F.array_position(keys, p["k"]) == i + 1)
    return F.map_from_entries(first)


def parse_annotation(lines: DataFrame) -> DataFrame:
    """Records of GTF lines in ``value``: 0-based half-open, attributes as a map and the usual ones as columns (SRC1)."""
    parts = F.split("value", "\t")
    rows = lines.where(~F.col("value").startswith("#")).select(parts.alias("p"), *[c for c in lines.columns if c != "value"]).where(F.size("p") >= 9)
    typed = rows.select(
        F.col("p")[0].alias("chromosome"), F.col("p")[1].alias("source"), F.col("p")[2].alias("feature"),
        (F.expr("try_cast(p[3] AS bigint)") - 1).alias("start"), F.expr("try_cast(p[4] AS bigint)").alias("end"),
        F.col("p")[5].alias("score"), F.col("p")[6].alias("strand"), F.col("p")[7].alias("frame"),
        parse_attributes(F.col("p")[8]).alias("attributes"), *[c for c in lines.columns if c != "value"],
    )
    return typed.select("*", *[F.element_at("attributes", F.lit(k)).alias(k) for k in PROMOTED])


def read_annotation(spark: SparkSession, path: str) -> DataFrame:
    """GTF text, compressed or not (SRC1)."""
    return parse_annotation(spark.read.text(path))


def parse_intervals(lines: DataFrame) -> DataFrame:
    """Valid intervals of BED lines in ``value`` (SRC2). An interval without a name is called by its place."""
    p = F.split(F.trim("value"), r"\s+")
    rows = lines.where(~F.col("value").rlike(r"^\s*($|#|track|browser)")).select(p.alias("p")).where(F.size("p") >= 3)
    typed = rows.select(normalize_chrom(F.col("p")[0]).alias("chromosome"), F.expr("try_cast(p[1] AS bigint)").alias("start"), F.expr("try_cast(p[2] AS bigint)").alias("end"), F.get("p", F.lit(3)).alias("n"), F.get("p", F.lit(4)).alias("score"), F.get("p", F.lit(5)).alias("strand"))
    place = F.concat("chromosome", F.lit(":"), F.col("start"), F.lit("-"), F.col("end"))
    name = F.when(F.coalesce(F.col("n"), F.lit(".")).isin("", "."), place).otherwise(F.col("n"))
    return typed.where("start >= 0 AND start < end").select("chromosome", "start", "end", name.alias("transcript_id"), "score", "strand")


def read_intervals(spark: SparkSession, path: str) -> DataFrame:
    """BED text (SRC2)."""
    return parse_intervals(spark.read.text(path))


def read_sequences(spark: SparkSession, paths: str | list[str], rna: bool = True, names: str = "*.{fa,fasta,fna,fas}", empty: bool = False) -> DataFrame:
    """(transcript_id, sequence, file, pos) of FASTA files or folders, of files that match ``names`` (SRC3).

    Records without a sequence are dropped, or kept with ``empty``: their sequence is then '', and null where ``write_sequences`` wrote a null one.
    """
    text = spark.read.option("lineSep", "\n>").option("recursiveFileLookup", "true").option("pathGlobFilter", names).text(paths)
    one = F.regexp_replace("value", "^>", "")
    head = F.regexp_extract(one, r"^([^\n]*)", 1)
    body = F.upper(F.regexp_replace(F.regexp_replace(one, r"^[^\n]*", ""), r"\s", ""))
    body = to_rna(body) if rna else body
    body = F.when((body != "") | ~head.endswith(NO_SEQUENCE), body) if empty else body
    rows = text.select(F.regexp_extract(head, r"^\s*(\S+)", 1).alias("transcript_id"), body.alias("sequence"), F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("pos"))
    return rows.where("transcript_id <> ''" if empty else "transcript_id <> '' AND sequence <> ''")


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """A feature table by its extension; a column ``index`` is the id (SRC4)."""
    low = path.lower().rstrip("/")
    if low.endswith((".parquet", ".pq")):
        df = spark.read.parquet(path)
    elif low.endswith((".csv", ".tsv")):
        df = spark.read.csv(path, sep="\t" if low.endswith(".tsv") else ",", header=True, inferSchema=True)
    else:
        raise ValueError(f"unsupported extension: {path}")
    return df.withColumnRenamed("index", "transcript_id")


def read_track(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """A signal (bedGraph) or entry (BED, further fields as ``rest``) track, or a Parquet table of either (SRC5)."""
    if kind not in ("signal", "entry"):
        raise ValueError(f"unknown kind {kind!r}")
    if path.lower().rstrip("/").endswith((".parquet", ".pq")):
        return spark.read.parquet(path)
    lines = spark.read.text(path).where(~F.col("value").rlike(r"^\s*($|#|track|browser)")).select(F.split("value", "\t").alias("p")).where(F.size("p") >= (4 if kind == "signal" else 3))
    last = F.expr("try_cast(p[3] AS double)").alias("value") if kind == "signal" else F.array_join(F.slice("p", 4, 1 << 20), "\t").alias("rest")
    rows = lines.select(F.col("p")[0].alias("chromosome"), F.expr("try_cast(p[1] AS bigint)").alias("start"), F.expr("try_cast(p[2] AS bigint)").alias("end"), last)
    return rows.where("start < end" + (" AND value IS NOT NULL AND NOT isnan(value)" if kind == "signal" else ""))


def read_sizes(spark: SparkSession, path: str) -> DataFrame:
    """(chromosome, length) of a two-column table."""
    return spark.read.csv(path, sep="\t", schema="chromosome string, length long")


def track_spec(items: list) -> list[dict]:
    """Rows (path, stat, name, upstream, downstream, name_field_index) of a track specification (SRC6).

    Distances and indexes that are no non-negative integers take their defaults; unknown statistics and malformed items are
    skipped; a specification that is no list, or an item without a path, fails.
    """
    if not isinstance(items, list):
        raise ValueError("a track specification is a list")
    whole = lambda x, default: x if isinstance(x, int) and not isinstance(x, bool) and x >= 0 else default
    rows = []
    for item in items:
        if not isinstance(item, dict) or not item.get("path"):
            raise ValueError(f"a track needs a path: {item!r}")
        for s in item.get("stats") or []:
            if isinstance(s, dict) and s.get("stat") in STATS and s.get("name"):
                rows.append({"path": item["path"], "stat": s["stat"], "name": s["name"], "upstream": whole(item.get("upstream"), 0), "downstream": whole(item.get("downstream"), 0), "name_field_index": whole(s.get("name_field_index"), 3)})
    return rows


def track_spec_table(spark: SparkSession, items: list) -> DataFrame:
    """The specification as a table (SRC6)."""
    names = ("path", "stat", "name", "upstream", "downstream", "name_field_index")
    return spark.createDataFrame([tuple(r[n] for n in names) for r in track_spec(items)], "path string, stat string, name string, upstream int, downstream int, name_field_index int")


def read_track_spec(spark: SparkSession, path: str) -> list[dict]:
    """The rows of a specification file, through Spark's file systems: JSON, or YAML where a YAML library is installed (SRC6)."""
    text = "\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect())
    if path.rsplit(".", 1)[-1].lower() in ("yaml", "yml"):
        try:
            import yaml
        except ImportError as error:
            raise ValueError(f"{path}: no YAML library is installed; write the specification as JSON") from error
        return track_spec(yaml.safe_load(text))
    return track_spec(json.loads(text))


def read_quant(spark: SparkSession, folder: str) -> DataFrame:
    """(transcript_id, gene_id, sample_id, fpkm) of all GTF files in a folder and below; the file names the sample (SRC7)."""
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.gtf").text(folder)
    named = lines.select("value", F.regexp_replace(F.col("_metadata.file_name"), r"(\.rna)?\.gtf$", "").alias("sample_id"))
    return sample_fpkm(parse_annotation(named).where("feature = 'transcript'"))


def parse_samples(lines: DataFrame, sep: str) -> DataFrame:
    """Rows of a sample sheet from its lines in ``value`` (SRC8).

    With a header that has sample_id the columns are named by it; without, lines hold run accessions (with ``sep``, in the first column).
    ``sep`` '' is a plain list.
    """
    clean = lines.where(~F.col("value").rlike(r"^\s*(#|$)"))
    if not sep:
        return clean.select(F.trim("value").alias("sample_id"))
    head = clean.where(F.col("value").rlike(rf"(^|{sep})\s*sample_id\s*({sep}|$)")).first()
    if head is None:
        return clean.select(F.trim(F.split("value", sep)[0]).alias("sample_id")).where(F.col("sample_id").rlike(r"^(SRR|ERR|DRR)\d+$"))
    names = [c.strip() for c in head["value"].split(sep)]
    rows = clean.where(F.col("value") != F.lit(head["value"])).select(F.split("value", sep).alias("p"))
    return rows.select(*[F.trim(F.get("p", F.lit(i))).alias(c) for i, c in enumerate(names)])


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    """A csv or tsv sheet, or a txt list (SRC8)."""
    sep = {"csv": ",", "tsv": "\t", "txt": ""}.get(path.rsplit(".", 1)[-1].lower())
    if sep is None:
        raise ValueError(f"unsupported sample sheet: {path}")
    return parse_samples(spark.read.text(path), sep)


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length) of the files of a folder, without reading them (SRC9)."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "length")
