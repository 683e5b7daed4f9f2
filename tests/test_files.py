"""Readers and writers by round trips through files."""

import duckdb
import pytest
from pyspark.sql import functions as F

from txspark.operators import kmers, scaling, schema, splits
from txspark.plans.catalogue import ORACLES, QUERIES
from txspark.sources import readers, writers


def test_gtf(spark, tmp_path):
    path = tmp_path / "a.gtf"
    path.write_text('#!note\nc\tsrc\ttranscript\t11\t20\t.\t+\t.\tgene_id "g"; transcript_id "t"; tag "x"; tag "y"; FPKM "1.5";\nshort\tline\nc\tsrc\texon\tx\t20\t.\t+\t.\tgene_id "g";\n')
    rows = readers.read_annotation(spark, str(path)).orderBy("feature").collect()
    assert [(r["feature"], r["start"], r["end"], r["transcript_id"]) for r in rows] == [("exon", None, 20, None), ("transcript", 10, 20, "t")]
    assert rows[1]["attributes"]["tag"] == "x"
    writers.write_annotation(readers.read_annotation(spark, str(path)).where("feature = 'transcript'"), str(tmp_path / "out"))
    again = readers.read_annotation(spark, str(tmp_path / "out")).first()
    assert (again["start"], again["end"], again["attributes"]) == (10, 20, rows[1]["attributes"])


def test_bed(spark, tmp_path):
    path = tmp_path / "a.bed"
    path.write_text("# c\ntrack x\nbrowser y\n\n2L\t5\t9\tn\t.\t-\nchrX 1 4\n2L\t9\t5\nX\t-1\t4\nX\ta\t4\nX\t1\n")
    rows = readers.read_intervals(spark, str(path))
    assert {tuple(r)[:4] for r in rows.collect()} == {("chr2L", 5, 9, "n"), ("chrX", 1, 4, "chrX:1-4")}
    writers.write_intervals(rows, str(tmp_path / "out"))
    assert {tuple(r)[:4] for r in readers.read_intervals(spark, str(tmp_path / "out")).collect()} == {tuple(r)[:4] for r in rows.collect()}


def test_fasta(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.fa").write_text(">t1 more words\nACGT\nacgt\n>empty\n>t2\n" + "ACGTN" * 30 + "\n")
    (tmp_path / "in/b.txt").write_text(">no\nAC\n")
    rows = readers.read_sequences(spark, str(tmp_path / "in"))
    got = {r["transcript_id"]: r["sequence"] for r in rows.collect()}
    assert got == {"t1": "ACGUACGU", "t2": "ACGUN" * 30}
    writers.write_sequences(rows, str(tmp_path / "out"))
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("part-*"))
    assert max(map(len, text.splitlines())) == 60 and text.count(">") == 2


def test_sequence_files_keep_texts_without_letters(spark, tmp_path):
    """Such documents have an empty sequence, and a null text has a null one: both are in the SQL's result, wherever they lie in a file."""
    texts = ["Éé è.", "acgt", None, "12", "", "T" * 130, None, "", "é"]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2).write.parquet(path)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    want = sorted(con.sql(ORACLES["sequence_files"]).fetchall())
    got = sorted(tuple(r) for r in QUERIES["sequence_files"](spark, str(tmp_path)).collect())
    assert got == want and len(got) == len(texts)


def test_tracks_and_spec(spark, tmp_path):
    (tmp_path / "s.bedgraph").write_text("track\nc\t0\t5\t1.5\nc\t5\t5\t2\nc\t6\t9\tnan\n")
    (tmp_path / "e.bed").write_text("c\t0\t5\ta\tb\n")
    assert [tuple(r) for r in readers.read_track(spark, str(tmp_path / "s.bedgraph"), "signal").collect()] == [("c", 0, 5, 1.5)]
    assert readers.read_track(spark, str(tmp_path / "e.bed"), "entry").first()["rest"] == "a\tb"
    items = [{"path": "p", "upstream": -4, "downstream": 7, "stats": [{"stat": "mean", "name": "m"}, {"stat": "odd", "name": "o"}, "text", {"stat": "extract_names", "name": "n", "name_field_index": "x"}]}, {"path": "q"}]
    assert [tuple(r) for r in readers.track_spec_table(spark, items).collect()] == [("p", "mean", "m", 0, 7, 3), ("p", "extract_names", "n", 0, 7, 3)]
    for bad in ({}, [{"stats": []}]):
        with pytest.raises(ValueError):
            readers.track_spec(bad)


def test_tables(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5), ("b", None)], "transcript_id string, x double")
    for name in ("t.csv", "t.tsv", "t.parquet"):
        assert writers.write_table(df, str(tmp_path / name))
        assert {tuple(r) for r in readers.read_features(spark, str(tmp_path / name)).collect()} == {("a", 1.5), ("b", None)}
    assert not writers.write_table(df.limit(0), str(tmp_path / "none.csv")) and not (tmp_path / "none.csv").exists()
    df.withColumnRenamed("transcript_id", "index").write.parquet(str(tmp_path / "i.pq"))
    assert readers.read_features(spark, str(tmp_path / "i.pq")).columns == ["transcript_id", "x"]
    with pytest.raises(ValueError):
        readers.read_features(spark, "x.xls")


def test_quantification(spark, tmp_path):
    for s, v in (("s1", "2.0"), ("s2", "bad")):
        (tmp_path / s).mkdir()
        (tmp_path / s / f"{s}.rna.gtf").write_text(f'c\tx\ttranscript\t1\t9\t.\t+\t.\tgene_id "g"; transcript_id "t"; FPKM "{v}";\nc\tx\ttranscript\t1\t9\t.\t+\t.\tgene_id "g"; transcript_id "t"; FPKM "4.0";\n')
    got = {r["sample_id"]: r["fpkm"] for r in readers.read_quant(spark, str(tmp_path)).collect()}
    assert got == {"s1": 3.0, "s2": 4.0}


def test_sample_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("sample_id,condition\nS1,x\nS2,y\n")
    (tmp_path / "b.tsv").write_text("SRR1\tz\nSRR2\tz\n")
    (tmp_path / "c.txt").write_text("# list\nS1\n\nS2\n")
    assert {tuple(r) for r in readers.read_samples(spark, str(tmp_path / "a.csv")).collect()} == {("S1", "x"), ("S2", "y")}
    assert {r[0] for r in readers.read_samples(spark, str(tmp_path / "b.tsv")).collect()} == {"SRR1", "SRR2"}
    assert {r[0] for r in readers.read_samples(spark, str(tmp_path / "c.txt")).collect()} == {"S1", "S2"}
    assert readers.list_files(spark, str(tmp_path)).count() == 3


def test_kmer_files(spark, tmp_path):
    counts = kmers.count_kmers(spark.createDataFrame([("s", "AGGA")], "transcript_id string, sequence string"), 2, 3)
    writers.write_kmers(counts, str(tmp_path / "k"))
    key = ["transcript_id", "k", "kmer", "cnt"]
    assert {tuple(r) for r in writers.read_kmers(spark, str(tmp_path / "k")).collect()} == {tuple(r) for r in counts.select(*key).collect()}
    writers.write_kmers(counts, str(tmp_path / "d.parquet"), "dense", 2, 3)
    dense = spark.read.parquet(str(tmp_path / "d.parquet"))
    assert len(dense.columns) == 13 and dense.first()["01"] == 1 and dense.first()["000"] == 0
    with pytest.raises(ValueError):
        writers.write_kmers(counts, str(tmp_path / "x"), codec="zip")


def test_splits_scaler_schema_files(spark, tmp_path):
    df = spark.range(40).select(F.col("id").cast("string").alias("transcript_id"), F.col("id").cast("double").alias("x"), (F.col("id") % 2 == 0).alias("y"))
    writers.write_splits(splits.stratified_split(df, "y"), str(tmp_path), "v1")
    assert writers.read_split(spark, str(tmp_path), "v1", "train").count() == 28
    stats = scaling.fit_scaler(df, "minmax", "y")
    writers.save_scaler(stats, str(tmp_path / "scaler"))
    assert writers.load_scaler(spark, str(tmp_path / "scaler")).collect() == stats.collect()
    doc = schema.extract_schema(df)
    schema.save_schema(spark, doc, str(tmp_path / "schema"))
    assert schema.load_schema(spark, str(tmp_path / "schema")) == doc and doc["feature_types"] == {"x": "continuous", "y": "nominal"}


def test_resume_batches(spark, tmp_path):
    df = spark.range(25).select(F.col("id").cast("string").alias("transcript_id"))
    compute = lambda rows: rows.withColumn("v", F.lit(1))
    assert writers.resume(df, None, "transcript_id", compute, ["v"]).count() == 25
    done = spark.createDataFrame([("3", 9), ("4", None), ("99", 9)], "transcript_id string, v int")
    got = {r["transcript_id"]: r["v"] for r in writers.resume(df, done, "transcript_id", compute, ["v"]).collect()}
    assert len(got) == 25 and got["3"] == 9 and got["4"] == 1
    writers.write_batches(df, str(tmp_path / "b"), "transcript_id", 10)
    assert spark.read.parquet(str(tmp_path / "b")).count() == 25
