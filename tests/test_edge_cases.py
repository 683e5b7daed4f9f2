"""Hand-made cases with answers computed by hand."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from txspark.functions import scalars
from txspark.operators import annotation, assembly, cleaning, encoding, evaluate, expression, intervals, kmers, models, samples, scaling, schema, sequences, splits, tracks

IV = "chromosome string, start long, end long, transcript_id string"


def iv(spark, *rows):
    return spark.createDataFrame([("c", *r) if len(r) == 3 else r for r in rows], IV)


def signal(spark, *rows):
    return spark.createDataFrame([("c", *r) for r in rows], "chromosome string, start long, end long, value double")


def entries(spark, *rows):
    return spark.createDataFrame([("c", *r) if len(r) == 3 else ("c", *r, "n") for r in rows], "chromosome string, start long, end long, rest string")


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


@pytest.mark.parametrize("width", [1, 7, 1 << 30])
def test_overlap(spark, width):
    a, b = iv(spark, (0, 10, "a"), (0, 100, "b"), (50, 50, "empty")), iv(spark, (10, 20, "x"), (9, 10, "y"), (0, 1000, "z"))
    got = {(r["transcript_id"], r["b_transcript_id"]) for r in intervals.overlap_join(a, b, width).collect()}
    assert got == {("a", "y"), ("a", "z"), ("b", "x"), ("b", "y"), ("b", "z")}
    assert intervals.overlap_join(a, b, width).count() == len(got)


def test_expansion_and_clipping(spark):
    sizes = spark.createDataFrame([("c", 100)], "chromosome string, length long")
    assert one(intervals.expand_intervals(iv(spark, (100, 200, "a")), 500, 50))[1:3] == (0, 250)
    assert one(intervals.expand_intervals(iv(spark, (150, 160, "a")), 5, 5, sizes))[1:3] == (150, 160)
    assert one(intervals.clip_intervals(iv(spark, (90, 120, "a")), sizes))[1:3] == (90, 100)
    assert intervals.clip_intervals(iv(spark, (150, 160, "a"), ("d", 0, 5, "b")), sizes).count() == 0


def test_signal(spark):
    s = signal(spark, (0, 2, 1.0), (5, 8, 4.0))
    r = one(tracks.signal_stats(iv(spark, (0, 10, "a")), s))
    assert (r["mean"], r["sum"], r["max"], r["min"], r["coverage"]) == (14 / 5, 14, 4, 1, 0.5)
    assert r["std"] == pytest.approx(np.std([1, 1, 4, 4, 4], ddof=1))
    assert one(tracks.signal_stats(iv(spark, (20, 30, "a")), s))["mean"] is None
    assert one(tracks.signal_stats(iv(spark, ("d", 0, 30, "a")), s))["coverage"] is None
    assert tracks.signal_stats(iv(spark, (0, 10, "a"), (0, 10, "b")), s).count() == 2


def test_entries(spark):
    e = entries(spark, (10, 30), (20, 40), (25, 28))
    r = one(tracks.entry_stats(iv(spark, (0, 100, "a")), e))
    assert (r["coverage"], r["depth_sum"], r["depth_mean"], r["depth_min"], r["depth_max"]) == (0.30, 43, 43 / 30, 1, 3)
    assert one(tracks.entry_coverage(iv(spark, (0, 100, "a")), e))["coverage"] == 0.30
    none = one(tracks.entry_stats(iv(spark, (60, 70, "a")), e))
    assert none["coverage"] == none["depth_max"] == none["depth_sum"] == 0.0
    assert one(tracks.entry_stats(iv(spark, ("d", 60, 70, "a")), e))["coverage"] is None
    names = entries(spark, (0, 5, "x\ty\t0\tb"), (3, 9, "x\ty\t0\ta"), (4, 6, "x\ty\t0\t."), (4, 6, "short"), (4, 6, "x\ty\t0\tb"))
    assert one(tracks.entry_names(iv(spark, (0, 10, "a")), names, 3))["names"] == "a,b"
    assert one(tracks.entry_names(iv(spark, (50, 60, "a")), names, 3))["names"] is None


def test_track_query_names(spark):
    spec = [{"path": "s", "stat": "max", "name": "x"}, {"path": "e", "stat": "std", "name": "y"}, {"path": "s", "stat": "min", "name": "x"}]
    got = tracks.query_tracks(iv(spark, (0, 10, "a")), spec, {"s": ("signal", signal(spark, (0, 2, 1.0), (5, 8, 4.0))), "e": ("entry", entries(spark, (1, 2)))})
    assert got.columns == ["chromosome", "start", "end", "transcript_id", "x", "y"]
    assert (one(got)["x"], one(got)["y"]) == (1.0, None)


def test_recoding(spark):
    df = spark.createDataFrame([("acgNTU1", "eve_1, , ftz_12")], "s string, t string")
    r = one(df.select(scalars.to_binary(F.col("s")), scalars.strip_rank_suffix(F.col("t")), scalars.revcomp(F.lit("AACGN")), scalars.valid_sequence(F.lit("ACX")), scalars.normalize_chrom(F.lit("2L")), scalars.to_rna(F.lit(" act "))))
    assert tuple(r) == ("01100", "eve,ftz", "NCGTT", False, "chr2L", "ACU")
    assert [scalars.sanitize_name(x) for x in ("a  b--c_", "__", "x")] == ["a_b_c", "feature", "x"]


def test_kmers(spark):
    df = spark.createDataFrame([("s", "AGGA"), ("t", "NN")], "transcript_id string, sequence string")
    assert {(r["kmer"], r["cnt"]) for r in kmers.count_kmers(df, 2, 2).collect()} == {("01", 1), ("11", 1), ("10", 1)}
    assert kmers.count_kmers(df.where("transcript_id = 's'"), 5, 5).count() == 0
    vocabulary = kmers.kmer_vocabulary(spark)
    assert vocabulary.count() == 8184 and vocabulary.where("k = 3").orderBy("kmer").first()["kmer"] == "000"
    for bad in ((0, 2), (3, 2)):
        with pytest.raises(ValueError):
            kmers.count_kmers(df, *bad)
    two = spark.createDataFrame([("a", 1, "0", 3), ("b", 1, "0", 5)], "transcript_id string, k int, kmer string, cnt long")
    assert {r["weight"] for r in kmers.tfidf(two).collect()} == {1.0}


def test_svd_against_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.random((12, 8))
    rows = [(f"t{i}", 3, f"{j:03b}", float(x[i, j])) for i in range(12) for j in range(8)]
    got = kmers.svd_by_k(spark.createDataFrame(rows, "transcript_id string, k int, kmer string, weight double"), 2).collect()
    v = np.linalg.svd(x)[2][:2]
    v = v * np.sign(v[np.arange(2), np.abs(v).argmax(axis=1)])[:, None]
    want = x @ v.T
    assert {r["name"] for r in got} == {"3mer_SVD1", "3mer_SVD2"}
    for r in got:
        assert r["score"] == pytest.approx(want[int(r["transcript_id"][1:]), int(r["name"][-1]) - 1], abs=1e-8)


def test_unique_ids(spark):
    df = spark.createDataFrame([("f.fa", i, "a") for i in range(3)], "file string, pos long, transcript_id string")
    assert [r["transcript_id"] for r in sequences.unique_ids(df).orderBy("pos").collect()] == ["a", "f.fa_a_dup1", "f.fa_a_dup2"]


def test_spliced(spark):
    genome = spark.createDataFrame([("c", "AACCGGTTACGT")], "chromosome string, sequence string")
    ann = spark.createDataFrame([("exon", "c", "t", 0, 3, "-"), ("exon", "c", "t", 6, 9, "-"), ("transcript", "c", "t", 0, 9, "-")], "feature string, chromosome string, transcript_id string, start long, end long, strand string")
    assert one(sequences.spliced_sequences(ann, genome, rna=False, size=2))["sequence"] == "TAAGTT"
    assert one(sequences.spliced_sequences(ann, genome, spliced=False, size=5))["sequence"] == "UAACCGGUU"


def test_annotation_needs_ids(spark):
    df = spark.createDataFrame([("c", "exon", 0, 1, "+", None)], "chromosome string, feature string, start long, end long, strand string, transcript_id string")
    with pytest.raises(ValueError):
        annotation.annotation_to_intervals(df)


def test_assembly_repeats(spark):
    track = spark.createDataFrame([("a", 1.0, 5), ("a", 2.0, 6)], "transcript_id string, Mean_x double, bed_y int")
    got = assembly.assemble_features(iv(spark, (5, 9, "a"), (0, 3, "a"), (0, 1, "b")), track)
    assert got.columns == ["transcript_id", "length", "mean_x"] and {(r["length"], r["mean_x"]) for r in got.collect()} == {(3, 1.0), (3, 2.0)}


def test_cleaning(spark):
    df = spark.createDataFrame([("a", None, -1.0, None), ("b", float("nan"), 1.0, "x"), ("c", 2.0, None, "y")], "transcript_id string, mean_x double, ss_mfe double, entries_t string")
    assert tuple(one(cleaning.handle_missing(df))) == ("a", 0.0, -1.0, "")
    same = spark.createDataFrame([("2", 5, False), ("1", 5, True)], "transcript_id string, x int, y boolean")
    assert tuple(one(cleaning.dedup_rows(same, "y"))) == ("1", 5, True)
    for df in (spark.createDataFrame([(1, 2)], "`a b` int, `a-b` int"), spark.createDataFrame([(1, 2)], "`a..b` int, `a b` int")):
        with pytest.raises(ValueError):
            cleaning.sanitize_columns(df)
    with pytest.raises(ValueError, match="only in the first"):
        cleaning.union_labelled(same, same.drop("x"))
    assert dict(cleaning.boolean_label(spark.createDataFrame([(2,), (1,)], "y int"), "y").dtypes)["y"] == "int"


def test_multi_hot(spark):
    df = spark.createDataFrame([("1", "Ab,c", ""), ("2", "", None), ("3", "c,", "")], "transcript_id string, entries_tfbs string, entries_none string")
    got = encoding.multi_hot(df, ["entries_tfbs", "entries_none"])
    assert got.columns == ["transcript_id", "tfbs_", "tfbs_ab", "tfbs_c"]
    assert [tuple(r)[1:] for r in got.orderBy("transcript_id").collect()] == [(False, True, True), (False, False, False), (True, False, True)]
    both = encoding.multi_hot(spark.createDataFrame([("1", "x", "x"), ("2", "", "x")], "transcript_id string, a string, b string"), ["a", "b"], prefix=False)
    assert [r["x"] for r in both.collect()] == [True, True]


def test_scaling(spark):
    df = spark.createDataFrame([("a", 5.0, 1), ("b", 5.0, 2), ("c", 5.0, 4)], "transcript_id string, k double, v int")
    stats = scaling.fit_scaler(df)
    assert {r["feature"]: r["scale"] for r in stats.collect()} == {"k": 1.0, "v": pytest.approx(1.247219, abs=1e-6)}
    assert [r["k"] for r in scaling.apply_scaler(df, stats).collect()] == [0, 0, 0]
    with pytest.raises(ValueError):
        scaling.apply_scaler(df.drop("k"), stats)
    assert [r["k"] for r in scaling.apply_scaler(df.drop("k"), stats, strict=False).collect()] == [-5.0] * 3


def test_split(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("transcript_id"), (F.col("id") % 5 == 0).alias("y"))
    got = splits.stratified_split(df, "y").groupBy("y", "split").count().collect()
    assert {(r["y"], r["split"]): r["count"] for r in got} == {(True, "train"): 140, (True, "validation"): 30, (True, "test"): 30, (False, "train"): 560, (False, "validation"): 120, (False, "test"): 120}
    for sizes in ((1.0, 0.0, 0.0), (0.5, 0.2, 0.2), (0.5, -0.1, 0.6)):
        with pytest.raises(ValueError):
            splits.check_sizes(sizes)
    assert {r["split"] for r in splits.stratified_split(df, None, (0.8, 0.2, 0.0)).collect()} == {"train", "validation"}


def test_schema_modes(spark):
    df = spark.createDataFrame([("a", 1, 2.0)], "transcript_id string, x int, z double")
    wanted = {"z": "double", "x": "double"}
    checks = lambda mode, **k: {(r["check"], r["level"]) for r in schema.validate(df, wanted, mode, **k)[0].collect()}
    assert checks(schema.Mode.STRICT) == {("order", "ERROR"), ("dtype", "ERROR")}
    assert schema.validate(df, wanted, schema.Mode.STRICT)[1] is None
    assert checks(schema.Mode.PERMISSIVE) == {("order", "INFO")}
    assert schema.validate(df, wanted, schema.Mode.PERMISSIVE)[1].columns == ["transcript_id", "z", "x"]
    assert checks(schema.Mode.COERCE) == {("order", "INFO"), ("dtype", "INFO")}
    assert dict(schema.validate(df, wanted, schema.Mode.COERCE)[1].dtypes)["x"] == "double"
    text = spark.createDataFrame([("a", "7"), ("b", "no")], "transcript_id string, x string")
    assert {(r["level"], r["n"]) for r in schema.validate(text, {"x": "double"}, schema.Mode.COERCE)[0].collect()} == {("ERROR", 1)}
    assert {r["check"] for r in schema.validate(df, {"x": "integer", "z": "double", "w": "double"}, schema.Mode.PERMISSIVE)[0].collect()} == {"missing"}
    extra = schema.validate(df, {"x": "integer"}, schema.Mode.STRICT)[0].collect()
    assert [(r["feature"], r["level"]) for r in extra] == [("z", "ERROR")]


def test_published_confusion(spark):
    counts = spark.createDataFrame([(3511, 2, 3, 417)], "tn long, fp long, fn long, tp long")
    r = one(evaluate.metrics_of_counts(counts))
    assert [round(r[c], 5) for c in ("accuracy", "precision", "recall", "f1", "f1beta")] == [0.99873, 0.99523, 0.99286, 0.99404, 0.99475]


def test_degenerate_metrics(spark):
    ones = spark.createDataFrame([(1, 0, 0.3), (1, 0, 0.4)], "y int, pred int, score double")
    assert one(evaluate.roc_auc(ones))["roc_auc"] == 0.0
    assert (one(evaluate.metrics(ones))["precision"], one(evaluate.metrics(ones))["f1"]) == (0.0, 0.0)
    tied = spark.createDataFrame([(1, 1, 0.5), (0, 1, 0.5)], "y int, pred int, score double")
    assert one(evaluate.roc_auc(tied))["roc_auc"] == 0.5
    assert evaluate.roc_curve(tied).count() == 2


def test_bh(spark):
    df = spark.createDataFrame([(i, p) for i, p in enumerate((0.01, 0.04, 0.03, 0.20, None))], "id int, pval double")
    got = {r["id"]: r["qval"] for r in expression.bh_adjust(df).collect()}
    assert got[4] is None and [round(got[i], 6) for i in range(4)] == [0.04, 0.053333, 0.053333, 0.2]


def test_f_tail():
    # P(F(1, d) > t * t) is the two-sided tail of Student's t; for one and two degrees it has closed forms
    for t in (0.1, 0.7, 1.5, 4.0, 30.0):
        assert expression._f_tail(np.array([t * t]), np.array([1.0]), np.array([1.0]))[0] == pytest.approx(1 - 2 * math.atan(t) / math.pi, rel=1e-9)
        assert expression._f_tail(np.array([t * t]), np.array([1.0]), np.array([2.0]))[0] == pytest.approx(1 - t / math.sqrt(2 + t * t), rel=1e-9)
    assert expression._f_tail(np.array([0.0]), np.array([1.0]), np.array([5.0]))[0] == pytest.approx(1.0)


def test_dge_against_least_squares(spark):
    rng = np.random.default_rng(3)
    rows = [(f"t{i}", f"g{i % 3}", f"s{j}", float(rng.gamma(2, 3) * (4 if i == 0 and j % 2 else 1))) for i in range(9) for j in range(8)]
    fpkm = spark.createDataFrame(rows, "transcript_id string, gene_id string, sample_id string, fpkm double")
    sheet = spark.createDataFrame([(f"s{j}", "AB"[j % 2]) for j in range(8)], "sample_id string, condition string")
    got = {r["id"]: r for r in expression.dge_test(fpkm, sheet).collect()}
    size = np.array([math.log2(sum(v for _, _, s, v in rows if s == f"s{j}") + 1) for j in range(8)])
    for i in range(9):
        y = np.log2(np.array([v for t, _, _, v in rows if t == f"t{i}"]) + 1)
        small, large = np.column_stack([np.ones(8), size]), np.column_stack([np.ones(8), size, np.arange(8) % 2])
        r0, r1 = (float(((y - m @ np.linalg.lstsq(m, y, rcond=None)[0]) ** 2).sum()) for m in (small, large))
        p = expression._f_tail(np.array([(r0 - r1) / (r1 / 5)]), np.array([1.0]), np.array([5.0]))[0]
        assert got[f"t{i}"]["pval"] == pytest.approx(p, rel=1e-6)
        assert got[f"t{i}"]["fc"] == pytest.approx(2 ** np.linalg.lstsq(large, y, rcond=None)[0][2], rel=1e-6)
    assert expression.dge_test(fpkm, sheet, "gene").count() == 3
    with pytest.raises(ValueError):
        expression.dge_test(fpkm, sheet.where("condition = 'A'"))


def test_layouts(spark):
    listing = spark.createDataFrame([("x/a_1.fastq.gz", 500), ("x/a_2.fastq.gz", 500), ("x/b.fq", 500), ("x/c_1.fastq", 500), ("x/d_R1.FASTQ.gz", 5)], "path string, length long")
    assert {r["sample_id"]: r["layout"] for r in samples.detect_layouts(listing).collect()} == {"a": "PAIRED", "b": "SINGLE", "c": "UNKNOWN", "d": "UNKNOWN"}
    assert [r["sample_id"] for r in samples.discover_samples(listing).collect()] == ["a", "b", "c", "d"]
    with pytest.raises(Exception, match="unknown layout"):
        samples.declared_layouts(spark.createDataFrame([("a", "maybe")], "sample_id string, paired string")).collect()


def test_correlation_forms_agree(spark):
    rng = np.random.default_rng(1)
    x = rng.random((60, 3))
    df = spark.createDataFrame([(float(a), float(2 * a + 0.001 * b), float(c)) for a, b, c in x], "a double, b double, c double")
    assert [r["feature"] for r in evaluate.correlated_features(df, ["a", "b", "c"]).collect()] == ["b"]


def test_additive_terms_score_like_the_pipeline(spark):
    rng = np.random.default_rng(2)
    rows = [(str(i), float(a), float(b), bool(a + 0.3 * b > 0.6)) for i, (a, b) in enumerate(rng.random((400, 2)))]
    df = spark.createDataFrame(rows, "transcript_id string, a double, b double, y boolean")
    model = models.train(df, "additive", ["a", "b"])
    terms, cuts, intercept = models.additive_terms(spark, model, ["a", "b"])
    own = {r["transcript_id"]: r["prob"] for r in models.score_additive(df, terms, cuts, intercept).collect()}
    for r in models.predict(model, df, ["a", "b"]).collect():
        assert own[r["transcript_id"]] == pytest.approx(r["score"], abs=1e-9)
    assert models.evaluate(model, df, ["a", "b"])["roc_auc"] > 0.95
    with pytest.raises(ValueError):
        models.train(df.withColumn("a", F.lit("x")), "additive", ["a"])
    trials = models.search(df, df, "random_forest", ["a", "b"], {"numTrees": [2, -1], "maxDepth": [2]}, n=2)
    assert {r["state"] for r in trials.collect()} == {"complete", "pruned"}
    assert len(models.refit_top(trials, 3, df, df, "random_forest", ["a", "b"])) == 1


def test_trials_in_parallel_and_by_halving(spark):
    """Two features tell the label only together, so depth decides; what halving keeps is the best of a full search."""
    rng = np.random.default_rng(5)
    rows = [(str(i), float(a), float(b), bool((a > 0.5) != (b > 0.5))) for i, (a, b) in enumerate(rng.random((900, 2)))]
    df = spark.createDataFrame(rows, "transcript_id string, a double, b double, y boolean").repartition(4)
    space = {"numTrees": [4], "maxDepth": [1, 2, 5, -3]}
    full = models.search(df, df, "random_forest", ["a", "b"], space, ("accuracy",), 4).collect()
    again = models.search(df, df, "random_forest", ["a", "b"], space, ("accuracy",), 4, parallel=1).collect()
    assert [r[:4] for r in full] == [r[:4] for r in again]
    assert [r["state"] for r in full] == ["complete"] * 3 + ["pruned"]
    halved = models.search(df, df, "random_forest", ["a", "b"], space, ("accuracy",), 4, rungs=2)
    out = halved.collect()
    assert [r["state"] for r in out] == ["complete"] + ["pruned"] * 3
    assert out[0][:4] == full[0][:4]
    assert sorted(r["value"] is None for r in out) == [False, False, False, True]
    assert len(models.refit_top(halved, 3, df, df, "random_forest", ["a", "b"])) == 1
    few, more = ({r["transcript_id"] for r in models.nested_sample(df, ["a", "b"], s).collect()} for s in (0.2, 0.5))
    assert few < more and 100 < len(few) < 260 < 350 < len(more) < 550
    nothing = models.search(df.where("false"), df, "random_forest", ["a", "b"], space, ("accuracy",), 4, rungs=2).collect()
    assert [r["state"] for r in nothing] == ["pruned"] * 4


def test_calls_from_annotation_genome_and_tracks(spark):
    """A token of an entry track turns the call of one of two transcripts with equal signal."""
    from txspark.operators.models import TERMS, Additive, call_annotation

    sequence = "ACGTTGCAAGGTCCATTGACCATGCAAGTCCGATTACGGA" * 8
    genome = spark.createDataFrame([("2L", sequence)], "chromosome string, sequence string")
    rows = [("2L", f, t, s, e, "+") for t, s, e in (("a", 0, 100), ("b", 150, 290)) for f in ("transcript", "exon")]
    annotation = spark.createDataFrame(rows, "chromosome string, feature string, transcript_id string, start long, end long, strand string")
    signal = spark.createDataFrame([("chr2L", 0, 320, 2.0)], "chromosome string, start long, end long, value double")
    entries = spark.createDataFrame([("chr2L", 160, 170, "x\ty\t0\tEve-1")], "chromosome string, start long, end long, rest string")
    spec = [{"path": "s", "stat": "mean", "name": "mean_signal"}, {"path": "e", "stat": "extract_names", "name": "entries_tfbs", "name_field_index": 3}]
    terms = spark.createDataFrame([("tfbs_eve_1", "tfbs_eve_1", b, None, None, v) for b, v in enumerate((-1.0, 1.0))] + [("mean_signal", "mean_signal", b, None, None, v) for b, v in enumerate((5.0, 0.0))], TERMS)
    model = Additive(terms, {"tfbs_eve_1": [0.5], "mean_signal": [1.0]})
    schema = {"mean_signal": "double", "tfbs_eve_1": "boolean", "3mer_svd1": "double"}
    got = call_annotation(annotation, genome, spec, {"s": ("signal", signal), "e": ("entry", entries)}, model, schema, lengths=(3, 4))
    assert {r["transcript_id"]: (r["prediction"], r["chromosome"]) for r in got.collect()} == {"a": (0, "chr2L"), "b": (1, "chr2L")}


def test_kmers_across_pieces(spark):
    from collections import Counter

    seqs = {"empty": "", "null": None, "short": "AC", "three": "ACG", "edge": "ACGGT" * 52, "long": "ACGGTTCA" * 8200 + "GATTACA"}
    df = spark.createDataFrame(list(seqs.items()), "transcript_id string, sequence string")
    got = {(r["transcript_id"], r["k"], r["kmer"]): r["cnt"] for r in kmers.count_kmers(df).collect()}
    want = Counter()
    for name, text in seqs.items():
        code = (text or "").translate(str.maketrans("ATUGC", "00011"))
        want.update((name, k, code[i : i + k]) for k in range(3, 13) for i in range(len(code) - k + 1))
    assert got == dict(want)


def test_kmers_of_long_sequences(spark, monkeypatch):
    """Parts, slices and repeated ids give the counts of whole sequences; what a query shuffles and stores are texts, not k-mers."""
    seqs = [("a", "ACGGTTCANGATTACA" * 40), ("b", "ACG"), ("a", "TTGACCA"), ("c", "GATTACAGC" * 15), ("d", "NN"), ("e", None)]
    df = spark.createDataFrame(seqs, "transcript_id string, sequence string")
    key = lambda r: (r["transcript_id"], r["k"], r["kmer"])
    counts = {key(r): r["cnt"] for r in kmers.count_kmers(df, 3, 6).collect()}
    words = {(r["k"], r["kmer"]): r["cnt"] for r in kmers.count_words(df, 3, 6).collect()}
    for name, value in (("PIECE", 50), ("PART", 2), ("CHARS", 70), ("CELLS", 1 << 8)):
        monkeypatch.setattr(kmers, name, value)
    assert {key(r): r["cnt"] for r in kmers.count_kmers(df, 3, 6).collect()} == counts
    assert {(r["k"], r["kmer"]): r["cnt"] for r in kmers.count_words(df, 3, 6).collect()} == words
    rows = spark.createDataFrame([(*k, v) for k, v in counts.items()], "transcript_id string, k int, kmer string, cnt long")
    want = {key(r): r["weight"] for r in kmers.tfidf(rows).collect()}
    assert {key(r): r["weight"] for r in kmers.kmer_weights(df, 3, 6).collect()} == pytest.approx(want)
    got = {(r["transcript_id"], r["name"]): r["score"] for r in kmers.sequence_components(df, 3, 6, {3: 2}).collect()}
    assert got == pytest.approx({(r["transcript_id"], r["name"]): r["score"] for r in kmers.svd_by_k(kmers.tfidf(rows), {3: 2}).collect()}, abs=1e-8)
    assert ("b", "3mer_SVD1") in got and ("b", "4mer_SVD1") not in got and not {"d", "e"} & {k[0] for k in got}
    plan = kmers.count_kmers(df, 3, 6)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("Generate")[0]  # k-mers are not shuffled
    assert kmers.reduce_sequences(df, 3, 6, order="svd_tfidf").columns == ["transcript_id", *[f"{k}mer_SVD1" for k in (3, 4, 5, 6)]]
    assert kmers.reduce_sequences(df.where("false"), 3, 6).count() == 0


def test_short_and_long_sequences_have_the_same_components(spark, monkeypatch):
    """Windows of short texts are looked up, counts of long ones multiplied: scores are the same either way."""
    rng = random.Random(17)
    seqs = [(f"t{i}", "".join(rng.choice("ACGT") for _ in range(rng.choice([2, 3, 5, 20, 50, 400])))) for i in range(60)] + [("n", "ACNNACGTN"), ("none", "NN")]
    df = spark.createDataFrame(seqs, "transcript_id string, sequence string")
    found = []
    for short in (-1, 100, 10_000):
        monkeypatch.setattr(kmers, "SHORT", short)
        monkeypatch.setattr(kmers, "WINDOWS", 700)
        found.append({(r["transcript_id"], r["name"]): r["score"] for by_k in (True, False) for r in kmers.sequence_components(df, 3, 8, 2, by_k).collect()})
    assert found[1] == pytest.approx(found[0], abs=1e-8) and found[2] == pytest.approx(found[0], abs=1e-8) and ("none", "SVD_0") not in found[2]


def test_a_slow_spectrum_takes_few_rounds():
    """Directions of all rounds count: 40 rounds of powers alone leave these values wrong."""
    rng = np.random.default_rng(3)
    values = 0.995 ** np.arange(400)
    basis = np.linalg.qr(rng.standard_normal((400, 400)))[0]
    gram, rounds = (basis * values) @ basis.T, []

    def times(rows, q):
        rounds.append({b: m.shape[1] for b, m in q.items()})
        return {b: gram @ m for b, m in q.items()}

    s, v = kmers.right_vectors(None, {5: 400}, {5: 2}, times)[5]
    assert np.abs(s**2 - values[:2]).max() < 1e-6 and np.abs(np.abs(basis[:, :2].T @ v) - np.eye(2)).max() < 1e-2
    assert len(rounds) <= 40 and max(r[5] for r in rounds) <= 4
    for m, wanted in ((1, 1), (8, 2), (12, 1), (30, 29)):
        part = gram[:m, :m]
        s, v = kmers.right_vectors(None, {0: m}, {0: wanted}, lambda rows, q, part=part: {b: part @ x for b, x in q.items()})[0]
        assert np.abs(s**2 - np.sort(np.linalg.eigvalsh(part))[::-1][:wanted]).max() < 1e-9 and v.shape == (m, wanted)


def test_overlap_join_is_no_broadcast(spark):
    """The rows by bin of a side that looks small stay off the driver, and a side shows itself only at levels that the other has."""
    a = spark.createDataFrame([("c", i, i + 5, f"t{i}") for i in range(50)], "chromosome string, start long, end long, transcript_id string")
    pairs = intervals.overlap_join(a, a, 16)
    assert pairs.count() == sum(abs(i - j) < 5 for i in range(50) for j in range(50))
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_splits_are_derived_once(spark):
    """What a fit reads many times is a written table, not the joins and aggregations behind it."""
    from txspark.plans import model_queries
    from txspark.plans.fixtures import Inputs

    for part in model_queries._split(Inputs(spark, "/root/testdata/sf0.001")):
        assert "Exchange" not in part._jdf.queryExecution().executedPlan().toString()
