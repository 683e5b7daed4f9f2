"""Operators whose work must be dealt over tasks: nested bins, slices of an order, exact quantiles, sparse decompositions, blocks of columns."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from txspark.operators import evaluate, expression, intervals, ordered, schema, tracks

INTERVALS = "chromosome string, start long, end long, transcript_id string"


def some(seed, n, longest):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        start, size = rng.randrange(longest), int(longest ** rng.random())
        rows.append((rng.choice(["chr1", "chr2"]), start, start + size, f"{seed}-{i}"))
    return rows


@pytest.mark.parametrize("width", [4, 1000])
def test_overlaps_of_all_lengths(spark, width):
    a, b = some(1, 60, 10**8), some(2, 200, 10**6) + some(3, 40, 10**8) + [("chr1", 5, 5, "empty")]
    got = [(r["transcript_id"], r["b_transcript_id"]) for r in intervals.overlap_join(spark.createDataFrame(a, INTERVALS), spark.createDataFrame(b, INTERVALS), width).collect()]
    want = {(x[3], y[3]) for x in a for y in b if x[0] == y[0] and x[1] < y[2] and y[1] < x[2] and y[1] < y[2]}
    assert len(got) == len(set(got)) and set(got) == want and want


def test_a_long_interval_lies_in_few_bins(spark):
    one = spark.createDataFrame([("chr1", 123_456, 100_123_456, "long"), ("chr1", 4095, 4097, "short")], INTERVALS)
    per = intervals.in_bins(one, "start", "end", list(range(intervals.LEVELS)), "own", intervals.BIN).groupBy("transcript_id").count().collect()
    assert all(r["count"] < 50 for r in per) and len(per) == 2


def test_many_tracks_share_one_join(spark):
    iv = spark.createDataFrame([("chr1", 10, 20, "a"), ("chr1", 10, 20, "b"), ("chr2", 0, 5, "c"), ("chr3", 0, 5, "d")], INTERVALS)
    signal = lambda v: spark.createDataFrame([("chr1", 12, 18, float(v))], "chromosome string, start long, end long, value double")
    entries = spark.createDataFrame([("chr1", 0, 12, "x\tn1"), ("chr1", 11, 30, "y\tn2"), ("chr2", 9, 12, "z\t.")], "chromosome string, start long, end long, rest string")
    tracks_ = {f"s{k}": ("signal", signal(k)) for k in range(10)} | {"e": ("entry", entries)}
    spec = [{"path": f"s{k}", "stat": "mean", "name": f"m{k}", "upstream": k} for k in range(10)]
    spec += [{"path": "e", "stat": s, "name": f"e_{s}", "name_field_index": 1} for s in ("coverage", "mean", "min", "max", "sum", "extract_names", "std")]
    spec += [{"path": "e", "stat": "extract_names", "name": "first", "name_field_index": 0, "downstream": 1}, {"path": "gone", "stat": "max", "name": "gone"}]
    got = tracks.query_tracks(iv, spec, tracks_)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Join" in line and "_bin#" in line for line in plan.splitlines()) == 1
    rows = {r["transcript_id"]: r.asDict() for r in got.collect()}
    assert len(rows) == 4 and rows["a"] | {"transcript_id": "b"} == rows["b"]
    a, c, d = rows["a"], rows["c"], rows["d"]
    assert [a[f"m{k}"] for k in range(10)] == [float(k) for k in range(10)] and a["gone"] is None and a["e_std"] is None
    assert (a["e_coverage"], a["e_sum"], a["e_min"], a["e_max"], a["e_extract_names"], a["first"]) == (1.0, 11.0, 1.0, 2.0, "n1,n2", "x,y") and abs(a["e_mean"] - 1.1) < 1e-12
    assert (c["e_coverage"], c["e_mean"], c["e_extract_names"], c["m1"]) == (0.0, 0.0, None, None) and d["e_coverage"] is None


def test_depth_is_swept_once_for_all_intervals(spark):
    """Depth comes from segments of the track, over any tile: what is shuffled by interval are sums, not the ends of each overlap."""
    rng = random.Random(9)
    entries = [(c, s, s + rng.choice([0, 1, 7, 30, 400]), "x") for c in ("a", "b") for s in (rng.randrange(-40, 900) for _ in range(150))]
    df = spark.createDataFrame(entries, "chromosome string, start long, end long, rest string")
    depth = {c: [0] * 1400 for c in ("a", "b")}
    for c, s, e, _ in entries:
        for x in range(s, e):
            depth[c][x + 50] += 1
    for tile in (1, 13, 256, tracks.TILE):
        got = {c: [0] * 1400 for c in ("a", "b")}
        for r in tracks.depth_segments(df, tile=tile).collect():
            for x in range(r["start"], r["end"]):
                assert got[r["chromosome"]][x + 50] == 0
                got[r["chromosome"]][x + 50] = r["value"]
        assert got == depth, tile
    iv = [(rng.choice("abc"), s, s + rng.choice([1, 3, 20, 300]), f"t{i}") for i, s in enumerate(rng.randrange(0, 1000) for _ in range(40))]
    spec = [{"path": p, "stat": s, "name": f"{p}_{s}", "upstream": 2 * (p == "f")} for p in ("e", "f") for s in ("coverage", "mean", "min", "max", "sum")]
    found = tracks.query_tracks(spark.createDataFrame(iv, INTERVALS), spec, {"e": ("entry", df), "f": ("entry", df.where("start % 2 = 0"))})
    assert "Window" not in found._jdf.queryExecution().optimizedPlan().toString()
    for r in found.collect():
        if r["chromosome"] == "c":
            assert r["e_sum"] is None and r["f_max"] is None
            continue
        own = depth[r["chromosome"]][r["start"] + 50 : r["end"] + 50]
        some = [d for d in own if d]
        want = (len(some) / len(own), sum(some) / len(some) if some else 0, min(some, default=0), max(some, default=0), sum(some))
        assert [r[f"e_{s}"] for s in ("coverage", "mean", "min", "max", "sum")] == pytest.approx(list(want))


def test_bins_are_as_long_as_the_typical_interval(spark):
    """A few short intervals do not make all of the other side show itself at their level too."""
    a = spark.createDataFrame([("c", 7 * i, 7 * i + (40 if i % 10 else 3), f"t{i}") for i in range(100)], INTERVALS)
    b = spark.createDataFrame([("c", i, i + 1, f"s{i}") for i in range(700)], INTERVALS)
    pairs = intervals.overlap_join(a, b, 16)
    assert pairs.count() == sum(min(7 * i + (40 if i % 10 else 3), 700) - 7 * i for i in range(100))
    levels = intervals.interval_levels(a, 16)
    assert levels == {0: 10, 1: 90} and intervals.typical_level(levels) == 1 and intervals.typical_level({}) == 0
    assert intervals.in_bins(b, "start", "end", [1], "own", 16, 1).count() == 700


def test_running_totals_over_many_slices(spark):
    df = spark.range(6_000).select((F.col("id") * 7919 % 6_007).cast("double").alias("x"), (F.col("id") % 5).alias("n"))
    with_n = ordered.in_slices(df, "x", 1_000).coalesce(8)
    got = ordered.running(with_n, "x", {"total": F.col("n")}, F.sum, lambda a, b: a + b).orderBy("x").toPandas()
    assert got["_slice"].nunique() > 500
    assert (got["total"] == got["n"].cumsum()).all()
    down = ordered.running(with_n, "x", {"least": F.col("n") + F.col("x")}, F.min, F.least, descending=True).orderBy("x").toPandas()
    assert (down["least"] == (down["n"] + down["x"])[::-1].cummin()[::-1]).all()


def test_q_values_read_their_input_once(spark):
    rng = random.Random(4)
    p = [rng.choice([rng.random(), 0.25, None]) for _ in range(500)]
    seen = spark.sparkContext.accumulator(0)

    def note(frames):
        for f in frames:
            seen.add(len(f))
            yield f

    df = spark.createDataFrame(list(enumerate(p)), "id long, pval double").mapInPandas(note, "id long, pval double")
    got = {r["id"]: r["qval"] for r in expression.bh_adjust(df, slices=40).collect()}
    assert seen.value == 500
    ranked = sorted(x for x in p if x is not None)
    for i, x in enumerate(p):
        want = None if x is None else min(1.0, min(ranked[j] * len(ranked) / (j + 1) for j in range(len(ranked)) if ranked[j] >= x))
        assert (got[i] is None) == (want is None) and (want is None or abs(got[i] - want) < 1e-12)


def test_exact_quantiles(spark):
    rng = np.random.default_rng(3)
    values = {"normal": rng.normal(size=999), "wide": 10.0 ** rng.uniform(-300, 300, 500) * rng.choice([-1, 1], 500), "ties": rng.integers(0, 3, 400).astype(float), "one": np.array([-2.5]), "zeros": np.array([0.0, -0.0, 0.0])}
    rows = [(f, float(v)) for f, own in values.items() for v in own] + [("normal", None), ("none", None)]
    levels = [0.0, 0.05, 0.25, 0.5, 0.95, 1.0]
    got = {(r["feature"], r["level"]): r["value"] for r in schema.exact_quantiles(spark.createDataFrame(rows, "feature string, v double"), levels).collect()}
    assert set(got) == {(f, q) for f in values for q in levels}
    for (f, q), v in got.items():
        want = np.quantile(values[f], q)
        assert abs(v - want) <= 1e-12 * max(1.0, abs(want)), (f, q, v, want)


def test_sparse_decomposition_of_all_lengths(spark):
    """Components of lengths 3 to 12 at once against numpy's decomposition of the dense matrices."""
    from txspark.operators import kmers

    rng = random.Random(8)
    seqs = [(f"t{i}", "".join(rng.choice("ACGT") for _ in range(rng.randrange(40, 400)))) for i in range(40)]
    weights = kmers.tfidf(kmers.count_kmers(spark.createDataFrame(seqs, "transcript_id string, sequence string"))).persist()
    dense = weights.toPandas()
    got = kmers.svd_by_k(weights, {3: 3, 7: 2, 12: 2}).toPandas()
    for k, n in ((3, 3), (5, 1), (7, 2), (12, 2)):
        own = dense[dense["k"] == k].pivot(index="transcript_id", columns="kmer", values="weight").fillna(0.0).sort_index(axis=1)
        v = np.linalg.svd(own.to_numpy(), full_matrices=False)[2][:n]
        v = v * np.sign(v[np.arange(n), np.abs(v).argmax(axis=1)])[:, None]
        want = own.to_numpy() @ v.T
        for c in range(n):
            mine = got[got["name"] == f"{k}mer_SVD{c + 1}"].set_index("transcript_id")["score"].reindex(own.index).to_numpy()
            assert np.abs(mine - want[:, c]).max() < 1e-5, (k, c)
        assert set(got["name"][got["name"].str.startswith(f"{k}mer_")]) == {f"{k}mer_SVD{c + 1}" for c in range(n)}
    none = spark.createDataFrame([], "transcript_id string, k int, kmer string, weight double")
    assert kmers.svd_by_k(none).count() == 0 and kmers.svd_global(none, 2).count() == 0


def test_only_changed_rows_are_computed(spark, tmp_path):
    from txspark.sources.writers import resume_changed

    def run(rows, label, batches=3):
        seen = []

        def compute(df):
            seen.extend(r["k"] for r in df.collect())
            return df.select("k", F.concat("x", F.lit(label)).alias("y"))

        df = spark.createDataFrame(rows, "k int, x string, other int")
        return {r["k"]: r["y"] for r in resume_changed(df, str(tmp_path / "work"), "k", compute, ["x"], batches).collect()}, sorted(seen)

    assert run([], "0") == ({}, [])
    assert run([(i, "a", 0) for i in range(6)], "1") == ({i: "a1" for i in range(6)}, list(range(6)))
    got, seen = run([(0, "a", 9), (1, "b", 0), (2, None, 0), (5, "a", 0), (7, "a", 0)], "2")
    assert seen == [1, 2, 7] and got == {0: "a1", 1: "b2", 2: None, 5: "a1", 7: "a2"}
    # back to earlier content: its result is still there
    assert run([(1, "a", 0), (2, "a", 1)], "3") == ({1: "a1", 2: "a1"}, [])
    # rows of a batch that never reached the manifest do not count
    spark.createDataFrame([(1, "lost", "c", "b")], "k int, y string, _content string, _batch string").write.mode("append").parquet(str(tmp_path / "work" / "rows"))
    assert run([(1, "a", 0)], "4") == ({1: "a1"}, [])


def test_specification_files(spark, tmp_path):
    from txspark.sources.readers import read_track_spec

    (tmp_path / "a.json").write_text('[{"path": "p", "upstream": -1, "stats": [{"stat": "mean", "name": "m"}]}]')
    want = [{"path": "p", "stat": "mean", "name": "m", "upstream": 0, "downstream": 0, "name_field_index": 3}]
    assert read_track_spec(spark, str(tmp_path / "a.json")) == want
    (tmp_path / "b.yaml").write_text("- path: p\n  upstream: -1\n  stats:\n    - {stat: mean, name: m}\n")
    try:
        import yaml  # noqa: F401
    except ImportError:
        with pytest.raises(ValueError, match="YAML"):
            read_track_spec(spark, str(tmp_path / "b.yaml"))
    else:
        assert read_track_spec(spark, str(tmp_path / "b.yaml")) == want


@pytest.mark.parametrize("block", [2, 128])
def test_correlations_by_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(evaluate, "BLOCK", block)
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 7)) + 1e6
    x[:, 3] = x[:, 0] + 0.01 * rng.normal(size=300)
    x[:, 5] = -2 * x[:, 1] + 0.1 * rng.normal(size=300)
    x[:, 6] = 4.0
    x[rng.random(x.shape) < 0.1] = np.nan
    columns = [f"c {i}" for i in range(7)]
    df = spark.createDataFrame([tuple(None if np.isnan(v) and k % 2 else float(v) for k, v in enumerate(row)) for row in x], ", ".join(f"`{c}` double" for c in columns)).repartition(5)
    got = {(r["feature"], r["feature2"]): r["corr"] for r in evaluate.correlations(df, columns, 0.5).collect()}
    assert set(got) == {("c 0", "c 3"), ("c 1", "c 5")}
    for (a, b), r in got.items():
        i, j = columns.index(a), columns.index(b)
        ok = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
        assert abs(r - np.corrcoef(x[ok, i], x[ok, j])[0, 1]) < 1e-9
    assert {r["feature"] for r in evaluate.correlated_features(df, columns, 0.5).collect()} == {"c 3", "c 5"}
    assert evaluate.correlations(df, [], 0.5).count() == 0


def test_a_planted_interaction_is_found(spark):
    from txspark.operators import models

    rng = random.Random(12)
    rows = []
    for i in range(1200):
        a, b, c = rng.random(), rng.random(), rng.random()
        rows.append((f"t{i}", a, b if i % 50 else None, c, int(((a > 0.5) != (b > 0.5)) != (rng.random() < 0.05))))
    df = spark.createDataFrame(rows, "transcript_id string, a double, b double, c double, y int").persist()
    names = ["a", "b", "c"]
    single = models.evaluate(models.train(df, "additive", names, params={"bins": 4}), df, names)
    paired = models.train(df, "additive", names, params={"bins": 4, "pairs": 1, "regParam": 0.001})
    assert single["accuracy"] < 0.7 < 0.9 < models.evaluate(paired, df, names)["accuracy"]
    terms, cuts, intercept = models.additive_terms(spark, paired, names)
    assert {r["term"] for r in terms.collect()} == {"a", "b", "c", "a & b"}
    whole = df.where("b IS NOT NULL")
    mine = {r["transcript_id"]: r["prob"] for r in models.score_additive(whole, terms, cuts, intercept).collect()}
    theirs = {r["transcript_id"]: r["score"] for r in models.predict(paired, whole, names).collect()}
    assert all(abs(mine[k] - theirs[k]) < 1e-9 for k in theirs) and len(mine) == len(theirs)
    ranked = models.importance(models.explain_rows(df, terms, cuts)).orderBy("rank").first()
    assert ranked["term"] == "a & b"


def test_many_tokens_are_looked_up_once(spark):
    from txspark.operators import encoding

    rows = [("a", "T1,t2", "x"), ("b", "", None), ("c", "t9999,zz,T1,t1", "t5")]
    df = spark.createDataFrame(rows, "transcript_id string, entries_tfbs string, other_tfbs string")
    vocabulary = {"entries_tfbs": [f"t{i}" for i in range(10_000)], "other_tfbs": ["t5", "x"]}
    sparse, names = encoding.token_places(df, ["entries_tfbs", "other_tfbs"], vocabulary)
    got = {r["transcript_id"]: [names[i] for i in r["places"]] for r in sparse.collect()}
    assert got == {"a": ["tfbs_t1", "tfbs_t2", "tfbs_x"], "b": [], "c": ["tfbs_t1", "tfbs_t5", "tfbs_t9999"]}
    small = encoding.multi_hot(df, ["entries_tfbs", "other_tfbs"], prefix=False)
    assert {r["transcript_id"]: (r["t1"], r["t5"], r["x"], r["zz"]) for r in small.collect()} == {"a": (True, False, True, False), "b": (False,) * 4, "c": (True, True, False, True)}
