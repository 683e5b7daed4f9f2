"""Mixing against its targets and a direct solution; the pipeline stage by stage."""

import random

import numpy as np
import pytest

import corpus_pipeline
from tests.llm import cases
from tests.llm.test_duplicates import components, shingles
from txspark.llm.mixing import apply_mixture, domain_of, fit_domains, fit_mixture, label_documents, rate_scored, score_domains

SHARES = {"high": 0.8, "low": 0.19, "toxic": 0.01}


def projected(n, p, target, rounds=20000):
    """Plain projected gradient on the tokens' shares, in the metric of the tokens."""
    r = np.ones(len(n))
    w = n / n.sum()
    for _ in range(rounds):
        r = np.maximum(0, r - p @ (p.T @ (w * r) - target))
    return p.T @ (w * r)


def test_targets_are_met(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    domains = fit_domains(label_documents(docs, labels))
    assert domains.names == ["high", "low", "toxic"]
    scored = score_domains(docs, domains)
    mixture = fit_mixture(scored, domains, SHARES)
    got = apply_mixture(docs, mixture).toPandas()
    assert rate_scored(scored, mixture).toPandas()["rate"].sum() == pytest.approx(got["rate"].sum())
    p = got[["p_high", "p_low", "p_toxic"]].to_numpy()
    n = got["n_tokens"].to_numpy(float)
    assert len(got) == docs.count() and (got["rate"] >= 0).all() and (abs(p.sum(axis=1) - 1) < 1e-9).all()
    assert (got["n_tokens"] == [len(t.split()) for t in got["text"]]).mean() > 0.99  # str.split knows more white space
    reached = p.T @ (n / n.sum() * got["rate"])
    assert reached == pytest.approx([0.8, 0.19, 0.01], abs=1e-4)
    assert reached == pytest.approx(projected(n, p, np.array([0.8, 0.19, 0.01])), abs=1e-3)
    assert (abs(got["copies"] - got["rate"]) <= 1).all() and abs((got["copies"] * n).sum() / (got["rate"] * n).sum() - 1) < 0.1


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = domain_of(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"))
    labelled = docs.select("doc_id", "text").join(labels, "doc_id")
    domains = fit_domains(labelled.where("doc_id % 2 = 0"), 1500)
    got = apply_mixture(labelled.where("doc_id % 2 = 1"), fit_mixture(score_domains(labelled.limit(0), domains), domains, SHARES)).toPandas()
    best = got[["p_high", "p_low", "p_toxic"]].to_numpy().argmax(axis=1)
    right = best == got["domain"].map({"high": 0, "low": 1, "toxic": 2})
    assert right.mean() > 0.85 and right[got["domain"] == "toxic"].mean() > 0.65 and right[got["domain"] == "high"].mean() > 0.85


def test_cases(spark):
    docs = cases.docs(spark)
    labels = spark.createDataFrame([(0, 1, 0), (4, 0, 0), (4, 0, 0), (5, None, None), (99, 1, 1), (19, 1, 0), (20, 0, 0)], "doc_id long, quality int, toxic int")
    domains = fit_domains(label_documents(docs, labels))
    got = apply_mixture(docs, fit_mixture(score_domains(docs, domains), domains, {"high": 1.0}))
    assert got.count() == len(cases.rows()) and got.columns[: len(docs.columns)] == docs.columns
    none = fit_domains(label_documents(docs, labels.limit(0)))
    assert {r["rate"] for r in apply_mixture(docs, fit_mixture(score_domains(docs, none), none, {"high": 1.0})).collect()} == {1.0}
    assert apply_mixture(cases.empty(spark), fit_mixture(score_domains(cases.empty(spark), domains), domains, {"high": 1.0})).count() == 0


def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    start, columns = docs, docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == columns
        seen[name] = docs = spark.createDataFrame(docs.collect(), docs.schema)
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    assert ids(seen["language"]) == ids(start)
    assert seen["near_duplicates"].count() == len(ids(seen["near_duplicates"])) < start.count()
    assert ids(seen["secrets"]) == ids(seen["near_duplicates"])
    assert not any(r["text"] and "token = " in r["text"] and len(r["text"].split("token = ")[1]) > 50 and r["text"].split('token = "')[1][:8].isalnum() for r in seen["secrets"].collect() if 'token = "' in r["text"])
    domain = {r["doc_id"]: r["domain"] for r in domain_of(spark.read.parquet(f"{sf}/labels.parquet")).collect()}
    before, kept = ids(seen["secrets"]), ids(seen["mixing"])
    share = lambda name: len([i for i in kept if domain.get(i) == name]) / len([i for i in before if domain.get(i) == name])
    assert share("high") > 0.97 and share("low") > 0.9 and share("toxic") < 0.7


def test_deduplicate_keeps_one_row(spark):
    rows = cases.rows()
    near, clean = rows[0][1] + " end", cases.words(random.Random(1), 80)
    more = [(900, near), (900, clean), (901, clean + " more"), (902, None), (902, None), (902, "")] + [(903, clean.upper() * 2)] * 40
    docs = spark.createDataFrame(rows + [(i, t, "en", "src0", None, 0, "x", None) for i, t in more], cases.SCHEMA).repartition(3)
    pairs = sorted({(r[0], r[1]) for r in docs.collect()}, key=str)
    sets = [shingles(t) for _, t in pairs]
    links = [(a, b) for a in range(len(sets)) for b in range(a) if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    group = components(range(len(pairs)), links)
    got = corpus_pipeline.deduplicate(spark, docs, "")
    kept = [(r["doc_id"], r["text"]) for r in got.collect()]
    assert got.columns == docs.columns and len(kept) == len(set(kept)) == len(set(group.values()))
    assert {group[pairs.index(p)] for p in kept} == set(group.values())
    for p in kept:
        assert p[0] == min(q[0] for q, g in zip(pairs, [group[k] for k in range(len(pairs))], strict=True) if g == group[pairs.index(p)])
    assert (900, clean) in kept and (900, near) not in kept


def test_stages_keep_columns_of_any_name(spark):
    """Columns named like those that the stages use inside, awkward rows and an empty table pass through all stages."""
    own = {"_text": "mine", "_id": 7, "score": -5.0, "lang_pred": "xx", "row": "r", "spans": "s", "copies": 3, "n": 2, "component_id": 9, "a.b": "dot"}
    more = ", ".join(f"`{c}` {'string' if isinstance(v, str) else 'double' if isinstance(v, float) else 'long'}" for c, v in own.items())
    docs = spark.createDataFrame([(*r, *own.values()) for r in cases.rows()], f"{cases.SCHEMA}, {more}").repartition(3)
    for table in (docs, docs.limit(0)):
        now = table
        for name, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, "/root/testdata/sf0.001")
            assert now.columns == docs.columns, name
            rows = now.collect()
            assert all(r[c] == v for r in rows for c, v in own.items()), name
            assert bool(rows) == (table is docs), name
            now = spark.createDataFrame(rows, docs.schema)
        assert bool(corpus_pipeline.pack_sequences(spark, now, "").count()) == (table is docs)


def test_mix_drops_labelled_toxic_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    domain = {r["doc_id"]: r["domain"] for r in domain_of(spark.read.parquet(f"{sf}/labels.parquet")).collect()}
    kept = {r["doc_id"] for r in corpus_pipeline.mix(spark, docs, sf).select("doc_id").collect()}
    left = {k: (sum(domain.get(i) == k for i in kept), sum(v == k for v in domain.values())) for k in ("high", "low", "toxic")}
    assert left["toxic"][0] == 0 and all(left[k][0] > 0.9 * left[k][1] for k in ("high", "low")), left


def test_pipeline_runs(spark):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and got.count() > 200
