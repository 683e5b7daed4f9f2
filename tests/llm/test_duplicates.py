"""Near-duplicate documents and vectors against all pairs."""

import random
import re

import numpy as np
import pytest

from tests.llm import cases
from txspark.llm import minhash, staging
from txspark.llm.components import connected_components
from txspark.llm.embeddings import near_vectors, normalise, quantise
from txspark.llm.minhash import band_keys, near_duplicates, shared_counts, shingle_sets, signatures
from txspark.llm.staging import Scratch


def components(ids, links):
    label = {i: i for i in ids}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        label[b] = a
    return {i: root(i) for i in ids}


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def check_documents(docs, got):
    sets = {r["doc_id"]: shingles(r["text"]) for r in docs}
    index = {}
    for i, s in sets.items():
        for x in s:
            index.setdefault(x, []).append(i)
    pairs = {(a, b) for ids in index.values() for a in ids for b in ids if a < b}
    links = [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = components(sets, links)
    assert sorted(r["doc_id"] for r in got) == sorted(sets)
    for r in got:
        assert r["n_shingles"] == len(sets[r["doc_id"]])
        assert r["component_id"] == want[r["doc_id"]] and r["kept"] == (r["doc_id"] == r["component_id"]), r


def test_documents(spark):
    check_documents(cases.docs(spark).collect(), near_duplicates(cases.docs(spark)).collect())
    assert near_duplicates(cases.empty(spark)).count() == 0


def test_documents_in_groups(spark):
    rng = random.Random(3)
    rows, boiler = [], cases.words(rng, 120)
    for g in range(12):
        own = cases.words(rng, rng.choice([4, 6, 9, 40, 300])).split()
        for _ in range(rng.choice([1, 2, 5, 40])):
            new = [w if rng.random() > 0.02 else f"e{rng.randrange(99)}" for w in own]
            rows.append((len(rows) * 3 % 1009, " ".join(new) + (" " + boiler if g % 3 == 0 else "")))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check_documents(docs.collect(), near_duplicates(docs).collect())


def test_documents_of_a_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    check_documents(docs.collect(), near_duplicates(docs).collect())


@pytest.mark.parametrize("tile", [256, 40])
def test_documents_with_a_shared_template(spark, monkeypatch, tile):
    """Unrelated documents of one template fill the common buckets, below 0.75; planted pairs lie just above it."""
    monkeypatch.setattr(minhash, "TILE", tile)
    rng = random.Random(11)
    template, rows = cases.words(rng, 420), []
    for g in range(130):
        own = [cases.words(rng, 82).split() for _ in range(2)]
        rows.append((2 * g, template + " " + " ".join(own[0])))
        if g % 3 == 0:
            rows.append((2 * g + 1, template + " " + " ".join(own[0][: rng.randrange(18, 26)] + own[1])))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = near_duplicates(docs).collect()
    check_documents(docs.collect(), got)
    assert 20 < sum(not r["kept"] for r in got) < 60


def test_no_table_that_grows_is_broadcast(spark, monkeypatch):
    """Files of ids look small to Spark: beyond the counted bound, no join sends a side through the driver, the rows by tile least of all."""
    plans = {}

    class Noted(minhash.Scratch):
        def put(self, df, name):
            plans[name] = df._jdf.queryExecution().executedPlan().toString()
            return super().put(df, name)

    monkeypatch.setattr(minhash, "Scratch", Noted)
    monkeypatch.setattr(staging, "BROADCAST_ROWS", 0)
    rng = random.Random(5)
    template = cases.words(rng, 420)
    docs = spark.createDataFrame([(g, template + " " + cases.words(rng, 82)) for g in range(40)] + [(50, template), (51, template + " x")], "doc_id long, text string")
    check_documents(docs.collect(), near_duplicates(docs).collect())
    assert {"reps", "candidates", "open", "rest", "links-3"} <= set(plans)
    for name in ("reps", "candidates", "placed", "chains", "rest", "sets", "links-3"):
        assert "Broadcast" not in plans[name], name


def test_shared_counts():
    rng = np.random.default_rng(6)
    sets = [np.unique(np.concatenate([rng.integers(0, 60, 30), rng.integers(100, 2000, k)]).astype(np.uint64)) for k in (0, 5, 400, 900) * 12] + [np.zeros(0, np.uint64)]
    got = shared_counts(sets)
    assert all(got[i, j] == len(np.intersect1d(a, b)) for i, a in enumerate(sets) for j, b in enumerate(sets) if i != j)
    assert shared_counts([]).shape == (0, 0)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    for n in (3, 40, 2000):
        a = np.sort(rng.integers(0, 2**63, 4 * n, dtype=np.int64).astype(np.uint64) * np.uint64(2))
        sig = signatures([np.sort(a[: 3 * n]), np.sort(a[n:])])
        assert abs((sig[0] == sig[1]).mean() - 0.5) < 0.2
        assert band_keys(sig).shape == (2, 32)
    assert [len(s) for s in shingle_sets([None, "", "a", "a b c d e f"])] == [0, 0, 1, 2]


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 300) if i % 50] + [(1000, 1000 + k) for k in range(200)] + [(rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(250)] + [(7, 7), (8, 9), (9, 8)]
    df = spark.createDataFrame(edges + [(None, 3)], "a long, b long")
    got = {r["id"]: r["component"] for r in connected_components(df, Scratch(spark, "test")).collect()}
    want = components({x for e in edges for x in e}, edges)
    linked = {x for e in edges for x in e if e[0] != e[1]}
    assert got == {k: v for k, v in want.items() if k in linked}


def check_vectors(rows, got, least=0.9):
    ids = [r[0] for r in rows]
    good = [i for i, r in enumerate(rows) if r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])]
    links = []
    for dim in {len(rows[i][1]) for i in good}:
        own = [i for i in good if len(rows[i][1]) == dim]
        x = np.array([rows[i][1] for i in own], np.float64)
        norm = np.sqrt((x * x).sum(axis=1))
        cos = (x @ x.T) / norm[:, None] / norm[None, :]
        links += [(ids[own[a]], ids[own[b]]) for a, b in zip(*np.nonzero(np.triu(cos >= least, 1)), strict=True)]
    want = components(ids, links)
    n = {i: 0 for i in ids}
    for a, b in links:
        n[a] += 1
        n[b] += 1
    assert sorted(r["vec_id"] for r in got) == sorted(ids)
    for r in got:
        assert (r["n_links"], r["component_id"]) == (n[r["vec_id"]], want[r["vec_id"]]), r
        assert r["kept"] == (r["vec_id"] == r["component_id"])


@pytest.mark.parametrize("tile", [4096, 50, 37])
def test_vectors(spark, tile):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 16))
    rows = [(i * 7 % 1009, [float(np.float32(x)) for x in base[i % 60] + rng.normal(size=16) * (0.3 if i % 2 else 0.05)]) for i in range(220)]
    rows += [(2000 + i, rows[3][1]) for i in range(9)] + [(3000, [2 * x for x in rows[3][1]])]
    rows += [(4000, None), (4001, []), (4002, [0.0] * 16), (4003, [None] * 16), (4004, [float("nan")] * 16), (4005, [float("inf")] + [1.0] * 15), (4006, [1.0, 2.0]), (4007, [1.0, 2.1]), (4008, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    check_vectors(rows, near_vectors(df, 0.9, tile).collect())


def test_vectors_of_a_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    check_vectors([(r["vec_id"], list(r["embedding"])) for r in df.collect()], near_vectors(df, 0.9, 600).collect())
    assert near_vectors(df.limit(0)).count() == 0


def test_quantisation_bound():
    rng = np.random.default_rng(4)
    x = normalise(rng.normal(size=(200, 64)))
    q, s, r = quantise(x)
    approx = (q.astype(float) @ q.T.astype(float)) * s[:, None] * s[None, :]
    assert (np.abs(x @ x.T - approx) <= r[:, None] + r[None, :] + r[:, None] * r[None, :] + 1e-12).all()
