"""Language-model scores against plain counting, and the trie against a dictionary."""

import re
import tempfile
from collections import Counter
from math import log10

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import cases
from txspark.llm import ngrams
from txspark.llm.elias_fano import EliasFano, NgramTrie


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def check(rows, got, prior=ngrams.PRIOR):
    """rows: (doc_id, text, train)."""
    words, pairs, after = Counter(), Counter(), Counter()
    for _, text, train in rows:
        own = tokens(text)
        if train:
            words.update(own)
            pairs.update(zip([""] + own[:-1], own, strict=True))
            after.update([""] + own[:-1])
    n, v = sum(words.values()), len(words)
    want = {}
    for doc_id, text, train in rows:
        own = tokens(text)
        one = [(words[w] + 1) / (n + v + 1) for w in own]
        two = [(pairs[c, w] + prior * p) / (after[c] + prior) for c, w, p in zip([""] + own[:-1], own, one, strict=True)]
        want[doc_id] = (not train, len(own), sum(words[w] > 0 for w in own), n, sum(map(log10, one)), sum(map(log10, two)))
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    for r in got:
        w = want[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == w[:4]
        assert r["base_score"] == pytest.approx(w[4], rel=1e-9)
        assert r["score"] == pytest.approx(w[5], rel=1e-4, abs=1e-3 + 1e-4 * w[1])


@pytest.mark.parametrize("sizes", [(12_000_000, 1_500_000), (3_000, 2_000), (30_000, 40)])
def test_scores(spark, monkeypatch, sizes):
    monkeypatch.setattr(ngrams, "BATCH_CHARS", sizes[0])
    monkeypatch.setattr(ngrams, "SHARD_TOKENS", sizes[1])
    docs = cases.docs(spark).withColumn("train", F.col("doc_id") % 3 != 2)
    rows = [(r["doc_id"], r["text"], r["train"]) for r in docs.collect()]
    check(rows, ngrams.score_texts(docs).collect())


def test_scores_of_a_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").withColumn("train", F.expr("crc32(cast(cast(doc_id as string) as binary)) % 7 <> 2"))
    rows = [(r["doc_id"], r["text"], r["train"]) for r in docs.collect()]
    got = ngrams.score_texts(docs).collect()
    check(rows, got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_no_rows(spark):
    docs = cases.docs(spark).withColumn("train", F.lit(False))
    assert ngrams.score_texts(cases.empty(spark).withColumn("train", F.lit(True))).count() == 0
    got = ngrams.score_texts(docs).collect()
    assert len(got) == len(cases.rows()) and all(r["n_known"] == 0 and r["score"] == pytest.approx(0) for r in got)


def test_elias_fano():
    rng = np.random.default_rng(0)
    for n, universe in ((0, 10), (1, 1), (5, 5), (1000, 1 << 64), (1000, 1200), (3000, 100)):
        values = np.sort(rng.integers(0, min(universe, (1 << 63) - 1), n, dtype=np.int64)).astype(np.uint64)
        s = EliasFano.build(values, universe)
        assert (s.all() == values).all()
        asked = np.concatenate([values, rng.integers(0, min(universe + 2, (1 << 63) - 1), 500, dtype=np.int64).astype(np.uint64)])
        place, equal = s.successor(asked)
        assert (place == np.searchsorted(values, asked)).all() and (equal == np.isin(asked, values)).all()


@pytest.mark.parametrize("order", [1, 2, 3])
def test_trie(order):
    rng = np.random.default_rng(order)
    rows = sorted({tuple(int(x) for x in rng.integers(0, 40, order)) for _ in range(2000)})
    stored, absent = rows[::2], rows[1::2]
    columns = lambda some: [np.array(c, np.uint64) for c in zip(*some, strict=True)]
    with tempfile.TemporaryFile() as file:
        NgramTrie.build(columns(stored), np.arange(len(stored), dtype=np.uint16)).write(file)
        trie = NgramTrie.open(file)
        assert (trie.find(columns(stored)) == np.arange(len(stored))).all()
        assert not absent or (trie.find(columns(absent)) == -1).all()
        assert (trie.find([np.array([99], np.uint64)] * order) == -1).all()
        del trie


def test_pointers_give_the_range_of_each_context():
    rng = np.random.default_rng(5)
    rows = sorted({tuple(int(x) for x in rng.integers(0, 30, 2)) for _ in range(400)})
    trie = NgramTrie.build([np.array(c, np.uint64) for c in zip(*rows, strict=True)], np.arange(len(rows)))
    heads = sorted({r[0] for r in rows})
    places = trie.pointers[1].access(np.arange(len(heads) + 1)).astype(int).tolist()
    assert places == [sum(r[0] < h for r in rows) for h in heads] + [len(rows)]
    assert (trie.levels[1].access(np.arange(len(rows))) == trie.levels[1].all()).all()


@pytest.mark.parametrize("n", [1, 2, 5, 40])
def test_few_values_of_a_wide_universe(n):
    values = np.sort(np.random.default_rng(n).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
    s = EliasFano.build(values, 1 << 64)
    assert (s.all() == values).all() and (s.access(np.arange(n)) == values).all() and s.successor(values)[1].all()
    assert not s.successor(values - np.uint64(1))[1].any()


def test_quantised_logarithms():
    p = 10.0 ** np.linspace(-12.9, 0, 1000)
    assert np.abs(np.log10(ngrams.dequantise_log(ngrams.quantise_log(p))) - np.log10(p)).max() < 1.1e-4
