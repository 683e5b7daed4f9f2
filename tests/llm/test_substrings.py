"""Removal of repeated substrings against the definition."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm import cases
from txspark.llm import substrings


def check(rows, got):
    """rows: (doc_id, text), with different ids."""
    length = substrings.LENGTH
    starts = defaultdict(int)
    data = {i: (t or "").encode() for i, t in rows}
    for d in data.values():
        for k in range(len(d) - length + 1):
            starts[d[k : k + length]] += 1
    assert Counter(r["doc_id"] for r in got) == Counter(data.keys())
    for r in got:
        d = data[r["doc_id"]]
        gone = bytearray(len(d))
        for k in range(len(d) - length + 1):
            if starts[d[k : k + length]] > 1:
                gone[k : k + length] = b"\x01" * length
        kept = bytes(c for c, g in zip(d, gone, strict=True) if not g)
        runs = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (len(d), len(d) - len(kept), runs, hashlib.sha256(kept).hexdigest()), r["doc_id"]


def test_cases(spark):
    docs = cases.docs(spark).dropDuplicates(["doc_id"])
    check([(r["doc_id"], r["text"]) for r in docs.collect()], substrings.remove_repeats(docs).collect())
    assert substrings.remove_repeats(cases.empty(spark)).count() == 0


@pytest.mark.parametrize("batches", [1, 3, 4])
def test_overlapping_passages(spark, monkeypatch, batches):
    monkeypatch.setattr(substrings, "BATCH_BYTES", 20_000)
    rng = random.Random(batches)
    text = lambda n: "".join(rng.choice("abcdefgh é\n") for _ in range(n))
    passages = [text(n) for n in (185, 190, 195, 199, 200, 201, 215, 230, 260, 400, 900)]
    rows = []
    for i in range(90):
        parts = [text(rng.randrange(0, 120))]
        for _ in range(rng.randrange(4)):
            p = rng.choice(passages)
            cut = rng.randrange(0, 12)
            parts += [p[cut:] if rng.random() < 0.5 else p[: len(p) - cut], text(rng.randrange(0, 60))]
        rows.append((i, "".join(parts)))
    rows += [(200, "a" * 700), (201, "ab" * 150), (202, "xyz" * 80 + "q"), (203, "a" * 199), (204, passages[4]), (205, passages[-1] + passages[-1])]
    check(rows, substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), batches).collect())


@pytest.mark.parametrize("bits", [40, 54, 56])
def test_anchors_of_a_text_with_more_places_than_a_key_holds(monkeypatch, bits):
    monkeypatch.setattr(substrings, "PLACE_BITS", bits)
    rng = np.random.default_rng(bits)
    passage = rng.integers(0, 256, 700, dtype=np.uint8)
    data = np.concatenate([passage, rng.integers(0, 256, 3000, dtype=np.uint8), passage, rng.integers(0, 4, 900, dtype=np.uint8)])
    hashes = substrings._Hashes(data)
    anchor, first, last = substrings._anchors_of(hashes, np.array([0, 150, len(data)]))
    low = np.uint64((1 << (64 - bits)) - 1)
    got = {w: a for a, b, e in zip(anchor.tolist(), first.tolist(), last.tolist(), strict=True) for w in range(b, e + 1)}
    assert got == {w: w + int(np.argmin(hashes.by[32][w : w + 169] & ~low)) for w in range(150, len(data) - 199)}
    assert all(got[w + 3700] == got[w] + 3700 for w in range(150, 501))


def test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    check([(r["doc_id"], r["text"]) for r in docs.collect()], substrings.remove_repeats(docs).collect())
