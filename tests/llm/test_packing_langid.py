"""Packing by an exact round trip, language identification by held-out accuracy."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tests.llm import cases
from txspark.llm.langid import fit, identify
from txspark.llm.packing import encoder, pack, piece_lengths

PATH = public_tokenizers.path("byte_bpe_50k.json")


def tokenizer():
    return Tokenizer.from_file(PATH)


def test_ids_equal_the_tokenizers(spark):
    texts = [t for _, t, *_ in cases.rows() if t] + ["<|endoftext|> it's  we'll\n\n  x　y ١٢٣ ½ ²"]
    texts += [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    texts += ["hello <|endoftext|> world", "<|endoftext|><|endoftext|>", " " * 2_000_000, "a" * 2_000_000, "x" + "\n" * 1_200_000 + "y <|endoftext", "\u3000" * 300_000]
    encode = encoder(PATH)
    for text, want in zip(texts, tokenizer().encode_batch(texts, add_special_tokens=False), strict=True):
        assert encode(text) == want.ids


def test_piece_lengths():
    for n in [*range(1, 70), 511, 512, 1023, 1024, 1025, 5000]:
        got = piece_lengths(n, 1024)
        assert sum(got) == n and max(got) <= 1024
        for piece in got:  # in its class, a sequence of such pieces is near full, or they are short
            assert piece * 32 < 1024 or 1024 - 1024 // piece * piece <= 1024 / 32
    assert sum(len(piece_lengths(n, 1024)) for n in range(1, 1025)) / 1024 < 2.9


def check_packing(docs, got, capacity=1024):
    t = tokenizer()
    ids = {r["doc_id"]: np.array([*t.encode(r["text"] or "", add_special_tokens=False).ids, 0], "<u4") for r in docs}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        own = ids[r["doc_id"]]
        assert r["doc_tokens"] == len(own)
        assert zlib.crc32(own[r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    times = defaultdict(int)
    for r in docs:
        times[r["doc_id"]] += 1
    for doc_id, n in times.items():
        at = 0
        for start, length in sorted(pieces[doc_id])[::n]:
            assert start == at
            at += length
        assert at == len(ids[doc_id]) and len(pieces[doc_id]) % n == 0
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding / (len(sequences) * capacity)


def test_round_trip(spark):
    check_packing(cases.docs(spark).collect(), pack(cases.docs(spark), PATH).collect())
    assert pack(cases.empty(spark), PATH).count() == 0
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert check_packing(docs.collect(), pack(docs, PATH).collect()) < 0.03


def test_language_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    train = docs.where("pmod(crc32(cast(cast(doc_id as string) as binary)), 3) <> 1")
    got = identify(docs.where("pmod(crc32(cast(cast(doc_id as string) as binary)), 3) = 1"), fit(train)).collect()
    right = sum(r["lang"] == r["lang_pred"] for r in got)
    assert len(got) > 300 and right / len(got) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_cases(spark):
    model = fit(cases.docs(spark))
    got = identify(cases.docs(spark), model)
    rows = got.collect()
    assert got.columns == [*cases.docs(spark).columns, "lang_pred", "score"] and len(rows) == len(cases.rows())
    for r in rows:
        letters = any(map(str.isalpha, r["text"] or ""))
        assert (r["lang_pred"] == "und") == (not letters) and r["lang_pred"] in {"und", "en", "de", "fr"}
    assert identify(cases.empty(spark), model).count() == 0
    nothing = fit(cases.empty(spark))
    assert {r["lang_pred"] for r in identify(cases.docs(spark), nothing).collect()} == {"und"}
