"""SentencePiece coding against the library, on hand-made, random and given texts."""

import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import cases
from txspark.llm.pieces import Merges, encode_texts, merges

PATH = public_tokenizers.path("piece_bpe_32k.model")
HARD = [
    "", " ", "  a  b ", "▁a a", "▁▁▁", "<s> </s> <unk> <0x41>", "\x00\x01 é½²日本語 😀😀", "a" * 3000, " " * 500 + "x", "x\n\n\t y\r\n", "퟿ \U00010348   tail", "ａｂｃ", "é ​﻿",
]


def check(texts):
    model = merges(PATH)
    got = model.encode(texts)
    assert got == model.library.encode(texts)
    for ids, text in zip(got, texts, strict=True):
        want = model.library.decode(ids)
        assert model.decode(ids) == want
        if not model.is_byte[ids].any():
            assert model.decode(ids, plain=True) == want
        assert model.agrees(text)


def test_hard_texts():
    check(HARD)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from("abTHEthein ▁ \n\té日😀<>0."), st.characters(exclude_categories=["Cs"])), max_size=60), max_size=8))
def test_any_texts(texts):
    check(texts)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 31999), st.integers(0, 260), st.sampled_from([28705, 259])), max_size=10))
def test_decoding_any_ids(ids):
    model = merges(PATH)
    assert model.decode(ids) == model.library.decode(ids)


def test_an_agenda_over_whole_texts_gives_the_same():
    """Cutting into chunks changes nothing: a text as one chunk has the same pieces."""
    model, rng = merges(PATH), random.Random(3)
    for text in [cases.words(rng, 40), "the  cat▁sat  on", *HARD[1:6]]:
        whole = " " + text.replace("▁", " ")
        assert [p for c in model.split(text) for p in model.merge(c)] == model.merge(whole)


def test_memory_of_chunks_is_bounded(monkeypatch):
    from txspark.llm import pieces

    monkeypatch.setattr(pieces, "REMEMBERED", 5)
    model, rng = Merges(PATH), random.Random(5)
    for _ in range(4):
        texts = [cases.words(rng, 30) for _ in range(3)]
        assert model.encode(texts) == model.library.encode(texts)
        assert len(model.known) < 200 and len(model.parts) < 200


def test_a_difference_is_told():
    model = Merges(PATH)
    model.pair_keys[:-1] = -1  # no merge is known any more
    assert model.encode(["on the mat"]) != model.library.encode(["on the mat"])
    assert not model.agrees("on the mat") and model.agrees("")


def test_rows(spark):
    rows = cases.rows()
    got = encode_texts(cases.docs(spark), PATH).collect()
    assert len(got) == len(rows)
    library = merges(PATH).library
    text = {r[0]: r[1] or "" for r in rows}
    for r in got:
        assert r["ids"] == library.encode(text[r["doc_id"]]) and r["decoded"] == library.decode(r["ids"]) and r["agrees"]
    assert encode_texts(cases.empty(spark), PATH).count() == 0


def test_given_documents(spark, monkeypatch):
    from txspark.llm import pieces

    monkeypatch.setattr(pieces, "SLICE_CHARS", 5000)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    library = merges(PATH).library
    text = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    got = encode_texts(docs, PATH).collect()
    assert {r["doc_id"] for r in got} == set(text) and len(got) == len(text)
    assert all(r["ids"] == library.encode(text[r["doc_id"]]) for r in got)


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(open(PATH, "rb").read())
    model.trainer_spec.model_type = model.trainer_spec.UNIGRAM
    (tmp_path / "m.model").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError, match="no merge-type model"):
        Merges(str(tmp_path / "m.model"))
