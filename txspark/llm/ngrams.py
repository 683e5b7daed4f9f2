"""Scores of whole texts under an n-gram model that is trained on the corpus itself."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txspark.llm.elias_fano import NgramTrie
from txspark.llm.staging import Scratch
from txspark.llm.words import Words, mix, word_hashes

#: Characters of text that one batch holds, near enough; one text is never cut.
BATCH_CHARS = 16_000_000
#: Tokens that one shard of the model answers for, near enough.
SHARD_TOKENS = 3_000_000
#: The successors of a context with more than a shard's share of the training tokens, and more than this share, are dealt over all shards.
LEAST_HOT = 1e-5
#: Bytes of a word's hash that tell the successors of a context apart: n of them expect n * n / 2 ** 49 collisions.
APART = 6
#: Weight of the lower order in a context, in tokens (Dirichlet smoothing, D. MacKay and L. Peto, 1995).
PRIOR = 20.0
LOW = np.uint64(0xFFFFFFFF)
END, START = np.uint64(0x9AE16A3B2F90404F), np.uint64(0xC949D7C7509E6557)
#: Codes of 16 bits for log10 of a probability from 10 ** -LOWEST to 1: the error is under 0.0001.
LOWEST = 13.0
Z = 3


def _squeeze(a: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(a).tobytes(), Z)


def _open(b: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(b), kind)


def quantise_log(p: np.ndarray) -> np.ndarray:
    return np.rint((np.clip(np.log10(p), -LOWEST, 0) + LOWEST) * (65535 / LOWEST)).astype(np.uint16)


def dequantise_log(code: np.ndarray) -> np.ndarray:
    return 10.0 ** (code.astype(np.float64) * (LOWEST / 65535) - LOWEST)


def _pack_codes(codes: np.ndarray) -> bytes:
    """Codes of words by falling frequency, the low bytes of all, then the higher ones."""
    return _squeeze(np.ascontiguousarray(codes.astype("<u4").view(np.uint8).reshape(-1, 4).T))


def _open_codes(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(_open(b, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _batch(number: int, doc_ids: list[int], train: list[bool], words: Words) -> pd.DataFrame:
    lengths = np.array(words.lengths, np.int64)
    # the end of each text is a token too
    codes = np.insert(words.codes(), np.cumsum(lengths), len(words.seen))
    often = np.bincount(codes, minlength=len(words.seen) + 1)
    order = np.argsort(-often, kind="stable")
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order))
    codes = rank[codes]
    hashes = np.append(word_hashes(list(words.seen)), END)[order]
    train = np.array(train, bool)
    counts = np.bincount(codes[np.repeat(train, lengths + 1)], minlength=len(hashes))
    return pd.DataFrame(
        {
            "batch": [number],
            "doc_ids": [np.array(doc_ids, np.int64).tobytes()],
            "train": [train.tobytes()],
            "lengths": [_squeeze(lengths + 1)],
            "codes": [_pack_codes(codes)],
            "lows": [(hashes & LOW).astype("<u4").tobytes()],
            "highs": [(hashes >> np.uint64(32)).astype("<u4").tobytes()],
            "counts": [_squeeze(counts.astype(np.int32))],
            "tokens": [len(codes)],
            "train_tokens": [int(counts.sum())],
            "train_docs": [int(train.sum())],
        }
    )


def _batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Texts as batches of token codes: one row for each, with the two halves of the hashes of its words."""
    number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
    doc_ids, train, words, size = [], [], Words(), 0
    for frame in frames:
        for doc_id, text, learn in zip(frame["doc_id"], frame["text"], frame["train"], strict=True):
            doc_ids.append(doc_id)
            train.append(learn)
            words.add(text)
            size += len(text) if text else 0
            if size >= BATCH_CHARS:
                yield _batch(number, doc_ids, train, words)
                number += 1
                doc_ids, train, words, size = [], [], Words(), 0
    if doc_ids:
        yield _batch(number, doc_ids, train, words)


BATCH = "batch long, doc_ids binary, train binary, lengths binary, codes binary, lows binary, highs binary, counts binary, tokens long, train_tokens long, train_docs long"


def _runs(place: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each shard that occurs, and the places where it does, in order."""
    order = np.argsort(place, kind="stable")
    shards, starts = np.unique(place[order], return_index=True)
    return zip(shards.tolist(), np.split(order, starts[1:]), strict=True)


def _hashes(low: bytes, high: bytes) -> np.ndarray:
    return np.frombuffer(low, "<u4").astype(np.uint64) | (np.frombuffer(high, "<u4").astype(np.uint64) << np.uint64(32))


def _words_to_shards(shards: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for batch, low, high, c in zip(frame["batch"], frame["lows"], frame["highs"], frame["counts"], strict=True):
                h, c = _hashes(low, high), _open(c, np.int32)
                rows = [(s, batch, h[own].tobytes(), _squeeze(c[own])) for s, own in _runs((h & LOW) % np.uint64(shards))]
                yield pd.DataFrame(rows, columns=["shard", "batch", "hashes", "counts"])

    return run


def _count_words(hot_count: float):
    """Add up the counts of a shard's words and answer each batch. In one row, ``known`` is the number of words seen in training, ``hot`` the
    hashes and counts of those beyond ``hot_count``."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        hashes = [np.frombuffer(h, np.uint64) for h in rows["hashes"]]
        words, back = np.unique(np.concatenate(hashes), return_inverse=True)
        total = np.bincount(back, np.concatenate([_open(c, np.int32) for c in rows["counts"]]), len(words)).astype(np.int64)
        ends = np.cumsum([len(h) for h in hashes])[:-1]
        answers = [_squeeze(total[b]) for b in np.split(back, ends)]
        known, hot = np.zeros(len(rows), np.int64), [b""] * len(rows)
        known[0], over = (total > 0).sum(), total > hot_count
        hot[0] = np.stack([words[over], total[over].astype(np.uint64)]).tobytes()
        return pd.DataFrame({"batch": rows["batch"], "shard": key[0], "kind": "words", "answer": answers, "known": known, "hot": hot})

    return run


ANSWER = "batch long, shard long, kind string, answer binary, known long, hot binary"


def _pairs(codes: np.ndarray, lengths: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (context, word) in order, and the pair of each token. The context of a text's first word is the start, whose code is ``words``."""
    key = np.concatenate(([words], codes[:-1])) if len(codes) else codes.copy()
    key[np.cumsum(lengths) - lengths] = words
    key *= words + 1
    key += codes
    key, pair = np.unique(key, return_inverse=True)
    return *np.divmod(key, words + 1), pair


def _places(context: np.ndarray, word: np.ndarray, lows: np.ndarray, hot: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each pair, from the low halves of the hashes. All successors of a context share a shard; those of a hot one are dealt over all."""
    low = np.append(lows.astype(np.uint64), START & LOW)
    return mix(low[context] ^ np.where(hot[context], mix(low[word] + np.uint64(1)), np.uint64(0))) % np.uint64(shards)


def _pairs_to_shards(shards: int, hot_hashes: np.ndarray):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for batch, train, lengths, codes, low, high in zip(*(frame[c] for c in ("batch", "train", "lengths", "codes", "lows", "highs")), strict=True):
                lengths = _open(lengths, np.int64)
                hashes = np.append(_hashes(low, high), START)
                context, word, pair = _pairs(_open_codes(codes), lengths, len(hashes) - 1)
                here = np.bincount(pair[np.repeat(np.frombuffer(train, bool), lengths)], minlength=len(context))
                del pair
                place = _places(context, word, np.frombuffer(low, "<u4"), np.isin(hashes, hot_hashes), shards)
                for s, at in _runs(place):
                    heads, runs = np.unique(context[at], return_counts=True)
                    after = np.ascontiguousarray((hashes[word[at]] >> np.uint64(64 - 8 * APART)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :APART])
                    yield pd.DataFrame({"shard": [s], "batch": [batch], "heads": [hashes[heads].tobytes()], "runs": [_squeeze(runs.astype(np.int32))], "words": [after.tobytes()], "counts": [_squeeze(here[at].astype(np.int32))]})

    return run


PAIRS = "shard long, batch long, heads binary, runs binary, words binary, counts binary"


def _answer_pairs(prior: float, hot_hashes: np.ndarray, hot_counts: np.ndarray):
    """Build the trie of a shard from the pairs seen in training, map it, and answer the pairs of every batch with codes; 0: not there.

    The count of a context is the sum over its successors, but for hot ones, whose counts are given.
    """

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        heads, words, counts, sizes = [], [], [], []
        for h, r, w, c in zip(rows["heads"], rows["runs"], rows["words"], rows["counts"], strict=True):
            heads.append(np.repeat(np.frombuffer(h, np.uint64), _open(r, np.int32)))
            wide = np.zeros((len(heads[-1]), 8), np.uint8)
            wide[:, :APART] = np.frombuffer(w, np.uint8).reshape(-1, APART)
            words.append(wide.view("<u8").ravel())
            counts.append(_open(c, np.int32))
            sizes.append(len(wide))
        batch = rows["batch"].to_numpy()
        del rows
        head, word, count = (np.concatenate(x) for x in (heads, words, counts))
        del heads, words, counts
        seen = np.flatnonzero(count)
        order = seen[np.lexsort((word[seen], head[seen]))]
        new_head = np.concatenate(([True], head[order][1:] != head[order][:-1])) if len(order) else np.zeros(0, bool)
        new = new_head | np.concatenate(([True], word[order][1:] != word[order][:-1])) if len(order) else new_head
        starts = np.flatnonzero(new)
        first = order[starts]
        sums = np.add.reduceat(count[order].astype(np.int64), starts) if len(starts) else np.zeros(0, np.int64)
        node = np.cumsum(new_head[starts]) - 1
        totals = np.bincount(node, sums)
        own = head[first][new_head[starts]]
        if len(hot_hashes) and len(own):
            at = np.minimum(np.searchsorted(hot_hashes, own), len(hot_hashes) - 1)
            totals = np.where(hot_hashes[at] == own, hot_counts[at], totals)
        values = np.maximum(quantise_log(sums / (totals[node] + prior)), 1) if len(node) else np.zeros(0, np.uint16)
        with tempfile.TemporaryFile() as file:  # of this task alone; a task that is run again builds it again
            NgramTrie.build([head[first], word[first]], values).write(file)
            trie = NgramTrie.open(file)
            code = np.zeros(len(head), np.uint16)
            for part in range(0, len(head), 1 << 19):
                k = slice(part, part + (1 << 19))
                at = trie.find([head[k], word[k]])
                code[k] = np.where(at >= 0, trie.values[np.maximum(at, 0)] if len(trie.values) else 0, 0)
            del trie
        answers = [_squeeze(x) for x in np.split(code, np.cumsum(sizes)[:-1])]
        return pd.DataFrame({"batch": batch, "shard": key[0], "kind": "pairs", "answer": answers, "known": 0, "hot": None})

    return run


def _score(shards: int, train_tokens: int, known: int, train_docs: int, hot_count: float, prior: float):
    def run(key: tuple, batch: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        row = batch.iloc[0]
        got = {(k, s): a for k, s, a in zip(answers["kind"], answers["shard"], answers["answer"], strict=True)}
        lengths, codes, lows = _open(row["lengths"], np.int64), _open_codes(row["codes"]), np.frombuffer(row["lows"], "<u4")
        counts = np.zeros(len(lows) + 1, np.int64)
        for s, own in _runs(lows.astype(np.uint64) % np.uint64(shards)):
            counts[own] = _open(got["words", s], np.int64)
        counts[-1] = train_docs
        context, word, pair = _pairs(codes, lengths, len(lows))
        upper = np.zeros(len(context))
        for s, own in _runs(_places(context, word, lows, counts > hot_count, shards)):
            code = _open(got["pairs", s], np.uint16)
            upper[own] = np.where(code > 0, dequantise_log(code), 0.0)
        one = (counts[:-1] + 1) / (train_tokens + known + 1)
        token = np.log10(upper + (prior / (counts[context] + prior)) * one[word])[pair]
        starts = np.cumsum(lengths) - lengths
        add = lambda x: np.add.reduceat(x, starts)
        train = np.frombuffer(row["train"], bool)
        return pd.DataFrame(
            {
                "doc_id": np.frombuffer(row["doc_ids"], np.int64),
                "held_out": ~train,
                "n_tokens": lengths,
                "n_known": add((counts[codes] > 0).astype(np.int64)),
                "train_tokens": train_tokens,
                "base_score": add(np.log10(one)[codes]),
                "score": add(token),
            }
        )

    return run


RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_texts(docs: DataFrame, prior: float = PRIOR) -> DataFrame:
    """Score every whole text of ``docs(doc_id, text, train)`` with a model of the words of all rows with ``train``.

    Words are lower-cased (A-Z) and split at white space; the end of a text is a token. The model is a trie of two levels, contexts
    and successors: p(w | v) = c(v w) / (c(v) + prior) + prior / (c(v) + prior) * p(w), with p(w) = (c(w) + 1) / (N + V + 1), which
    adds up to one over the V known words and one unknown. The first term is stored quantised.

    Texts become batches of token codes. Each batch sends its distinct words, then its distinct pairs, to shards that
    are numbered by hash; a shard adds up the training counts, builds the trie of its pairs as Elias-Fano levels in a mapped file, and
    answers. A word or pair travels once a batch, however frequent, and the codes themselves once. A message holds all that a batch asks of a
    shard. Batches and shards have about the same size whatever the input; a context whose successors would fill a shard is dealt over all.

    Null or empty text is its end token alone; repeated rows count and are scored each; null ``train`` means false; without training
    rows every count is 0; an empty table gives no rows. Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.
    """
    scratch = Scratch(docs.sparkSession, "ngrams")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce("train", F.lit(False)).alias("train"))
    batches = scratch.put(rows.mapInPandas(_batches, BATCH), "batches")
    total = batches.agg(*[F.sum(c).alias(c) for c in ("tokens", "train_tokens", "train_docs")]).first()
    tokens, train_tokens, train_docs = (total[c] or 0 for c in ("tokens", "train_tokens", "train_docs"))
    shards = max(1, -(-tokens // SHARD_TOKENS))
    hot_count = train_tokens * max(1 / shards, LEAST_HOT)

    asked = batches.select("batch", "lows", "highs", "counts").mapInPandas(_words_to_shards(shards), "shard long, batch long, hashes binary, counts binary")
    words = scratch.put(asked.groupBy("shard").applyInPandas(_count_words(hot_count), ANSWER), "words")
    known = words.agg(F.sum("known")).first()[0] or 0
    # under 1 / LEAST_HOT words have more than that share of the tokens
    hot = [np.frombuffer(r["hot"], np.uint64).reshape(2, -1) for r in words.where(F.length("hot") > 0).select("hot").collect()]
    hot = np.concatenate([*hot, np.array([[START], [train_docs]] if train_docs > hot_count else np.zeros((2, 0)), np.uint64)], axis=1)
    hot_hashes, hot_counts = hot[:, np.argsort(hot[0])]

    asked = batches.select("batch", "train", "lengths", "codes", "lows", "highs").mapInPandas(_pairs_to_shards(shards, hot_hashes), PAIRS)
    answers = scratch.put(asked.groupBy("shard").applyInPandas(_answer_pairs(prior, hot_hashes, hot_counts), ANSWER), "pairs")
    del asked
    scratch.free_shuffles()
    both = words.unionByName(answers).select("batch", "shard", "kind", "answer")
    parts = batches.select("batch", "doc_ids", "train", "lengths", "codes", "lows")
    return parts.groupBy("batch").cogroup(both.groupBy("batch")).applyInPandas(_score(shards, train_tokens, known, train_docs, hot_count, prior), RESULT)
