"""Collocations against brute force in plain Python."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest

from tests.llm import cases
from txspark.llm import phrases
from txspark.llm.phrases import build_filter, mine_phrases, phrase_counts
from txspark.llm.staging import Scratch


def grams(rows, order):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, min(order, len(words) - i) + 1):
                    counts[lang][tuple(words[i : i + k])] += 1
    return counts, totals


def brute(rows, order=5, least=100, top=2000):
    counts, totals = grams(rows, order)
    out = set()
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        gone = {q[i : i + k] for q, a in candidates.items() for k in range(2, len(q)) for i in range(len(q) - k + 1) if 100 * a >= 100 * f[q[i : i + k]]}
        found = []
        for p, a in candidates.items():
            if p not in gone:
                score, k = min((1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), " ".join(p), a, f[p[:k]], f[p[k:]], totals[lang], score))
        out |= {(lang, i + 1, *row[3:]) for i, row in enumerate(sorted(found)[:top])}
    return out


def texts_of(seed):
    rng, rows = random.Random(seed), []
    vocabulary = ["the", "Of", "in", "a", "b", "straße", "日本", "x\x85y", "zz"]
    fixed = ["as soon as possible then", "in the end of", "one,two of the", "new york city"]
    for _ in range(120):
        parts = [rng.choice(fixed) if rng.random() < 0.2 else rng.choice(vocabulary) for _ in range(rng.randrange(40))]
        rows.append((rng.choice([" ", "\t ", "  "]).join(parts) + rng.choice([".", "\n", ""]) + rng.choice(["", "rare" + str(rng.random())]), rng.choice(["en", "en", "de", None])))
    return rows


@pytest.mark.parametrize("bits, chars, order, top, pruned", [(1 << 26, 16_000_000, 5, 2000, 3), (64, 200, 4, 9, 1), (1 << 26, 3000, 2, 50, 5)])
def test_against_brute_force(spark, monkeypatch, bits, chars, order, top, pruned):
    """Also with filters so small that they let nearly all pass, with many slices, with few rows, and with more or fewer passes."""
    monkeypatch.setattr(phrases, "PRUNED", pruned)
    monkeypatch.setattr(phrases, "MOST_BITS", bits)
    monkeypatch.setattr(phrases, "SLICE_CHARS", chars)
    rows = texts_of(order)
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    got = [tuple(r) for r in mine_phrases(docs, order, 6, top).collect()]
    want = brute(rows, order, 6, top)
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 10


def test_rollup_gives_all_phrases(spark):
    rows = texts_of(11)
    counts, totals = phrase_counts(spark.createDataFrame([(t, g or "und") for t, g in rows], "text string, lang string"), Scratch(spark, "test"), 5, 4)
    want, n = grams(rows, 5)
    assert {(r["lang"], r["phrase"], r["f"], r["size"]) for r in counts.collect()} == {(g, " ".join(p), f, len(p)) for g, own in want.items() for p, f in own.items() if f >= 4}
    assert {r["lang"]: r["n"] for r in totals.collect()} == {g: k for g, k in n.items() if k}


def test_awkward_rows(spark):
    rows = [(r[1], r[2]) for r in cases.rows()]
    assert {tuple(r) for r in mine_phrases(cases.docs(spark), least=3).collect()} == brute(rows, 5, 3)
    assert mine_phrases(cases.empty(spark)).count() == 0


def test_filter_has_no_false_negatives(spark):
    keys = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 5000)
    made = build_filter(spark.createDataFrame([(int(k),) for k in keys], "key long"))
    assert made.holds(keys.view(np.uint64)).all()
    others = np.random.default_rng(2).integers(-(2**63), 2**63 - 1, 5000)
    assert made.holds(others.view(np.uint64)).mean() < 0.02
    assert not build_filter(spark.createDataFrame([], "key long")).holds(keys.view(np.uint64)).any()


def test_rows_of_windows_grow_no_faster_than_the_words(spark, tmp_path):
    """Runs of four times as many words, four times as frequent: with a fixed least count they would come to pass a filter by count all at once."""
    rng = random.Random(5)
    words = [f"w{k}" for k in range(30)]
    texts = [(" ".join(rng.choice(words) for _ in range(200)), "en") for _ in range(320)]
    made = {}
    for n in (80, 320):
        docs = spark.createDataFrame(texts[:n], "text string, lang string").coalesce(1)
        found = phrases._windows
        rows = []

        def counted(*args, found=found, rows=rows):
            out = found(*args)
            rows.append(out.count())
            return out

        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(phrases, "_windows", counted)
            patch.setattr(phrases, "SLICE_CHARS", 20_000)
            got = {(r["phrase"], r["f"]) for r in phrase_counts(docs, Scratch(spark, "test"), 3, 30)[0].collect()}
        want, _ = grams(texts[:n], 3)
        assert got == {(" ".join(p), f) for p, f in want["en"].items() if f >= 30}
        made[n] = rows[-1]
    assert made[80] > 0 and made[320] <= 5 * made[80]


@pytest.mark.parametrize("step", [1, 3, 1000])
def test_prefixes_across_frames(step):
    """Frames may end anywhere: within a phrase, and within all of its prefixes."""
    lexicon = phrases.Lexicon([("en", f"w{k}") for k in range(1 << 13)], 5)
    assert len(lexicon.packs) == 2
    rng = random.Random(step)
    windows = Counter(tuple(rng.choice([1, 2, 8192]) for _ in range(rng.randrange(2, 6))) for _ in range(500))
    pack = lambda w: [sum(x << lexicon.bits * (width - 1 - i) for i, x in enumerate((*w, 0, 0, 0, 0)[start : start + width])) for start, width in ((0, lexicon.widths[0]), (lexicon.widths[0], lexicon.widths[1]))]
    rows = sorted((*pack(w), n) for w, n in windows.items())
    frames = [pd.DataFrame(rows[i : i + step], columns=[*lexicon.packs, "n"]) for i in range(0, len(rows), step)]
    want = Counter()
    for w, n in windows.items():
        for k in range(2, len(w) + 1):
            want[" ".join(f"w{x - 1}" for x in w[:k])] += n
    got = [(r.phrase, r.f) for frame in phrases.prefix_counts(iter(frames), lexicon, 5) for r in frame.itertuples()]
    assert len(got) == len(set(got)) and dict(got) == {p: n for p, n in want.items() if n >= 5}
