"""Source divergence against brute force in plain Python."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import cases
from txspark.llm import divergence
from txspark.llm.divergence import audit_sources, count_terms, radix_order

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, least, top):
    counts, held, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source, own = lang or "", source or "", terms(text)
        groups[lang].add(source)
        counts[lang, source].update(own)
        held[lang].update(set(own))
    out = set()
    for lang, sources in groups.items():
        kept = {t for t, n in held[lang].items() if n >= least}
        v = len(kept)
        whole = Counter()
        for s in sources:
            whole.update(counts[lang, s])

        def share(c, t, kept=kept, v=v):
            return 1 + 10**9 * (c[t] + 5) // (sum(c[k] for k in kept) + 5 * v)

        p = {s: {t: share(counts[lang, s], t) for t in kept} for s in sources}
        q = {t: share(whole, t) for t in kept}
        for s in sources:
            pairs = sorted(((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in sources - {s}))
            out |= {(lang, s, "pair", o, -x, i + 1) for i, (x, _, o) in enumerate(pairs)}
            over = sorted(((q[t] - p[s][t], t.encode(), t) for t in kept if counts[lang, s][t] > 0 and p[s][t] > q[t]))[:top]
            out |= {(lang, s, "term", t, -x, i + 1) for i, (x, _, t) in enumerate(over)}
    return out


def texts_of(seed, n=160):
    rng = random.Random(seed)
    vocabulary = ["a", "The", "straße", "eightlet", "ninechars", "sixteencharsword", "seventeencharterm", "x" * 40, "日本語" * 9, "Ünï", "q" * 300, *[f"t{chr(97 + i)}" for i in range(26)]]
    rows = []
    for _ in range(n):
        words = rng.choices(vocabulary, [1 / (k + 1) for k in range(len(vocabulary))], k=rng.randrange(30))
        rows.append((" ".join(w + rng.choice(["", ".", "1", "\x00"]) for w in words), rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "Ä", "", None, "s10"])))
    return rows


@pytest.mark.parametrize("tile, block, chars", [(256, 4096, 16_000_000), (2, 3, 300)])
def test_against_brute_force(spark, monkeypatch, tile, block, chars):
    for name, value in (("TILE", tile), ("BLOCK", block), ("SLICE_CHARS", chars)):
        monkeypatch.setattr(divergence, name, value)
    rows = texts_of(tile)
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(3)
    got = [tuple(r) for r in audit_sources(docs, least_docs=5, top_terms=7).collect()]
    want = brute(rows, 5, 7)
    assert len(got) == len(set(got)) and set(got) == want
    assert any(r[2] == "pair" for r in want) and any(len(r[3]) > 30 for r in want)


def test_tiles_without_sources(spark, monkeypatch):
    """Many tiles for few sources: some have none."""
    monkeypatch.setattr(divergence, "TILE", 1)
    rows = [(f"one two {'three ' * i}", "en", f"s{i}") for i in range(9)]
    got = {tuple(r) for r in audit_sources(spark.createDataFrame(rows, "text string, lang string, source string"), least_docs=1).collect()}
    assert got == brute(rows, 1, 50)


def test_awkward_rows(spark):
    rows = [(r[1], r[2], r[3]) for r in cases.rows()]
    got = {tuple(r) for r in audit_sources(cases.docs(spark), least_docs=2).collect()}
    assert got == brute(rows, 2, 50)
    # no term is in 30 documents here: all pairs are equal, in the order of their names
    got = {tuple(r) for r in audit_sources(cases.docs(spark)).collect()}
    assert got == brute(rows, 30, 50) and {r[4] for r in got if r[2] == "pair"} == {0}
    assert audit_sources(cases.empty(spark)).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2**64 - 1) | st.integers(0, 3), st.integers(0, 70000)), max_size=50))
def test_radix_order(rows):
    words = [np.array([r[k] for r in rows], np.uint64) for k in (0, 1)]
    assert radix_order(words).tolist() == sorted(range(len(rows)), key=lambda i: rows[i])


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.text("aBÜ z.\x00日", max_size=40)), max_size=12))
def test_count_terms(rows):
    rows = sorted(rows, key=lambda r: r[0])
    texts, groups = [t for _, t in rows], np.array([g for g, _ in rows], np.int64)
    got = Counter(), Counter()
    for own, term, n, docs in count_terms(texts, groups) if rows else ():
        for g, t, k, d in zip(own.tolist(), term, n.tolist(), docs.tolist(), strict=True):
            assert (g, t) not in got[0]
            got[0][g, t], got[1][g, t] = k, d
    want = Counter((g, t) for g, text in rows for t in terms(text)), Counter((g, t) for g, text in rows for t in set(terms(text)))
    assert got == want
