"""Secret scans, sharding and quality rules against brute force."""

import hashlib
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm import cases
from txspark.llm.quality import METRICS, RULES, judge_quality, quantile_fences
from txspark.llm.secrets import KINDS, redact, scan_secrets, span_string, window_entropy
from txspark.llm.sharding import hilbert_index, shard_documents

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if m.end() - m.start() >= 32]
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(out))


def test_secret_spans(spark):
    got = scan_secrets(cases.docs(spark)).select("doc_id", "text", span_string(F.filter("secret_spans", lambda s: s["kind"] < 3)).alias("base"), span_string("secret_spans").alias("all")).collect()
    assert len(got) == len(cases.rows())
    for r in got:
        assert r["base"] == base_spans(r["text"]), r["doc_id"]
        assert set(filter(None, r["base"].split(","))) <= set(r["all"].split(","))
    found = {r["doc_id"]: r["all"] for r in got}
    assert "entropy:0:20" in found[16]
    assert not found[17] and not found[4] and not found[23]
    assert scan_secrets(cases.empty(spark)).count() == 0


def test_many_matches(spark):
    text = " ".join(f"token={i:08d}" for i in range(2000))
    got = scan_secrets(spark.createDataFrame([(1, text)], "doc_id long, text string")).select(span_string("secret_spans")).first()[0]
    assert got == base_spans(text)


def test_window_entropy(spark):
    from math import log2

    values = ["abcdefghijklmnopqrst", "aaaaaaaaaaaaaaaaaaaaaaaab", "04dbebab91ab85687d33eeaaf9ac699e1188f962", "short", "Zq9/x8W7v6U5t4S3r2Q1+==" * 9]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    for v, h in df.select("v", window_entropy(F.col("v"))).collect():
        want = max((-sum(c / 20 * log2(c / 20) for c in Counter(v[i : i + 20]).values()) for i in range(len(v) - 19)), default=-1)
        assert h == pytest.approx(want, abs=1e-9)


def test_redact(spark):
    got = {r["doc_id"]: r for r in redact(cases.docs(spark)).collect()}
    assert got[13]["text"] == 'x [SECRET]" y' and got[13]["n_chars"] == len(got[13]["text"])
    assert got[0]["text"] == cases.rows()[0][1] and got[5]["text"] is None
    assert redact(cases.docs(spark)).columns == cases.docs(spark).columns
    own = redact(cases.docs(spark).withColumns({"_spans": F.lit(7), "spans": F.lit(8), "row": F.lit(9)})).select("_spans", "spans", "row").distinct().collect()
    assert [tuple(r) for r in own] == [(7, 8, 9)]


def test_allowed_words(spark):
    words = ["Donaudampfschifffahrtsgesellschaft", "Users/JohnSmith/Documents/HTMLParser", "state-of-the-art_and_more-words", "a-b-c-d-e-f-g-h-i-j-k-l-m", "=" * 40, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]
    keys = ["qVtbXkZrLpWyHsNcGdJmTf==", "xK/vQzRtWpLmYbNcHsGdJfTe", "sQ" + "aVtbXkZrLpWyHsNcGdJmTf" * 20000]
    df = spark.createDataFrame(list(enumerate(words + keys)), "doc_id long, text string")
    got = {r[0]: r[1] for r in scan_secrets(df).select("doc_id", span_string("secret_spans")).collect()}
    assert [k for k in sorted(got) if got[k]] == [len(words) + i for i in range(len(keys))]


def test_hilbert_steps(spark):
    side = 8
    df = spark.range(side**3).select((F.col("id") % side).alias("x"), (F.col("id") / side % side).cast("int").alias("y"), (F.col("id") / side**2).cast("int").alias("z"))
    points = df.select("x", "y", "z", hilbert_index([F.col("x"), F.col("y"), F.col("z")], 3).alias("h")).orderBy("h").collect()
    assert [p["h"] for p in points] == list(range(side**3))
    assert all(abs(a.x - b.x) + abs(a.y - b.y) + abs(a.z - b.z) == 1 for a, b in zip(points, points[1:]))


@pytest.mark.parametrize("shards", [8, 5, 40])
def test_shards(spark, shards):
    got = shard_documents(cases.docs(spark), shards).collect()
    want = cases.rows()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in want)
    counts = Counter(r["shard"] for r in got)
    sizes = [counts[s] for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(want)
    for s in range(shards):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sizes[s]))
    text = {r[0]: (r[1] or "").encode() for r in want}
    assert all(r["size"] == len(text[r["doc_id"]]) + 1 and r["text_crc32"] == zlib.crc32(text[r["doc_id"]]) for r in got)
    by_place = sorted(got, key=lambda r: (r["shard"], r["slot"]))
    assert [r["curve"] for r in by_place] == sorted(r["curve"] for r in got)
    assert shard_documents(cases.empty(spark)).count() == 0


def test_shards_can_be_skipped(spark):
    """A reader that knows the least and largest value of each shard leaves most of them out, by any of the three columns."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "lang", "source", F.octet_length("text").alias("n_bytes"), "text")
    got = shard_documents(docs, 64).select("doc_id", "shard").join(docs.na.fill(""), "doc_id").toPandas()

    def read(column, buckets):
        ranges = got.groupby("shard")[column].agg(["min", "max"])
        return sum(((ranges["min"] <= v) & (v <= ranges["max"])).mean() for v in buckets) / len(buckets)

    langs, sources = sorted(set(got["lang"])), sorted(set(got["source"]))
    assert read("lang", langs) < 0.45 and read("source", sources) < 0.5 and read("n_bytes", got["n_bytes"].quantile([0.1, 0.5, 0.9, 0.99]).tolist()) < 0.5
    mixed = got.assign(shard=got["doc_id"] % 64)
    assert all(((mixed.groupby("shard")["lang"].agg(["min", "max"])["min"] <= v)).all() for v in langs[1:])


def counts_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if many[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_quality(spark):
    got = judge_quality(cases.docs(spark)).collect()
    text = {r[0]: r[1] for r in cases.rows()}
    assert len(got) == len(cases.rows())
    for r in got:
        n, *rest = counts_of(text[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, *rest), r["doc_id"]
        assert r["base_failed"] == (n < 50 or 100 * rest[-1] > 50 * n)
        assert not (r["kept"] and r["base_failed"])
    kept = {r["doc_id"] for r in got if r["kept"]}
    assert {0, 1, 2, 4, 19, 20} <= kept and not {5, 6, 18, 22} & kept
    assert judge_quality(cases.empty(spark)).count() == 0


def test_quality_fences_follow_groups(spark):
    """One source writes with many symbols throughout: they are ordinary there and odd elsewhere."""
    words = [f"w{k}" for k in range(120)]
    texts = lambda marks: " ".join(w + "#" * (i < marks) for i, w in enumerate(words))
    rows = [(i, texts(80 + i % 5), "en", "code") for i in range(300)] + [(1000 + i, texts(i % 3), "en", "prose") for i in range(300)] + [(5000, texts(80), "en", "prose")]
    got = {r["doc_id"]: r["kept"] for r in judge_quality(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not got.pop(5000) and all(got.values())


def test_junk_does_not_move_the_fences(spark):
    """A source of which a third is junk keeps its ordinary documents and loses the junk."""
    words = [f"w{k}" for k in range(120)]
    text = lambda marks, i: " ".join(w + "#" * (k < marks) for k, w in enumerate(words[i % 20 :]))
    rows = [(i, text(60 if i % 3 == 0 else i % 4, i), "en", "mixed") for i in range(1000)] + [(2000 + i, text(i % 4, i), "en", f"other{i % 9}") for i in range(300)]
    got = {r["doc_id"]: r["kept"] for r in judge_quality(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(kept == (i >= 2000 or i % 3 > 0) for i, kept in got.items())


def test_a_source_of_its_own_kind_is_no_junk(spark):
    """A small source that writes otherwise than its large language follows itself, whatever the valley of the language."""
    words = [f"w{k}" for k in range(120)]
    text = lambda marks, i: " ".join(w + "#" * (k < marks) for k, w in enumerate(words[i % 20 :]))
    rows = [(i, text(70 + i % 5, i), "en", "code") for i in range(60)] + [(1000 + i, text(i % 3, i), "en", "prose") for i in range(1200)] + [(5000 + i, text(70, i), "en", "prose") for i in range(40)]
    got = {r["doc_id"]: r["kept"] for r in judge_quality(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(kept == (i < 5000) for i, kept in got.items())


def test_fences_are_no_fixed_cutoffs(spark):
    """In the given tables the fences of each metric differ between groups, and a value that one group allows is refused in another."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    judged = judge_quality(docs).join(docs.select("doc_id", "lang", "source").na.fill(""), "doc_id").where("NOT base_failed").cache()
    fences = quantile_fences(judged).collect()
    for rule in RULES:
        assert len({f[f"fence_{rule}"] for f in fences}) > 1, rule
    rows = judged.collect()
    kept, gone = [r for r in rows if r["kept"]], [r for r in rows if not r["kept"]]
    assert gone and max(r["mean_word"] for r in kept) > min(r["mean_word"] for r in gone)
    # no single set of upper cutoffs gives the same verdicts
    most = {m: max(r[m] for r in kept) for m in METRICS}
    assert any(all(r[m] <= most[m] for m in METRICS) for r in gone)
