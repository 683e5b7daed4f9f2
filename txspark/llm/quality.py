"""Quality rules with thresholds that follow from quantile sketches of each language and source (native)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txspark.llm.staging import Scratch, few_rows

LEAST_WORDS = 50
MOST_REPEATED = 0.5
#: Rule: the metric, the scale on which it is sketched and the width of a bucket there. On the arcsine scale shares of the same
#: number of words scatter alike whatever their size, and lengths do so on the logarithmic one; ``short`` runs downwards.
RULES = {
    "symbol_ratio": ("symbol_ratio", "share", 0.0125),
    "dup_lines": ("dup_lines_per_word", "share", 0.0125),
    "repeat_ratio": ("repeat_ratio", "share", 0.0125),
    "long_words": ("mean_word", "long", 0.01),
    "short_words": ("mean_word", "short", 0.01),
}
METRICS = ("symbol_ratio", "dup_line_ratio", "dup_lines_per_word", "repeat_ratio", "mean_word")
#: A group is sketched with this many more documents like its language, and a language with as many like the whole table.
PRIOR_DOCS = 20
#: Valleys are looked for in sums of a bucket and this many on each side, so that a mode needs few documents and its edges stay sharp.
BESIDE = 4
#: A bucket lies in a valley if a later sum is at least twice its own, and higher by this many standard deviations of their difference.
CERTAIN = 3.0
#: Without a valley, this many documents in a thousand of a group may lie beyond its fence.
TAIL = 5


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeated(words: Column) -> Column:
    """Words covered by windows of three words that occur at least twice; windows are told apart by a 64-bit hash."""

    def count(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(p: Column) -> Column:
            twice = F.filter(p, lambda x, k: (F.get(p, F.when(k > 0, k - 1))["h"] == x["h"]) | (F.get(p, k + 1)["h"] == x["h"]))
            return F.array_sort(F.transform(twice, lambda x: x["i"]))

        def covered(at: Column) -> Column:
            return F.aggregate(F.transform(at, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1), x + 3) - x)), F.lit(0), lambda a, v: a + v)

        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(_let(_let(pairs, places), covered))

    windows = F.slice(F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))), F.lit(1), F.greatest(F.size(words) - 2, F.lit(0)))
    return _let(windows, count)


def text_metrics(docs: DataFrame) -> DataFrame:
    """Counts of each whole text: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines (with a word).

    Null text counts as empty: all zero. Rows and other columns stay; columns of those names are replaced.
    """
    text = F.coalesce("text", F.lit(""))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counts = _let(
        words,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("word_chars"),
            _repeated(w).cast("long").alias("n_repeat_words"),
        ),
    )
    line_counts = _let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    symbols = (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long")
    kept = [c for c in docs.columns if c not in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")]
    found = docs.select(F.struct(*kept).alias("row"), counts.alias("w"), line_counts.alias("l"), symbols.alias("n_symbols"))
    return found.select(*[F.col("row")[c].alias(c) for c in kept], "w.n_words", "w.word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words", "l.n_lines")


def place_on_scale(rule: str) -> Column:
    """The place of a row's metric on the scale of a rule, in buckets; a whole number is the lower edge of a bucket."""
    metric, scale, step = RULES[rule]
    if scale == "share":
        return F.asin(F.sqrt(F.least(F.col(metric), F.lit(1.0)))) / F.lit(step)
    return F.log(F.greatest(F.col(metric), F.lit(1e-9))) / F.lit(step if scale == "long" else -step)


def _smoothed(own: DataFrame, wider: DataFrame, keys: list[str], on: list[str]) -> DataFrame:
    """Sketches of ``keys`` with those of the wider groups added, weighed down to PRIOR_DOCS documents; n counts thousandths of documents.

    A wider sketch has a row for each bucket of the whole table's range, empty ones included, and so have those that this returns.
    """
    total = wider.groupBy(*on).agg(F.sum("n").alias("total"))
    most = F.least(F.lit(1000 * PRIOR_DOCS).cast("long"), F.col("total"))
    light = wider.join(few_rows(total), on).withColumn("most", most).select(*on, "bucket", F.expr("n * most div total").alias("n"))
    prior = own.select(*keys).distinct().join(few_rows(light), on).select(*keys, "bucket", "n")
    return own.select(*keys, "bucket", (1000 * F.col("n")).alias("n")).unionByName(prior).groupBy(*keys, "bucket").agg(F.sum("n").alias("n"))


def _shapes(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """A row for each sketch: ``middle``, the bucket of the median; ``dip``, the first bucket of the first valley above it; ``valley``, the
    middle of that valley, both null if there is none; ``tail``, the upper edge of the bucket with the quantile at 1 - TAIL / 1000."""
    whole = Window.partitionBy(*keys)
    upwards = whole.orderBy("bucket")
    near = F.sum("n").over(upwards.rowsBetween(-BESIDE, BESIDE))
    seen = sketch.withColumns({"upto": F.sum("n").over(upwards), "total": F.sum("n").over(whole), "near": near})
    seen = seen.withColumn("later", F.coalesce(F.max("near").over(upwards.rowsBetween(1, Window.unboundedFollowing)), F.lit(0)))
    gain = (F.col("later") - F.col("near")).cast("double")
    low = (F.col("later") > 2 * F.col("near")) & (gain * gain > F.lit(1000.0 * CERTAIN * CERTAIN) * (F.col("later") + F.col("near")))
    seen = seen.withColumns({"low": low, "middle": F.min(F.when(2 * F.col("upto") >= F.col("total"), F.col("bucket"))).over(whole)})
    seen = seen.withColumn("dip", F.min(F.when(F.col("low") & (F.col("bucket") > F.col("middle")), F.col("bucket"))).over(whole))
    end = F.min(F.when((F.col("bucket") > F.col("dip")) & ~F.col("low"), F.col("bucket")))
    tail = F.min(F.when(1000 * F.col("upto") >= (1000 - TAIL) * F.col("total"), F.col("bucket"))) + 1
    return seen.groupBy(*keys).agg(F.max("middle").alias("middle"), F.max("dip").alias("dip"), ((F.max("dip") + end) / 2).alias("valley"), tail.alias("tail"))


def quantile_fences(rows: DataFrame) -> DataFrame:
    """``lang``, ``source`` and fence_<rule> for each of RULES, a place on its scale: a row for each group.

    ``rows`` has lang, source and METRICS. A histogram with equal buckets on the scale of a rule is a mergeable sketch of quantiles, exact to a
    bucket: counts add up, first in the tasks, then over groups, so that the sketch of a language is the sum of those of its sources.

    Junk is a second mode above that of the ordinary documents, so the fence is put in the middle of the first valley above the median. Median and
    valley stay where they are whatever the share of junk, as long as it is under half. A group whose own sketch shows no certain valley, as it is
    small or has little junk, takes that of its language, or of the table, if its own median lies below it; a source that writes otherwise than its
    language throughout thus follows itself alone. Where no valley applies, an upper quantile of the group is the fence. No metric has a fixed cutoff or floor.
    """
    scratch = Scratch(rows.sparkSession, "fences")
    places = F.array(*[F.struct(F.lit(r).alias("rule"), F.floor(place_on_scale(r)).cast("int").alias("bucket")) for r in RULES])
    long = rows.select("lang", "source", F.explode(places).alias("x")).select("lang", "source", "x.*")
    own = scratch.put(long.groupBy("lang", "source", "rule", "bucket").agg(F.count("*").alias("n")), "sketches")
    spread = own.groupBy("rule").agg(F.min("bucket").alias("a"), F.max("bucket").alias("b"))
    every = spread.select("rule", F.explode(F.sequence("a", "b")).alias("bucket"), F.lit(0).cast("long").alias("n"))
    table = own.select("rule", "bucket", (1000 * F.col("n")).alias("n")).unionByName(every).groupBy("rule", "bucket").agg(F.sum("n").alias("n"))
    table = scratch.put(table, "table")
    languages = scratch.put(_smoothed(own, table, ["lang", "rule"], ["rule"]), "languages")
    groups = _shapes(_smoothed(own, languages, ["lang", "source", "rule"], ["lang", "rule"]), ["lang", "source", "rule"])
    wider = lambda df, keys, name: scratch.put(_shapes(df, keys).select(*keys, F.col("dip").alias(f"{name}_dip"), F.col("valley").alias(f"{name}_valley")), f"{name}_shapes")
    shaped = groups.join(few_rows(wider(languages, ["lang", "rule"], "lang")), ["lang", "rule"]).join(few_rows(wider(table, ["rule"], "table")), "rule")
    above = lambda name: F.when(F.col(f"{name}_dip") > F.col("middle"), F.col(f"{name}_valley"))
    fence = F.coalesce("valley", above("lang"), above("table"), F.col("tail").cast("double"))
    return shaped.groupBy("lang", "source").agg(*[F.max(F.when(F.col("rule") == r, fence)).alias(f"fence_{r}") for r in RULES])


def judge_quality(docs: DataFrame) -> DataFrame:
    """Counts of each document, the fixed base rule, and the verdict of the adaptive rules.

    A document is kept if the base rule passes and no metric lies beyond a fence of its language and source. Only documents that pass
    the base rule shape the fences. Null language or source is a group of its own; null text fails the base rule; repeated rows are judged each; an
    empty table gives none; columns of the documents other than doc_id, text, lang and source are ignored.
    """
    key = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    per = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    counted = text_metrics(docs.select("doc_id", "text", key("lang"), key("source"))).drop("text")
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    ratios = {"symbol_ratio": per("n_symbols", "word_chars"), "dup_line_ratio": per("n_dup_lines", "n_lines"), "dup_lines_per_word": per("n_dup_lines", "n_words"), "repeat_ratio": per("n_repeat_words", "n_words"), "mean_word": per("word_chars", "n_words")}
    scratch = Scratch(docs.sparkSession, "quality")
    rows = scratch.put(counted.withColumns(ratios | {"base_failed": failed}), "counts")
    fences = scratch.put(quantile_fences(rows.where(~F.col("base_failed"))), "fences")
    # a row for each language and source; a document without one failed the base rule
    joined = rows.join(few_rows(fences), ["lang", "source"], "left")
    within = F.lit(True)
    for r in RULES:
        within = within & F.coalesce(place_on_scale(r) <= F.col(f"fence_{r}"), F.lit(False))
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & within).alias("kept"), *METRICS)
