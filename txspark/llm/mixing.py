"""Mixing of documents to target weights of domains that are known only as probabilities (native)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txspark.llm.staging import Scratch

#: The fit reads at most about this many labelled rows of a domain, those with the smallest hashes of doc_id.
ROWS_PER_DOMAIN = 4000
#: Words that tell a domain from the rest: at most this many for each domain, in LEAST_DOCS of its rows at least, LEAST_Z deviations from chance.
WORDS, LEAST_DOCS, LEAST_Z = 400, 8, 5.0
RARE = 0.05
ROUNDS, CLOSE = 40, 1e-5


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def word_hashes(text: Column) -> Column:
    """Hashes of the words of a text in lower case, and of marks that stand for its shape."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    symbols = F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))

    def with_shape(w: Column) -> Column:
        hashes = F.transform(w, lambda x: F.xxhash64(x))
        tenth = lambda a, b: F.floor(F.lit(10) * a / F.greatest(b, F.lit(1))).cast("string")
        shape = F.array(
            F.xxhash64(F.concat(F.lit(" marked "), tenth(symbols, F.size(w)))),
            F.xxhash64(F.concat(F.lit(" distinct "), F.when(F.size(w) >= 200, tenth(F.size(F.array_distinct(hashes)), F.size(w))).otherwise(""))),
        )
        return F.struct(F.size(w).cast("long").alias("n"), F.concat(hashes, F.when(F.size(w) > 0, shape).otherwise(F.array().cast("array<bigint>"))).alias("hashes"))

    return _let(words, with_shape)


class Domains:
    """A classifier of whole texts: log odds of the domains, and of a bounded number of telling words."""

    def __init__(self, names: list[str], priors: np.ndarray, weights: dict[int, list[float]]):
        self.names, self.priors, self.weights = names, priors, weights

    def posteriors(self, text: Column) -> Column:
        """A struct of n_tokens and p: the probability of each domain, in the order of ``names``; they add up to one."""
        prior = F.array(*[F.lit(float(p)) for p in self.priors])

        def chances(odds: Column) -> Column:
            return _let(F.transform(odds, lambda o: F.exp(o - F.array_max(odds))), lambda e: _let(F.aggregate(e, F.lit(0.0), lambda a, v: a + v), lambda s: F.transform(e, lambda v: v / s)))

        if not self.weights:
            return _let(word_hashes(text), lambda w: F.struct(w["n"].alias("n_tokens"), chances(prior).alias("p")))
        known = F.array(*[F.lit(h) for h in self.weights])
        table = F.create_map(*[x for h, w in self.weights.items() for x in (F.lit(h), F.array(*[F.lit(float(v)) for v in w]))])

        def scored(w: Column) -> Column:
            hits = F.array_intersect(w["hashes"], known)
            odds = F.aggregate(hits, prior, lambda acc, h: F.zip_with(acc, F.element_at(table, h), lambda a, b: a + b))
            return F.struct(w["n"].alias("n_tokens"), _let(odds, chances).alias("p"))

        return _let(word_hashes(text), scored)


def fit_domains(labelled: DataFrame, rows_per_domain: int = ROWS_PER_DOMAIN) -> Domains:
    """Bernoulli naive Bayes over the telling words of ``labelled(doc_id, text, domain)``, by the number of documents that hold a word.

    Rows without text or domain are not used. The driver gets a count for each domain and the telling words only.
    """
    usable = labelled.where(F.col("text").isNotNull() & F.col("domain").isNotNull())
    counts = {r["domain"]: r["n"] for r in usable.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    names = sorted(counts)
    if not names:
        return Domains([], np.zeros(0), {})
    rate = F.lit(1.0)
    for name in names:
        rate = F.when(F.col("domain") == name, F.lit(min(1.0, rows_per_domain / counts[name]))).otherwise(rate)
    sample = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < rate * (1 << 20))
    held = sample.select("domain", F.explode(F.array_distinct(word_hashes(F.col("text"))["hashes"])).alias("word"))
    size = {r["domain"]: r["n"] for r in sample.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    n = {k: max(size.get(k, 0), 1) for k in names}
    total = sum(n.values())
    by_word = held.groupBy("word").agg(*[F.count_if(F.col("domain") == k).alias(f"c{i}") for i, k in enumerate(names)])
    by_word = Scratch(labelled.sparkSession, "domains").put(by_word, "words")
    every = sum((F.col(f"c{i}") for i in range(len(names))), F.lit(0))
    telling = None
    for i, k in enumerate(names):
        own, rest, m = F.col(f"c{i}"), every - F.col(f"c{i}"), max(total - n[k], 1)
        share = every / total
        z = F.abs(own / n[k] - rest / m) / F.sqrt(F.greatest(share * (1 - share), F.lit(1e-9)) * (1 / n[k] + 1 / m))
        best = by_word.where((every >= LEAST_DOCS) & (z >= LEAST_Z)).orderBy(z.desc(), "word").limit(WORDS)
        telling = best if telling is None else telling.unionByName(best)
    weights, priors = {}, np.log([counts[k] / sum(counts.values()) for k in names])
    for r in sorted(telling.distinct().collect()):
        shares = np.array([(r[f"c{i}"] + 0.5) / (n[k] + 1) for i, k in enumerate(names)])
        # that a word is absent says something if it is rare but for some domain; common words are absent from short texts anyway
        absent = np.log1p(-shares) if shares.min() < RARE else np.full(len(names), np.log(shares).mean())
        weights[r["word"]] = [float(x) for x in np.log(shares) - absent]
        priors += absent if shares.min() < RARE else 0
    return Domains(names, priors, weights)


class Mixture:
    """Rates of documents as a function of their domain probabilities: projected steps from a rate of one."""

    def __init__(self, domains: Domains, steps: list[list[float]], error: float):
        self.domains, self.steps, self.error = domains, steps, error

    def rate(self, p: Column) -> Column:
        """The non-negative rate that belongs to the probabilities ``p``."""
        rate = F.lit(1.0)
        for step in self.steps:  # one generated expression, a few multiplications a round
            rate = F.greatest(F.lit(0.0), rate - sum((p[i] * F.lit(float(v)) for i, v in enumerate(step)), F.lit(0.0)))
        return rate


def score_domains(docs: DataFrame, domains: Domains) -> DataFrame:
    """A written table of doc_id, n_tokens and p of each row of ``docs``."""
    scored = docs.select("doc_id", domains.posteriors(F.col("text")).alias("x")).select("doc_id", "x.*")
    return Scratch(docs.sparkSession, "mixing").put(scored, "posteriors")


def fit_mixture(scored: DataFrame, domains: Domains, shares: dict[str, float], keep: tuple[str, ...] = ()) -> Mixture:
    """Rates r >= 0 whose expected tokens of each domain, sum of r * tokens * p, meet the targets, by projected-gradient least squares.

    ``shares`` are the weights of the domains; one that is not named has 0. The targets share out all tokens or, with
    ``keep``, as many as let none of those domains fall below what it has. A step is scaled by the inverse of the token-weighted Gram
    matrix of the domains over the documents whose rate is positive, which makes the loss equally steep along all of them; where such a step
    gains little, by that over all documents, with which a step of length one never fails to descend. A rate follows from the steps so far and the document's own probabilities: each round is one
    aggregation over the compact table ``scored(n_tokens, p)``, and only K * K numbers reach the driver.
    """
    k = len(domains.names)
    if not k:
        return Mixture(domains, [], 0.0)
    rows = scored.select("n_tokens", "p").where("n_tokens > 0")
    p = [F.col("p")[i] for i in range(k)]

    def totals(rate: Column) -> tuple[np.ndarray, np.ndarray, float]:
        """Expected tokens by domain and the Gram matrix over rows with a positive rate, in shares of all tokens."""
        live = F.when(F.col("r") > 0, F.col("n_tokens")).otherwise(0)
        sums = [F.sum("n_tokens"), *[F.sum(F.col("r") * F.col("n_tokens") * x) for x in p], *[F.sum(live * p[i] * p[j]) for i in range(k) for j in range(k)]]
        row = rows.withColumn("r", rate).agg(*[x.alias(f"x{i}") for i, x in enumerate(sums)]).first()
        n = float(row[0] or 0)
        return (np.array(row[1 : k + 1], float) / n, np.array(row[k + 1 :], float).reshape(k, k) / n, n) if n else (np.zeros(k), np.eye(k), n)

    have, gram, tokens = totals(F.lit(1.0))
    if not tokens:
        return Mixture(domains, [], 0.0)
    weight = np.array([shares.get(name, 0.0) for name in domains.names])
    weight = weight / max(weight.sum(), 1e-12)
    target = weight * max((have[i] / weight[i] for i in range(k) if weight[i] > 0 and domains.names[i] in keep), default=1.0)
    ridge = 1e-6 * np.eye(k)
    whole = np.linalg.inv(gram + ridge)
    loss = lambda h: float((h - target) @ whole @ (h - target))
    steps: list[list[float]] = []
    for _ in range(ROUNDS):
        if np.abs(have - target).max() <= CLOSE:
            break
        for metric in (np.linalg.inv(gram + ridge), whole):
            tried = [*steps, [float(v) for v in metric @ (have - target)]]
            after, live, _ = totals(Mixture(domains, tried, 0.0).rate(F.col("p")))
            if loss(after) < 0.7 * loss(have):
                break
        done = loss(after) > 0.9 * loss(have)  # the targets cannot all be met, and are as near as they get
        steps, have, gram = tried, after, live
        if done:
            break
    return Mixture(domains, steps, float(np.abs(have - target).max()))


def _rated(rows: DataFrame, kept: list[str], mixture: Mixture) -> DataFrame:
    """Columns ``kept`` of rows with n_tokens and p, and what follows from these."""
    chance = F.pmod(F.xxhash64("doc_id", F.lit("copies")), F.lit(1 << 30)) / float(1 << 30)
    rated = rows.withColumn("_rate", mixture.rate(F.col("_p")))
    return rated.select(
        *kept, F.col("_n").alias("n_tokens"), *[F.col("_p")[i].alias(f"p_{k}") for i, k in enumerate(mixture.domains.names)],
        F.col("_rate").alias("rate"), F.floor(F.col("_rate") + chance).cast("long").alias("copies"),
    )


def rate_scored(scored: DataFrame, mixture: Mixture) -> DataFrame:
    """doc_id, n_tokens, a column p_<domain> for each domain, rate and copies of a table of ``score_domains``."""
    return _rated(scored.select("doc_id", F.col("n_tokens").alias("_n"), F.col("p").alias("_p")), ["doc_id"], mixture)


def apply_mixture(docs: DataFrame, mixture: Mixture) -> DataFrame:
    """``docs`` with n_tokens, a column p_<domain> for each domain, rate, and copies: the rate rounded at random by doc_id.

    Probabilities, rate and copies follow from the row alone. Null or empty text has no tokens, the domains' overall
    probabilities, and a rate that moves no total; repeated rows get equal numbers; columns of those names are replaced.
    """
    kept = [c for c in docs.columns if c not in ("n_tokens", *[f"p_{k}" for k in mixture.domains.names], "rate", "copies")]
    rows = docs.select(*kept, mixture.domains.posteriors(F.col("text")).alias("_x"))
    return _rated(rows.select(*kept, F.col("_x.n_tokens").alias("_n"), F.col("_x.p").alias("_p")), kept, mixture)


def domain_of(labels: DataFrame) -> DataFrame:
    """``(doc_id, domain)`` of a table of labels: toxic, else low or high quality; null if both are unknown.

    Of several labels of a document the first in that order holds.
    """
    place = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    return labels.groupBy("doc_id").agg(F.min(place).alias("place")).select("doc_id", F.get(F.array(F.lit("toxic"), F.lit("low"), F.lit("high")), F.col("place")).alias("domain"))


def label_documents(docs: DataFrame, labels: DataFrame, rows_per_domain: int = ROWS_PER_DOMAIN) -> DataFrame:
    """The labelled rows of ``docs`` that a fit may read, about ``rows_per_domain`` of a domain: few enough to send their ids to all tasks."""
    known = domain_of(labels).where("domain IS NOT NULL")
    counts = {r["domain"]: r["n"] for r in known.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    rate = F.lit(0.0)
    for name, n in counts.items():
        rate = F.when(F.col("domain") == name, F.lit(min(1.0, rows_per_domain / n))).otherwise(rate)
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < rate * (1 << 20))
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
