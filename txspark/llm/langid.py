"""Language identification: family first, then linear support vector machines within the family."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Families of languages by ISO 639-1 code; a language that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "af", "sv", "da", "no", "nb", "nn", "is", "fo", "fy", "lb", "yi"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc", "la"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "sl", "mk", "bs"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz", "ky"),
}
FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes}
#: Features: hashed n-grams of 1 to 3 bytes of the lower-cased text.
BUCKETS = 1 << 12
#: The fit reads at most this many labelled rows of a language: those with the smallest hashes of doc_id.
ROWS_PER_LANGUAGE = 600
UNKNOWN = "und"


def _grams(data: np.ndarray) -> np.ndarray:
    """Buckets of the n-grams of one, two and three bytes that end at each place; a row for each n."""
    x = data.astype(np.uint32)
    two = (np.concatenate(([np.uint32(32)], x[:-1])) << np.uint32(8)) | x
    three = (np.concatenate(([np.uint32(32)], two[:-1])) << np.uint32(8) & np.uint32(0xFFFFFF)) | x
    hashed = [(g * np.uint32(0x9E3779B1) + np.uint32(k * 0x85EBCA77 & 0xFFFFFFFF)) >> np.uint32(20) for k, g in enumerate((x, two, three))]
    return np.stack(hashed).astype(np.intp)


def _bytes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)


def features(text: str) -> np.ndarray:
    """Frequencies of the buckets over a whole text."""
    grams = _grams(_bytes(text))
    return np.bincount(grams.ravel(), minlength=BUCKETS) / max(grams.shape[1], 1)


def fit_svm(x: np.ndarray, y: np.ndarray, rounds: int = 80, ridge: float = 1e-3) -> np.ndarray:
    """Weights and bias of a linear support vector machine with squared hinge loss, by accelerated gradient steps; y is -1 or 1.

    Classes weigh the same whatever their sizes. The steps have no random part.
    """
    x1 = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1))
    share, y = share.astype(x1.dtype), y.astype(x1.dtype)
    direction = np.ones(x1.shape[1], x1.dtype)
    for _ in range(20):  # power steps to the largest curvature
        direction = x1.T @ (share * (x1 @ direction))
        top = np.linalg.norm(direction)
        direction /= max(top, 1e-12)
    rate = x1.dtype.type(1 / (2.2 * top + ridge))
    ridge = x1.dtype.type(ridge)
    w = v = np.zeros(x1.shape[1], x1.dtype)
    for t in range(rounds):
        slack = np.maximum(0, 1 - y * (x1 @ v))
        after = v - rate * (ridge * v - 2 * x1.T @ (share * slack * y))
        v = after + x1.dtype.type(t / (t + 3)) * (after - w)
        w = after
    return w


class Model:
    """Weights over buckets: one column for each pair of families and for each pair of languages of a family."""

    def __init__(self, groups: dict[str, list[str]], pairs: list[tuple[str, str]], weights: np.ndarray, bias: np.ndarray):
        self.groups, self.pairs, self.weights, self.bias = groups, pairs, weights, bias

    def margins(self, text: str) -> np.ndarray:
        grams = _grams(_bytes(text)).ravel()
        counts = np.bincount(grams, minlength=BUCKETS)
        return (counts @ self.weights) / max(len(grams) // 3, 1) + self.bias

    def choose(self, names: list[str], margins: np.ndarray) -> tuple[str, float]:
        """The name with most duels won, ties by the sum of margins, then by name; its confidence from its closest duel."""
        if len(names) == 1:
            return names[0], 1.0
        won, sums, least = dict.fromkeys(names, 0), dict.fromkeys(names, 0.0), dict.fromkeys(names, np.inf)
        for (a, b), m in zip(self.pairs, margins, strict=True):
            if a in won and b in won:
                for name, value in ((a, m), (b, -m)):
                    won[name] += value > 0
                    sums[name] += value
                    least[name] = min(least[name], value)
        best = min(names, key=lambda n: (-won[n], -sums[n], n))
        return best, float(1 / (1 + np.exp(-3 * np.clip(least[best], -10, 10))))

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not any(map(str.isalpha, text)) or not self.groups:
            return UNKNOWN, 0.0
        margins = self.margins(text)
        family, sure = self.choose(sorted(self.groups), margins)
        lang, surer = self.choose(self.groups[family], margins)
        return lang, sure * surer


def _duel(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of the buckets and bias of a machine that was fitted on standardised features."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + np.float32(1e-4)
    x -= mean
    x /= scale * np.float32(np.sqrt(x.shape[1]))
    w = fit_svm(x, y).astype(np.float64)
    weights = w[:-1] / scale / np.sqrt(len(scale))
    return np.append(weights, w[-1] - mean @ weights)


def _fit_duel(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["doc_id", "lang"])
    x = np.frombuffer(b"".join(rows["x"]), np.float32).reshape(len(rows), BUCKETS).copy()
    return pd.DataFrame({"duel": [key[0]], "w": [_duel(x, np.where(rows["first"], 1.0, -1.0)).tobytes()]})


def fit(labelled: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> Model:
    """Fit on about ``rows_per_language`` rows of each language of ``labelled(doc_id, text, lang)``, and as many of each family.

    Each pair of families, and each pair of languages of a family, is fitted by a task of its own on that bounded sample; the driver gets the
    number of rows of each language and the weights of each pair. Rows without language, text or letters are not used.
    """
    usable = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("doc_id", "lang", "text")
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    groups: dict[str, list[str]] = {}
    for lang in sorted(counts):
        groups.setdefault(FAMILY.get(lang, lang), []).append(lang)
    duels = [*combinations(sorted(groups), 2), *(pair for names in groups.values() for pair in combinations(names, 2))]
    rank = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / (1 << 20)
    # for each language, the duels it takes part in, its side, and the share of its rows that they see
    parts: dict[str, list] = {lang: [] for lang in counts}
    for k, (a, b) in enumerate(duels):
        for name in (a, b):
            members = groups[name] if k < len(groups) * (len(groups) - 1) // 2 else [name]
            for lang in members:
                parts[lang].append(F.struct(F.lit(k).alias("duel"), F.lit(name == a).alias("first"), F.lit(min(1.0, rows_per_language / counts[lang] / len(members))).alias("share")))
    if not duels:
        return Model(groups, [], np.zeros((BUCKETS, 0)), np.zeros(0))
    table = F.create_map(*[x for lang, own in parts.items() for x in (F.lit(lang), F.array(*own))])
    sample = usable.withColumn("duels", F.filter(table[F.col("lang")], lambda d: d["share"] >= rank)).where(F.size("duels") > 0)

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[["doc_id", "lang", "duels"]].assign(x=[features(t).astype(np.float32).tobytes() for t in batch["text"]])

    described = sample.mapInPandas(vectors, "doc_id long, lang string, duels array<struct<duel:int,first:boolean,share:double>>, x binary")
    rows = described.select("doc_id", "lang", "x", F.explode("duels").alias("d")).select("doc_id", "lang", "x", "d.duel", "d.first")
    fitted = rows.groupBy("duel").applyInPandas(_fit_duel, "duel int, w binary").collect()
    weights = np.zeros((BUCKETS + 1, len(duels)))
    for r in fitted:
        weights[:, r["duel"]] = np.frombuffer(r["w"])
    return Model(groups, duels, weights[:-1], weights[-1])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1), from the whole text alone.

    Null text or text without a letter is ``und`` with score 0; so is every row if nothing was learned. Rows and other
    columns stay; columns of those two names are replaced. The model's size is fixed by its parameters and languages.
    """
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    schema = docs.select(*kept).schema.add("lang_pred", "string").add("score", "double")

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            got = [model.predict(t) for t in batch["text"]]
            yield batch.assign(lang_pred=[g[0] for g in got], score=[g[1] for g in got])

    return docs.select(*kept).mapInPandas(score, schema)
