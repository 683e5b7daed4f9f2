"""Additive models as tables of binned terms, tree classifiers, search and end-to-end calls."""

from __future__ import annotations

import math
import random
import time
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txspark.functions.scalars import normalize_chrom
from txspark.operators.annotation import annotation_to_intervals
from txspark.operators.assembly import assemble_features, attach_dge, attach_expression, attach_metadata, drop_non_features
from txspark.operators.cleaning import canonical_columns, dedup_rows, handle_missing, sanitize_columns
from txspark.operators.encoding import encode_for_schema
from txspark.operators.evaluate import metrics, roc_auc
from txspark.operators.kmers import reduce_sequences
from txspark.operators.scaling import apply_scaler
from txspark.operators.schema import enforce_schema, fields_of
from txspark.operators.sequences import spliced_sequences
from txspark.operators.tracks import query_tracks
from txspark.session import stored

TERMS = "term string, feature string, bin int, feature2 string, bin2 int, score double"


def _bin(value: Column, cuts: list[float]) -> Column:
    """The number of cuts at or below the value."""
    return reduce(lambda a, c: a + F.when(value >= c, 1).otherwise(0), cuts, F.lit(0))


def _contributions(terms: DataFrame, cuts: dict[str, list[float]]) -> list[tuple[str, Column]]:
    """Each term with its contribution as an expression: look-ups of the scores by bin. A null value contributes 0. The model reaches the driver."""
    table: dict[tuple, dict[tuple, float]] = {}
    for r in terms.collect():
        table.setdefault((r["term"], r["feature"], r["feature2"]), {})[r["bin"], r["bin2"] or 0] = r["score"]
    value = lambda c: F.col(f"`{c}`").cast("double")
    binned = lambda c: F.when(value(c).isNotNull(), _bin(value(c), cuts[c]))
    out = []
    for (term, one, two), scores in sorted(table.items(), key=lambda kv: kv[0][0]):
        wide = len(cuts[two]) + 1 if two else 1
        flat = F.array(*[F.lit(scores.get((a, b), 0.0)) for a in range(len(cuts[one]) + 1) for b in range(wide)])
        place = binned(one) * wide + binned(two) if two else binned(one)
        out.append((term, F.coalesce(F.get(flat, place), F.lit(0.0))))
    return out


def explain_rows(df: DataFrame, terms: DataFrame, cuts: dict[str, list[float]], key: str = "transcript_id") -> DataFrame:
    """(id, term, contribution) of each row and term, for single features and pairs (MDL2). A null value contributes 0.

    ``terms`` has a row for each term and bin (or pair of bins), ``cuts`` the ascending cut points of each feature; both are the model.
    """
    parts = F.array(*[F.struct(F.lit(t).alias("term"), c.alias("contribution")) for t, c in _contributions(terms, cuts)])
    return df.select(key, F.explode(parts).alias("x")).select(key, "x.*")


def score_additive(df: DataFrame, terms: DataFrame, cuts: dict[str, list[float]], intercept: float = 0.0, key: str = "transcript_id") -> DataFrame:
    """(id, score, prob, pred): logistic of the intercept and all contributions, in one projection; 1 from 0.5 on (MDL1)."""
    total = F.aggregate(F.array(*[c for _, c in _contributions(terms, cuts)]), F.lit(0.0), lambda a, c: a + c)
    score = df.select(key, (total + intercept).alias("score"))
    return score.withColumn("prob", 1 / (1 + F.exp(-F.col("score")))).withColumn("pred", (F.col("prob") >= 0.5).cast("int"))


@dataclass
class Additive:
    """An additive model as tables: terms, cut points and intercept."""

    terms: DataFrame
    cuts: dict[str, list[float]]
    intercept: float = 0.0


def importance(contributions: DataFrame, top_n: int | None = None, singles_only: bool = False) -> DataFrame:
    """(term, importance, percent, cumulative, rank): mean absolute contribution, largest first (MDL3). Pair terms contain `` & ``."""
    per = contributions.groupBy("term").agg(F.avg(F.abs("contribution")).alias("importance"))
    if singles_only:
        per = per.where(~F.col("term").contains(" & "))
    order = Window.orderBy(F.col("importance").desc(), "term")  # a row for each term of the model
    whole = Window.partitionBy()
    out = per.withColumns({"percent": 100 * F.col("importance") / F.sum("importance").over(whole), "rank": F.row_number().over(order)})
    out = out.withColumn("cumulative", F.sum("percent").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return out if top_n is None else out.where(F.col("rank") <= top_n)


def check_features(df: DataFrame, features: list[str]) -> None:
    """Text columns are no features (MDL4)."""
    text = [f for f in features if isinstance(df.schema[f].dataType, T.StringType)]
    if text:
        raise ValueError(f"text columns cannot be features: {text}")


def train(df: DataFrame, kind: str, features: list[str], label: str = "y", params: dict | None = None, class_weight: bool = False):
    """A fitted pipeline of ``pyspark.ml``: random_forest, boosted_trees or additive (MDL4).

    The additive one bins each feature by quantiles and fits an elastic-net logistic regression on the bins; its
    coefficients are the terms that ``additive_terms`` returns. With ``pairs`` among the parameters, so many pairs of features that explain most of what
    single ones leave (``pair_gains``) become terms too, and all are fitted again.
    """
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import OneHotEncoder, QuantileDiscretizer, SQLTransformer, VectorAssembler

    check_features(df, features)
    params = dict(params or {})
    rows = df.withColumn("label", F.col(label).cast("double"))
    if class_weight:
        n = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
        rows = rows.withColumn("weight", reduce(lambda a, kv: F.when(F.col("label") == kv[0], sum(n.values()) / (len(n) * kv[1])).otherwise(a), n.items(), F.lit(1.0)))
        params["weightCol"] = "weight"
    rows = rows.select("*", *[F.coalesce(F.col(f"`{f}`").cast("double"), F.lit(float("nan"))).alias(f"_{f}") for f in features])
    inputs = [f"_{f}" for f in features]
    if kind == "additive":
        bins, pairs = params.pop("bins", 8), params.pop("pairs", 0)
        binned = [f"{c}_bin" for c in inputs]
        binner = QuantileDiscretizer(inputCols=inputs, outputCols=binned, numBucketsArray=[bins] * len(inputs), handleInvalid="keep")

        def rest(columns: list[str]) -> list:
            hot = [f"{c}_hot" for c in columns]
            return [OneHotEncoder(inputCols=columns, outputCols=hot, dropLast=False, handleInvalid="keep"), VectorAssembler(inputCols=hot, outputCol="features"), LogisticRegression(**{"regParam": 0.01, "elasticNetParam": 0.1, "maxIter": 50} | params)]

        single = Pipeline(stages=[binner, *rest(binned)]).fit(rows)
        if not pairs:
            return single
        best = pair_gains(single.transform(rows), features).orderBy(F.col("gain").desc(), "feature", "feature2").limit(pairs).collect()
        widths = [len(s) - 1 for s in (single.stages[0].getSplitsArray() if len(features) > 1 else [single.stages[0].getSplits()])]
        terms = {f"{r['feature']} & {r['feature2']}": f"CAST(`_{r['feature']}_bin` * {widths[features.index(r['feature2'])] + 1} + `_{r['feature2']}_bin` AS double)" for r in best}
        joint = SQLTransformer(statement=f"SELECT *, {', '.join(f'{e} AS `{t}`' for t, e in terms.items())} FROM __THIS__")
        both = PipelineModel(stages=[single.stages[0], joint])
        fitted = Pipeline(stages=rest([*binned, *terms])).fit(both.transform(rows))
        return PipelineModel(stages=[single.stages[0], joint, *fitted.stages])
    else:
        model = {"random_forest": RandomForestClassifier, "boosted_trees": GBTClassifier}
        if kind not in model:
            raise ValueError(f"unknown model {kind!r}")
        stages = [VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep"), model[kind](**{"seed": 99} | params)]
    return Pipeline(stages=stages).fit(rows)


def predict(model, df: DataFrame, features: list[str]) -> DataFrame:
    """``df`` with score (probability of the positive class) and pred."""
    from pyspark.ml.functions import vector_to_array

    rows = df.select("*", *[F.coalesce(F.col(f"`{f}`").cast("double"), F.lit(float("nan"))).alias(f"_{f}") for f in features])
    out = model.transform(rows)
    return out.select(*[F.col(f"`{c}`") for c in df.columns], vector_to_array("probability")[1].alias("score"), F.col("prediction").cast("int").alias("pred"))


def additive_terms(spark, model, features: list[str]) -> tuple[DataFrame, dict[str, list[float]], float]:
    """Terms, cut points and intercept of a fitted additive pipeline, for ``score_additive``."""
    from pyspark.ml.feature import OneHotEncoderModel

    binner, regression = model.stages[0], model.stages[-1]
    hot = next(s for s in model.stages if isinstance(s, OneHotEncoderModel))
    splits = dict(zip(features, binner.getSplitsArray() if len(features) > 1 else [binner.getSplits()], strict=True))
    weights, at, rows, cuts = regression.coefficients.toArray(), 0, [], {f: [float(x) for x in s[1:-1]] for f, s in splits.items()}
    pairs = [tuple(c.split(" & ")) for c in hot.getInputCols()[len(features) :]]
    for term, size in zip([(f,) for f in features] + pairs, hot.categorySizes, strict=True):
        if len(term) == 1:
            rows += [(term[0], term[0], b, None, None, float(weights[at + b])) for b in range(len(splits[term[0]]) - 1) if b < size]
        else:
            one, two = (len(splits[f]) - 1 for f in term)
            rows += [(" & ".join(term), term[0], a, term[1], b, float(weights[at + k])) for a in range(one) for b in range(two) if (k := a * (two + 1) + b) < size]
        at += size + 1  # one more slot for unseen bins
    return spark.createDataFrame(rows, TERMS), cuts, float(regression.intercept)


def pair_gains(scored: DataFrame, features: list[str]) -> DataFrame:
    """(feature, feature2, gain): how much of the squared residuals of a fitted additive model the means of a pair's joint bins explain (MDL4).

    ``scored`` has label, probability and the bins of all features. One aggregation over the bins of all pairs, combined in the tasks: a group for each pair and joint bin.
    """
    from pyspark.ml.functions import vector_to_array

    rows = scored.select((F.col("label") - vector_to_array("probability")[1]).alias("r"), F.array(*[F.col(f"`_{f}_bin`").cast("int") for f in features]).alias("b"))
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col("b")[i].alias("a"), F.col("b")[j].alias("b")) for i in range(len(features)) for j in range(i + 1, len(features))])
    cells = rows.select("r", F.explode(pairs).alias("x")).groupBy("x.i", "x.j", "x.a", "x.b").agg(F.count("*").alias("n"), F.sum("r").alias("r"))
    names = F.array(*[F.lit(f) for f in features])
    return cells.groupBy("i", "j").agg(F.sum(F.col("r") * F.col("r") / F.col("n")).alias("gain")).select(names[F.col("i")].alias("feature"), names[F.col("j")].alias("feature2"), "gain")


def candidates(space: dict[str, list], n: int, seed: int = 99) -> list[dict]:
    """n seeded draws from a space of parameter values, without repeats as far as there are others."""
    rng, out, seen = random.Random(seed), [], set()
    for _ in range(20 * n):
        one = {k: rng.choice(v) for k, v in sorted(space.items())}
        mark = tuple(sorted((k, repr(v)) for k, v in one.items()))
        if mark not in seen:
            seen.add(mark)
            out.append(one)
        if len(out) == n:
            break
    return out


TRIAL = "trial int, state string, value double, params string, seconds double"


def nested_sample(df: DataFrame, columns: list[str], share: float, seed: int = 99) -> DataFrame:
    """The rows whose hash over the columns lies in the first ``share``: a larger share holds all rows of a smaller one, and equal rows go together."""
    return df if share >= 1 else df.where(F.pmod(F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in columns]), F.lit(1 << 30)) < int(share * (1 << 30)))


def search(train_df: DataFrame, test_df: DataFrame, kind: str, features: list[str], space: dict[str, list], names: list[str] = ("f1",), n: int = 10, direction: str = "maximize", seed: int = 99, parallel: int = 4, rungs: int = 1, keep: int = 3) -> DataFrame:
    """A row for each candidate: fitted on the first table, scored on the second by the mean of the named metrics (MDL5).

    ``parallel`` candidates at a time, each a distributed fit in a scheduler pool of its own. With more than one rung, candidates are fitted on a nested sample of
    the first table that grows ``keep`` times with each rung, up to the whole in the last; of each rung the best in ``keep`` go on, at equal values the first ones.
    One that stops early is recorded as pruned with its last value, one that fails as pruned without a value; if all fail on a sample, as an empty one
    or one of a single class makes them, all go on. The complete ones come first.
    """
    spark, trials, found = train_df.sparkSession, candidates(space, n, seed), {}

    def attempt(i: int, rows: DataFrame, state: str) -> None:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"trial{i}")
        start, spent = time.monotonic(), found[i][4] if i in found else 0.0
        try:
            row = evaluate(train(rows, kind, features, params=trials[i]), test_df, features)
            value, params = float(sum(row[m] for m in names) / len(names)), repr(trials[i])
        except Exception as error:  # noqa: BLE001  any failure of a candidate prunes it
            state, value, params = "pruned", None, f"{trials[i]!r}: {type(error).__name__}"
        found[i] = (i, state, value, params, spent + time.monotonic() - start)

    live = list(range(len(trials)))
    for rung in range(1, rungs + 1):
        rows = nested_sample(train_df, [*features, "y"], keep ** (rung - rungs), seed)
        if live:
            with ThreadPool(min(parallel, len(live))) as pool:
                pool.map(inheritable_thread_target(spark)(lambda i: attempt(i, rows, "complete" if rung == rungs else "pruned")), live, 1)  # noqa: B023  the pool ends within the rung
        done = [i for i in live if found[i][2] is not None]
        done.sort(key=lambda i: (-found[i][2] if direction == "maximize" else found[i][2], i))
        if done and rung < rungs:
            live = done[: math.ceil(len(done) / keep)]
    sign = F.col("value").desc_nulls_last() if direction == "maximize" else F.col("value").asc_nulls_last()
    return spark.createDataFrame([found[i] for i in sorted(found)], TRIAL).orderBy(F.col("state") != "complete", sign, "trial")


def evaluate(model, df: DataFrame, features: list[str], label: str = "y") -> dict:
    """accuracy, precision, recall, f1, f1beta and roc_auc of a model on a table."""
    # predicted once, read by both
    scored = stored(predict(model, df.withColumn("y", F.col(label).cast("int")), features).select("y", "score", "pred"), "scored")
    return metrics(scored).first().asDict() | roc_auc(scored).first().asDict()


def refit_top(trials: DataFrame, n: int, train_df: DataFrame, holdout: DataFrame, kind: str, features: list[str]) -> list[tuple[int, dict]]:
    """Fit the n best completed candidates again and evaluate them on the holdout (MDL6)."""
    from ast import literal_eval

    best = trials.where("state = 'complete'").orderBy(F.col("value").desc(), "trial").limit(n).collect()
    return [(r["trial"], evaluate(train(train_df, kind, features, params=literal_eval(r["params"])), holdout, features)) for r in best]


def clean_for_model(features: DataFrame, schema: dict[str, str], scaler: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Rows ready for a model, and the ids that cleaning dropped: comma lists become the model's token columns, names are sanitised, the
    schema is enforced, and saved statistics scale the rest."""
    clean = dedup_rows(canonical_columns(handle_missing(drop_non_features(features))))
    ready = enforce_schema(sanitize_columns(encode_for_schema(clean, schema)), schema)
    dropped = features.select("transcript_id").join(ready.select("transcript_id"), "transcript_id", "left_anti").distinct()
    return (apply_scaler(ready, scaler) if scaler is not None else ready), dropped


def score_features(features: DataFrame, model, schema: dict[str, str], scaler: DataFrame | None = None) -> DataFrame:
    """(transcript_id, prediction, prob_lncrna, prob_coding) of extracted features by a fitted pipeline or an ``Additive`` (MDL8)."""
    ready, _ = clean_for_model(features, schema, scaler)
    if isinstance(model, Additive):
        scored = score_additive(ready, model.terms, model.cuts, model.intercept).select("transcript_id", "pred", F.col("prob").alias("score"))
    else:
        scored = predict(model, ready, list(schema))
    return scored.select("transcript_id", F.col("pred").alias("prediction"), F.col("score").alias("prob_lncrna"), (1 - F.col("score")).alias("prob_coding"))


def call_transcripts(annotation: DataFrame, model, schema: dict[str, str], track: DataFrame | None = None, structure: DataFrame | None = None, kmers: DataFrame | None = None, scaler: DataFrame | None = None, expression: DataFrame | None = None, dge: DataFrame | None = None) -> DataFrame:
    """From annotation and feature tables to enriched calls: assemble, clean, score, attach (MDL9)."""
    transcripts = annotation.where("feature = 'transcript' AND transcript_id IS NOT NULL")
    calls = score_features(assemble_features(transcripts.select("transcript_id", "start", "end"), track, structure, kmers), model, schema, scaler)
    out = attach_metadata(calls, transcripts)
    out = attach_expression(out, expression) if expression is not None else out
    return attach_dge(out, dge) if dge is not None else out


def call_annotation(annotation: DataFrame, genome: DataFrame, spec: list[dict], tracks: dict[str, tuple[str, DataFrame]], model, schema: dict[str, str], sizes: DataFrame | None = None, lengths: tuple[int, int] = (3, 12), components: int | dict[int, int] = 1, **rest) -> DataFrame:
    """From annotation, genome and track specification to enriched calls (MDL9).

    Transcripts are queried on all tracks; their spliced sequences give k-mer components of ``lengths``; ``rest`` goes to ``call_transcripts``.
    """
    chrom = normalize_chrom(F.col("chromosome"))
    own, genome = annotation.withColumn("chromosome", chrom), genome.withColumn("chromosome", chrom)
    intervals = annotation_to_intervals(annotation).select("chromosome", "start", "end", "transcript_id")
    track = query_tracks(intervals, spec, tracks, sizes).drop("chromosome", "start", "end")
    kmers = reduce_sequences(spliced_sequences(own, genome), *lengths, components)
    return call_transcripts(own, model, schema, track, kmers=kmers, **rest)


def feature_columns(df: DataFrame, label: str = "y") -> list[str]:
    return [c for c in fields_of(df) if c != label]
