"""Classification metrics, curves and summaries as aggregations."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txspark.operators.ordered import in_slices, running


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def confusion_counts(df: DataFrame, by: list[str] | None = None, y: str = "y", pred: str = "pred") -> DataFrame:
    """tn, fp, fn, tp of each group (EVL6, EVL7)."""
    is_ = lambda a, b: F.count_if((F.col(y).cast("int") == a) & (F.col(pred).cast("int") == b))
    return df.groupBy(*(by or [])).agg(is_(0, 0).alias("tn"), is_(0, 1).alias("fp"), is_(1, 0).alias("fn"), is_(1, 1).alias("tp"))


def metrics_of_counts(counts: DataFrame, beta: float = 0.5) -> DataFrame:
    """accuracy, precision, recall, f1 and F-beta (EVL1, EVL2); 0 where a denominator is."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    p, r = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    f = lambda b: _ratio((1 + b * b) * tp, (1 + b * b) * tp + b * b * fn + fp)
    keep = [c for c in counts.columns if c not in ("tn", "fp", "fn", "tp")]
    return counts.select(*keep, _ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"), p.alias("precision"), r.alias("recall"), f(1.0).alias("f1"), f(beta).alias("f1beta"))


def metrics(df: DataFrame, by: list[str] | None = None, beta: float = 0.5) -> DataFrame:
    """One row of metrics, or one for each group (EVL1, EVL2, EVL7)."""
    return metrics_of_counts(confusion_counts(df, by), beta)


def confusion(df: DataFrame, normalize: bool = False) -> DataFrame:
    """(y, pred, n), or shares of each label's row (EVL6)."""
    counts = df.groupBy(F.col("y").cast("int").alias("y"), F.col("pred").cast("int").alias("pred")).agg(F.count("*").alias("n"))
    return counts.select("y", "pred", (F.col("n") / F.sum("n").over(Window.partitionBy("y"))).alias("share")) if normalize else counts


def _steps(df: DataFrame, by: list[str]) -> DataFrame:
    """p, n, true and false positives at each distinct score and above. Rows of one score are added up before the ordered windows, which see a
    slice of the scores each, or a group if there are groups."""
    counts = df.groupBy(*by, "score").agg(F.count_if(F.col("y").cast("int") == 1).alias("p"), F.count_if(F.col("y").cast("int") == 0).alias("n"))
    values = {"tp": F.col("p"), "fp": F.col("n")}
    if not by:
        cut = in_slices(counts, "score")
        totals = cut.agg(F.sum("p").alias("all_p"), F.sum("n").alias("all_n")).withColumn("_k", F.lit(1))
        return running(cut, "score", values, F.sum, lambda a, b: a + b, descending=True).withColumn("_k", F.lit(1)).join(F.broadcast(totals), "_k").drop("_k", "_slice")
    group = Window.partitionBy(*by)
    down = group.orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, 0)
    return counts.select("*", *[F.sum(v).over(down).alias(k) for k, v in values.items()], F.sum("p").over(group).alias("all_p"), F.sum("n").over(group).alias("all_n"))


def roc_curve(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(threshold, fpr, tpr), from threshold infinity at (0, 0); tied scores are one point (EVL3)."""
    by = by or []
    steps = _steps(df, by)
    points = steps.select(*by, F.col("score").cast("double").alias("threshold"), _ratio(F.col("fp"), F.col("all_n")).alias("fpr"), _ratio(F.col("tp"), F.col("all_p")).alias("tpr"))
    start = steps.select(*by).distinct() if by else steps.agg(F.count("*").alias("_n")).where("_n > 0")
    return points.unionByName(start.select(*by, F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")))


def roc_auc(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Area under the ROC curve by trapezoids; 0 for a single class (EVL4)."""
    by = by or []
    s = _steps(df, by)
    area = F.col("n") * (2 * F.col("tp") - F.col("p")) / 2
    return s.withColumn("_a", area).groupBy(*by).agg(_ratio(F.sum("_a"), F.first("all_p").cast("double") * F.first("all_n")).alias("roc_auc"))


def pr_curve(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(threshold, recall, precision), with the end point (0, 1) (EVL5)."""
    by = by or []
    s = _steps(df, by)
    points = s.select(*by, F.col("score").cast("double").alias("threshold"), _ratio(F.col("tp"), F.col("all_p")).alias("recall"), (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"))
    start = s.select(*by).distinct() if by else s.agg(F.count("*").alias("_n")).where("_n > 0")
    return points.unionByName(start.select(*by, F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("recall"), F.lit(1.0).alias("precision")))


def pr_auc(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Area under the precision-recall curve by trapezoids from (0, 1) (EVL5)."""
    by = by or []
    s = _steps(df, by)
    tp, fp = F.col("tp") - F.col("p"), F.col("fp") - F.col("n")  # at the score above
    above = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(1.0))
    area = _ratio(F.col("p"), F.col("all_p")) * (F.col("tp") / (F.col("tp") + F.col("fp")) + above) / 2
    return s.withColumn("_a", area).groupBy(*by).agg(F.sum("_a").alias("pr_auc"))


def cv_metrics(df: DataFrame, fold: str = "fold") -> DataFrame:
    """Metrics, confusion counts and ROC area of each fold (EVL7)."""
    counts = confusion_counts(df, [fold])
    return counts.join(metrics_of_counts(counts), fold).join(roc_auc(df, [fold]), fold)


def fold_summary(per_fold: DataFrame, names: list[str]) -> DataFrame:
    """(metric, mean, std) over folds, std with n - 1 (AGG9)."""
    long = per_fold.select(F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("v")) for n in names])).alias("x")).select("x.*")
    return long.groupBy("metric").agg(F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"))


def compare_models(df: DataFrame, model: str = "model") -> DataFrame:
    """accuracy, balanced accuracy, ROC area, weighted F1, precision and time of each model, best balanced accuracy first (EVL8)."""
    counts = confusion_counts(df, [model])
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    f_pos, f_neg = _ratio(2 * tp, 2 * tp + fp + fn), _ratio(2 * tn, 2 * tn + fn + fp)
    table = counts.select(
        model, _ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"), ((_ratio(tp, tp + fn) + _ratio(tn, tn + fp)) / 2).alias("balanced_accuracy"),
        (((tp + fn) * f_pos + (tn + fp) * f_neg) / (tp + tn + fp + fn)).alias("f1_weighted"), _ratio(tp, tp + fp).alias("precision"),
    ).join(roc_auc(df, [model]), model)
    if "seconds" in df.columns:
        table = table.join(df.groupBy(model).agg(F.max("seconds").alias("seconds")), model)
    return table.orderBy(F.col("balanced_accuracy").desc(), model)


def tally(df: DataFrame, pred: str = "pred") -> DataFrame:
    """One row: predictions of the positive and of the negative class (AGG6)."""
    return df.agg(F.count_if(F.col(pred).cast("int") == 1).alias("n_noncoding"), F.count_if(F.col(pred).cast("int") == 0).alias("n_coding"))


def high_confidence(df: DataFrame, threshold: float = 0.9, probability: str = "score", pred: str = "pred") -> DataFrame:
    """Positive calls above the threshold (PRJ17)."""
    return df.where((F.col(probability) > threshold) & (F.col(pred).cast("int") == 1))


def top_n(df: DataFrame, by: str, n: int, tie: str) -> DataFrame:
    """The n rows with the largest values, ties by ``tie`` (SRT3)."""
    return df.orderBy(F.col(by).desc_nulls_last(), tie).limit(n)


def sort_by_id(df: DataFrame, key: str = "transcript_id") -> DataFrame:
    """By id, for a sink (SRT1)."""
    return df.orderBy(key)


def convergence(trials: DataFrame) -> DataFrame:
    """(trial, value, slope, rolling): linear trend over all trials, and the centred mean of min(10, n / 3) of them; full windows only (MDL10).

    Trials are few: one table of an optimisation study.
    """
    row = trials.agg(F.count("*").alias("n"), F.regr_slope("value", "trial").alias("slope")).first()
    w = max(1, min(10, row["n"] // 3))
    frame = Window.orderBy("trial").rowsBetween(-(w // 2), (w - 1) // 2)
    rolling = F.when(F.count("*").over(frame) == w, F.avg("value").over(frame))
    return trials.select("trial", "value", F.lit(row["slope"]).cast("double").alias("slope"), rolling.alias("rolling"))


def importance_stability(trials: DataFrame) -> DataFrame:
    """(feature, variance, mean) of importances over trials, most variable first (MDL11)."""
    return trials.groupBy("feature").agg(F.var_pop("importance").alias("variance"), F.avg("importance").alias("mean")).orderBy(F.col("variance").desc(), "feature")


#: Columns in a block of the correlation matrix, tasks whose sums one group adds up, and rows of a product.
BLOCK, TOGETHER, ROWS = 128, 32, 4096


def correlations(df: DataFrame, columns: list[str], threshold: float) -> DataFrame:
    """(feature, feature2, corr) of pairs of columns, the first of them earlier, whose absolute Pearson correlation exceeds the threshold (AGG5).

    Columns are cut into blocks. A task adds up, for each pair of blocks, the products that a correlation needs over the rows where both values are there; these
    sums of BLOCK x BLOCK numbers are added up in groups of tasks, and a task makes the correlations of a pair of blocks from them. No matrix of all columns
    exists anywhere: a task holds one block of rows of it. Values are centred by the column's mean first. Pairs with a constant column are left out.
    """
    spark = df.sparkSession
    value = lambda c: F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double"))
    means = df.agg(*[F.avg(value(c)).alias(f"c{i}") for i, c in enumerate(columns)]).first() if columns else ()
    blocks = [range(s, min(s + BLOCK, len(columns))) for s in range(0, len(columns), BLOCK)]
    kind = "i int, j int, part int, sums binary"

    def sums_of(i: int) -> DataFrame:
        wide = [c for b in blocks[i:] for c in b]

        def add_up(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = {j: 0.0 for j in range(i, len(blocks))}
            for frame in frames:
                for at in range(0, len(frame), ROWS):
                    x = frame.iloc[at : at + ROWS].to_numpy(float)
                    there = ~np.isnan(x)
                    x, m = np.where(there, x, 0.0), there.astype(float)
                    n = len(blocks[i])
                    a, ma = x[:, :n].T, m[:, :n].T
                    for j in total:
                        own = slice(blocks[j].start - blocks[i].start, blocks[j].stop - blocks[i].start)
                        b, mb = x[:, own], m[:, own]
                        total[j] = total[j] + np.stack([ma @ mb, a @ mb, ma @ b, (a * a) @ mb, ma @ (b * b), a @ b])
            part = TaskContext.get().partitionId() // TOGETHER
            for j, t in total.items():
                if not np.isscalar(t):
                    yield pd.DataFrame({"i": [i], "j": [j], "part": [part], "sums": [t.tobytes()]})

        return df.select(*[(value(columns[c]) - F.lit(means[c])).alias(f"c{c}") for c in wide]).mapInPandas(add_up, kind)

    def join(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(s) for s in frame["sums"]], axis=0)
        return pd.DataFrame({"i": frame["i"].iloc[:1], "j": frame["j"].iloc[:1], "part": frame["part"].iloc[:1], "sums": [total.tobytes()]})

    def pairs(frame: pd.DataFrame) -> pd.DataFrame:
        i, j = int(frame["i"].iloc[0]), int(frame["j"].iloc[0])
        n, sa, sb, saa, sbb, sab = np.frombuffer(join(frame)["sums"].iloc[0]).reshape(6, len(blocks[i]), len(blocks[j]))
        with np.errstate(divide="ignore", invalid="ignore"):
            r = (n * sab - sa * sb) / np.sqrt((n * saa - sa * sa) * (n * sbb - sb * sb))
        a, b = np.nonzero(np.abs(np.nan_to_num(r, posinf=0.0, neginf=0.0)) > threshold)
        a, b, r = a + blocks[i].start, b + blocks[j].start, r[a, b]
        keep = a < b
        names = np.array(columns, dtype=object)  # also where no pair is left
        return pd.DataFrame({"feature": names[a[keep]], "feature2": names[b[keep]], "corr": r[keep]})

    if not blocks:
        return spark.createDataFrame([], "feature string, feature2 string, corr double")
    sums = reduce(lambda x, y: x.unionByName(y), [sums_of(i) for i in range(len(blocks))])
    return sums.groupBy("i", "j", "part").applyInPandas(join, kind).groupBy("i", "j").applyInPandas(pairs, "feature string, feature2 string, corr double")


def correlated_features(df: DataFrame, columns: list[str], threshold: float = 0.95) -> DataFrame:
    """Columns whose absolute Pearson correlation with an earlier one exceeds the threshold (AGG5), from ``correlations``."""
    return correlations(df, columns, threshold).select(F.col("feature2").alias("feature")).distinct()
