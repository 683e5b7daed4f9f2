"""Expression, differential expression, evaluation and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from txspark.operators import evaluate, expression, models
from txspark.plans.registry import query
from txspark.plans.track_queries import NAMES as SITES, PLAIN
from txspark.session import stored

FEATURES = ["mean_price", "max_qty", "sum_tax", "length"]


@query("""SELECT transcript_id, gene_id, sample_id, round(avg(fpkm), 6) AS fpkm FROM f_expression GROUP BY 1, 2, 3""")
def expression_means(x):
    return expression.sample_fpkm(x.f_expression.select("transcript_id", "gene_id", "sample_id", F.explode(F.array(F.col("fpkm").cast("string"), F.col("fpkm").cast("string"), F.lit("none"))).alias("FPKM")))


@query("SELECT transcript_id, " + ", ".join(f"round(avg(fpkm) FILTER (sample_id = 's{i}'), 6) AS s{i}" for i in range(6)) + " FROM f_expression GROUP BY 1")
def expression_matrix(x):
    return expression.fpkm_matrix(x.f_expression, [f"s{i}" for i in range(6)])


@query("""SELECT transcript_id, round(avg(fpkm), 6) AS fpkm_mean, round(stddev_pop(fpkm), 5) AS fpkm_std FROM f_expression WHERE transcript_id IN (SELECT transcript_id FROM f_features) GROUP BY 1""")
def expression_summary(x):
    return expression.fpkm_summary(expression.restrict_ids(x.f_expression, x.f_features)).withColumn("fpkm_std", F.round("fpkm_std", 5))


@query("""SELECT transcript_id, round(var_samp(fpkm), 4) AS variance FROM f_expression GROUP BY 1 HAVING var_samp(fpkm) > 1""")
def variable_transcripts(x):
    return expression.variance_filter(x.f_expression).withColumn("variance", F.round("variance", 4))


@query("""SELECT count(*) AS input_rows, count(DISTINCT transcript_id) AS transcripts, count(DISTINCT gene_id) AS genes, (SELECT count(*) FROM (SELECT transcript_id FROM f_expression GROUP BY 1 HAVING var_samp(fpkm) > 1)) AS kept,
    CAST(2 AS bigint) AS conditions, 'completed' AS status FROM f_expression""")
def expression_counts(x):
    return expression.dge_summary(x.f_expression, x.f_samples, expression.variance_filter(x.f_expression))


@query("""SELECT concat('s', c_custkey % 8) AS sample_id FROM customer WHERE c_custkey % 8 >= 6 GROUP BY 1""")
def missing_samples(x):
    sheet = x.sql("SELECT DISTINCT concat('s', c_custkey % 8) AS sample_id, 'A' AS condition FROM customer")
    return expression.check_design(sheet, x.f_expression)


DGE = """r AS (SELECT KEY AS id, sample_id, sum(fpkm) AS fpkm FROM f_expression GROUP BY 1, 2), z AS (SELECT sample_id, log2(sum(fpkm) + 1) AS z FROM f_expression GROUP BY 1),
    d AS (SELECT id, z, CASE WHEN r.sample_id IN ('s0', 's2', 's4') THEN 0 ELSE 1 END AS x, log2(fpkm + 1) AS y FROM r JOIN z ON r.sample_id = z.sample_id),
    m AS (SELECT id, count(*) AS n, avg(z) AS mz, avg(x) AS mx, avg(y) AS my FROM d GROUP BY 1),
    c AS (SELECT d.id, max(n) AS n, sum((y - my) * (y - my)) AS yy, sum((x - mx) * (x - mx)) AS xx, sum((z - mz) * (z - mz)) AS zz, sum((x - mx) * (y - my)) AS xy, sum((x - mx) * (z - mz)) AS xz, sum((y - my) * (z - mz)) AS yz
        FROM d JOIN m ON d.id = m.id GROUP BY 1),
    p AS (SELECT id, n, yy - CASE WHEN zz < 1e-12 THEN 0 ELSE yz * yz / zz END AS r0, xx - CASE WHEN zz < 1e-12 THEN 0 ELSE xz * xz / zz END AS vx, xy - CASE WHEN zz < 1e-12 THEN 0 ELSE xz * yz / zz END AS vxy FROM c)"""


@query(f"""WITH {DGE.replace("KEY", "gene_id")} SELECT 'gene' AS feature, id, round(pow(2, vxy / vx), 4) AS fc, round((vxy * vxy / vx) / ((r0 - vxy * vxy / vx) / (n - 3)), 3) AS f, CAST(n - 3 AS double) AS d2 FROM p WHERE n >= 4 AND vx > 1e-12""")
def gene_statistics(x):
    out = expression.dge_statistics(x.f_expression, x.f_samples, "gene").where("f IS NOT NULL")
    return out.withColumns({"fc": F.round("fc", 4), "f": F.round("f", 3)})


#: P(F > f) with 1 and d2 = 1, 2 or 3 degrees of freedom in closed form: the tails of Student's t. Six samples have no more.
TESTED = """t AS (SELECT id, CASE WHEN n >= 4 AND vx > 1e-12 THEN vxy / vx END AS beta, r0, greatest(r0 - vxy * vxy / vx, 0) AS r1, n FROM p),
    g AS (SELECT id, pow(2, beta) AS fc, n - 3 AS d2, CASE WHEN beta IS NULL THEN NULL WHEN r1 < 1e-12 THEN CASE WHEN r0 < 1e-12 THEN 0 ELSE 1e300 END ELSE (r0 - r1) / (r1 / (n - 3)) END AS f FROM t),
    v AS (SELECT id, fc, CASE d2 WHEN 1 THEN 1 - 2 / pi() * atan(sqrt(f)) WHEN 2 THEN 1 - sqrt(f / (2 + f)) WHEN 3 THEN 1 - 2 / pi() * (atan(sqrt(f / 3)) + sqrt(f / 3) / (1 + f / 3)) END AS pval FROM g),
    k AS (SELECT *, CASE WHEN pval IS NOT NULL THEN rank() OVER (ORDER BY pval) + count(*) OVER (PARTITION BY pval) - 1 END AS r, count(pval) OVER () AS m FROM v),
    q AS (SELECT id, fc, pval, CASE WHEN pval IS NOT NULL THEN least(1, min(pval * m / r) OVER (ORDER BY pval DESC NULLS LAST)) END AS qval FROM k)"""


def _test(level):
    return f"WITH {DGE.replace('KEY', level + '_id')}, {TESTED} SELECT '{level}' AS feature, id, round(CASE WHEN pval IS NOT NULL THEN fc END, 3) AS fc, round(pval, 4) AS pval, round(qval, 4) AS qval FROM q"


def _rounded_test(df):
    return df.withColumns({"fc": F.round(F.when(F.col("pval").isNotNull(), F.col("fc")), 3), "pval": F.round("pval", 4), "qval": F.round("qval", 4)})


@query(_test("transcript"))
def transcript_test(x):
    return expression.sort_by_p(_rounded_test(expression.dge_test(x.f_expression, x.f_samples, "transcript")))


@query(_test("gene"))
def gene_test(x):
    return _rounded_test(expression.dge_test(x.f_expression, x.f_samples, "gene"))


BH = """k AS (SELECT *, rank() OVER (ORDER BY pval) + count(*) OVER (PARTITION BY pval) - 1 AS r, count(*) OVER () AS m FROM f_pvalues), q AS (SELECT id, fc, pval, least(1, min(pval * m / r) OVER (ORDER BY pval DESC)) AS qval FROM k)"""


@query(f"WITH {BH} SELECT id, round(fc, 6) AS fc, pval, round(qval, 6) AS qval FROM q")
def adjusted_p(x):
    return expression.bh_adjust(x.f_pvalues)


@query("""SELECT id, round(log10(fc + 1), 6) AS a, round(log2(fc + 0.1), 6) AS m, pval < 0.05 AS significant FROM f_pvalues""")
def ma_points(x):
    return expression.ma_table(x.f_pvalues.withColumnRenamed("pval", "qval"))


@query("""SELECT count(*) FILTER (pval < 0.05) AS n_significant FROM f_pvalues""")
def significant_count(x):
    return expression.significant_count(x.f_pvalues.withColumnRenamed("pval", "qval"))


@query("""SELECT id, pval FROM f_pvalues WHERE pval < 0.05""")
def significant_rows(x):
    return expression.significant(x.f_pvalues, 0.05, "pval").select("id", "pval")


COUNTS = """c AS (SELECT fold, count(*) FILTER (y = 0 AND pred = 0) AS tn, count(*) FILTER (y = 0 AND pred = 1) AS fp, count(*) FILTER (y = 1 AND pred = 0) AS fn, count(*) FILTER (y = 1 AND pred = 1) AS tp FROM f_scores GROUP BY 1)"""
METRICS = """CAST(tp + tn AS double) / (tp + tn + fp + fn) AS accuracy, CASE WHEN tp + fp > 0 THEN CAST(tp AS double) / (tp + fp) ELSE 0 END AS "precision", CASE WHEN tp + fn > 0 THEN CAST(tp AS double) / (tp + fn) ELSE 0 END AS recall,
    CASE WHEN 2 * tp + fn + fp > 0 THEN 2.0 * tp / (2 * tp + fn + fp) ELSE 0 END AS f1, CASE WHEN 1.25 * tp + 0.25 * fn + fp > 0 THEN 1.25 * tp / (1.25 * tp + 0.25 * fn + fp) ELSE 0 END AS f1beta"""
NAMES = ["accuracy", "precision", "recall", "f1", "f1beta"]
ROUNDED = ", ".join(f'round("{c}", 6) AS "{c}"' for c in NAMES)


@query(f"WITH {COUNTS}, t AS (SELECT sum(tn) AS tn, sum(fp) AS fp, sum(fn) AS fn, sum(tp) AS tp FROM c), m AS (SELECT {METRICS} FROM t) SELECT {ROUNDED} FROM m")
def class_metrics(x):
    return evaluate.metrics(x.f_scores)


@query(f"WITH {COUNTS}, m AS (SELECT fold, tn, fp, fn, tp, {METRICS} FROM c) SELECT fold, tn, fp, fn, tp, {ROUNDED} FROM m")
def fold_metrics(x):
    return evaluate.cv_metrics(x.f_scores).drop("roc_auc")


@query(f"WITH {COUNTS}, m AS (SELECT fold, {METRICS} FROM c) " + " UNION ALL ".join(f"""SELECT '{c}' AS metric, round(avg("{c}"), 6) AS mean, round(stddev_samp("{c}"), 6) AS std FROM m""" for c in NAMES))
def fold_summaries(x):
    return evaluate.fold_summary(evaluate.metrics(x.f_scores, ["fold"]), NAMES)


STEPS = """g AS (SELECT score, count(*) FILTER (y = 1) AS p, count(*) FILTER (y = 0) AS n FROM f_scores GROUP BY 1), s AS (SELECT score, sum(p) OVER w AS tp, sum(n) OVER w AS fp, sum(p) OVER () AS pp, sum(n) OVER () AS nn FROM g WINDOW w AS (ORDER BY score DESC)),
    r AS (SELECT score, CAST(fp AS double) / nn AS fpr, CAST(tp AS double) / pp AS tpr, CAST(tp AS double) / (tp + fp) AS prec FROM s)"""


@query(f"WITH {STEPS} SELECT score AS threshold, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr FROM r UNION ALL SELECT CAST('inf' AS double), 0, 0")
def roc_points(x):
    return evaluate.roc_curve(x.f_scores)


@query("SELECT round((sum(CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0 END)) / count(*), 6) AS roc_auc FROM f_scores a, f_scores b WHERE a.y = 1 AND b.y = 0")
def roc_area(x):
    return evaluate.roc_auc(x.f_scores)


@query(f"WITH {STEPS} SELECT score AS threshold, round(tpr, 6) AS recall, round(prec, 6) AS \"precision\" FROM r UNION ALL SELECT NULL, 0, 1")
def pr_points(x):
    return evaluate.pr_curve(x.f_scores)


@query(f"WITH {STEPS} SELECT round(sum(a), 6) AS pr_auc FROM (SELECT (tpr - lag(tpr, 1, 0) OVER (ORDER BY score DESC)) * (prec + lag(prec, 1, 1) OVER (ORDER BY score DESC)) / 2 AS a FROM r)")
def pr_area(x):
    return evaluate.pr_auc(x.f_scores)


@query("SELECT CAST(y AS int) AS y, pred, count(*) AS n FROM f_scores GROUP BY 1, 2")
def confusion_matrix(x):
    return evaluate.confusion(x.f_scores)


@query("SELECT CAST(y AS int) AS y, pred, round(n / CAST(sum(n) OVER (PARTITION BY y) AS double), 6) AS share FROM (SELECT y, pred, count(*) AS n FROM f_scores GROUP BY 1, 2) c")
def confusion_shares(x):
    return evaluate.confusion(x.f_scores, normalize=True)


@query(f"""WITH {COUNTS}, m AS (SELECT fold AS model, CAST(tp + tn AS double) / (tp + tn + fp + fn) AS accuracy, (CAST(tp AS double) / (tp + fn) + CAST(tn AS double) / (tn + fp)) / 2 AS balanced_accuracy,
    ((tp + fn) * (2.0 * tp / (2 * tp + fp + fn)) + (tn + fp) * (2.0 * tn / (2 * tn + fn + fp))) / (tp + tn + fp + fn) AS f1_weighted, CAST(tp AS double) / (tp + fp) AS prec FROM c),
    a AS (SELECT a.fold, sum(CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0 END) / count(*) AS auc FROM f_scores a, f_scores b WHERE a.y = 1 AND b.y = 0 AND a.fold = b.fold GROUP BY 1)
    SELECT model, round(accuracy, 6) AS accuracy, round(balanced_accuracy, 6) AS balanced_accuracy, round(f1_weighted, 6) AS f1_weighted, round(prec, 6) AS "precision", round(auc, 6) AS roc_auc FROM m JOIN a ON model = a.fold""")
def model_comparison(x):
    return evaluate.compare_models(x.f_scores.withColumnRenamed("fold", "model"))


@query("SELECT count(*) FILTER (pred = 1) AS n_noncoding, count(*) FILTER (pred = 0) AS n_coding FROM f_scores")
def call_tally(x):
    return evaluate.tally(x.f_scores)


@query("SELECT doc_id, score FROM f_scores WHERE score > 0.9 AND pred = 1")
def confident_calls(x):
    return evaluate.high_confidence(x.f_scores).select("doc_id", "score")


@query("SELECT transcript_id, round(mean_price, 6) AS mean_price FROM f_features ORDER BY mean_price DESC NULLS LAST, transcript_id LIMIT 25")
def top_features(x):
    return evaluate.top_n(x.f_features, "mean_price", 25, "transcript_id").select("transcript_id", "mean_price")


@query("SELECT transcript_id, length FROM f_features")
def sorted_features(x):
    return evaluate.sort_by_id(x.f_features).select("transcript_id", "length")


@query("""SELECT trial, value, round((SELECT regr_slope(p_retailprice, p_partkey) FROM part), 6) AS slope, round(CASE WHEN count(*) OVER w = 10 THEN avg(value) OVER w END, 5) AS rolling
    FROM (SELECT p_partkey AS trial, CAST(p_retailprice AS double) AS value FROM part) WINDOW w AS (ORDER BY trial ROWS BETWEEN 5 PRECEDING AND 4 FOLLOWING)""")
def trial_convergence(x):
    return evaluate.convergence(x.sql("SELECT p_partkey AS trial, CAST(p_retailprice AS double) AS value FROM part")).withColumn("rolling", F.round("rolling", 5))


@query("SELECT p_type AS feature, round(var_pop(p_retailprice), 4) AS variance, round(avg(p_retailprice), 6) AS mean FROM part GROUP BY 1")
def importance_spread(x):
    rows = x.sql("SELECT p_type AS feature, CAST(p_retailprice AS double) AS importance FROM part")
    return evaluate.importance_stability(rows).withColumn("variance", F.round("variance", 4))


@query("""SELECT feature FROM (SELECT 'twice' AS feature, corr(mean_price, 2 * mean_price + 1) AS r FROM f_features UNION ALL SELECT 'max_qty', corr(mean_price, max_qty) FROM f_features) WHERE abs(r) > 0.95""")
def correlated_columns(x):
    return evaluate.correlated_features(x.f_features.withColumn("twice", 2 * F.col("mean_price") + 1), ["mean_price", "twice", "max_qty"])


CUTS = {"max_qty": [10.0, 20.0, 30.0, 40.0], "length": [2.0, 4.0, 6.0]}
TERM_ROWS = [("max_qty", "max_qty", b, None, None, 0.3 * b - 0.5) for b in range(5)] + [("length", "length", b, None, None, 0.7 - 0.4 * b) for b in range(4)]
TERM_ROWS += [("max_qty & length", "max_qty", a, "length", b, 0.05 * a - 0.03 * b) for a in range(5) for b in range(4)]
BINS = """b AS (SELECT transcript_id, CASE WHEN max_qty >= 40 THEN 4 WHEN max_qty >= 30 THEN 3 WHEN max_qty >= 20 THEN 2 WHEN max_qty >= 10 THEN 1 ELSE 0 END AS q,
    CASE WHEN length >= 6 THEN 3 WHEN length >= 4 THEN 2 WHEN length >= 2 THEN 1 ELSE 0 END AS l FROM f_features),
    e AS (SELECT transcript_id, 'max_qty' AS term, 0.3 * q - 0.5 AS contribution FROM b UNION ALL SELECT transcript_id, 'length', 0.7 - 0.4 * l FROM b UNION ALL SELECT transcript_id, 'max_qty & length', 0.05 * q - 0.03 * l FROM b)"""


def _terms(x):
    return x.spark.createDataFrame(TERM_ROWS, models.TERMS)


@query(f"WITH {BINS} SELECT transcript_id, term, round(CAST(contribution AS double), 6) AS contribution FROM e")
def row_contributions(x):
    return models.explain_rows(x.f_features, _terms(x), CUTS)


@query(f"""WITH {BINS}, s AS (SELECT transcript_id, CAST(sum(contribution) AS double) + 0.1034567 AS score FROM e GROUP BY 1) SELECT transcript_id, round(score, 6) AS score, round(1 / (1 + exp(-score)), 6) AS prob,
    CASE WHEN score >= 0 THEN 1 ELSE 0 END AS pred FROM s""")
def additive_scores(x):
    return models.score_additive(x.f_features, _terms(x), CUTS, 0.1034567)


@query(f"""WITH {BINS}, i AS (SELECT term, avg(abs(CAST(contribution AS double))) AS importance FROM e GROUP BY 1) SELECT term, round(importance, 6) AS importance, round(100 * importance / sum(importance) OVER (), 6) AS percent,
    CAST(row_number() OVER (ORDER BY importance DESC, term) AS int) AS rank, round(sum(100 * importance) OVER (ORDER BY importance DESC, term) / sum(importance) OVER (), 6) AS cumulative FROM i""")
def term_importance(x):
    return models.importance(models.explain_rows(x.f_features, _terms(x), CUTS))


def _split(x):
    from txspark.operators.splits import stratified_split

    # a fit reads its rows many times: they are derived from the tables once
    rows = stored(stratified_split(stored(x.f_features.na.fill(0.0), "features"), "y"), "split")
    return [rows.where(F.col("split") == s).drop("split") for s in ("train", "validation", "test")]


@query()
def trained_models(x):
    train, _, test = _split(x)
    rows = [(kind, *[float(models.evaluate(models.train(train, kind, FEATURES, params=p), test, FEATURES)[m]) for m in ("accuracy", "f1", "roc_auc")]) for kind, p in (("random_forest", {"numTrees": 8, "maxDepth": 4}), ("boosted_trees", {"maxIter": 4}), ("additive", {}))]
    return x.spark.createDataFrame(rows, "kind string, accuracy double, f1 double, roc_auc double")


@query()
def parameter_search(x):
    train, validation, _ = _split(x)
    return models.search(train, validation, "random_forest", FEATURES, {"numTrees": [3, 5], "maxDepth": [2, 3]}, ("accuracy", "roc_auc"), 2)


@query()
def transcript_calls(x):
    train, _, _ = _split(x)
    names = ["mean_price", "max_qty", "length"]
    model = models.train(train, "random_forest", names, params={"numTrees": 5, "maxDepth": 3})
    annotation = x.f_intervals.withColumn("feature", F.lit("transcript"))
    track = x.f_features.select("transcript_id", "mean_price", "max_qty")
    from txspark.operators.expression import fpkm_summary

    return models.call_transcripts(annotation, model, {n: "double" for n in names}, track, expression=fpkm_summary(x.f_expression))


CALLS = """a AS (SELECT i.transcript_id, "end" - start AS length, max_qty, entries_tfbs FROM f_intervals i JOIN f_features f ON i.transcript_id = f.transcript_id JOIN f_lists l ON i.transcript_id = l.transcript_id),
    d AS (SELECT min(transcript_id) AS transcript_id, length, max_qty, entries_tfbs FROM a GROUP BY length, max_qty, entries_tfbs),
    s AS (SELECT transcript_id, 0.05 + CASE WHEN max_qty >= 40 THEN 0.7 WHEN max_qty >= 20 THEN 0.1 ELSE -0.5 END + CASE WHEN length >= 15 THEN -0.3 ELSE 0.2 END
        + CASE WHEN list_contains(string_split(entries_tfbs, ','), 'brand#11') THEN 0.9 ELSE -0.15 END AS score FROM d)"""


@query(f"""WITH {CALLS} SELECT s.transcript_id, CASE WHEN score >= 0 THEN 1 ELSE 0 END AS prediction, round(CAST(1 / (1 + exp(-score)) AS double), 6) AS prob_lncrna, round(CAST(1 - 1 / (1 + exp(-score)) AS double), 6) AS prob_coding,
    chromosome, start, "end", strand FROM s JOIN f_intervals i ON s.transcript_id = i.transcript_id""")
def additive_calls(x):
    """A model that knows one token of a comma list."""
    rows = [("max_qty", "max_qty", b, None, None, v) for b, v in enumerate((-0.5, 0.1, 0.7))] + [("length", "length", b, None, None, v) for b, v in enumerate((0.2, -0.3))]
    rows += [("tfbs_brand_11", "tfbs_brand_11", b, None, None, v) for b, v in enumerate((-0.15, 0.9))]
    model = models.Additive(x.spark.createDataFrame(rows, models.TERMS), {"max_qty": [20.0, 40.0], "length": [15.0], "tfbs_brand_11": [0.5]}, 0.05)
    schema = {"length": "long", "max_qty": "double", "tfbs_brand_11": "boolean"}
    track = x.f_features.select("transcript_id", "max_qty").join(x.f_lists, "transcript_id")
    return models.call_transcripts(x.f_intervals.withColumn("feature", F.lit("transcript")), model, schema, track)


RAW = """SELECT chromosome, 'transcript' AS feature, transcript_id, start, "end", strand FROM f_intervals
    UNION ALL SELECT chromosome, 'exon', transcript_id, start % 97, start % 97 + 20 + start % 30, strand FROM f_intervals"""
GENOME = """SELECT concat('chr', substr(transcript_id, 2)) AS chromosome, concat(replace(sequence, 'N', 'A'), repeat('ACGGTTCA', 20)) AS sequence FROM f_sequences"""
FOLDING = """SELECT concat('T', o_orderkey) AS transcript_id, CAST(-o_orderkey AS double) / 1000 AS mfe FROM orders"""


@query(f"""WITH {PLAIN}, {SITES}, k AS (SELECT DISTINCT concat('chr', substr(transcript_id, 2)) AS chromosome FROM f_sequences),
    s AS (SELECT i.*, 0.13 + CASE WHEN coalesce(mean, 0) >= 0.0512345 THEN 0.41 ELSE -0.32 END + CASE WHEN list_contains(string_split(coalesce(names, ''), ','), 'E3') THEN 0.83 ELSE -0.21 END
        + CASE WHEN i."end" - i.start >= 15 THEN -0.27 ELSE 0.19 END + CASE WHEN mfe >= -5 THEN 0.16 ELSE -0.11 END AS score
        FROM f_intervals i JOIN k ON i.chromosome = k.chromosome JOIN ({FOLDING}) f ON i.transcript_id = f.transcript_id AND mfe < 0 LEFT JOIN a ON i.transcript_id = a.transcript_id LEFT JOIN n ON i.transcript_id = n.transcript_id),
    e AS (SELECT transcript_id, avg(fpkm) AS fpkm_mean, stddev_pop(fpkm) AS fpkm_std FROM f_expression GROUP BY 1)
    SELECT s.transcript_id, CASE WHEN score >= 0 THEN 1 ELSE 0 END AS prediction, round(CAST(1 / (1 + exp(-score)) AS double), 6) AS prob_lncrna, round(CAST(1 - 1 / (1 + exp(-score)) AS double), 6) AS prob_coding,
    chromosome, start, "end", strand, round(fpkm_mean, 6) AS fpkm_mean, round(fpkm_std, 5) AS fpkm_std FROM s LEFT JOIN e ON s.transcript_id = e.transcript_id""")
def annotation_calls(x):
    """From annotation, genome, tracks, folding energies and expression to enriched calls: intervals are queried on both tracks, exons are spliced, k-mers of 3 to 12 are
    counted and reduced, all parts are assembled, cleaned (an energy that is not negative drops its row) and brought to the model's schema, and an additive model scores them."""
    bins = lambda name, *scores: [(name, name, b, None, None, v) for b, v in enumerate(scores)]
    terms = bins("mean_signal", -0.32, 0.41) + bins("tfbs_e3", -0.21, 0.83) + bins("length", 0.19, -0.27) + bins("ss_mfe", -0.11, 0.16)
    model = models.Additive(x.spark.createDataFrame(terms, models.TERMS), {"mean_signal": [0.0512345], "tfbs_e3": [0.5], "length": [15.0], "ss_mfe": [-5.0]}, 0.13)
    schema = {"mean_signal": "double", "tfbs_e3": "boolean", "length": "long", "ss_mfe": "double"} | {f"{k}mer_svd1": "double" for k in range(3, 13)}
    spec = [{"path": "signal", "stat": "mean", "name": "mean_signal"}, {"path": "sites", "stat": "extract_names", "name": "entries_tfbs", "name_field_index": 3}]
    summary = expression.fpkm_summary(x.f_expression).withColumn("fpkm_std", F.round("fpkm_std", 5))
    return models.call_annotation(x.sql(RAW), x.sql(GENOME), spec, {"signal": ("signal", x.f_signal), "sites": ("entry", x.f_entries)}, model, schema, structure=x.sql(FOLDING), expression=summary)


@query()
def refitted_trials(x):
    train, validation, test = _split(x)
    trials = models.search(train, validation, "random_forest", FEATURES, {"numTrees": [3, 5], "maxDepth": [2, 3]}, ("accuracy",), 2)
    rows = [(trial, float(m["accuracy"]), float(m["f1"]), float(m["roc_auc"])) for trial, m in models.refit_top(trials, 1, train, test, "random_forest", FEATURES)]
    return x.spark.createDataFrame(rows, "trial int, accuracy double, f1 double, roc_auc double")
