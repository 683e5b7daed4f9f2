"""Assembly, cleaning, encoding, scaling, splits and the schema contract."""

from __future__ import annotations

from pyspark.sql import functions as F

from txspark.operators import assembly, cleaning, encoding, expression, scaling, schema, splits
from txspark.plans.registry import query
from txspark.session import work_folder
from txspark.sources.writers import resume, resume_changed

NUMERIC = ["mean_price", "max_qty", "sum_tax", "length"]


@query("""SELECT i.transcript_id, "end" - start AS length, round(mean_price, 6) AS mean_price, max_qty, round(ss_mfe, 6) AS ss_mfe, entries_tfbs FROM f_intervals i JOIN f_features f ON i.transcript_id = f.transcript_id
    JOIN f_lists l ON i.transcript_id = l.transcript_id""")
def assembled_features(x):
    track = x.f_features.select("transcript_id", F.col("mean_price").alias("MEAN_price"), "max_qty", F.lit(1).alias("bed_x"), F.lit(0).alias("LENGTH"))
    structure = x.f_features.select("transcript_id", F.col("ss_mfe").alias("mfe"))
    return assembly.assemble_features(x.f_intervals, track, structure, x.f_lists)


@query("""SELECT transcript_id, round(mean_price, 6) AS mean_price, round(ss_mfe, 6) AS ss_mfe, "end" - start AS length FROM f_features JOIN f_intervals USING (transcript_id)""")
def feature_projection(x):
    rows = x.f_features.select("transcript_id", "mean_price", "ss_mfe", F.lit("(.)").alias("ss_structure")).join(x.f_intervals.select("transcript_id", "chromosome", "start", "end"), "transcript_id")
    return assembly.drop_non_features(assembly.add_length(rows))


@query("""SELECT f.transcript_id, y, chromosome, start, "end", strand, round(m, 6) AS fpkm_mean, round(s, 6) AS fpkm_std, fc AS dge_fc, pval AS dge_pval, CASE WHEN pval < 0.75 THEN pval + 0.25 WHEN pval >= 0.75 THEN 1 END AS dge_qval
    FROM f_features f LEFT JOIN f_intervals i ON f.transcript_id = i.transcript_id LEFT JOIN (SELECT transcript_id, avg(fpkm) AS m, stddev_pop(fpkm) AS s FROM f_expression GROUP BY 1) e
    ON f.transcript_id = e.transcript_id LEFT JOIN f_pvalues p ON f.transcript_id = p.id""")
def enriched_calls(x):
    calls = assembly.attach_metadata(x.f_features.select("transcript_id", "y"), x.f_intervals)
    dge = x.f_pvalues.select(F.col("id").alias("transcript_id"), "fc", "pval", F.least(F.lit(1.0), F.col("pval") + 0.25).alias("qval"))
    return assembly.attach_dge(assembly.attach_expression(calls, expression.fpkm_summary(x.f_expression)), dge)


@query("""SELECT transcript_id, min(start) AS start FROM (SELECT transcript_id, start FROM f_annotation) GROUP BY 1""")
def first_records(x):
    return assembly.first_by_id(x.f_annotation, ["start", "end"]).select("transcript_id", "start")


@query("""SELECT transcript_id, round(mean_price, 6) AS mean_price, max_qty, round(coalesce(sum_tax, 0), 6) AS sum_tax, round(ss_mfe, 6) AS ss_mfe, length, y, coalesce(entries_tfbs, '') AS entries_tfbs
    FROM f_features LEFT JOIN (SELECT * FROM f_lists WHERE length(entries_tfbs) > 12) l USING (transcript_id) WHERE ss_mfe IS NOT NULL AND ss_mfe < 0""")
def missing_values(x):
    lists = x.f_lists.where("length(entries_tfbs) > 12")
    return cleaning.handle_missing(x.f_features.join(lists, "transcript_id", "left"))


@query("""SELECT transcript_id, entries_tfbs AS entries_epdnew FROM f_lists""")
def promoter_names(x):
    marked = x.f_lists.select("transcript_id", F.concat(F.regexp_replace("entries_tfbs", ",", "_3 , ,"), F.lit("_12,")).alias("entries_epdnew"))
    return cleaning.clean_promoters(marked)


@query("""SELECT transcript_id, y, round(mean_price, 6) AS a_mean_price, max_qty AS b FROM f_features""")
def column_names(x):
    rows = x.f_features.select("y", F.col("max_qty").alias("B"), F.col("mean_price").alias("A  mean--price_"), "transcript_id")
    return cleaning.canonical_columns(cleaning.sanitize_columns(rows), "y")


@query("""SELECT transcript_id, length % 2 = 1 AS y, length AS z FROM f_features""")
def boolean_labels(x):
    rows = x.f_features.select("transcript_id", (F.col("length") % 2).alias("y"), F.col("length").alias("z"), "max_qty")
    return cleaning.drop_features([cleaning.boolean_label(cleaning.boolean_label(rows, "y"), "z")], ["max_qty", "absent"])[0]


@query("""SELECT max_qty, length, first.transcript_id AS transcript_id, first.y AS y FROM (SELECT max_qty, length, min(struct_pack(transcript_id := transcript_id, y := y)) AS first FROM f_features GROUP BY 1, 2)""")
def distinct_features(x):
    return cleaning.dedup_rows(x.f_features.select("transcript_id", "max_qty", "length", "y"), "y")


@query("""SELECT transcript_id, length, y FROM f_features""")
def labelled_union(x):
    rows = x.f_features.select("length", "transcript_id", "y")
    return cleaning.union_labelled(rows.where("y").drop("y"), rows.where("NOT y").drop("y").select("transcript_id", "length"))


BRANDS = [f"brand#{i}{j}" for i in range(1, 6) for j in range(1, 6)]


@query("SELECT transcript_id, t AS token, list_contains(string_split(entries_tfbs, ','), t) AS held FROM f_lists, (SELECT DISTINCT lower(p_brand) AS t FROM part JOIN lineitem ON l_partkey = p_partkey) v")
def multi_hot(x):
    wide = encoding.multi_hot(x.f_lists, ["entries_tfbs"])
    long = wide.unpivot("transcript_id", [c for c in wide.columns if c != "transcript_id"], "name", "held")
    return long.select("transcript_id", F.regexp_replace("name", "^tfbs_", "").alias("token"), "held")


@query("""SELECT transcript_id, length > 3 AS b_other, length > 2 AS "merged_x", length > 4 AS a_other FROM f_features""")
def merged_columns(x):
    n = F.col("length")
    rows = x.f_features.select("transcript_id", (n > 2).alias("a_x"), (n > 2).alias("b_x"), (n > 4).alias("a_other"), (n > 3).alias("b_other"))
    return encoding.merge_agreeing(rows, ["a_x", "b_x", "a_other", "b_other"])


@query("SELECT transcript_id, y, " + ", ".join(f"round((CAST({c} AS double) - (SELECT avg({c}) FROM f_features)) / (SELECT stddev_pop({c}) FROM f_features), 5) AS {c}" for c in NUMERIC) + " FROM f_features")
def scaled_standard(x):
    rows = x.f_features.drop("ss_mfe")
    out = scaling.apply_scaler(rows, scaling.fit_scaler(rows, "standard", "y"))
    return out.select("transcript_id", "y", *[F.round(c, 5).alias(c) for c in NUMERIC])


@query("SELECT transcript_id, y, " + ", ".join(f"round((CAST({c} AS double) - (SELECT min({c}) FROM f_features)) / (SELECT CAST(max({c}) - min({c}) AS double) FROM f_features), 6) AS {c}" for c in NUMERIC) + " FROM f_features")
def scaled_minmax(x):
    rows = x.f_features.drop("ss_mfe")
    return scaling.apply_scaler(rows, scaling.fit_scaler(rows, "minmax", "y"))


SPLIT = """r AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY md5(concat('99:', transcript_id)), transcript_id) AS r, count(*) OVER (PARTITION BY y) AS n FROM f_features),
    s AS (SELECT *, CASE WHEN r <= round(n * 0.7) THEN 'train' WHEN r <= round(n * (0.7 + 0.15)) THEN 'validation' ELSE 'test' END AS split FROM r)"""


@query(f"WITH {SPLIT} SELECT transcript_id, y, split FROM s")
def stratified_split(x):
    return splits.stratified_split(x.f_features.select("transcript_id", "y"), "y")


@query(f"""WITH {SPLIT}, c AS (SELECT split, CAST(y AS varchar) AS label, count(*) AS n FROM s GROUP BY 1, 2) SELECT split, label, n, round(n / CAST(sum(n) OVER (PARTITION BY split) AS double), 4) AS share FROM c""")
def label_shares(x):
    return splits.label_distribution(splits.stratified_split(x.f_features.select("transcript_id", "y"), "y"), "y", "split")


@query(f"""WITH {SPLIT}, t AS (SELECT avg(mean_price) AS m, stddev_pop(mean_price) AS d FROM s WHERE split = 'train') SELECT transcript_id, split, round((mean_price - m) / d, 5) AS mean_price FROM s, t""")
def scaled_splits(x):
    rows = splits.stratified_split(x.f_features.select("transcript_id", "y", "mean_price"), "y")
    out, _ = scaling.scale_splits(rows, "standard", "y")
    return out.select("transcript_id", "split", F.round("mean_price", 5).alias("mean_price"))


PROFILE = " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, count(*) - count({c}) AS null_count, round(100.0 * (count(*) - count({c})) / count(*), 6) AS null_percent, round(CAST(min({c}) AS double), 6) AS min, round(CAST(max({c}) AS double), 6) AS max,
    round(avg({c}), 5) AS mean, round(stddev_samp({c}), 5) AS std, round(quantile_cont(CAST({c} AS double), 0.05), 6) AS p05, round(quantile_cont(CAST({c} AS double), 0.25), 6) AS p25, round(median(CAST({c} AS double)), 6) AS median,
    round(quantile_cont(CAST({c} AS double), 0.75), 6) AS p75, round(quantile_cont(CAST({c} AS double), 0.95), 6) AS p95 FROM f_features"""
    for c in (*NUMERIC, "ss_mfe")
)


@query(PROFILE)
def feature_profile(x):
    out = schema.profile(x.f_features).where("type = 'continuous'").drop("type", "n_distinct", "percent_true")
    return out.withColumns({c: F.round(c, 5) for c in ("mean", "std")})


@query("""SELECT 'y' AS feature, CAST(y AS varchar) AS value, count(*) AS n FROM f_features GROUP BY 1, 2""")
def nominal_counts(x):
    return schema.value_counts(x.f_features, ["y"])


@query()
def profile_by_sketch(x):
    return schema.profile(x.f_features, approximate=True)


@query("""SELECT * FROM (VALUES ('gone', 'missing', 'double', NULL), ('length', 'dtype', 'string', 'long'), ('ss_mfe', 'extra', NULL, 'double'), ('y', 'extra', NULL, 'boolean')) t(feature, issue, expected, actual) WHERE (SELECT count(*) FROM f_features) > 0""")
def schema_difference(x):
    return schema.schema_diff(x.f_features, {"gone": "double", "length": "string", "mean_price": "float", "max_qty": "double", "sum_tax": "double"})


@query("""SELECT transcript_id, CAST(length AS double) AS length, FALSE AS flag, CAST(0 AS double) AS gone, '' AS word, round(mean_price, 6) AS mean_price FROM f_features""")
def schema_enforced(x):
    return schema.enforce_schema(x.f_features, {"length": "double", "flag": "boolean", "gone": "double", "word": "string", "mean_price": "double"})


@query("""SELECT 'ss_mfe' AS feature, 'null' AS "check", 'WARNING' AS level, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM f_features), 6) AS percent FROM f_features WHERE ss_mfe IS NULL
    UNION ALL SELECT 'sum_tax', 'null', 'WARNING', count(*), round(100.0 * count(*) / (SELECT count(*) FROM f_features), 6) FROM f_features WHERE sum_tax IS NULL HAVING count(*) > 0
    UNION ALL SELECT 'max_qty', 'range', 'WARNING', count(*), round(100.0 * count(*) / (SELECT count(max_qty) FROM f_features), 6) FROM f_features WHERE max_qty < 8 OR max_qty > 42 HAVING count(*) > 0
    UNION ALL SELECT 'length', 'boolean', 'ERROR', count(*), round(100.0 * count(*) / (SELECT count(length) FROM f_features), 6) FROM f_features WHERE length NOT IN (0, 1)
    UNION ALL SELECT 'length', 'dtype', 'WARNING', NULL, NULL""")
def schema_validation(x):
    wanted = {"mean_price": "double", "max_qty": "double", "sum_tax": "double", "ss_mfe": "double", "length": "boolean", "y": "boolean"}
    issues, _ = schema.validate(x.f_features, wanted, schema.Mode.PERMISSIVE, {"max_qty": (11.0, 39.0 + 1 / 3)}, tolerance=3 / (28 + 1 / 3))
    return issues.drop("detail")


@query("""SELECT transcript_id, CAST(l AS bigint) AS length FROM (SELECT transcript_id, CAST(length AS varchar) AS l FROM f_features)""")
def schema_coerced(x):
    rows = x.f_features.select("transcript_id", F.col("length").cast("string").alias("length"))
    return schema.validate(rows, {"length": "long"}, schema.Mode.COERCE)[1]


@query("""SELECT transcript_id, length, CASE WHEN length % 2 = 0 THEN length * 10 ELSE length END AS value FROM f_features""")
def resumed_work(x):
    inputs = x.f_features.select("transcript_id", "length")
    done = inputs.where("length % 3 > 0").withColumn("value", F.when(F.col("length") % 2 == 0, F.col("length") * 10).when(F.col("length") % 5 > 0, F.col("length")))
    compute = lambda df: df.withColumn("value", F.when(F.col("length") % 2 == 0, F.col("length") * 10).otherwise(F.col("length")))
    return resume(inputs, done, "transcript_id", compute, ["value"])


@query("""SELECT transcript_id, CASE WHEN length % 3 = 0 THEN length + 1000 ELSE length END AS length, CASE WHEN length % 3 = 0 OR mod(CAST(substr(transcript_id, 2) AS bigint), 7) = 0 THEN 2 ELSE 1 END AS run FROM f_features""")
def changed_rows(x):
    """A second run over a table computes again only the rows whose content has changed, and those that are new."""
    folder = work_folder(x.spark, "changed")
    second = x.f_features.select("transcript_id", F.when(F.col("length") % 3 == 0, F.col("length") + 1000).otherwise(F.col("length")).alias("length"))
    first = x.f_features.select("transcript_id", "length").where("CAST(substr(transcript_id, 2) AS bigint) % 7 > 0")
    for run, rows in ((1, first), (2, second)):
        out = resume_changed(rows, folder, "transcript_id", lambda df, run=run: df.withColumn("run", F.lit(run)), ["length"], batches=2)
    return out
