"""Intervals and tracks."""

from __future__ import annotations

from pyspark.sql import functions as F

from txspark.functions.scalars import normalize_chrom
from txspark.operators import intervals, tracks
from txspark.plans.registry import query
from txspark.sources.readers import parse_intervals

#: Fixture days are few bases: bins of a few intervals.
BIN = 16


@query("""SELECT i.chromosome, transcript_id, strand,
    CASE WHEN greatest(start - 40, 0) < least("end" + 25, coalesce(length, "end" + 25)) THEN greatest(start - 40, 0) ELSE start END AS start,
    CASE WHEN greatest(start - 40, 0) < least("end" + 25, coalesce(length, "end" + 25)) THEN least("end" + 25, coalesce(length, "end" + 25)) ELSE "end" END AS "end"
    FROM f_intervals i LEFT JOIN f_sizes s ON i.chromosome = s.chromosome""")
def interval_expand(x):
    return intervals.expand_intervals(x.f_intervals, 40, 25, x.f_sizes)


@query("""SELECT i.chromosome, transcript_id, strand, greatest(start, 0) AS start, least("end", length) AS "end" FROM f_intervals i JOIN f_sizes s ON i.chromosome = s.chromosome
    WHERE greatest(start, 0) < least("end", length)""")
def interval_clip(x):
    return intervals.clip_intervals(x.f_intervals, x.f_sizes)


@query("""SELECT a.chromosome, a.start, a."end", transcript_id, strand, b.start AS b_start, b."end" AS b_end, round(b.value, 6) AS b_value
    FROM f_intervals a JOIN f_signal b ON a.chromosome = b.chromosome AND a.start < b."end" AND b.start < a."end" """)
def overlap_pairs(x):
    return intervals.overlap_join(x.f_intervals, x.f_signal, BIN)


SIGNAL = """q AS (SELECT DISTINCT i.chromosome, start, "end", least("end", length) AS e FROM f_intervals i JOIN f_sizes s ON i.chromosome = s.chromosome WHERE start < least("end", length)),
    p AS (SELECT q.chromosome, q.start, q."end", q.e - q.start AS len, value AS v, least(q.e, b."end") - greatest(q.start, b.start) AS w FROM q JOIN f_signal b
        ON q.chromosome = b.chromosome AND q.start < b."end" AND b.start < q.e),
    a AS (SELECT chromosome, start, "end", sum(v * w) / sum(w) AS mean, max(v) AS max, min(v) AS min, sum(v * w) AS sum, sum(w) / CAST(max(len) AS double) AS coverage,
        CASE WHEN sum(w) > 1 THEN sqrt(greatest((sum(v * v * w) - sum(v * w) * sum(v * w) / sum(w)) / (sum(w) - 1), 0)) ELSE 0 END AS std FROM p GROUP BY 1, 2, 3)"""


@query(f"""WITH {SIGNAL} SELECT i.*, round(mean, 6) AS mean, round(max, 6) AS max, round(min, 6) AS min, round(sum, 6) AS sum, round(coverage, 6) AS coverage, round(std, 5) AS std
    FROM f_intervals i LEFT JOIN a ON i.chromosome = a.chromosome AND i.start = a.start AND i."end" = a."end" """)
def signal_statistics(x):
    return tracks.signal_stats(x.f_intervals, x.f_signal, sizes=x.f_sizes, bin_size=BIN).withColumn("std", F.round("std", 5))


ENTRY = """q AS (SELECT DISTINCT i.chromosome, start, "end", least("end", length) AS e FROM f_intervals i JOIN f_sizes s ON i.chromosome = s.chromosome WHERE start < least("end", length)),
    p AS (SELECT q.chromosome, q.start, q."end", q.e, unnest(range(greatest(q.start, b.start), least(q.e, b."end"))) AS base FROM q JOIN f_entries b
        ON q.chromosome = b.chromosome AND q.start < b."end" AND b.start < q.e),
    d AS (SELECT chromosome, start, "end", base, count(*) AS depth FROM p GROUP BY ALL),
    a AS (SELECT chromosome, start, "end", count(*) AS bases, sum(depth) AS total, min(depth) AS low, max(depth) AS high FROM d GROUP BY ALL),
    r AS (SELECT q.chromosome, q.start, q."end", round(coalesce(bases, 0) / CAST(e - q.start AS double), 6) AS coverage, CAST(coalesce(total, 0) AS double) AS depth_sum,
        round(coalesce(CAST(total AS double) / bases, 0), 6) AS depth_mean, CAST(coalesce(low, 0) AS double) AS depth_min, CAST(coalesce(high, 0) AS double) AS depth_max
        FROM q LEFT JOIN a ON q.chromosome = a.chromosome AND q.start = a.start AND q."end" = a."end")"""


@query(f"""WITH {ENTRY} SELECT i.*, r.coverage, depth_sum, depth_mean, depth_min, depth_max FROM f_intervals i LEFT JOIN r ON i.chromosome = r.chromosome AND i.start = r.start AND i."end" = r."end" """)
def entry_depth(x):
    return tracks.entry_stats(x.f_intervals, x.f_entries, x.f_sizes, BIN)


@query(f"""WITH {ENTRY} SELECT i.*, r.coverage FROM f_intervals i LEFT JOIN r ON i.chromosome = r.chromosome AND i.start = r.start AND i."end" = r."end" """)
def entry_coverage(x):
    return tracks.entry_coverage(x.f_intervals, x.f_entries, x.f_sizes, BIN)


NAMES = """n AS (SELECT i.chromosome, i.start, i."end", transcript_id, string_agg(DISTINCT split_part(rest, chr(9), 4), ',' ORDER BY split_part(rest, chr(9), 4)) AS names FROM f_intervals i JOIN f_entries b
    ON i.chromosome = b.chromosome AND i.start < b."end" AND b.start < i."end" WHERE split_part(rest, chr(9), 4) NOT IN ('', '.') GROUP BY ALL)"""


@query(f"""WITH {NAMES} SELECT i.*, names FROM f_intervals i LEFT JOIN n ON i.transcript_id = n.transcript_id""")
def entry_name_lists(x):
    return tracks.entry_names(x.f_intervals, x.f_entries, 3, bin_size=BIN)


PLAIN = """p AS (SELECT i.chromosome, i.start, i."end", transcript_id, value AS v, least(i."end", b."end") - greatest(i.start, b.start) AS w FROM f_intervals i JOIN f_signal b
    ON i.chromosome = b.chromosome AND i.start < b."end" AND b.start < i."end"),
    a AS (SELECT transcript_id, sum(v * w) / sum(w) AS mean, max(v) AS high, sum(w) / CAST(max("end" - start) AS double) AS coverage FROM p GROUP BY ALL)"""


@query(f"""WITH {PLAIN}, {NAMES} SELECT i.*, round(mean, 6) AS mean_signal, round(high, 6) AS max_signal, round(coverage, 6) AS cov_signal, names AS entries_names
    FROM f_intervals i LEFT JOIN a ON i.transcript_id = a.transcript_id LEFT JOIN n ON i.transcript_id = n.transcript_id""")
def interval_profile(x):
    spec = [{"path": "s", "stat": s, "name": n} for s, n in (("mean", "mean_signal"), ("max", "max_signal"), ("coverage", "cov_signal"))]
    spec.append({"path": "e", "stat": "extract_names", "name": "entries_names", "name_field_index": 3})
    return tracks.query_tracks(x.f_intervals, spec, {"s": ("signal", x.f_signal), "e": ("entry", x.f_entries)}, bin_size=BIN)


WIDE = """w AS (SELECT i.*, greatest(start - 20, 0) AS s, least("end" + 5, coalesce(length, "end" + 5)) AS e0 FROM f_intervals i LEFT JOIN f_sizes z ON i.chromosome = z.chromosome),
    u AS (SELECT chromosome, start, "end", transcript_id, strand, CASE WHEN s < e0 THEN s ELSE start END AS s, CASE WHEN s < e0 THEN e0 ELSE "end" END AS e FROM w),
    c AS (SELECT u.*, least(u.e, z.length) AS ce FROM u JOIN f_sizes z ON u.chromosome = z.chromosome WHERE u.s < least(u.e, z.length)),
    m AS (SELECT transcript_id, sum(value * (least(ce, b."end") - greatest(s, b.start))) AS total FROM c JOIN f_signal b ON c.chromosome = b.chromosome AND s < b."end" AND b.start < ce GROUP BY ALL),
    k AS (SELECT transcript_id, max(depth) AS high FROM (SELECT transcript_id, base, count(*) AS depth FROM (SELECT transcript_id, unnest(range(greatest(s, b.start), least(ce, b."end"))) AS base
        FROM c JOIN f_entries b ON c.chromosome = b.chromosome AND s < b."end" AND b.start < ce) GROUP BY ALL) GROUP BY ALL)"""


@query(f"""WITH {WIDE} SELECT i.*, round(total, 6) AS sum_signal, CASE WHEN c.transcript_id IS NULL THEN NULL ELSE CAST(coalesce(high, 0) AS double) END AS max_entries, CAST(NULL AS varchar) AS names_of_signal, CAST(NULL AS double) AS mean_absent
    FROM f_intervals i LEFT JOIN c ON i.transcript_id = c.transcript_id LEFT JOIN m ON i.transcript_id = m.transcript_id LEFT JOIN k ON i.transcript_id = k.transcript_id""")
def track_query_expanded(x):
    rows = [("s", "sum", "sum_signal"), ("e", "max", "max_entries"), ("s", "extract_names", "names_of_signal"), ("gone", "mean", "mean_absent")]
    spec = [{"path": p, "stat": s, "name": n, "upstream": 20, "downstream": 5} for p, s, n in rows]
    return tracks.query_tracks(x.f_intervals, spec, {"s": ("signal", x.f_signal), "e": ("entry", x.f_entries)}, x.f_sizes, BIN)


@query("""SELECT CASE WHEN n_name LIKE 'chr%' THEN n_name ELSE concat('chr', n_name) END AS chromosome, c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def chromosome_names(x):
    return x.sql("SELECT n_name, c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey").select(normalize_chrom(F.col("n_name")).alias("chromosome"), "c_custkey")


@query("""SELECT concat('chr', o_custkey % 5) AS chromosome, CAST(DAY(o_orderdate) AS bigint) AS start, CAST(DAY(o_orderdate) + o_orderkey % 9 AS bigint) AS "end",
    CASE WHEN o_orderkey % 4 = 0 THEN concat('chr', o_custkey % 5, ':', DAY(o_orderdate), '-', DAY(o_orderdate) + o_orderkey % 9) ELSE concat('n', o_orderkey) END AS transcript_id
    FROM orders WHERE o_orderkey % 9 > 0 AND o_orderkey % 5 > 0""")
def interval_lines(x):
    lines = x.sql("""SELECT CASE WHEN o_orderkey % 10 = 0 THEN '# comment' WHEN o_orderkey % 5 = 0 THEN concat('chr1', chr(9), 'x', chr(9), '9') ELSE
        concat(CASE WHEN o_orderkey % 2 = 0 THEN 'chr' ELSE '' END, o_custkey % 5, chr(9), DAY(o_orderdate), chr(9), DAY(o_orderdate) + o_orderkey % 9,
        CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE concat(chr(9), 'n', o_orderkey) END) END AS value FROM orders""")
    return parse_intervals(lines).select("chromosome", "start", "end", "transcript_id")
