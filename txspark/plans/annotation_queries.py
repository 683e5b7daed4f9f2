"""Annotation, sequences, k-mers and sample sheets."""

from __future__ import annotations

from pyspark.sql import functions as F

from txspark.functions import scalars
from txspark.operators import annotation, kmers, samples, sequences
from txspark.plans.registry import query
from txspark.session import stored
from txspark.sources import readers, writers


@query("""SELECT chromosome, start, "end", transcript_id, gene_id FROM f_annotation WHERE feature = 'transcript' AND chromosome IN ('2L', '2R', '3L', '3R', '4', 'X', 'Y')
    AND gene_biotype = 'ncRNA' AND transcript_biotype = 'ncRNA' AND "end" - start > 200""")
def noncoding_transcripts(x):
    rows = annotation.on_chromosomes(annotation.by_feature(x.f_annotation, "transcript"))
    return annotation.by_biotype(rows, "ncRNA", 200).select("chromosome", "start", "end", "transcript_id", "gene_id")


@query("""SELECT transcript_id, feature, start FROM f_annotation WHERE regexp_matches(transcript_id, '^MSTRG*')""")
def novel_records(x):
    return annotation.novel_only(x.f_annotation).select("transcript_id", "feature", "start")


@query("""SELECT concat('chr', chromosome) AS chromosome, start, "end", transcript_id, '.' AS score, strand FROM f_annotation WHERE feature = 'transcript'""")
def transcript_intervals(x):
    return annotation.annotation_to_intervals(x.f_annotation)


@query("""SELECT e.transcript_id, e.start, e."end" FROM f_annotation e JOIN (SELECT DISTINCT transcript_id FROM f_annotation WHERE feature = 'transcript' AND gene_biotype = 'ncRNA' AND transcript_biotype = 'ncRNA'
    AND "end" - start > 10) k ON e.transcript_id = k.transcript_id WHERE e.feature = 'exon'""")
def exons_of_transcripts(x):
    kept = annotation.by_biotype(annotation.by_feature(x.f_annotation), "ncRNA", 10)
    return annotation.exons_of(x.f_annotation, kept).select("transcript_id", "start", "end")


@query("""SELECT chromosome, start, "end", min(transcript_id) AS transcript_id FROM f_annotation WHERE feature = 'transcript' GROUP BY 1, 2, 3""")
def transcripts_by_position(x):
    return annotation.dedup_positions(annotation.by_feature(x.f_annotation), ["chromosome", "start", "end"], ["transcript_id"]).select("chromosome", "start", "end", "transcript_id")


@query("""SELECT a.n AS rows_before, b.n AS rows_after, round(100.0 * (a.n - b.n) / a.n, 4) AS percent_removed FROM (SELECT count(*) AS n FROM f_annotation WHERE feature = 'transcript') a,
    (SELECT count(*) AS n FROM (SELECT DISTINCT chromosome, start, "end" FROM f_annotation WHERE feature = 'transcript')) b""")
def position_report(x):
    rows = annotation.by_feature(x.f_annotation)
    return annotation.dedup_report(rows, annotation.dedup_positions(rows, ["chromosome", "start", "end"], ["transcript_id"]))


@query("""SELECT feature, gene_biotype, count(*) AS n FROM f_annotation GROUP BY 1, 2""")
def record_union(x):
    both = annotation.union_records(annotation.by_feature(x.f_annotation), annotation.by_feature(x.f_annotation, "exon"))
    return both.groupBy("feature", "gene_biotype").agg(F.count("*").alias("n"))


@query("""SELECT DISTINCT chromosome, "end" AS start, nxt AS "end", strand FROM (SELECT *, lead(start) OVER (PARTITION BY transcript_id ORDER BY start, "end") AS nxt FROM f_annotation
    WHERE feature = 'exon') WHERE nxt > "end" """)
def splice_junctions(x):
    return annotation.splice_junctions(x.f_annotation)


GTF = """SELECT concat_ws(chr(9), chromosome, source, feature, start + 1, "end", '.', strand, '.', concat('gene_id "', gene_id, '"; transcript_id "', transcript_id, '"; tag "a"; tag "b";')) AS value FROM f_annotation"""


@query("""SELECT chromosome, feature, start, "end", strand, transcript_id, gene_id, 'a' AS tag FROM f_annotation""")
def annotation_lines(x):
    rows = readers.parse_annotation(x.sql(GTF))
    return rows.select("chromosome", "feature", "start", "end", "strand", "transcript_id", "gene_id", F.element_at("attributes", F.lit("tag")).alias("tag"))


@query("""SELECT concat_ws(chr(9), chromosome, source, feature, start + 1, "end", '.', strand, '.', concat('gene_id "', gene_id, '"; transcript_id "', transcript_id, '";')) AS value FROM f_annotation WHERE feature = 'transcript'""")
def annotation_text(x):
    fields = F.create_map(F.lit("gene_id"), F.col("gene_id"), F.lit("transcript_id"), F.col("transcript_id"))
    rows = annotation.by_feature(x.f_annotation).withColumns({"attributes": fields, "score": F.lit(None).cast("string"), "frame": F.lit(None).cast("string")})
    return writers.gtf_lines(rows)


@query("""SELECT chromosome, start, "end", transcript_id, '.' AS score, strand FROM f_intervals""")
def interval_rows(x):
    return writers.bed_rows(x.f_intervals)


@query("""SELECT concat('>', transcript_id, chr(10), rtrim(regexp_replace(sequence, '(.{60})', '\\1' || chr(10), 'g'), chr(10))) AS record FROM f_sequences""")
def sequence_records(x):
    return x.f_sequences.select(writers.fasta_lines(F.col("transcript_id"), F.col("sequence")).alias("record"))


@query("""SELECT transcript_id, translate(sequence, 'T', 'U') AS rna, translate(regexp_replace(upper(sequence), '[^ATUGC]', '', 'g'), 'ATUGC', '00011') AS code,
    reverse(translate(sequence, 'ACGTN', 'TGCAN')) AS back, regexp_matches(sequence, '^[ATGCUatgcuNn]+$') AS valid FROM f_sequences""")
def sequence_forms(x):
    s = F.col("sequence")
    return x.f_sequences.select("transcript_id", scalars.to_rna(s).alias("rna"), scalars.to_binary(s).alias("code"), scalars.revcomp(s).alias("back"), scalars.valid_sequence(s).alias("valid"))


KMERS = """c AS (SELECT transcript_id, translate(regexp_replace(upper(sequence), '[^ATUGC]', '', 'g'), 'ATUGC', '00011') AS s FROM f_sequences),
    p AS (SELECT transcript_id, substr(s, CAST(j * 64 + 1 AS bigint), 75) AS t FROM (SELECT transcript_id, s, unnest(range(0, (length(s) + 63) // 64)) AS j FROM c)),
    w AS (SELECT transcript_id, k, substr(t, CAST(i AS bigint), k) AS kmer FROM (SELECT transcript_id, t, k, unnest(range(1, least(64, length(t) - k + 1) + 1)) AS i FROM p CROSS JOIN (SELECT CAST(unnest(range(3, 7)) AS int) AS k) r)),
    n AS (SELECT transcript_id, k, kmer, count(*) AS cnt FROM w GROUP BY ALL)"""
ALL_KMERS = KMERS.replace("range(3, 7)", "range(3, 13)")


@query(f"WITH {KMERS} SELECT * FROM n")
def kmer_counts(x):
    return kmers.count_kmers(x.f_sequences, 3, 6)


@query(f"WITH {KMERS} SELECT transcript_id, " + ", ".join(f"""CAST(coalesce(sum(cnt) FILTER (kmer = '{i:03b}'), 0) AS bigint) AS "{i:03b}" """ for i in range(8)) + " FROM n WHERE k = 3 GROUP BY 1")
def kmer_columns(x):
    return kmers.kmer_wide(kmers.count_kmers(x.f_sequences, 3, 3), [f"{i:03b}" for i in range(8)])


@query(f"""WITH {ALL_KMERS}, t AS (SELECT k, kmer, count(*) AS cnt FROM w GROUP BY 1, 2), a AS (SELECT CAST(k AS int) AS k, unnest(range(0, CAST(pow(2, k) AS bigint))) AS c FROM (SELECT unnest(range(3, 13)) AS k)),
    v AS (SELECT k, right(concat('000000000000', bin(c)), k) AS kmer FROM a) SELECT v.k, v.kmer, CAST(coalesce(cnt, 0) AS bigint) AS cnt FROM v LEFT JOIN t ON v.k = t.k AND v.kmer = t.kmer""")
def kmer_words(x):
    return kmers.kmer_vocabulary(x.spark).join(kmers.count_words(x.f_sequences), ["k", "kmer"], "left").fillna(0, ["cnt"])


@query(f"""WITH {KMERS}, d AS (SELECT kmer, count(*) AS df FROM n GROUP BY 1), t AS (SELECT transcript_id, k, n.kmer, cnt * (ln((1 + (SELECT count(DISTINCT transcript_id) FROM n)) / CAST(1 + df AS double)) + 1) AS v
    FROM n JOIN d ON n.kmer = d.kmer), u AS (SELECT transcript_id, k, kmer, v / sqrt(sum(v * v) OVER (PARTITION BY transcript_id)) AS weight FROM t) SELECT transcript_id, k, kmer, round(weight, 6) AS weight FROM u""")
def kmer_weights(x):
    return kmers.kmer_weights(x.f_sequences, 3, 6)


@query()
def kmer_components(x):
    return kmers.sequence_components(x.f_sequences, n={3: 2, 4: 2})


@query()
def kmer_components_global(x):
    return kmers.sequence_components(x.f_sequences, n=2, by_k=False)


@query()
def kmer_reduced(x):
    return kmers.reduce_sequences(x.f_sequences)


@query(f"""WITH {KMERS}, s AS (SELECT CAST(kmer AS varchar) AS kmer, sum(CAST(cnt AS double) * cnt) AS g FROM n WHERE k = 3 GROUP BY 1) SELECT 3 AS k, round(sum(g) / 1e6, 6) AS energy FROM s""")
def kmer_energy(x):
    """The squared lengths of all components of the counts of length 3 add up to the trace of the Gram matrix."""
    counts = stored(kmers.count_kmers(x.f_sequences, 3, 3), "kmers")
    columns = {3: [f"{i:03b}" for i in range(8)]}
    sparse = kmers.sparse_rows(counts.withColumn("block", F.lit(3)), columns, "cnt")
    values, _ = kmers.right_vectors(sparse, {3: 8}, {3: 8})[3]
    return x.spark.createDataFrame([(3, float((values**2).sum()) / 1e6)], "k int, energy double")


@query("""SELECT l_orderkey, CASE WHEN n = 0 THEN concat('P', l_partkey) ELSE concat('f', l_suppkey % 3, '.fa_P', l_partkey, '_dup', n) END AS transcript_id FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey
    ORDER BY concat('f', l_suppkey % 3, '.fa'), l_orderkey * 10 + l_linenumber) - 1 AS n FROM lineitem)""")
def unique_names(x):
    rows = x.sql("SELECT l_orderkey, concat('f', l_suppkey % 3, '.fa') AS file, l_orderkey * 10 + l_linenumber AS pos, concat('P', l_partkey) AS transcript_id FROM lineitem")
    return sequences.unique_ids(rows).select("l_orderkey", "transcript_id")


#: Two exons over the whole sequence, one before and one after its middle, at places that its length gives.
HALF = "CAST((length(sequence) - length(sequence) % 2) / 2 AS bigint)"
STRAND = "CASE WHEN length(sequence) % 2 = 0 THEN '+' ELSE '-' END"
EXONS = f"""SELECT 'exon' AS feature, chromosome, concat('X', chromosome) AS transcript_id, length(sequence) % 5 AS start, {HALF} AS "end", {STRAND} AS strand FROM f_genome
    UNION ALL SELECT 'exon', chromosome, concat('X', chromosome), {HALF} + length(sequence) % 3, length(sequence), {STRAND} FROM f_genome"""


@query(f"""SELECT concat('X', chromosome) AS transcript_id, translate(CASE WHEN length(sequence) % 2 = 0 THEN s ELSE reverse(translate(s, 'ACGTN', 'TGCAN')) END, 'T', 'U') AS sequence FROM (SELECT *,
    concat(substr(sequence, length(sequence) % 5 + 1, greatest({HALF} - length(sequence) % 5, 0)), substr(sequence, {HALF} + length(sequence) % 3 + 1)) AS s FROM f_genome) WHERE s <> ''""")
def spliced_transcripts(x):
    return sequences.spliced_sequences(x.sql(EXONS), x.f_genome, size=256)


PLACES = f"""SELECT chromosome, length(sequence) % 7 AS start, length(sequence) - length(sequence) % 11 AS "end", {STRAND} AS strand FROM f_genome"""


@query(f"""SELECT concat(chromosome, ':', start, '-', "end") AS transcript_id, CASE WHEN strand = '+' THEN s ELSE reverse(translate(s, 'ACGTN', 'TGCAN')) END AS sequence
    FROM (SELECT p.*, substr(sequence, start + 1, "end" - start) AS s FROM ({PLACES}) p JOIN f_genome g ON p.chromosome = g.chromosome WHERE start < "end")""")
def interval_bases(x):
    return sequences.interval_sequences(x.sql(PLACES), x.f_genome, rna=False, size=256)


@query("""SELECT s.transcript_id, length(sequence) AS n, CASE WHEN hash_part % 3 = 0 THEN CAST(-hash_part AS double) END AS ss_mfe FROM (SELECT *, CAST(substr(transcript_id, 2) AS bigint) AS hash_part FROM f_sequences) s""")
def structure_columns(x):
    results = x.sql("SELECT transcript_id, CASE WHEN CAST(substr(transcript_id, 2) AS bigint) % 3 = 0 THEN concat('-', substr(transcript_id, 2)) ELSE 'failed' END AS mfe, '(.)' AS structure FROM f_sequences WHERE CAST(substr(transcript_id, 2) AS bigint) % 3 < 2")
    return sequences.attach_structure(x.f_sequences, results).select("transcript_id", F.length("sequence").cast("long").alias("n"), "ss_mfe")


@query("""SELECT DISTINCT CAST(c_custkey AS varchar) AS sample_id FROM customer""")
def sample_discovery(x):
    return samples.discover_samples(x.f_listing)


@query("""SELECT CAST(c_custkey AS varchar) AS sample_id, CASE WHEN c_custkey % 3 = 1 THEN 'SINGLE' ELSE 'PAIRED' END AS declared,
    CASE WHEN c_custkey % 7 * 60 <= 100 THEN 'UNKNOWN' WHEN c_custkey % 3 = 0 THEN 'PAIRED' WHEN c_custkey % 3 = 1 THEN 'SINGLE' ELSE 'UNKNOWN' END AS detected,
    CASE WHEN c_custkey % 7 * 60 <= 100 THEN FALSE ELSE c_custkey % 3 < 2 END AS agrees FROM customer""")
def sample_layouts(x):
    declared = x.sql("SELECT CAST(c_custkey AS string) AS sample_id, CASE WHEN c_custkey % 3 = 1 THEN ' No' ELSE 'TRUE' END AS paired FROM customer")
    return samples.reconcile_layouts(x.f_listing, declared)


@query("""SELECT concat('SRR', c_custkey) AS sample_id, c_mktsegment AS condition, CAST(c_nationkey AS varchar) AS replicate FROM customer""")
def sample_sheet(x):
    lines = x.sql("SELECT concat('SRR', c_custkey, ',', c_mktsegment, ', ', c_nationkey) AS value FROM customer UNION ALL SELECT 'sample_id,condition,replicate' UNION ALL SELECT '# note' UNION ALL SELECT ''")
    return readers.parse_samples(lines, ",")


@query("""SELECT concat('ERR', c_custkey) AS sample_id FROM customer""")
def sample_list(x):
    return readers.parse_samples(x.sql("SELECT concat('ERR', c_custkey, chr(9), 'x') AS value FROM customer UNION ALL SELECT concat('run', chr(9), 'y')"), "\t")
