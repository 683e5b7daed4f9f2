"""Inputs of the queries, derived from the driver's tables by SQL that Spark and DuckDB share but for a few spellings."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from txspark.session import ship_package

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

#: Chromosomes grow in number with the tables, so that overlaps grow in proportion; those of customers beyond the suppliers are in no track.
#: Written for DuckDB, with DAY(x) for the days since 1992 and LETTERS(x) for the ASCII letters of x.
FIXTURES = {
    "f_intervals": """SELECT concat('chr', CAST((o_custkey - o_custkey % 14) / 14 AS bigint)) AS chromosome, DAY(o_orderdate) AS start, DAY(o_orderdate) + 1 + o_orderkey % 30 AS "end",
        concat('T', o_orderkey) AS transcript_id, CASE WHEN o_orderkey % 2 = 0 THEN '+' ELSE '-' END AS strand FROM orders""",
    "f_signal": """SELECT concat('chr', l_suppkey) AS chromosome, DAY(l_shipdate) AS start, DAY(l_shipdate) + 1 AS "end", CAST(avg(l_discount) AS double) AS value
        FROM lineitem GROUP BY 1, 2, 3""",
    "f_entries": """SELECT concat('chr', l_suppkey) AS chromosome, DAY(l_shipdate) AS start, DAY(l_shipdate) + CAST(l_quantity AS bigint) % 7 + 1 AS "end",
        concat(l_returnflag, chr(9), l_linestatus, chr(9), '0', chr(9), CASE WHEN l_partkey % 17 = 0 THEN '.' ELSE concat('E', l_partkey % 17) END) AS rest
        FROM lineitem""",
    "f_sizes": """SELECT chromosome, max("end") - 300 AS length FROM f_signal GROUP BY chromosome""",
    "f_sequences": """SELECT concat('S', doc_id) AS transcript_id, translate(upper(LETTERS(text)), 'BDEFHIJKLMOPQRSUVWXYZ', 'ACGTACGTACGTACGTACGTN') AS sequence FROM documents""",
    "f_annotation": """SELECT CASE o_custkey % 5 WHEN 0 THEN '2L' WHEN 1 THEN '2R' WHEN 2 THEN 'X' WHEN 3 THEN '4' ELSE 'Un' END AS chromosome, 'src' AS source, 'transcript' AS feature,
        DAY(o_orderdate) * 20 AS start, DAY(o_orderdate) * 20 + 100 + o_orderkey % 3 * 100 AS "end", CASE WHEN o_orderkey % 2 = 0 THEN '+' ELSE '-' END AS strand,
        concat(CASE WHEN o_orderkey % 6 = 0 THEN 'MSTRG.' ELSE 'T' END, o_orderkey) AS transcript_id, concat('G', o_custkey) AS gene_id,
        CASE WHEN o_orderkey % 4 = 0 THEN 'ncRNA' ELSE 'protein_coding' END AS gene_biotype, CASE WHEN o_orderkey % 4 = 0 THEN 'ncRNA' ELSE 'protein_coding' END AS transcript_biotype FROM orders
        UNION ALL SELECT CASE o_custkey % 5 WHEN 0 THEN '2L' WHEN 1 THEN '2R' WHEN 2 THEN 'X' WHEN 3 THEN '4' ELSE 'Un' END, 'src', 'exon',
        DAY(o_orderdate) * 20 + l_linenumber * 12, DAY(o_orderdate) * 20 + l_linenumber * 12 + 6, CASE WHEN o_orderkey % 2 = 0 THEN '+' ELSE '-' END,
        concat(CASE WHEN o_orderkey % 6 = 0 THEN 'MSTRG.' ELSE 'T' END, o_orderkey), concat('G', o_custkey),
        CASE WHEN o_orderkey % 4 = 0 THEN 'ncRNA' ELSE 'protein_coding' END, CASE WHEN o_orderkey % 4 = 0 THEN 'ncRNA' ELSE 'protein_coding' END FROM orders JOIN lineitem ON l_orderkey = o_orderkey""",
    "f_lists": """SELECT concat('T', l_orderkey) AS transcript_id, LISTOF(lower(p_brand)) AS entries_tfbs FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey""",
    "f_features": """SELECT concat('T', l_orderkey) AS transcript_id, CAST(avg(l_extendedprice) AS double) AS mean_price, CAST(max(l_quantity) AS double) AS max_qty, CAST(nullif(sum(l_tax), 0) AS double) AS sum_tax,
        CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE CAST(-avg(l_discount) * 10 AS double) END AS ss_mfe, CAST(count(*) AS bigint) AS length, l_orderkey % 4 = 0 AS y FROM lineitem GROUP BY l_orderkey""",
    "f_expression": """SELECT concat('T', l_partkey) AS transcript_id, p_brand AS gene_id, concat('s', l_suppkey % 6) AS sample_id, CAST(avg(l_extendedprice / 1000) AS double) AS fpkm
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3""",
    "f_samples": """SELECT DISTINCT sample_id, CASE WHEN sample_id IN ('s0', 's2', 's4') THEN 'A' ELSE 'B' END AS condition FROM f_expression""",
    "f_scores": """SELECT d.doc_id, l.quality AS y, CAST(d.n_chars % 1000 AS double) / 1000 AS score, CASE WHEN d.n_chars % 1000 >= 500 THEN 1 ELSE 0 END AS pred, d.doc_id % 5 AS fold
        FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
    "f_pvalues": """SELECT concat('T', p_partkey) AS id, CAST(p_partkey * 7919 % 1000 AS double) / 1000 AS pval, CAST(p_retailprice AS double) / 1000 AS fc FROM part""",
    "f_listing": """SELECT concat('run/', c_custkey, CASE WHEN c_custkey % 3 = 1 THEN '.fastq.gz' WHEN n = 1 THEN '_1.fastq.gz' ELSE '_2.fq' END) AS path, CAST(c_custkey % 7 * 60 AS bigint) AS length
        FROM customer CROSS JOIN (SELECT 1 AS n UNION ALL SELECT 2) m WHERE n = 1 OR c_custkey % 3 = 0""",
    "f_genome": """SELECT transcript_id AS chromosome, sequence FROM f_sequences""",
}


def _decimal_rounds(sql: str) -> str:
    """Every ``round(x, 6)``, whatever x is, by decimals of nine digits: a tie at the seventh digit rounds up, as in ``rounded``. What no such decimal holds rounds as it is."""
    out, at = "", 0
    for found in re.finditer(r"\bround\(", sql):
        if found.start() < at:
            continue
        depth, end = 1, found.end()
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        inner = sql[found.end() : end - 1]
        if inner.endswith(", 6"):
            x = _decimal_rounds(inner[:-3])
            out += sql[at : found.start()] + f"coalesce(CAST(round(TRY_CAST({x} AS decimal(28, 9)), 6) AS double), round({x}, 6))"
            at = end
    return out + sql[at:]


def duck(sql: str) -> str:
    """The spelling of DuckDB."""
    sql = re.sub(r"DAY\((\w+)\)", r"date_diff('day', DATE '1992-01-01', CAST(\1 AS date))", sql)
    sql = re.sub(r"LETTERS\((\w+)\)", r"regexp_replace(\1, '[^A-Za-z]', '', 'g')", sql)
    sql = _decimal_rounds(sql)
    return re.sub(r"LISTOF\((.+?\))\)", r"string_agg(DISTINCT \1, ',' ORDER BY \1)", sql)


def _spark(sql: str) -> str:
    sql = re.sub(r"DAY\((\w+)\)", r"CAST(datediff(\1, DATE '1992-01-01') AS bigint)", sql)
    sql = re.sub(r"LETTERS\((\w+)\)", r"regexp_replace(\1, '[^A-Za-z]', '')", sql)
    sql = re.sub(r"LISTOF\((.+?\))\)", r"array_join(array_sort(collect_set(\1)), ',')", sql)
    return sql.replace('"end"', "`end`")


class Inputs:
    """Tables and fixtures of one folder as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        ship_package(spark)
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name not in FIXTURES:
            raise AttributeError(name)
        return self.sql(FIXTURES[name])

    def sql(self, text: str) -> DataFrame:
        """Spark's result of a query over tables and fixtures, in the spelling of the fixtures."""
        text = _spark(text)
        used = [n for n in (*TABLES, *FIXTURES) if re.search(rf"\b(FROM|JOIN)\s+{n}\b", text)]
        for n in used:
            text = re.sub(rf"\b(FROM|JOIN)\s+{n}\b", rf"\1 {{{n}}} AS {n}" if not re.search(rf"\b(FROM|JOIN)\s+{n}\s+[a-z]\b", text) else rf"\1 {{{n}}}", text)
        return self.spark.sql(text, **{n: getattr(self, n) for n in used})


def with_fixtures(sql: str) -> str:
    """An oracle with the fixtures that it names as common table expressions."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in FIXTURES:
            if re.search(rf"\b{name}\b", text) and name not in needed:
                visit(FIXTURES[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return duck(sql)
    head = ", ".join(f"{n} AS ({FIXTURES[n]})" for n in needed)
    body = sql.strip()
    body = ", " + body[5:].strip() if body[:5].upper() == "WITH " else " " + body
    return duck(f"WITH {head}{body}")
