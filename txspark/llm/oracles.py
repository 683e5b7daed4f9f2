"""DuckDB SQL for the operators whose whole result SQL can express."""

from __future__ import annotations

from txspark.llm.divergence import LEAST_DOCS, PRIOR, SCALE, TOP_TERMS
from txspark.llm.phrases import LEAST, ORDER, TOP
from txspark.llm.quality import BESIDE, CERTAIN, LEAST_WORDS, METRICS, PRIOR_DOCS, RULES, TAIL

_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORDS = "list_filter(string_split_regex({text}, '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '')"

_COMPONENTS = """reach AS (SELECT id AS a, id AS b FROM nodes UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
    comp AS (SELECT a AS id, min(b) AS component_id FROM reach GROUP BY 1)"""

OP4 = f"""WITH RECURSIVE t AS (SELECT doc_id AS id, {_WORDS.format(text="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
    s AS (SELECT id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM t),
    n AS (SELECT id, len(s) AS n FROM s), x AS (SELECT id, md5(unnest(s)) AS h FROM s),
    p AS (SELECT a.id AS a, b.id AS b, count(*) AS shared FROM x a JOIN x b ON a.h = b.h AND a.id < b.id GROUP BY 1, 2),
    l AS (SELECT a, b FROM p JOIN n na ON na.id = a JOIN n nb ON nb.id = b WHERE 100 * shared >= 75 * (na.n + nb.n - shared)),
    links AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l), nodes AS (SELECT id FROM n), {_COMPONENTS}
    SELECT n.id AS doc_id, n.n AS n_shingles, component_id, n.id = component_id AS kept FROM n JOIN comp ON n.id = comp.id"""

OP6 = f"""WITH RECURSIVE v AS (SELECT vec_id AS id, list_transform(embedding, lambda x: CAST(x AS double)) AS e FROM embeddings),
    g AS (SELECT id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM v WHERE len(e) > 0 AND list_bool_and(list_transform(e, lambda x: x IS NOT NULL AND isfinite(x)))),
    links AS (SELECT a.id AS a, b.id AS b FROM g a JOIN g b ON a.id <> b.id AND len(a.e) = len(b.e) WHERE a.norm > 0 AND b.norm > 0 AND list_dot_product(a.e, b.e) / a.norm / b.norm >= 0.9),
    nodes AS (SELECT id FROM v), {_COMPONENTS}, n AS (SELECT a AS id, count(*) AS n FROM links GROUP BY 1)
    SELECT v.id AS vec_id, coalesce(n.n, 0) AS n_links, component_id, v.id = component_id AS kept FROM v JOIN comp ON v.id = comp.id LEFT JOIN n ON n.id = v.id"""



def _place(rule: str) -> str:
    metric, scale, step = RULES[rule]
    return f"asin(sqrt(least({metric}, 1.0))) / {step}" if scale == "share" else f"ln(greatest({metric}, 1e-9)) / {step if scale == 'long' else -step}"


def _smoothed(keys: str, on: str, wider: str) -> str:
    """Sketches by ``keys`` in thousandths of documents, with PRIOR_DOCS documents of the wider ones."""
    total = f"SELECT {on}, CAST(sum(n) AS bigint) AS total FROM {wider} GROUP BY ALL"
    return f"""SELECT {keys}, bucket, CAST(sum(n) AS bigint) AS n FROM (SELECT {keys}, bucket, 1000 * n AS n FROM b UNION ALL
        SELECT {keys}, bucket, n * least({1000 * PRIOR_DOCS}, total) // total FROM {wider} JOIN ({total}) USING ({on}) JOIN (SELECT DISTINCT {keys} FROM b) USING ({on})) GROUP BY ALL"""


def _shapes(keys: str, sketch: str) -> str:
    """Median, first valley above it and upper quantile of each sketch."""
    return f"""SELECT {keys}, max(middle) AS middle, max(dip) AS dip, (max(dip) + min(CASE WHEN bucket > dip AND NOT low THEN bucket END)) / 2 AS valley, min(CASE WHEN 1000 * upto >= {1000 - TAIL} * total THEN bucket END) + 1 AS tail
        FROM (SELECT *, min(CASE WHEN low AND bucket > middle THEN bucket END) OVER (PARTITION BY {keys}) AS dip
        FROM (SELECT *, min(CASE WHEN 2 * upto >= total THEN bucket END) OVER (PARTITION BY {keys}) AS middle, later > 2 * near AND CAST(later - near AS double) * (later - near) > {1000 * CERTAIN * CERTAIN} * (later + near) AS low
        FROM (SELECT *, coalesce(max(near) OVER (PARTITION BY {keys} ORDER BY bucket ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) AS later FROM (SELECT *, sum(n) OVER (PARTITION BY {keys} ORDER BY bucket ROWS BETWEEN {BESIDE} PRECEDING AND {BESIDE} FOLLOWING) AS near, sum(n) OVER (PARTITION BY {keys} ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY {keys}) AS total FROM {sketch})))) GROUP BY ALL"""


_FENCES = ", ".join(f"max(CASE WHEN rule = '{r}' THEN fence END) AS fence_{r}" for r in RULES)
_WITHIN = " AND ".join(f"{_place(r)} <= fence_{r}" for r in RULES)

OP10 = f"""WITH t AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text, {_WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
    tri AS (SELECT doc_id, i, hash_key, count(*) OVER (PARTITION BY doc_id, hash_key) AS times FROM (SELECT doc_id, i, md5(array_to_string(w[i:i + 2], ' ')) AS hash_key FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM t))),
    rep AS (SELECT doc_id, count(DISTINCT word_at) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS word_at FROM tri WHERE times > 1) GROUP BY 1),
    ln AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t) WHERE length(translate(line, {_SPACE}, '')) > 0 GROUP BY 1),
    c AS (SELECT t.doc_id, lang, source, len(w) AS n_words, length(translate(text, {_SPACE}, '')) AS word_chars, length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
        coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_lines, 0) AS n_lines, coalesce(rep.n, 0) AS n_repeat_words FROM t LEFT JOIN ln ON t.doc_id = ln.doc_id LEFT JOIN rep ON t.doc_id = rep.doc_id),
    r AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed, CASE WHEN word_chars > 0 THEN n_symbols / CAST(word_chars AS double) ELSE 0 END AS symbol_ratio,
        CASE WHEN n_lines > 0 THEN n_dup_lines / CAST(n_lines AS double) ELSE 0 END AS dup_line_ratio, CASE WHEN n_words > 0 THEN n_dup_lines / CAST(n_words AS double) ELSE 0 END AS dup_lines_per_word, CASE WHEN n_words > 0 THEN n_repeat_words / CAST(n_words AS double) ELSE 0 END AS repeat_ratio,
        CASE WHEN n_words > 0 THEN word_chars / CAST(n_words AS double) ELSE 0 END AS mean_word FROM c),
    long AS ({" UNION ALL ".join(f"SELECT lang, source, '{r}' AS rule, CAST(floor({_place(r)}) AS int) AS bucket FROM r WHERE NOT base_failed" for r in RULES)}),
    b AS (SELECT *, count(*) AS n FROM long GROUP BY ALL), every AS (SELECT rule, unnest(range(min(bucket), max(bucket) + 1)) AS bucket FROM b GROUP BY rule),
    sa AS (SELECT every.rule, every.bucket, CAST(coalesce(1000 * sum(n), 0) AS bigint) AS n FROM every LEFT JOIN b ON b.rule = every.rule AND b.bucket = every.bucket GROUP BY ALL),
    sl AS ({_smoothed("lang, rule", "rule", "sa")}), sg AS ({_smoothed("lang, source, rule", "lang, rule", "sl")}),
    ha AS ({_shapes("rule", "sa")}), hl AS ({_shapes("lang, rule", "sl")}), hg AS ({_shapes("lang, source, rule", "sg")}),
    k AS (SELECT hg.lang, hg.source, hg.rule, coalesce(hg.valley, CASE WHEN hl.dip > hg.middle THEN hl.valley END, CASE WHEN ha.dip > hg.middle THEN ha.valley END, hg.tail) AS fence
        FROM hg JOIN hl ON hg.lang = hl.lang AND hg.rule = hl.rule JOIN ha ON hg.rule = ha.rule),
    wide AS (SELECT lang, source, {_FENCES} FROM k GROUP BY 1, 2)
    SELECT r.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce({_WITHIN}, FALSE) AS kept, {", ".join(f"round(r.{m}, 9) AS {m}" for m in METRICS)}
    FROM r LEFT JOIN wide ON r.lang = wide.lang AND r.source = wide.source"""

_LOWER = "translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _share(n: str, total: str, size: str) -> str:
    return f"1 + (CAST({SCALE} AS hugeint) * ({n} + {PRIOR})) // ({total} + {PRIOR} * {size})"


OP12 = f"""WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
    t AS (SELECT id, lang, source, unnest(regexp_extract_all({_LOWER.format(text="text")}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
    v AS (SELECT lang, term, CAST(count(*) AS hugeint) AS n FROM t GROUP BY 1, 2 HAVING count(DISTINCT id) >= {LEAST_DOCS}), g AS (SELECT DISTINCT lang, source FROM d),
    c AS (SELECT g.lang, g.source, v.term, v.n AS lang_n, CAST(coalesce(o.n, 0) AS hugeint) AS n FROM g JOIN v ON g.lang = v.lang LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL) o ON o.lang = g.lang AND o.source = g.source AND o.term = v.term),
    s AS (SELECT *, sum(n) OVER (PARTITION BY lang, source) AS total, sum(lang_n) OVER (PARTITION BY lang, source) AS lang_total, count(*) OVER (PARTITION BY lang, source) AS size FROM c),
    p AS (SELECT *, {_share("n", "CAST(total AS hugeint)", "size")} AS p, {_share("lang_n", "CAST(lang_total AS hugeint)", "size")} AS q FROM s),
    pairs AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    u AS (SELECT g.lang, g.source, 'pair' AS part, h.source AS item, CAST(coalesce(value, 0) AS bigint) AS value FROM g JOIN g h ON g.lang = h.lang AND g.source <> h.source LEFT JOIN pairs ON pairs.lang = g.lang AND pairs.source = g.source AND pairs.item = h.source
        UNION ALL SELECT lang, source, 'term', term, CAST(p - q AS bigint) FROM p WHERE n > 0 AND p > q),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS int) AS rank FROM u)
    SELECT * FROM r WHERE part = 'pair' OR rank <= {TOP_TERMS}"""

_CUTS = " UNION ALL ".join(f"SELECT lang, phrase, a, {k} AS k, array_to_string(ws[1:{k}], ' ') AS head, array_to_string(ws[{k + 1}:], ' ') AS rest FROM cand WHERE size > {k}" for k in range(1, ORDER))
_GRAMS = " UNION ALL ".join(f"SELECT lang, unnest(list_transform(range(1, len(ws) - {k} + 2), lambda i: ws[i:i + {k - 1}])) AS ws FROM t WHERE len(ws) >= {k}" for k in range(1, ORDER + 1))

OP13 = f"""WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER.format(text="coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
    t AS (SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda w: w <> '') AS ws FROM p), total AS (SELECT lang, CAST(sum(len(ws)) AS bigint) AS n FROM t GROUP BY 1),
    f AS (SELECT lang, ws, len(ws) AS size, array_to_string(ws, ' ') AS phrase, count(*) AS a FROM ({_GRAMS}) GROUP BY 1, 2 HAVING count(*) >= {LEAST}), cand AS (SELECT * FROM f WHERE size > 1),
    sub AS (SELECT DISTINCT lang, a, len(ws) AS longer, unnest(flatten(list_transform(range(2, len(ws)), lambda m: list_transform(range(1, len(ws) - m + 2), lambda i: array_to_string(ws[i:i + m - 1], ' '))))) AS phrase FROM cand WHERE size > 2),
    gone AS (SELECT DISTINCT cand.lang, cand.phrase FROM cand JOIN sub ON cand.lang = sub.lang AND cand.phrase = sub.phrase AND 100 * sub.a >= 100 * cand.a AND sub.longer > cand.size),
    cuts AS ({_CUTS}), s AS (SELECT cuts.lang, cuts.phrase, cuts.a, k, l.a AS l, r.a AS r, n, CAST((CAST(1000 AS hugeint) * cuts.a * n) // (CAST(l.a AS hugeint) * r.a) AS bigint) AS score
        FROM cuts JOIN f l ON l.lang = cuts.lang AND l.phrase = cuts.head JOIN f r ON r.lang = cuts.lang AND r.phrase = cuts.rest JOIN total ON total.lang = cuts.lang),
    low AS (SELECT * FROM s WHERE (lang, phrase) NOT IN (SELECT (lang, phrase) FROM gone) QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM low)
    SELECT * FROM ranked WHERE rank <= {TOP}"""

ORACLES = {"op4_minhash": OP4, "op6_int8_vectors": OP6, "op10_quality_rules": OP10, "op12_source_divergence": OP12, "op13_collocations": OP13}
