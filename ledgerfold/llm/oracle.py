"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

from ledgerfold.llm.licenses import TEMPLATES, template_rows

TOP_K = """
WITH good AS (
  SELECT vec_id AS id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
asked AS (SELECT id, v FROM good WHERE id % 100 = 0 QUALIFY row_number() OVER (PARTITION BY id ORDER BY len(v), v) = 1),
scored AS (
  SELECT q.id AS query_id, c.id AS vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM asked q JOIN good c ON c.id <> q.id AND len(c.v) = len(q.v)),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

def licenses_sql() -> str:
    """The scan by joins: bigrams of units and templates as lists, compared where sizes allow."""
    grams = ", ".join("('{}', {}, ['{}'])".format(name, k, "', '".join(found)) for name, k, found in template_rows(TEMPLATES))
    words = "string_split(trim(regexp_replace(lower(t), '[^\\p{L}\\p{N}]+', ' ', 'g')), ' ')"
    return f"""
WITH template(name, k, grams) AS (VALUES {grams}),
docs AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents),
lines AS (SELECT r, string_split(text, chr(10)) AS l FROM docs),
unit AS (
  SELECT r, CAST(unnest(range(len(l))) AS INTEGER) AS line, unnest(l) AS t FROM lines
  UNION ALL SELECT d.r, -1, d.text FROM docs d JOIN lines USING (r) WHERE len(l) > 1),
words AS (SELECT r, line, {words} AS w FROM unit),
sized AS (SELECT r, line, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM words WHERE len(w) > 1),
hit AS (
  SELECT r, line, name, 2.0::DOUBLE * len(list_intersect(g, grams)) / (len(g) + len(grams)) AS dice
  FROM sized JOIN template ON len(g) * 3 >= len(grams) * 2 AND len(grams) * 3 >= len(g) * 2
  WHERE len(list_intersect(g, grams)) * 10 >= (len(g) + len(grams)) * 4),
summed AS (
  SELECT r, CAST(count(DISTINCT line) AS INTEGER) AS n, array_to_string(list_sort(list(DISTINCT name)), ',') AS names,
         first(name ORDER BY dice DESC, name, line) AS best, first(dice ORDER BY dice DESC, name, line) AS dice,
         first(line ORDER BY dice DESC, name, line) AS line
  FROM hit GROUP BY r)
SELECT doc_id, coalesce(n, 0) AS n_matches, coalesce(names, '') AS licenses, best, dice AS best_dice, line AS best_line
FROM docs LEFT JOIN summed USING (r)
"""


TERMS = """regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"""
RANKED = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {TERMS} AS t FROM documents WHERE text IS NOT NULL),
size AS (SELECT r, doc_id, CAST(len(t) AS BIGINT) AS n FROM docs WHERE len(t) > 0),
total AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS nt FROM size),
asked AS (SELECT DISTINCT item_id, unnest({TERMS}) AS term FROM benchmark WHERE text IS NOT NULL),
words AS (SELECT r, unnest(t) AS term FROM docs),
tf AS (SELECT r, term, count(*) AS tf FROM words SEMI JOIN asked USING (term) GROUP BY r, term),
weight AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * nd + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
           FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), total),
part AS (SELECT r, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * nd) // nt))) AS s
         FROM tf JOIN size USING (r) JOIN weight USING (term), total),
summed AS (SELECT item_id, r, CAST(sum(s) AS BIGINT) AS score FROM asked JOIN part USING (term) GROUP BY item_id, r),
ranked AS (SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
           FROM summed JOIN size USING (r) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


ORACLE: dict[str, str] = {"op3_license_scan": licenses_sql(), "op5_exact_top_k": TOP_K, "op12_ranked_search": RANKED}
