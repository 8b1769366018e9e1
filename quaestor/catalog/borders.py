"""Registered queries on learned sentence borders."""

from __future__ import annotations

from quaestor.catalog import inputs as src
from quaestor.catalog.scoring import WS
from quaestor.operators import borders as bd
from quaestor.operators import chunks as ch


def sentence_borders(spark, sf_dir):
    return bd.model_rows(bd.train(src.heavy_table(spark, sf_dir, "documents", "doc_id")))


def sentence_split_trained(spark, sf_dir):
    docs = src.heavy_table(spark, sf_dir, "documents", "doc_id")
    return ch.sentences(docs, "text", bd.train(docs))


QUERIES = {"sentence_borders": sentence_borders, "sentence_split_trained": sentence_split_trained}

OPENERS, TAIL, CLOSERS = (x.replace("'", "''") for x in (bd.OPENERS, bd.TAIL, bd.CLOSERS))


def _shape_sql(token: str, tag: str = "") -> str:
    """Columns of the shape of a token, in the order of their dependence."""
    return f"""regexp_replace(regexp_replace({token}, '^[{OPENERS}]+', ''), '[{TAIL}]+$', '') AS core{tag},
  regexp_replace(core{tag}, '[.!?]+$', '') AS word{tag}, word{tag}[1:1] AS letter{tag},
  CASE WHEN regexp_matches(word{tag}, '{bd.NUMBER}') THEN '#' ELSE lower(word{tag}) END AS type{tag},
  core{tag} LIKE '%.' AS stop{tag}, regexp_matches(core{tag}, '[.!?]$') AS mark{tag},
  CASE WHEN letter{tag} <> lower(letter{tag}) THEN 1 WHEN letter{tag} <> upper(letter{tag}) THEN -1 ELSE 0 END AS case{tag}"""


def _binomial(k: str, n: str, p: str) -> str:
    return f"(CASE WHEN {k} > 0 THEN {k} * ln({p}) ELSE 0 END + CASE WHEN {n} - {k} > 0 THEN ({n} - {k}) * ln(1.0::DOUBLE - {p}) ELSE 0 END)"


def _association(k: str, a: str, b: str, n: str) -> str:
    p, p1, p2 = f"({b}::DOUBLE / {n})", f"({k}::DOUBLE / {a})", f"(({b} - {k})::DOUBLE / ({n} - {a}))"
    return f"""CASE WHEN {n} > {a} AND {b} < {n} AND {p1} > {p} THEN 2.0::DOUBLE * ({_binomial(k, a, p1)} + {_binomial(f'({b} - {k})', f'({n} - {a})', p2)}
  - {_binomial(k, a, p)} - {_binomial(f'({b} - {k})', f'({n} - {a})', p)}) ELSE 0 END"""


MODEL_SQL = f"""v_tokens AS (SELECT r, unnest(w) AS token, generate_subscripts(w, 1) AS i FROM (
  SELECT row_number() OVER () AS r, list_filter(regexp_split_to_array(text, '{WS}+'), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL)),
v_shapes AS (SELECT r, i, {_shape_sql('token')} FROM v_tokens),
v_placed AS (SELECT *, CASE WHEN lag(stop) OVER w THEN lag(type) OVER w END AS first, coalesce(lag(mark) OVER w, true) AS opens
  FROM v_shapes WINDOW w AS (PARTITION BY r ORDER BY i)),
v_counts AS MATERIALIZED (SELECT first, type, count(*) AS n, count(*) FILTER (stop) AS n_stops, count(*) FILTER ("case" = -1) AS n_lower,
  count(*) FILTER ("case" = 1) AS n_upper, count(*) FILTER ("case" = 1 AND NOT opens) AS n_inner FROM v_placed WHERE type <> '' GROUP BY 1, 2),
v_types AS MATERIALIZED (SELECT type, sum(n)::BIGINT AS n, sum(n_stops)::BIGINT AS n_stops, sum(n_lower) AS n_lower, sum(n_inner) AS n_inner FROM v_counts GROUP BY 1),
v_total AS (SELECT sum(n)::BIGINT AS n, sum(n_stops)::BIGINT AS stops FROM v_types),
v_abbr AS MATERIALIZED (SELECT * FROM (SELECT type, n, n_stops,
  -2.0::DOUBLE * (n_stops * ln(share) + (n - n_stops) * ln(1.0::DOUBLE - share) - n_stops * ln(0.99::DOUBLE) - (n - n_stops) * ln(1.0::DOUBLE - 0.99::DOUBLE))
  * exp(-size::DOUBLE) * (inner_stops + 1) * pow(size::DOUBLE, -(n - n_stops)::DOUBLE) AS score FROM (
  SELECT t.*, v_total.stops::DOUBLE / v_total.n AS share, length(type) - length(replace(type, '.', '')) AS inner_stops,
    greatest(length(type) - inner_stops, 1) AS size FROM v_types t, v_total
  WHERE t.n_stops > 0 AND v_total.stops < v_total.n AND regexp_matches(type, '\\p{{L}}'))) WHERE score >= 0.3),
v_opened AS (SELECT type, sum(n)::BIGINT AS both_n FROM v_counts WHERE first IS NOT NULL AND first NOT IN (SELECT type FROM v_abbr) GROUP BY 1),
v_start AS MATERIALIZED (SELECT * FROM (SELECT o.type, both_n AS n,
  {_association('both_n', 'b.breaks', 't.n', 'v_total.n')} AS score
  FROM v_opened o JOIN v_types t USING (type), v_total, (SELECT sum(both_n)::BIGINT AS breaks FROM v_opened) b) WHERE score >= 30),
v_coll AS MATERIALIZED (SELECT * FROM (SELECT c.first, c.type AS second, c.n, {_association('c.n', 'a.n', 'b.n', 'v_total.n')} AS score
  FROM v_counts c JOIN v_types a ON a.type = c.first JOIN v_types b ON b.type = c.type, v_total
  WHERE c.n > 1 AND c.first <> '' AND c.type NOT IN (SELECT type FROM v_start)) WHERE score >= 7.88),
v_decisive AS (SELECT type FROM v_types WHERE n_lower > 0 AND n_inner = 0 AND type IN (
  SELECT type FROM v_counts WHERE n_upper > 0 AND (first = '#' OR length(first) = 1 OR first IN (SELECT type FROM v_abbr))))"""

SPLIT_SQL = rf"""v_units AS (SELECT doc_id, unnest(u) AS unit, generate_subscripts(u, 1) AS i FROM (
  SELECT doc_id, string_split(regexp_replace(text, '([.!?][{CLOSERS}]{{0,3}})({WS}+)', '\1' || chr(1) || '\2' || chr(2), 'g'), chr(2)) AS u
  FROM documents WHERE text IS NOT NULL)),
v_parts AS (SELECT doc_id, i, string_split(unit, chr(1))[1] AS piece, coalesce(string_split(unit, chr(1))[2], '') AS gap,
  regexp_extract(piece, '[^{WS[1:-1]}]+$') AS last_token, regexp_extract(piece, '^[^{WS[1:-1]}]+') AS first_token FROM v_units),
v_sides AS (SELECT doc_id, i, piece, gap, lag(last_token) OVER (PARTITION BY doc_id ORDER BY i) AS before_token, first_token FROM v_parts),
v_facts AS (SELECT doc_id, i, piece, gap, before_token, {_shape_sql('before_token', '_b')},
  {_shape_sql('first_token', '_a')}, regexp_extract(core_b, '\.\.+$') AS dots FROM v_sides),
v_known AS (SELECT *, type_b IN (SELECT type FROM v_abbr) AS abbr, (type_b, type_a) IN (SELECT (first, second) FROM v_coll) AS coll,
  type_a IN (SELECT type FROM v_start) AS start, type_a IN (SELECT type FROM v_decisive) AS decisive, type_b = '#' OR length(type_b) = 1 AS doubt FROM v_facts),
v_open AS (SELECT doc_id, i, piece, gap, CASE WHEN before_token IS NULL THEN true WHEN NOT stop_b THEN true WHEN dots <> '' THEN case_a <> -1
  WHEN coll THEN false WHEN abbr THEN case_a = 1 AND (decisive OR start) WHEN doubt AND case_a = -1 THEN false
  WHEN doubt AND type_b <> '#' AND case_a = 1 THEN decisive OR start ELSE true END AS opens FROM v_known),
v_run AS (SELECT *, sum(CASE WHEN opens THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM v_open),
v_sentence AS (SELECT doc_id, run, string_agg(piece || gap, '' ORDER BY i) AS s, arg_max(gap, i) AS tail FROM v_run GROUP BY 1, 2)"""

ORACLE = {
    "sentence_borders": f"""WITH {MODEL_SQL}
SELECT 'abbreviation' AS kind, type AS first, '' AS second, n, round(score, 2) AS score FROM v_abbr
UNION ALL SELECT 'collocation', first, second, n, round(score, 2) FROM v_coll
UNION ALL SELECT 'starter', type, '', n, round(score, 2) FROM v_start""",
    "sentence_split_trained": f"""WITH {MODEL_SQL}, {SPLIT_SQL}
SELECT doc_id, CAST(run - 1 AS INTEGER) AS pos, s[1:length(s) - length(tail)] AS sentence FROM v_sentence""",
}
