"""Registered queries on TF-IDF weights and near-duplicate removal, over whole documents.

Documents play the questions; those of one source are compared with each other.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quaestor.catalog import inputs as src
from quaestor.operators import dedup, tfidf
from quaestor.session import pin


def _questions(spark, sf_dir):
    return src.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("ord"), F.col("source").alias("scope"), F.col("text").alias("question"),
        F.when(F.col("doc_id") % 3 == 0, "easy").when(F.col("doc_id") % 3 == 1, "medium")
        .otherwise("hard").alias("difficulty_estimate"))


def _weights(spark, sf_dir):
    rows = dedup._rows(_questions(spark, sf_dir), "ord", "question", "difficulty_estimate", "scope")
    arrays = pin(tfidf.term_arrays(dedup.distinct_texts(rows)).select("scope", "text_id", "copies", "counts"), "terms")
    counts = tfidf.exploded(arrays)
    return arrays.drop("counts"), counts, tfidf.vocabulary(counts)


def tfidf_vocab(spark, sf_dir):
    return _weights(spark, sf_dir)[2].select("scope", "term", "corpus_tf", "df", "term_id")


def tfidf_weights(spark, sf_dir):
    texts, counts, vocab = _weights(spark, sf_dir)
    return tfidf.weights(texts, counts, pin(vocab, "vocabulary")).select("scope", "text_id", "term_id", F.round("w", 6).alias("weight"))


def tfidf_similar_pairs(spark, sf_dir):
    found = dedup.resolve(_questions(spark, sf_dir), scope="scope", all_removals=True)
    return dedup.duplicate_pairs(found).select("scope", "i", "j", "removed", F.round("similarity", 6).alias("similarity"))


def dedup_survivors(spark, sf_dir):
    return dedup.survivors(_questions(spark, sf_dir), scope="scope").select("scope", "ord", "difficulty_estimate")


def dedup_survivors_corpus(spark, sf_dir):
    """All documents against each other, whatever their source."""
    return dedup.survivors(_questions(spark, sf_dir)).select("ord", "difficulty_estimate")


def dedup_survivors_filings(spark, sf_dir):
    """Fifty documents in a row as the questions of one filing: scopes grow in number, not in size."""
    rows = _questions(spark, sf_dir).withColumn("scope", F.floor(F.col("ord") / 50))
    return dedup.survivors(rows, scope="scope").select("scope", "ord", "difficulty_estimate")


def dedup_summary(spark, sf_dir):
    return dedup.summary(dedup.resolve(_questions(spark, sf_dir), scope="scope"))


QUERIES = {
    "tfidf_vocab": tfidf_vocab, "tfidf_weights": tfidf_weights, "tfidf_similar_pairs": tfidf_similar_pairs,
    "dedup_survivors": dedup_survivors, "dedup_survivors_corpus": dedup_survivors_corpus,
    "dedup_survivors_filings": dedup_survivors_filings,
    "dedup_summary": dedup_summary,
}

_STOP = ", ".join(f"'{w}'" for w in tfidf.STOP_WORDS)


def weights_sql(scope: str) -> str:
    """Weights of every row, copies included."""
    return f"""q AS (SELECT {scope} AS scope, doc_id AS ord, text AS question, 1 + doc_id % 3 AS rank,
  CASE doc_id % 3 WHEN 0 THEN 'easy' WHEN 1 THEN 'medium' ELSE 'hard' END AS difficulty_estimate FROM documents),
w AS (SELECT scope, ord, list_filter(regexp_extract_all(lower(question), '[\\p{{L}}\\p{{N}}_]{{2,}}'), lambda t: t NOT IN ({_STOP})) AS ws FROM q),
t AS (SELECT scope, ord, term, count(*) AS tf FROM (
  SELECT scope, ord, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda k: ws[k] || ' ' || ws[k + 1]))) AS term FROM w) GROUP BY ALL),
v AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY scope ORDER BY corpus_tf DESC, term) AS term_id FROM (
  SELECT scope, term, CAST(sum(tf) AS BIGINT) AS corpus_tf, count(*) AS df FROM t GROUP BY 1, 2)
  QUALIFY row_number() OVER (PARTITION BY scope ORDER BY corpus_tf DESC, term) <= 5000),
n AS (SELECT scope, count(*) AS n FROM q GROUP BY 1),
r AS (SELECT scope, ord, term_id, tf * (ln((1.0 + n) / (1 + df)) + 1) AS x FROM t JOIN v USING (scope, term) JOIN n USING (scope)),
x AS MATERIALIZED (SELECT scope, ord, term_id, x / sqrt(sum(x * x) OVER (PARTITION BY scope, ord)) AS weight FROM r)"""


def greedy_sql(scope: str) -> str:
    """The pass over similar pairs in order; ``rj`` and ``ri`` list the removed later and earlier rows.

    Rows with an inner product above 0.85 share one of the rarest terms that
    hold over 1 - 0.85 * 0.85 of a row's mass, so only such pairs are summed.
    """
    return weights_sql(scope) + """,
p AS MATERIALIZED (SELECT scope, ord, term_id FROM (
  SELECT scope, ord, term_id, weight, sum(weight * weight) OVER (PARTITION BY scope, ord ORDER BY df, term_id) AS mass FROM x JOIN v USING (scope, term_id))
  WHERE mass - weight * weight < 1 - 0.85 * 0.85 + 1e-9),
c AS MATERIALIZED (SELECT DISTINCT scope, a.ord AS i, b.ord AS j FROM p a JOIN p b USING (scope, term_id) WHERE a.ord < b.ord),
e AS MATERIALIZED (SELECT c.scope, c.i, c.j, sum(a.weight * b.weight) AS similarity FROM c JOIN x a ON a.scope = c.scope AND a.ord = c.i
  JOIN x b ON b.scope = c.scope AND b.ord = c.j AND b.term_id = a.term_id GROUP BY ALL HAVING sum(a.weight * b.weight) > 0.85),
f AS MATERIALIZED (SELECT e.*, qi.rank >= qj.rank AS kills, row_number() OVER (ORDER BY e.scope, i, j) AS step
  FROM e JOIN q qi ON qi.ord = i JOIN q qj ON qj.ord = j),
g(step, rj, ri, i, j, gone) AS (
  SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[]), CAST([] AS BIGINT[]), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)
  UNION ALL
  SELECT f.step, CASE WHEN live AND kills THEN list_append(rj, f.j) ELSE rj END,
    CASE WHEN live AND NOT kills THEN list_append(ri, f.i) ELSE ri END,
    f.i, f.j, CASE WHEN live THEN CASE WHEN kills THEN f.j ELSE f.i END END
  FROM (SELECT g.rj, g.ri, f.*, NOT list_contains(g.rj, f.i) AND NOT list_contains(g.rj, f.j)
      AND NOT list_contains(g.ri, f.j) AS live FROM g JOIN f ON f.step = g.step + 1) f),
gone AS (SELECT DISTINCT gone AS ord FROM g WHERE gone IS NOT NULL)"""


ORACLE = {
    "tfidf_vocab": src.with_ctes(weights_sql("source"), body="SELECT scope, term, corpus_tf, df, CAST(term_id AS INTEGER) AS term_id FROM v"),
    "tfidf_weights": src.with_ctes(weights_sql("source"), body="""
SELECT scope, min(ord) AS text_id, CAST(term_id AS INTEGER) AS term_id, round(min(weight), 6) AS weight
FROM x JOIN (SELECT scope, ord, question FROM q) USING (scope, ord) GROUP BY scope, question, term_id"""),
    "dedup_survivors": src.with_ctes(greedy_sql("source"), recursive=True,
                                     body="SELECT scope, ord, difficulty_estimate FROM q WHERE ord NOT IN (SELECT ord FROM gone)"),
    "dedup_survivors_corpus": src.with_ctes(greedy_sql("''"), recursive=True,
                                            body="SELECT ord, difficulty_estimate FROM q WHERE ord NOT IN (SELECT ord FROM gone)"),
    "dedup_survivors_filings": src.with_ctes(greedy_sql("doc_id // 50"), recursive=True,
                                             body="SELECT scope, ord, difficulty_estimate FROM q WHERE ord NOT IN (SELECT ord FROM gone)"),
    "tfidf_similar_pairs": src.with_ctes(
        greedy_sql("source"), "k AS (SELECT scope, ord, min(ord) OVER (PARTITION BY scope, question, rank) AS node FROM q)",
        recursive=True, body="""
SELECT g.scope, g.i, g.j, g.gone AS removed, round(f.similarity, 6) AS similarity
FROM (SELECT f.scope, g.* FROM g JOIN f ON f.step = g.step WHERE g.gone IS NOT NULL) g JOIN f ON f.step = g.step
JOIN k ON k.ord = g.j WHERE k.node = g.j"""),
    "dedup_summary": src.with_ctes(greedy_sql("source"), recursive=True, body="""
SELECT count(*) AS total, (SELECT count(*) FROM g WHERE gone IS NOT NULL) AS duplicate_pairs,
  (SELECT count(*) FROM gone) AS removed, count(*) - (SELECT count(*) FROM gone) AS remaining FROM q"""),
}
