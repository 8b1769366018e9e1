"""Registered queries on cleaning, sections, sentences and chunks."""

from __future__ import annotations

from pyspark.sql import functions as F

from quaestor.catalog import inputs as src
from quaestor.catalog.scoring import WS
from quaestor.functions import text as tx
from quaestor.operators import chunks as ch
from quaestor.operators import sections as se
from quaestor.options import Options

# Small windows, so that most documents yield several chunks.
SMALL = Options(chunk_size_tokens=200, chunk_overlap_tokens=20, min_chunk_tokens=30)

WS_LINE = WS.replace(r"[\t-\r", r"[\t\x0b-\r")


def clean_sql(expr: str) -> str:
    for pattern, by in ((rf"\n{WS}*\n", "chr(10) || chr(10)"), (f"{WS_LINE}+", "' '"),
                        (rf"\n{WS}*\p{{Nd}}+{WS}*\n", "chr(10)"), (rf"(?i)table of contents{WS}*", "''"),
                        (r" ?\n ?", "chr(10)"), (r"\n{3,}", "chr(10) || chr(10)"), (rf"\A{WS}+|{WS}+\z", "''")):
        expr = f"regexp_replace({expr}, '{pattern}', {by}, 'g')"
    return expr


def _doc_sections(spark, sf_dir):
    """Every document as one section named after its source."""
    return src.heavy_table(spark, sf_dir, "documents", "doc_id").select(
        "doc_id", F.col("source").alias("section"), F.col("text").alias("full_text"))


def clean_text(spark, sf_dir):
    return src.filings(spark, sf_dir).select("doc_id", tx.clean_text(F.col("full_text")).alias("cleaned"))


def estimate_tokens(spark, sf_dir):
    return src.heavy_table(spark, sf_dir, "documents", "doc_id").select("doc_id", tx.estimate_tokens(F.col("text")).alias("tokens"))


def section_markers(spark, sf_dir):
    return se.section_markers(src.filings(spark, sf_dir)).select(
        "doc_id", "section", F.col("hits").cast("int").alias("hits"), "start_pos")


def section_split(spark, sf_dir):
    return se.split_sections(src.filings(spark, sf_dir))


def fallback_split(spark, sf_dir):
    docs = src.heavy_table(spark, sf_dir, "documents", "doc_id").select("doc_id", F.col("text").alias("full_text"))
    return se.fallback_split(docs)


def sentence_split(spark, sf_dir):
    return ch.sentences(src.heavy_table(spark, sf_dir, "documents", "doc_id"), "text")


def chunk_sections(spark, sf_dir):
    return ch.chunk_sections(_doc_sections(spark, sf_dir))


def chunk_sections_small(spark, sf_dir):
    return ch.chunk_sections(_doc_sections(spark, sf_dir), SMALL)


def chunk_offsets(spark, sf_dir):
    chunks = ch.chunk_sections(se.split_sections(src.filings(spark, sf_dir)), SMALL)
    return chunks.select("doc_id", "section", "chunk_index", "start_char", "end_char")


def chunk_stats(spark, sf_dir):
    return ch.chunk_stats(ch.chunk_sections(_doc_sections(spark, sf_dir), SMALL))


def num_questions_bucket(spark, sf_dir):
    return src.heavy_table(spark, sf_dir, "documents", "doc_id").select(
        "doc_id", ch.question_count(F.col("text")).alias("num_questions"))


QUERIES = {
    "clean_text": clean_text, "estimate_tokens": estimate_tokens, "section_markers": section_markers,
    "section_split": section_split, "fallback_split": fallback_split, "sentence_split": sentence_split,
    "chunk_sections": chunk_sections, "chunk_sections_small": chunk_sections_small,
    "chunk_offsets": chunk_offsets, "chunk_stats": chunk_stats, "num_questions_bucket": num_questions_bucket,
}


def _marker_sql() -> str:
    """All hits per pattern: the text before hit k is the joined first k pieces and hits."""
    arms = []
    for pattern, name in (*se.SECTION_PATTERNS, se.UNRESOLVED_PATTERN):
        inner = WS[1:-1]
        pattern = "(?i)" + pattern.replace(r"[.\s:]", f"[.:{inner}]").replace(r"\s", WS)
        arms.append(f"""SELECT doc_id, '{name}' AS section, regexp_extract_all(full_text, '{pattern}') AS found,
  length(full_text) AS total, length(regexp_split_to_array(full_text, '{pattern}')[-1]) AS tail FROM v_filing""")
    union = "\nUNION ALL ".join(arms)
    return f"""v_hits AS ({union}),
v_marks AS (SELECT doc_id, section, CAST(len(found) AS INTEGER) AS hits,
  CAST(total - tail - length(found[-1]) AS INTEGER) AS start_pos FROM v_hits WHERE len(found) > 0)"""


SECTION_SQL = f"""v_target AS (SELECT f.doc_id, m.section, m.start_pos, f.full_text,
  lead(m.start_pos, 1, CAST(length(f.full_text) AS INTEGER)) OVER (PARTITION BY f.doc_id ORDER BY m.start_pos) AS end_pos
  FROM v_filing f JOIN v_marks m ON m.doc_id = f.doc_id WHERE m.section <> 'Item 1B: Unresolved Staff Comments'),
v_cut AS (SELECT doc_id, section, start_pos, {clean_sql("substr(full_text, start_pos + 1, end_pos - start_pos)")} AS full_text FROM v_target),
v_kept AS (SELECT * FROM v_cut WHERE length(full_text) > 500),
v_lost AS (SELECT doc_id, {clean_sql("full_text")} AS c FROM v_filing WHERE doc_id NOT IN (SELECT doc_id FROM v_kept)),
v_sections AS (SELECT * FROM v_kept
  UNION ALL SELECT doc_id, 'Section ' || (i + 1), CAST(i * (length(c) // 5) AS INTEGER), CASE WHEN i < 4 THEN substr(c, i * (length(c) // 5) + 1, length(c) // 5)
    ELSE substr(c, i * (length(c) // 5) + 1) END FROM v_lost, range(0, 5) t(i))"""

DOC_SECTIONS_SQL = "v_sections AS (SELECT doc_id, source AS section, text AS full_text FROM documents)"


def chunk_sql(o: Options) -> str:
    """The packing loop as a recursive table with one row per section and sentence."""
    return f"""v_split AS (SELECT doc_id, section, full_text,
  string_split(regexp_replace(full_text, '([.!?]){WS}+', '\\1' || chr(1), 'g'), chr(1)) AS s,
  list_transform(regexp_extract_all(full_text, '[.!?]{WS}+'), lambda g: length(g) - 1) AS g FROM v_sections),
v_len AS (SELECT *, len(s) AS n, list_transform(s, lambda x: length(x) // 4) AS tok,
  list_transform(range(1, len(s) + 1), lambda k: length(s[k]) + coalesce(g[k], 0)) AS reach FROM v_split),
v_pos AS (SELECT *, list_transform(range(0, n + 1), lambda k: CAST(coalesce(list_sum(reach[1:k]), 0) AS BIGINT)) AS pos FROM v_len),
v_walk(doc_id, section, n, tok, i, lo, cur, cut_lo, cut_hi) AS (
  SELECT doc_id, section, n, tok, CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(-1 AS BIGINT), CAST(-1 AS BIGINT) FROM v_pos
  UNION ALL
  SELECT doc_id, section, n, tok, i + 1, new_lo,
    CAST(CASE WHEN flush THEN coalesce(list_sum(tok[new_lo + 1:i]), 0) ELSE cur END + tok[i + 1] AS BIGINT),
    CASE WHEN flush THEN lo ELSE -1 END, CASE WHEN flush THEN i ELSE -1 END
  FROM (SELECT *, CASE WHEN flush THEN coalesce(list_max(list_filter(range(lo, i),
      lambda j: list_sum(tok[j + 1:i]) >= {o.chunk_overlap_tokens})), i) ELSE lo END AS new_lo
    FROM (SELECT *, i > lo AND cur + tok[i + 1] > {o.chunk_size_tokens} AS flush FROM v_walk WHERE i < n))),
v_win AS (SELECT doc_id, section, cut_lo AS lo, cut_hi AS hi, false AS final FROM v_walk WHERE cut_hi >= 0
  UNION ALL SELECT doc_id, section, lo, n, true FROM v_walk WHERE i = n),
v_text AS (SELECT w.doc_id, w.section, w.lo, w.hi, array_to_string(p.s[w.lo + 1:w.hi], ' ') AS text,
  CASE WHEN w.lo = 0 THEN 0 ELSE p.pos[w.lo + 1] END AS start_char,
  CASE WHEN w.final THEN length(p.full_text) ELSE p.pos[w.hi] + length(p.s[w.hi]) END AS end_char
  FROM v_win w JOIN v_pos p ON p.doc_id = w.doc_id AND p.section = w.section),
v_chunk AS (SELECT doc_id, section, CAST(row_number() OVER (PARTITION BY doc_id, section ORDER BY lo, hi) - 1 AS INTEGER) AS chunk_index,
  text, CAST(start_char AS INTEGER) AS start_char, CAST(end_char AS INTEGER) AS end_char FROM v_text WHERE length(text) // 4 >= {o.min_chunk_tokens})"""


CHUNK_COLS = "SELECT doc_id, section, chunk_index, text, start_char, end_char FROM v_chunk"

ORACLE = {
    "clean_text": src.with_ctes(src.FILING_SQL, body=f"SELECT doc_id, {clean_sql('full_text')} AS cleaned FROM v_filing"),
    "estimate_tokens": "SELECT doc_id, CAST(length(text) // 4 AS INTEGER) AS tokens FROM documents",
    "section_markers": src.with_ctes(src.FILING_SQL, _marker_sql(), body="SELECT doc_id, section, hits, start_pos FROM v_marks"),
    "section_split": src.with_ctes(src.FILING_SQL, _marker_sql(), SECTION_SQL,
                                   body="SELECT doc_id, section, start_pos, full_text FROM v_sections"),
    "fallback_split": f"""WITH c AS (SELECT doc_id, {clean_sql('text')} AS c FROM documents)
SELECT doc_id, 'Section ' || (i + 1) AS section, CAST(i * (length(c) // 5) AS INTEGER) AS start_pos,
  CASE WHEN i < 4 THEN substr(c, i * (length(c) // 5) + 1, length(c) // 5) ELSE substr(c, i * (length(c) // 5) + 1) END AS full_text
FROM c, range(0, 5) t(i)""",
    "sentence_split": rf"""SELECT doc_id, CAST(p - 1 AS INTEGER) AS pos, s[p] AS sentence FROM (SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS p FROM (
SELECT doc_id, string_split(regexp_replace(text, '([.!?]){WS}+', '\1' || chr(1), 'g'), chr(1)) AS s FROM documents))""",
    "chunk_sections": src.with_ctes(DOC_SECTIONS_SQL, chunk_sql(Options()), body=CHUNK_COLS, recursive=True),
    "chunk_sections_small": src.with_ctes(DOC_SECTIONS_SQL, chunk_sql(SMALL), body=CHUNK_COLS, recursive=True),
    "chunk_offsets": src.with_ctes(src.FILING_SQL, _marker_sql(), SECTION_SQL, chunk_sql(SMALL), recursive=True,
                                   body="SELECT doc_id, section, chunk_index, start_char, end_char FROM v_chunk"),
    "chunk_stats": src.with_ctes(DOC_SECTIONS_SQL, chunk_sql(SMALL), recursive=True, body="""
SELECT section, count(*) AS n_chunks, CAST(sum(length(text) // 4) // count(*) AS BIGINT) AS avg_tokens FROM v_chunk GROUP BY 1"""),
    "num_questions_bucket": """SELECT doc_id, CASE WHEN length(text) // 4 > 1500 THEN 8 WHEN length(text) // 4 > 800 THEN 6 ELSE 5 END AS num_questions
FROM documents""",
}
