"""Registered queries on finished datasets, verification and supplements."""

from __future__ import annotations

from pyspark.sql import functions as F

from quaestor.catalog import inputs as src
from quaestor.catalog import texts as tq
from quaestor.catalog.scoring import CONFIDENCE_SQL
from quaestor.functions import text as tx
from quaestor.operators import batch_calls as bc
from quaestor.operators import chunks as ch
from quaestor.operators import cleanup as cl
from quaestor.operators import generate as ge
from quaestor.operators import report as rp
from quaestor.operators import sections as se
from quaestor.operators import summaries as sm
from quaestor.operators import supplement as su
from quaestor.operators import verify as vf
from quaestor.session import pin

QUANTILES = (0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0)
QA_COLS = ["ord", "question", "ground_truth_answer", "source_passage", "question_type", "difficulty_estimate",
           "section", "confidence_score", "reasoning_steps"]


def _dist(column):
    def query(spark, sf_dir):
        return rp.distribution(src.qa_pairs(spark, sf_dir), column).select(
            column, "count", F.round("pct", 6).alias("pct"), "label", "bar")
    return query


def _dist_sql(column):
    return src.with_ctes(src.QA_SQL, body=f"""SELECT {column}, count(*) AS count, round(count(*) * 100.0 / (SELECT count(*) FROM v_qa), 6) AS pct,
  format('{{:.1f}}%', count(*)::DOUBLE * 100.0 / (SELECT count(*) FROM v_qa)::DOUBLE) AS label,
  repeat('█', CAST(floor(count(*) * 100.0 / (SELECT count(*) FROM v_qa) / 5) AS INTEGER)) AS bar FROM v_qa WHERE {column} IS NOT NULL GROUP BY 1""")


def dist_difficulty(spark, sf_dir):
    return rp.fixed_distribution(src.qa_pairs(spark, sf_dir), "difficulty_estimate").select(
        "pos", "difficulty_estimate", "count", F.round("pct", 6).alias("pct"), "label", "bar")


def length_stats(spark, sf_dir):
    stats = rp.length_stats(src.qa_pairs(spark, sf_dir))
    return stats.select(*[F.round(c, 6).alias(c) if c.endswith("avg") else F.col(c) for c in stats.columns])


def length_quantiles(spark, sf_dir):
    """Quantiles of text lengths per language from summaries per source, and whether their exact ranks are within bounds."""
    docs = src.table(spark, sf_dir, "documents").select("lang", "source", "text")
    stored = pin(sm.length_summaries(docs, "text", ["lang", "source"]), "summaries")
    found = sm.quantiles(sm.merged(stored, ["lang"]), QUANTILES)
    ranks = (docs.where("text IS NOT NULL").select("lang", F.length("text").alias("own")).groupBy("lang", "own").agg(F.count(F.lit(1)).alias("_c"))
             .join(found.withColumnRenamed("lang", "_lang"), F.col("lang").eqNullSafe(F.col("_lang"))))
    below, upto = (F.sum(F.when(c, F.col("_c")).otherwise(0)) / F.col("n") for c in (F.col("own") < F.col("length"), F.col("own") <= F.col("length")))
    return ranks.groupBy("lang", "share", "n").agg(
        ((below <= F.col("share") + sm.RANK_ERROR) & (upto >= F.col("share") - sm.RANK_ERROR)).alias("within_bounds"))


def reasoning_coverage(spark, sf_dir):
    return rp.reasoning_coverage(src.qa_pairs(spark, sf_dir)).withColumn("pct", F.round("pct", 6))


def report_samples(spark, sf_dir):
    return rp.samples(src.qa_pairs(spark, sf_dir)).select("type_pos", "title", "sample", "ord", "question",
                                                          "ground_truth_answer", "difficulty_estimate", "section")


def gen_distribution(spark, sf_dir):
    return ge.distribution_of_raw(src.qa_pairs(spark, sf_dir).withColumnRenamed("difficulty_estimate", "difficulty"))


def distinct_sections(spark, sf_dir):
    return src.qa_pairs(spark, sf_dir).select("section").distinct()


def fake_calculation(spark, sf_dir):
    docs = src.heavy_table(spark, sf_dir, "documents", "doc_id").select(F.col("doc_id").alias("ord"), tx.is_fake_calculation(F.col("text")).alias("fake"))
    qa = src.qa_pairs(spark, sf_dir).select("ord", tx.is_fake_calculation(F.col("reasoning_steps")).alias("fake"))
    return docs.withColumn("origin", F.lit("document")).unionByName(qa.withColumn("origin", F.lit("pair")))


def fake_multi_step(spark, sf_dir):
    return src.qa_pairs(spark, sf_dir).select("ord", tx.is_fake_multi_step(F.col("source_passage")).alias("fake"))


def taxonomy_cleanup(spark, sf_dir):
    return cl.clean_taxonomy(src.qa_pairs(spark, sf_dir)).select(*QA_COLS)


def cleanup_counters(spark, sf_dir):
    return cl.cleanup_counters(cl.clean_taxonomy(src.qa_pairs(spark, sf_dir)))


def _batched(spark, sf_dir):
    return vf.assign_batches(src.qa_pairs(spark, sf_dir))


def _verdict_rows(spark, sf_dir, batched):
    """Verdicts by batch and index: some indices lie beyond the batch, some come twice."""
    facts = batched.select("ord", "batch_id", "qa_index").join(src.verdicts(spark, sf_dir), "ord")
    shifted = facts.withColumn("qa_index", F.when(F.col("ord") % 13 == 0, F.col("qa_index") + 5).otherwise(F.col("qa_index")))
    copies = F.when(F.col("ord") % 17 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return shifted.withColumn("copy", F.explode(copies)).drop("ord")


def _judged(spark, sf_dir):
    batched = _batched(spark, sf_dir)
    return vf.join_verdicts(batched, _verdict_rows(spark, sf_dir, batched))


def verify_batches(spark, sf_dir):
    return _batched(spark, sf_dir).select("ord", "batch_id", "qa_index")


def verify_batch_text(spark, sf_dir):
    return vf.batch_texts(_batched(spark, sf_dir))


def verify_batch_calls(spark, sf_dir):
    """The texts of verify_batch_text, put together by a table function with one partition per batch."""
    return bc.call_batches(_batched(spark, sf_dir))


def verify_join(spark, sf_dir):
    return _judged(spark, sf_dir).select("ord", "batch_id", "qa_index", "is_faithful", "is_answerable", "confidence", "copy")


def verify_rejects(spark, sf_dir):
    batched = _batched(spark, sf_dir)
    audit = vf.verdict_audit(batched, _verdict_rows(spark, sf_dir, batched), order_by=["copy"])
    return audit.select("batch_id", "qa_index", "ord", "copy", "outcome")


def verify_accept(spark, sf_dir):
    return vf.accepted(_judged(spark, sf_dir)).select("ord", "copy", "confidence")


def verified_projection(spark, sf_dir):
    judged = vf.accepted(_judged(spark, sf_dir)).withColumn("confidence", F.nullif("confidence", F.lit(0.0)))
    pairs = judged.withColumnRenamed("ground_truth_answer", "answer").withColumnRenamed("difficulty_estimate", "difficulty")
    return vf.verified_dataset(pairs)


def acceptance_rate(spark, sf_dir):
    return vf.acceptance_rate(src.qa_pairs(spark, sf_dir), _judged(spark, sf_dir)).withColumn(
        "acceptance_rate", F.round("acceptance_rate", 6))


def rejection_reasons(spark, sf_dir):
    return vf.rejection_reasons(_judged(spark, sf_dir))


def reject_preview(spark, sf_dir):
    return vf.rejected(_judged(spark, sf_dir)).select("ord", "copy", "reasons", "question_preview")


def _covered(spark, sf_dir):
    """A labelled document counts as a section that already has pairs."""
    return src.table(spark, sf_dir, "labels").select(
        F.floor(F.col("doc_id") / 4).alias("doc_id"),
        F.element_at(F.array(*[F.lit(s) for s in COVERED]), (F.col("doc_id") % 4 + 1).cast("int")).alias("section"))


COVERED = ("Item 1: Business", "Item 1A: Risk Factors", "Item 7: MD&A", "Item 8: Financial Statements")


def missing_sections(spark, sf_dir):
    sections = se.split_sections(src.filings(spark, sf_dir)).select("doc_id", "section")
    return su.missing_sections(sections, _covered(spark, sf_dir))


def priority_topn(spark, sf_dir):
    chunks = ch.chunk_sections(se.split_sections(src.filings(spark, sf_dir)), tq.SMALL)
    missing = su.missing_sections(chunks, _covered(spark, sf_dir))
    return su.prioritize(missing).select("doc_id", "section", "chunk_index", "priority")


def missing_chunk_counts(spark, sf_dir):
    chunks = ch.chunk_sections(se.split_sections(src.filings(spark, sf_dir)), tq.SMALL)
    return su.chunks_per_section(su.missing_sections(chunks, _covered(spark, sf_dir)))


def merge_supplement(spark, sf_dir):
    existing = src.qa_pairs(spark, sf_dir).select("ord", "question")
    added = src.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("ord"), F.col("text").alias("question"))
    return su.merge_pairs(existing, added)


def _chunks(spark, sf_dir):
    docs = src.heavy_table(spark, sf_dir, "documents", "doc_id").select("doc_id", F.col("source").alias("section"), F.col("text").alias("full_text"))
    return ch.chunk_sections(docs)


def gen_prompt(spark, sf_dir):
    return ge.generation_prompts(_chunks(spark, sf_dir)).select("doc_id", "section", "chunk_index", "prompt")


def _responses(spark, sf_dir):
    """Responses as JSON text; of ten one each has an unknown type, no answer, a bracket ahead, its end cut off, text behind and a number as question."""
    case = F.col("ord") % 10
    kind = F.when(case == 1, "opinion").otherwise(F.col("question_type"))
    answer = F.when(case == 2, F.lit(None).cast("string")).otherwise(F.col("ground_truth_answer"))
    pair = F.struct("question", answer.alias("answer"), "source_passage", kind.alias("question_type"),
                    F.col("difficulty_estimate").alias("difficulty"), "reasoning_steps")
    text = F.to_json(F.struct(F.array(pair).alias("qa_pairs")))
    numbered = F.to_json(F.struct(F.array(pair.withField("question", F.col("ord"))).alias("qa_pairs")))
    response = (F.when(case == 3, F.concat(F.lit("["), text)).when(case == 4, F.substring(text, 1, F.length(text) - 3))
                .when(case == 5, F.concat(text, F.lit(" done"))).when(case == 6, numbered).otherwise(F.concat(F.lit(" \n"), text)))
    return src.qa_pairs(spark, sf_dir).select("ord", response.alias("response"))


def parse_llm_json(spark, sf_dir):
    parsed = ge.parse_generation(_responses(spark, sf_dir))
    return ge.explode_generation(parsed, "ord").select("ord", "question", "answer", "question_type", "difficulty", "reasoning_steps")


def _verdict_responses(spark, sf_dir):
    """Verdicts as JSON text: values in quotation marks, numbers for truth values, wrong words, cut ends, text behind."""
    case = F.col("ord") % 7

    def as_text(name):
        plain = F.col(name).cast("string")
        number = F.when(F.col(name), "1").otherwise("0.0")
        word = F.when(F.col(name), '"Yes"').otherwise('"off"')
        return F.when(case == 1, word).when(case == 2, number).otherwise(plain)
    index = (F.col("ord") % 5).cast("string")
    confidence = F.col("confidence").cast("string")
    text = F.concat(F.lit('{"results":[{"qa_index":'), F.when(case == 2, F.concat(index, F.lit(".0"))).otherwise(index),
                    F.lit(',"is_faithful":'), F.when(case == 3, '"maybe"').otherwise(as_text("is_faithful")),
                    F.lit(',"is_answerable":'), as_text("is_answerable"), F.lit(',"confidence":'),
                    F.when(case == 1, F.concat(F.lit('"'), confidence, F.lit('"'))).otherwise(confidence), F.lit(',"reasoning":"r"}]}'))
    response = F.when(case == 4, F.concat(text, F.lit("]"))).when(case == 5, F.concat(text, F.lit(","), text)).otherwise(text)
    return src.verdicts(spark, sf_dir).select("ord", F.col("ord").alias("batch_id"), response.alias("response"))


def parse_verification(spark, sf_dir):
    parsed = ge.parse_verification(_verdict_responses(spark, sf_dir))
    return ge.explode_verification(parsed, "ord").select("ord", "qa_index", "is_faithful", "is_answerable", "confidence")


QUERIES = {
    "dist_question_type": _dist("question_type"), "dist_section": _dist("section"), "dist_difficulty": dist_difficulty,
    "length_stats": length_stats, "length_quantiles": length_quantiles, "reasoning_coverage": reasoning_coverage, "report_samples": report_samples,
    "gen_distribution": gen_distribution, "distinct_sections": distinct_sections, "fake_calculation": fake_calculation,
    "fake_multi_step": fake_multi_step, "taxonomy_cleanup": taxonomy_cleanup, "cleanup_counters": cleanup_counters,
    "verify_batches": verify_batches, "verify_batch_text": verify_batch_text, "verify_batch_calls": verify_batch_calls, "verify_join": verify_join,
    "verify_rejects": verify_rejects, "verify_accept": verify_accept, "verified_projection": verified_projection, "acceptance_rate": acceptance_rate,
    "rejection_reasons": rejection_reasons, "reject_preview": reject_preview, "missing_sections": missing_sections,
    "priority_topn": priority_topn, "missing_chunk_counts": missing_chunk_counts, "merge_supplement": merge_supplement,
    "gen_prompt": gen_prompt, "parse_llm_json": parse_llm_json, "parse_verification": parse_verification,
}

_TYPE_POS = """CASE question_type WHEN 'fact_extraction' THEN 1 WHEN 'numeric_calculation' THEN 2 WHEN 'comparison' THEN 3 ELSE 4 END"""
_FAKE_CALC = "NOT regexp_matches(lower(coalesce({0}, '')), '[-+*/=%x]|times|divided')"
_WS = tq.WS


def _fake_multi(column: str) -> str:
    return f"""len(list_filter(string_split(coalesce({column}, ''), '.'),
  lambda p: length(regexp_replace(p, '\\A{_WS}+|{_WS}+\\z', '', 'g')) > 5)) <= 1"""


CLEAN_SQL = f"""v_marked AS (SELECT *, question_type = 'numeric_calculation' AND {_FAKE_CALC.format('reasoning_steps')} AS fc,
  question_type = 'multi_step_reasoning' AND {_fake_multi('source_passage')} AS fm FROM v_qa),
v_typed AS (SELECT * REPLACE (CASE WHEN fc OR fm THEN 'fact_extraction' ELSE question_type END AS question_type,
  CASE WHEN fm THEN 'medium' ELSE difficulty_estimate END AS difficulty_estimate) FROM v_marked),
v_clean AS (SELECT ord, question, ground_truth_answer, source_passage, question_type, difficulty_estimate, section,
  {CONFIDENCE_SQL} AS confidence_score,
  CASE WHEN question_type IN ('fact_extraction', 'comparison') THEN NULL ELSE reasoning_steps END AS reasoning_steps FROM v_typed)"""

BATCH_SQL = """v_batch AS (SELECT *, CAST((row_number() OVER (ORDER BY ord) - 1) // 5 AS BIGINT) AS batch_id,
  CAST((row_number() OVER (ORDER BY ord) - 1) % 5 AS INTEGER) AS qa_index FROM v_qa)"""
JUDGED_SQL = """v_rows AS (SELECT b.batch_id, CASE WHEN b.ord % 13 = 0 THEN b.qa_index + 5 ELSE b.qa_index END AS qa_index,
  v.is_faithful, v.is_answerable, v.confidence, c.copy FROM v_batch b JOIN v_verdict v ON v.ord = b.ord
  JOIN (SELECT 0 AS copy UNION ALL SELECT 1) c ON c.copy = 0 OR b.ord % 17 = 0),
v_judged AS (SELECT b.*, r.is_faithful, r.is_answerable, r.confidence, r.copy FROM v_batch b JOIN v_rows r ON r.batch_id = b.batch_id AND r.qa_index = b.qa_index)"""
JUDGED = (src.QA_SQL, src.VERDICT_SQL, BATCH_SQL, JUDGED_SQL)
REASONS = """CASE WHEN NOT is_faithful AND NOT is_answerable THEN 'unfaithful, unanswerable' WHEN NOT is_faithful THEN 'unfaithful' ELSE 'unanswerable' END"""
COVERED_SQL = """v_covered AS (SELECT CAST(floor(doc_id / 4) AS BIGINT) AS doc_id, CASE doc_id % 4 WHEN 0 THEN 'Item 1: Business'
  WHEN 1 THEN 'Item 1A: Risk Factors' WHEN 2 THEN 'Item 7: MD&A' ELSE 'Item 8: Financial Statements' END AS section FROM labels)"""
FILING_CHUNKS = (src.FILING_SQL, tq._marker_sql(), tq.SECTION_SQL, tq.chunk_sql(tq.SMALL), COVERED_SQL)
MISSING_SQL = "v_missing AS (SELECT c.* FROM v_chunk c ANTI JOIN v_covered k ON k.doc_id = c.doc_id AND k.section = c.section)"
DOC_CHUNKS = (tq.DOC_SECTIONS_SQL, tq.chunk_sql(tq.Options()))


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


ORACLE = {
    "dist_question_type": _dist_sql("question_type"), "dist_section": _dist_sql("section"),
    "dist_difficulty": src.with_ctes(src.QA_SQL, body="""SELECT d.pos, d.name AS difficulty_estimate, count(q.ord) AS count,
  round(count(q.ord) * 100.0 / (SELECT count(*) FROM v_qa), 6) AS pct,
  format('{:.1f}%', count(q.ord)::DOUBLE * 100.0 / (SELECT count(*) FROM v_qa)::DOUBLE) AS label, repeat('█', CAST(floor(count(q.ord) * 100.0 / (SELECT count(*) FROM v_qa) / 5) AS INTEGER)) AS bar
FROM (VALUES (0, 'easy'), (1, 'medium'), (2, 'hard')) d(pos, name) LEFT JOIN v_qa q ON q.difficulty_estimate = d.name GROUP BY 1, 2"""),
    "length_stats": src.with_ctes(src.QA_SQL, body="""SELECT round(avg(length(source_passage)), 6) AS passage_avg, CAST(min(length(source_passage)) AS INTEGER) AS passage_min,
  CAST(max(length(source_passage)) AS INTEGER) AS passage_max, round(avg(length(ground_truth_answer)), 6) AS answer_avg, round(avg(length(question)), 6) AS question_avg FROM v_qa"""),
    "reasoning_coverage": src.with_ctes(src.QA_SQL, body="""SELECT count(reasoning_steps) AS has_reasoning,
  count(*) FILTER (question_type IN ('numeric_calculation', 'multi_step_reasoning')) AS needs_reasoning,
  round(count(reasoning_steps) * 100.0 / count(*) FILTER (question_type IN ('numeric_calculation', 'multi_step_reasoning')), 6) AS pct FROM v_qa"""),
    "report_samples": src.with_ctes(src.QA_SQL, body=f"""SELECT {_TYPE_POS} AS type_pos, CASE question_type WHEN 'fact_extraction' THEN 'Fact Extraction' WHEN 'numeric_calculation' THEN 'Numeric Calculation'
  WHEN 'comparison' THEN 'Comparison' ELSE 'Multi Step Reasoning' END AS title, CAST(row_number() OVER (PARTITION BY question_type ORDER BY ord) AS INTEGER) AS sample,
  ord, question, ground_truth_answer, difficulty_estimate, section FROM v_qa QUALIFY row_number() OVER (PARTITION BY question_type ORDER BY ord) <= 2"""),
    "gen_distribution": src.with_ctes(src.QA_SQL, body="""SELECT 'question_type' AS field, question_type AS value, count(*) AS count FROM v_qa GROUP BY 2
UNION ALL SELECT 'difficulty', difficulty_estimate, count(*) FROM v_qa GROUP BY 2"""),
    "distinct_sections": src.with_ctes(src.QA_SQL, body="SELECT DISTINCT section FROM v_qa"),
    "fake_calculation": src.with_ctes(src.QA_SQL, body=f"""SELECT doc_id AS ord, {_FAKE_CALC.format('text')} AS fake, 'document' AS origin FROM documents
UNION ALL SELECT ord, {_FAKE_CALC.format('reasoning_steps')}, 'pair' FROM v_qa"""),
    "fake_multi_step": src.with_ctes(src.QA_SQL, body=f"SELECT ord, {_fake_multi('source_passage')} AS fake FROM v_qa"),
    "taxonomy_cleanup": src.with_ctes(src.QA_SQL, CLEAN_SQL, body="SELECT * FROM v_clean"),
    "cleanup_counters": src.with_ctes(src.QA_SQL, CLEAN_SQL, body="SELECT count(*) FILTER (fc) AS downgraded_calculations, count(*) FILTER (fm) AS downgraded_multi_step FROM v_marked"),
    "verify_batches": src.with_ctes(src.QA_SQL, BATCH_SQL, body="SELECT ord, batch_id, qa_index FROM v_batch"),
    "verify_batch_text": src.with_ctes(src.QA_SQL, BATCH_SQL, body="""SELECT batch_id, count(*) AS batch_size, string_agg(concat('--- QA Pair ', qa_index, ' ---', chr(10), 'Section: ', section, chr(10),
  'Question: ', question, chr(10), 'Answer: ', ground_truth_answer, chr(10), 'Source Passage: ', source_passage, chr(10), 'Question Type: ', question_type, chr(10)), chr(10) ORDER BY qa_index) AS qa_pairs_text
FROM v_batch GROUP BY 1"""),
    "verify_join": src.with_ctes(*JUDGED, body="SELECT ord, batch_id, qa_index, is_faithful, is_answerable, confidence, copy FROM v_judged"),
    "verify_rejects": src.with_ctes(*JUDGED, body="""SELECT coalesce(b.batch_id, r.batch_id) AS batch_id, coalesce(b.qa_index, r.qa_index) AS qa_index, b.ord, r.copy,
  CASE WHEN r.batch_id IS NULL THEN 'without verdict' WHEN b.ord IS NULL THEN 'out of range' WHEN r.turn > 1 THEN 'repeated' ELSE 'matched' END AS outcome
FROM v_batch b FULL JOIN (SELECT *, row_number() OVER (PARTITION BY batch_id, qa_index ORDER BY copy) AS turn FROM v_rows) r
  ON r.batch_id = b.batch_id AND r.qa_index = b.qa_index"""),
    "verify_accept": src.with_ctes(*JUDGED, body="SELECT ord, copy, confidence FROM v_judged WHERE is_faithful AND is_answerable"),
    "verified_projection": src.with_ctes(*JUDGED, body="""SELECT ord, question, ground_truth_answer, source_passage, question_type, difficulty_estimate, section,
  coalesce(nullif(confidence, 0.0), 1.0) AS confidence_score, reasoning_steps FROM v_judged WHERE is_faithful AND is_answerable"""),
    "acceptance_rate": src.with_ctes(*JUDGED, body="""SELECT count(*) FILTER (is_faithful AND is_answerable) AS accepted, count(*) FILTER (NOT (is_faithful AND is_answerable)) AS rejected,
  (SELECT count(*) FROM v_qa) AS total, round(count(*) FILTER (is_faithful AND is_answerable) * 100.0 / (SELECT count(*) FROM v_qa), 6) AS acceptance_rate FROM v_judged"""),
    "rejection_reasons": src.with_ctes(*JUDGED, body=f"SELECT {REASONS} AS reasons, count(*) AS count FROM v_judged WHERE NOT (is_faithful AND is_answerable) GROUP BY 1"),
    "reject_preview": src.with_ctes(*JUDGED, body=f"SELECT ord, copy, {REASONS} AS reasons, substr(question, 1, 60) AS question_preview FROM v_judged WHERE NOT (is_faithful AND is_answerable)"),
    "missing_sections": src.with_ctes(src.FILING_SQL, tq._marker_sql(), tq.SECTION_SQL, COVERED_SQL, body="""SELECT s.doc_id, s.section FROM v_sections s
ANTI JOIN v_covered k ON k.doc_id = s.doc_id AND k.section = s.section"""),
    "priority_topn": src.with_ctes(*FILING_CHUNKS, MISSING_SQL, recursive=True, body="""
SELECT doc_id, section, chunk_index, priority FROM (SELECT *, CASE section WHEN 'Item 7: MD&A' THEN 1 WHEN 'Item 8: Financial Statements' THEN 2
  WHEN 'Item 1A: Risk Factors' THEN 3 WHEN 'Item 7A: Market Risk Disclosures' THEN 4 END AS priority,
  row_number() OVER (PARTITION BY doc_id, section ORDER BY chunk_index) AS n FROM v_missing) WHERE priority IS NOT NULL AND (priority <> 2 OR n <= 5)"""),
    "missing_chunk_counts": src.with_ctes(*FILING_CHUNKS, MISSING_SQL, recursive=True, body="SELECT section, count(*) AS n_chunks FROM v_missing GROUP BY 1"),
    "merge_supplement": src.with_ctes(src.QA_SQL, body="SELECT ord, question, 0 AS src_rank FROM v_qa UNION ALL SELECT item_id, text, 1 FROM benchmark"),
    "gen_prompt": src.with_ctes(*DOC_CHUNKS, recursive=True, body=f"""SELECT doc_id, section, chunk_index, concat({_literal(ge.GENERATION_HEAD)},
  CASE WHEN length(text) // 4 > 1500 THEN 8 WHEN length(text) // 4 > 800 THEN 6 ELSE 5 END, {_literal(ge.GENERATION_MIDDLE)}, section,
  chr(10), chr(10), '<passage>', chr(10), text, chr(10), '</passage>') AS prompt FROM v_chunk"""),
    "parse_llm_json": src.with_ctes(src.QA_SQL, body="""SELECT ord, question, ground_truth_answer AS answer, question_type, difficulty_estimate AS difficulty, reasoning_steps
FROM v_qa WHERE ord % 10 NOT IN (1, 2, 3, 4, 5, 6)"""),
    "parse_verification": src.with_ctes(src.QA_SQL, src.VERDICT_SQL, body="""SELECT ord, CAST(ord % 5 AS INTEGER) AS qa_index, is_faithful, is_answerable, confidence
FROM v_verdict WHERE ord % 7 NOT IN (3, 4, 5)"""),
}
ORACLE["length_quantiles"] = f"""SELECT lang, share, count(*) AS n, true AS within_bounds
FROM documents, (SELECT unnest([{', '.join(map(str, QUANTILES))}])::DOUBLE AS share) WHERE text IS NOT NULL GROUP BY 1, 2"""
ORACLE["verify_batch_calls"] = ORACLE["verify_batch_text"]
