"""From filings to a verified, deduplicated dataset with its report."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from quaestor.operators import chunks as ch
from quaestor.operators import dedup
from quaestor.operators import generate as ge
from quaestor.operators import report as rp
from quaestor.operators import sections as se
from quaestor.operators import supplement as su
from quaestor.operators import verify as vf
from quaestor.operators.borders import train
from quaestor.operators.ordinals import with_ordinal
from quaestor.options import Options
from quaestor.session import pin
from quaestor.sources import datasets as ds
from quaestor.sources import filings as fl
from quaestor.sources import stages as st
from quaestor.sources.providers import Provider

ORDER = ["doc_id", "start_pos", "chunk_index", "qa_pos"]
DATASET = ["question", "ground_truth_answer", "source_passage", "question_type", "difficulty_estimate", "section",
           "confidence_score", "reasoning_steps"]


@dataclass(frozen=True)
class Run:
    """Where a run keeps its stages and how it asks the provider."""
    stage_dir: str
    output_dir: str
    provider: Callable[[], Provider]
    options: Options = Options()
    resume: bool = False
    provider_tasks: int | None = None
    waves: int = 1  # parts in which requests are sent and stored
    single_file: bool = False
    trained_sentences: bool = True  # learn abbreviations and sentence starters from the filings

    @property
    def outputs(self) -> tuple[str, str]:
        return f"{self.output_dir}/qa_pairs.csv", f"{self.output_dir}/qa_pairs.jsonl"


def filing_chunks(html_filings: DataFrame, options: Options = Options(), trained: bool = False) -> DataFrame:
    """Chunks of every section of every filing, without a shuffle.

    With ``trained``, sentences end where the sections of all filings together
    teach (see :mod:`quaestor.operators.borders`); sections are stored then.
    """
    texts = fl.filing_texts(html_filings).select("doc_id", "full_text")
    sections = se.split_sections(texts, options.min_section_chars)
    if not trained:
        return ch.chunk_sections(sections, options)
    sections = pin(sections, "sections")
    return ch.chunk_sections(sections, options, train(sections, "full_text"))


def _in_waves(spark: SparkSession, run: Run, rows: DataFrame, keys: list[str], stage: str,
              send: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Answers to all rows, sent in ``run.waves`` parts.

    Each part is stored before the next is sent and before anything uses it,
    so a failure costs the requests of one part at most.
    """
    part = F.pmod(F.xxhash64(*keys), F.lit(run.waves))
    done = [st.run_stage(spark, run.stage_dir, f"{stage}_answers-{k}", lambda k=k: send(rows.where(part == k)), run.resume)
            for k in range(run.waves)]
    return reduce(DataFrame.unionByName, done)


def _generate(spark: SparkSession, run: Run, chunks: DataFrame, stage: str) -> DataFrame:
    answers = _in_waves(spark, run, chunks, ["doc_id", "start_pos", "chunk_index"], stage, lambda rows: ge.generate_pairs(
        rows, run.provider, run.options, run.provider_tasks))
    pairs = ge.explode_generation(answers, "doc_id", "section", "start_pos", "chunk_index")
    return st.run_stage(spark, run.stage_dir, stage, lambda: with_ordinal(pairs, ORDER, name="ord"), run.resume)


def _verify(spark: SparkSession, run: Run, pairs: DataFrame, stage: str) -> DataFrame:
    batched = st.run_stage(spark, run.stage_dir, f"{stage}_batches", lambda: vf.assign_batches(
        pairs, ["ord"], ["doc_id"], run.options.verification_batch_size), run.resume)
    answers = _in_waves(spark, run, batched, ["doc_id", "batch_id"], stage, lambda rows: ge.verify_pairs(
        rows, run.provider, ["doc_id"], run.options, run.provider_tasks))
    verdicts = ge.explode_verification(answers, "doc_id").drop("reasoning")
    judged = vf.join_verdicts(batched, verdicts, ["doc_id"], wrap_negative=True)
    audit = vf.verdict_audit(batched, verdicts, ["doc_id"], wrap_negative=True)
    st.run_stage(spark, run.stage_dir, "rejected", lambda: vf.rejects(judged, audit, run.options.question_preview), run.resume)
    return st.run_stage(spark, run.stage_dir, stage, lambda: vf.accepted(judged), run.resume)


def _requests(spark: SparkSession, run: Run, *stages: str) -> tuple[int, int]:
    """Requests sent, and batches that failed or had an invalid answer; their reasons are stored as ``failed``."""
    answers = [found.select("requests", "error", "is_valid") for stage in stages for k in range(run.waves)
               if (found := st.load_stage(spark, run.stage_dir, f"{stage}_answers-{k}")) is not None]
    if not answers:
        return 0, 0
    every = reduce(DataFrame.unionByName, answers)
    failed = st.save_stage(ge.failed_batches(every, run.options.error_preview), run.stage_dir, "failed")
    return (every.agg(F.coalesce(F.sum("requests"), F.lit(0))).first()[0],
            failed.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0])


def _finish(spark: SparkSession, run: Run, pairs: DataFrame, verified: DataFrame, started: float, sent: tuple[int, int],
            scope: str | None = "doc_id") -> dict:
    """Deduplicate within each filing, write the dataset and its report."""
    dataset = vf.verified_dataset(verified)
    kept = dedup.survivors(dataset, scope=scope, options=run.options)
    final = st.run_stage(spark, run.stage_dir, "final", lambda: kept, run.resume)
    calls, failed = sent
    ds.write_csv(final.select(*DATASET), run.outputs[0], run.single_file, run.resume)
    ds.write_jsonl(final.select(*DATASET), run.outputs[1], run.single_file, run.resume)
    raw, accepted, size = pairs.count(), verified.count(), final.count()
    text = rp.render_report(final, raw, accepted, accepted - size, time.time() - started, calls, run.options.cik)
    write_text(spark, text, f"{run.output_dir}/quality_report.md")
    return {"raw": raw, "verified": accepted, "removed": accepted - size, "final": size, "requests": calls, "failed_batches": failed,
            "enough": size >= run.options.min_qa_pairs}


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """One small text file through the Hadoop file system of the session."""
    target, fs = fl._hadoop_path(spark, path)
    stream = fs.create(target, True)
    stream.write(bytearray(text, "utf-8"))
    stream.close()


def build_dataset(spark: SparkSession, html_filings: DataFrame, run: Run, scope: str | None = "doc_id") -> dict:
    ds.check_target(spark, *run.outputs, resume=run.resume)
    started = time.time()
    chunks = filing_chunks(html_filings, run.options, run.trained_sentences)
    pairs = _generate(spark, run, chunks, "generation")
    verified = _verify(spark, run, pairs, "verification")
    return _finish(spark, run, pairs, verified, started, _requests(spark, run, "generation", "verification"), scope)


def supplement_dataset(spark: SparkSession, html_filings: DataFrame, run: Run, earlier_stages: str) -> dict:
    """Generate for sections without pairs, put the new pairs behind the old ones and verify all again.

    The earlier stages are read from their own folder and stay as they are.
    """
    ds.check_target(spark, *run.outputs, resume=run.resume)
    started = time.time()
    chunks = filing_chunks(html_filings, run.options, run.trained_sentences)
    existing = st.load_stage(spark, earlier_stages, "generation")
    if existing is None:
        pairs = _generate(spark, run, chunks, "generation")
    else:
        missing = su.prioritize(su.missing_sections(chunks, existing), run.options).drop("priority")
        added = _generate(spark, run, missing, "added")
        behind = existing.agg(F.coalesce(F.max("ord"), F.lit(-1)) + 1).scalar()
        merged = su.merge_pairs(existing, added.withColumn("ord", F.col("ord") + behind)).drop("src_rank")
        pairs = st.run_stage(spark, run.stage_dir, "generation", lambda: merged, run.resume)
    verified = _verify(spark, run, pairs, "verification")
    calls = _requests(spark, run, "added" if existing is not None else "generation", "verification")
    return _finish(spark, run, pairs, verified, started, calls)
