"""Packing sentences into overlapping chunks.

Everything happens inside the row of a section, without a shuffle. The fold
over the sentences sees only their lengths; chunk texts are cut afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quaestor.functions import text as tx
from quaestor.functions.binding import bind
from quaestor.operators.borders import Borders, with_sentences
from quaestor.options import Options

PIECE = "array<struct<lo:int,hi:int,start_char:int,end_char:int>>"


def _overlap(lengths: Column, lo: Column, hi: Column, overlap_tokens: int) -> Column:
    """Shortest run of sentences before ``hi`` that reaches the overlap.

    Walks back from ``hi`` and adds up tokens and characters until the
    overlap is reached; ``n`` stays at the run's length from then on.
    """
    window = F.reverse(F.slice(lengths, lo + 1, hi - lo))

    def step(acc: Column, s: Column) -> Column:
        done = acc["tokens"] >= overlap_tokens
        return F.struct(F.when(done, acc["n"]).otherwise(acc["n"] + 1).alias("n"),
                        F.when(done, acc["tokens"]).otherwise(acc["tokens"] + s["tokens"]).alias("tokens"),
                        F.when(done, acc["chars"]).otherwise(acc["chars"] + s["reach"]).alias("chars"))

    def finish(acc: Column) -> Column:
        reached = acc["tokens"] >= overlap_tokens
        return F.struct(*[F.when(reached, acc[k]).otherwise(0).alias(k) for k in ("n", "tokens", "chars")])

    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("tokens"), F.lit(0).alias("chars"))
    return F.aggregate(window, zero, step, finish)


def _pack(lengths: Column, text_length: Column, size: int, overlap_tokens: int) -> Column:
    """Windows ``[lo, hi)`` of sentences with their character range."""

    def step(acc: Column, s: Column) -> Column:
        full = (acc["i"] > acc["lo"]) & (acc["tokens"] + s["tokens"] > size)
        kept = F.when(full, _overlap(lengths, acc["lo"], acc["i"], overlap_tokens))

        def moved(k: Column) -> Column:
            return F.struct(
                (acc["i"] + 1).alias("i"),
                F.when(full, acc["i"] - k["n"]).otherwise(acc["lo"]).alias("lo"),
                (F.when(full, k["tokens"]).otherwise(acc["tokens"]) + s["tokens"]).alias("tokens"),
                F.when(full, acc["pos"] - k["chars"]).otherwise(acc["start"]).alias("start"),
                (acc["pos"] + s["reach"]).alias("pos"),
                (acc["pos"] + s["chars"]).alias("end"),
                F.when(full, F.concat(acc["out"], F.array(F.struct(
                    acc["lo"].alias("lo"), acc["i"].alias("hi"), acc["start"].alias("start_char"),
                    acc["end"].alias("end_char"))))).otherwise(acc["out"]).alias("out"))

        return bind(kept, moved)

    zero = F.struct(F.lit(0).alias("i"), F.lit(0).alias("lo"), F.lit(0).alias("tokens"), F.lit(0).alias("start"),
                    F.lit(0).alias("pos"), F.lit(0).alias("end"), F.array().cast(PIECE).alias("out"))

    def finish(acc: Column) -> Column:
        last = F.struct(acc["lo"].alias("lo"), acc["i"].alias("hi"), acc["start"].alias("start_char"),
                        text_length.alias("end_char"))
        return F.concat(acc["out"], F.array(last))

    return F.aggregate(lengths, zero, step, finish)


def _with_sentences(texts: DataFrame, text: str, borders: Borders | None, gaps: str | None = "_gaps") -> DataFrame:
    """Arrays ``_sentences`` and ``_gaps``, by learned borders (without the latter if not named) or by the plain pattern."""
    if borders is not None:
        return with_sentences(texts, borders, text, "_sentences", gaps)
    return texts.withColumns({"_sentences": tx.split_sentences(F.col(text)), "_gaps": tx.sentence_gaps(F.col(text))})


def chunk_sections(sections: DataFrame, options: Options = Options(), borders: Borders | None = None) -> DataFrame:
    """Overlapping chunks of whole sentences; short chunks are dropped before numbering.

    Sentences end where ``borders`` (see :mod:`quaestor.operators.borders`) has
    learned, or at every end mark before white space. Other columns of a section are repeated on its chunks.

    A chunk's text joins its sentences with one space, so it can differ from
    the text between its offsets.
    """
    text = F.col("full_text")
    split = _with_sentences(sections, "full_text", borders)
    lengths = F.transform("_sentences", lambda s, i: F.struct(
        tx.estimate_tokens(s).alias("tokens"), F.length(s).alias("chars"),
        (F.length(s) + F.coalesce(F.length(F.get(F.col("_gaps"), i)), F.lit(0))).alias("reach")))
    packed = split.withColumn("_lengths", lengths).withColumn(
        "_windows", _pack(F.col("_lengths"), F.length(text), options.chunk_size_tokens,
                          options.chunk_overlap_tokens))
    chunks = F.filter(
        F.transform("_windows", lambda w: F.struct(
            F.array_join(F.slice("_sentences", w["lo"] + 1, w["hi"] - w["lo"]), " ").alias("text"),
            w["start_char"].alias("start_char"), w["end_char"].alias("end_char"))),
        lambda c: tx.estimate_tokens(c["text"]) >= options.min_chunk_tokens)
    kept = [c for c in sections.columns if c != "full_text"]
    return (packed.select(*kept, F.posexplode(chunks).alias("chunk_index", "_c"))
            .select(*kept, "chunk_index", "_c.text", "_c.start_char", "_c.end_char"))


def sentences(texts: DataFrame, text_col: str = "full_text", borders: Borders | None = None) -> DataFrame:
    """One row per sentence."""
    return _with_sentences(texts, text_col, borders, None).select("doc_id", F.posexplode("_sentences").alias("pos", "sentence"))


def chunk_stats(chunks: DataFrame) -> DataFrame:
    """Chunks and floored mean tokens per section."""
    tokens = tx.estimate_tokens(F.col("text")).cast("bigint")
    return (chunks.groupBy("section")
            .agg(F.count(F.lit(1)).alias("n_chunks"), F.sum(tokens).alias("_tokens"))
            .select("section", "n_chunks", F.floor(F.col("_tokens") / F.col("n_chunks")).alias("avg_tokens")))


def question_count(text: Column, options: Options = Options()) -> Column:
    """How many questions to ask about a chunk of this length."""
    tokens = tx.estimate_tokens(text)
    return (F.when(tokens > 1500, options.qa_per_chunk_max)
            .when(tokens > 800, options.qa_per_chunk_min + 1).otherwise(options.qa_per_chunk_min))
