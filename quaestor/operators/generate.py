"""From chunks to question-answer pairs through a provider."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from quaestor.functions import text as tx
from quaestor.operators import verify as vf
from quaestor.operators.chunks import question_count
from quaestor.options import Options
from quaestor.schemas import (DIFFICULTIES, GENERATION_RESPONSE, QUESTION_TYPES, VERIFICATION_RESPONSE)
from quaestor.sources.providers import Provider, complete

# Words that stand for truth values.
TRUE_WORDS = ("true", "t", "yes", "y", "on", "1")
FALSE_WORDS = ("false", "f", "no", "n", "off", "0")

GENERATION_HEAD = """You write benchmark questions about annual reports.

Write exactly """
GENERATION_MIDDLE = """ question-answer pairs about the passage below. Cover every type at least once:
fact_extraction (direct lookup), numeric_calculation (needs arithmetic), comparison (two or more
items, years or segments) and multi_step_reasoning (combines two or more facts).

Rules:
- source_passage quotes the passage word for word.
- answer follows from source_passage alone and keeps its numbers, dates and units.
- reasoning_steps shows the steps for numeric_calculation and multi_step_reasoning, else null.
- difficulty is easy (one stated fact), medium (context or simple arithmetic) or hard (several steps).
- Respond as JSON: {"qa_pairs": [{"question", "answer", "source_passage", "question_type",
  "difficulty", "reasoning_steps"}]}.

Section: """
VERIFICATION_HEAD = """You check question-answer pairs about annual reports. Judge each pair twice:

- is_faithful: every claim and number of the answer stands in the source passage or follows from it.
- is_answerable: the source passage alone answers the question fully and without ambiguity.

Add a confidence from 0.0 (bad) to 1.0 (perfect) and a short reasoning. When in doubt, say false.
Respond as JSON: {"results": [{"qa_index", "is_faithful", "is_answerable", "confidence", "reasoning"}]}
with qa_index counting from 0.

"""


def generation_prompt(section: Column, text: Column, count: Column) -> Column:
    """Pieces are concatenated, so braces and markers inside the text stay untouched."""
    return F.concat(F.lit(GENERATION_HEAD), count.cast("string"), F.lit(GENERATION_MIDDLE), section,
                    F.lit("\n\n<passage>\n"), text, F.lit("\n</passage>"))


def generation_prompts(chunks: DataFrame, options: Options = Options()) -> DataFrame:
    count = question_count(F.col("text"), options)
    return chunks.withColumn("prompt", generation_prompt(F.col("section"), F.col("text"), count))


def _json_object(text: Column) -> Column:
    """The text as a variant if it is one JSON object and nothing else, else NULL.

    A parser that stops behind the first value would let trailing text pass;
    nothing can follow it in a list and in an object at the same time.
    """
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    held = F.try_parse_json(F.concat(F.lit('{"r":'), text, F.lit("}")))
    items = F.try_variant_get(listed, "$", "array<variant>")
    alone = held.isNotNull() & (F.size(items) == 1) & F.startswith(F.ltrim(text, F.lit(" \t\r\n")), F.lit("{"))
    return F.when(alone, F.get(items, F.lit(0)))


def _field(item: Column, name: str) -> tuple[Column, Column]:
    value = F.try_variant_get(item, f"$.{name}", "variant")
    return value, F.schema_of_variant(value)


def _text(item: Column, name: str) -> Column:
    value, kind = _field(item, name)
    return F.when(kind == "STRING", F.try_variant_get(value, "$", "string"))


def _number(item: Column, name: str) -> Column:
    """Numbers, numbers in quotation marks, and truth values as 1 and 0."""
    value, kind = _field(item, name)
    text = F.trim(F.try_variant_get(value, "$", "string"))
    return (F.when(kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean").cast("double"))
            .when(kind == "STRING", text.try_cast("double"))
            .when(kind.rlike("BIGINT|DECIMAL|DOUBLE|FLOAT"), F.try_variant_get(value, "$", "double")))


def _whole(item: Column, name: str) -> Column:
    return F.when(_number(item, name) == F.floor(_number(item, name)), _number(item, name).try_cast("int"))


def _truth(item: Column, name: str) -> Column:
    """Truth values, 1 and 0, and the words for them."""
    value, kind = _field(item, name)
    word = F.lower(F.try_variant_get(value, "$", "string"))
    number = _number(item, name)
    return (F.when(kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean"))
            .when(kind == "STRING", F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False))
            .when(number == 1, True).when(number == 0, False))


def _parse(answers: DataFrame, response: str, name: str, kind: str, fields: Callable[[Column], list[Column]],
           ok: Callable[[Column, Column], Column]) -> DataFrame:
    """``_parsed`` with the typed list ``name`` and ``is_valid``; ``ok`` judges an entry by its raw and its typed form."""
    listed = F.try_variant_get("_json", f"$.{name}", "array<variant>")
    typed = F.transform("_raw", lambda r: F.struct(*fields(r)))
    valid = F.col("_raw").isNotNull() & F.forall(F.arrays_zip(F.col("_raw").alias("raw"), typed.alias("typed")),
                                                 lambda x: F.coalesce(ok(x["raw"], x["typed"]), F.lit(False)))
    return (answers.withColumn("_json", _json_object(F.col(response))).withColumn("_raw", listed)
            .withColumn("is_valid", F.coalesce(valid, F.lit(False)))
            .withColumn("_parsed", F.when(F.col("is_valid"), F.struct(typed.cast(kind).alias(name)))).drop("_json", "_raw"))


def _present(item: Column, *names: str) -> Column:
    ok = F.lit(True)
    for name in names:
        ok = ok & item[name].isNotNull()
    return ok


def parse_generation(answers: DataFrame, response: str = "response") -> DataFrame:
    """Typed pairs of every valid response; one wrong pair makes the whole response invalid."""
    names = ("question", "answer", "source_passage", "question_type", "difficulty", "reasoning_steps")

    def ok(raw: Column, pair: Column) -> Column:
        steps = F.schema_of_variant(F.try_variant_get(raw, "$.reasoning_steps", "variant"))
        return (_present(pair, *names[:5]) & pair["question_type"].isin(*QUESTION_TYPES) & pair["difficulty"].isin(*DIFFICULTIES)
                & F.coalesce(steps.isin("STRING", "VOID"), F.lit(True)))
    return _parse(answers, response, "qa_pairs", GENERATION_RESPONSE["qa_pairs"].dataType.simpleString(),
                  lambda r: [_text(r, n).alias(n) for n in names], ok)


def explode_generation(parsed: DataFrame, *keys: str) -> DataFrame:
    return (parsed.where("is_valid")
            .select(*keys, F.posexplode("_parsed.qa_pairs").alias("qa_pos", "_qa"))
            .select(*keys, "qa_pos", "_qa.*"))


def parse_verification(answers: DataFrame, response: str = "response") -> DataFrame:
    """Typed verdicts of every valid response; numbers and truth values may stand in quotation marks."""
    kinds = {"qa_index": _whole, "is_faithful": _truth, "is_answerable": _truth, "confidence": _number, "reasoning": _text}
    return _parse(answers, response, "results", VERIFICATION_RESPONSE["results"].dataType.simpleString(),
                  lambda r: [read(r, n).alias(n) for n, read in kinds.items()], lambda raw, v: _present(v, *kinds))


def generate_pairs(chunks: DataFrame, factory: Callable[[], Provider], options: Options = Options(),
                   tasks: int | None = None) -> DataFrame:
    """Answers of the provider for every chunk, parsed; invalid ones keep ``is_valid = false``."""
    answers = complete(generation_prompts(chunks, options).drop("start_char", "end_char"), factory,
                       "generation", options.generation_temperature, options, tasks)
    return parse_generation(answers.drop("prompt", "text"))


def verify_pairs(batched: DataFrame, factory: Callable[[], Provider], scope=(), options: Options = Options(),
                 tasks: int | None = None) -> DataFrame:
    """Answers of the provider for every batch, parsed."""
    texts = vf.batch_texts(batched.withColumnRenamed("answer", "ground_truth_answer")
                           if "answer" in batched.columns else batched, scope)
    prompts = texts.withColumn("prompt", F.concat(F.lit(VERIFICATION_HEAD), F.col("qa_pairs_text")))
    answers = complete(prompts.drop("qa_pairs_text"), factory, "verification",
                       options.verification_temperature, options, tasks)
    return parse_verification(answers.drop("prompt"))


def explode_verification(parsed: DataFrame, *keys: str) -> DataFrame:
    return parsed.where("is_valid").select(*keys, "batch_id", F.inline("_parsed.results"))


def distribution_of_raw(pairs: DataFrame) -> DataFrame:
    """Raw pairs per question type and per difficulty."""
    kinds = F.array(F.struct(F.lit("question_type").alias("field"), F.col("question_type").alias("value")),
                    F.struct(F.lit("difficulty").alias("field"), F.col("difficulty").alias("value")))
    return pairs.select(F.inline(kinds)).groupBy("field", "value").agg(F.count(F.lit(1)).alias("count"))


def failed_batches(answers: DataFrame, length: int = Options().error_preview) -> DataFrame:
    """Why batches brought nothing: the start of each error, or ``invalid response``, with the number of batches."""
    reason = F.when(F.col("error").isNotNull(), tx.preview(F.col("error"), length)).when(~F.col("is_valid"), "invalid response")
    return answers.withColumn("reason", reason).where("reason IS NOT NULL").groupBy("reason").agg(F.count(F.lit(1)).alias("count"))
