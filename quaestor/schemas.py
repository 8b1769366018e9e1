"""Explicit schemas of every table that enters or leaves the package."""

from __future__ import annotations

from pyspark.sql import types as T

# The closed domains of the data model, in report order.
QUESTION_TYPES = ("fact_extraction", "numeric_calculation", "comparison", "multi_step_reasoning")
REASONING_TYPES = ("numeric_calculation", "multi_step_reasoning")
DIFFICULTIES = ("easy", "medium", "hard")
DIFFICULTY_RANK = {"hard": 3, "medium": 2, "easy": 1}


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


GENERATED_QA = _struct(question=T.StringType(), answer=T.StringType(), source_passage=T.StringType(),
                       question_type=T.StringType(), difficulty=T.StringType(),
                       reasoning_steps=T.StringType())

GENERATION_RESPONSE = _struct(qa_pairs=T.ArrayType(GENERATED_QA))

QA_VERIFICATION = _struct(qa_index=T.IntegerType(), is_faithful=T.BooleanType(),
                          is_answerable=T.BooleanType(), confidence=T.DoubleType(),
                          reasoning=T.StringType())

VERIFICATION_RESPONSE = _struct(results=T.ArrayType(QA_VERIFICATION))

QA_PAIRS = _struct(question=T.StringType(), ground_truth_answer=T.StringType(),
                   source_passage=T.StringType(), question_type=T.StringType(),
                   difficulty_estimate=T.StringType(), section=T.StringType(),
                   confidence_score=T.DoubleType(), reasoning_steps=T.StringType())

PREDICTIONS = _struct(question=T.StringType(), predicted_answer=T.StringType())

EDGAR_SUBMISSIONS = _struct(
    name=T.StringType(),
    filings=_struct(recent=_struct(form=T.ArrayType(T.StringType()),
                                   accessionNumber=T.ArrayType(T.StringType()),
                                   primaryDocument=T.ArrayType(T.StringType()))))
