from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException

from quaestor.operators.batch_calls import call_batches
from quaestor.operators.verify import assign_batches, batch_texts

PAIRS = "doc_id string, ord long, section string, question string, ground_truth_answer string, source_passage string, question_type string"


@pytest.fixture(scope="module")
def batched(spark):
    rows = [(doc, k, "Item 1", f"q{k}\nand more" if k % 3 else None, f"a{k}", "p é", "comparison") for doc in ("x", "y") for k in range(13)]
    return assign_batches(spark.createDataFrame(rows, PAIRS), ["ord"], ["doc_id"], 5)


def test_texts_are_those_of_the_grouped_query(batched):
    want = {(r.doc_id, r.batch_id): (r.batch_size, r.qa_pairs_text) for r in batch_texts(batched, ["doc_id"]).collect()}
    got = call_batches(batched, ["doc_id"])
    assert got.schema["batch_id"].dataType == batched.schema["batch_id"].dataType
    assert {(r.doc_id, r.batch_id): (r.batch_size, r.qa_pairs_text) for r in got.collect()} == want and len(want) == 6


def test_one_call_per_batch_and_errors_are_rows(batched):
    def call(text):
        if "q11" in text:
            raise TimeoutError("too slow")
        return str(text.count("--- QA Pair"))
    rows = call_batches(batched, ["doc_id"], call).orderBy("doc_id", "batch_id").collect()
    assert [(r.response, r.error) for r in rows] == [("5", None), ("5", None), (None, "TimeoutError: too slow")] * 2


def test_missing_columns_are_named(batched):
    with pytest.raises(AnalysisException, match="UNRESOLVED_COLUMN"):
        call_batches(batched.drop("section"), ["doc_id"])
    assert call_batches(batched.limit(0), ["doc_id"]).count() == 0
