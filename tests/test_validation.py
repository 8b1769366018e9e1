"""Which answers of a provider are valid, and what is read from them."""

from __future__ import annotations

import json

import pytest

from quaestor.functions import text as tx
from quaestor.operators import generate as ge
from pyspark.sql import functions as F

PAIR = {"question": "q", "answer": "a", "source_passage": "s", "question_type": "comparison", "difficulty": "easy"}
VERDICT = {"qa_index": 0, "is_faithful": True, "is_answerable": False, "confidence": 0.9, "reasoning": "r"}


def pairs(**other):
    return json.dumps({"qa_pairs": [PAIR | other]})


def results(**other):
    return json.dumps({"results": [VERDICT | other]})


GENERATION = [
    (pairs(), True), (pairs(reasoning_steps=None), True), (pairs(reasoning_steps="x", more=[1]), True), (f"\n {pairs()} \n", True),
    ('{"qa_pairs": []}', True), (pairs(question=1), False), (pairs(reasoning_steps=5), False), (pairs(difficulty="Easy"), False),
    (pairs(answer=None), False), (pairs() + " done", False), (pairs() + "}", False), (pairs() + "] x", False), (pairs() + "," + pairs(), False),
    (pairs()[:-2], False), (f"[{pairs()}]", False), ('{"qa_pairs": {"question": "q"}}', False), ('{"qa_pairs": ["q"]}', False),
    ("{}", False), ("", False), ("null", False), (None, False)]


def test_generation(spark):
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(GENERATION)], "id int, response string")
    got = {r.id: r for r in ge.parse_generation(rows).collect()}
    assert {i: got[i].is_valid for i in got} == {i: ok for i, (_, ok) in enumerate(GENERATION)}
    assert got[2]._parsed.qa_pairs[0].reasoning_steps == "x" and got[0]._parsed.qa_pairs[0].question == "q"
    assert ge.explode_generation(ge.parse_generation(rows), "id").count() == 4


VERIFICATION = [
    (results(), (0, True, False, 0.9)), (results(confidence="0.9", is_faithful="true", qa_index=0.0), (0, True, False, 0.9)),
    (results(qa_index="2", is_faithful=0, is_answerable=1.0, confidence=1), (2, False, True, 1.0)),
    (results(is_faithful="YES", is_answerable="off", qa_index=-1), (-1, True, False, 0.9)),
    (results(qa_index=0.5), None), (results(is_faithful="maybe"), None), (results(is_faithful=2), None), (results(confidence="high"), None),
    (results(reasoning=1), None), (results(confidence=None), None), (results()[:-1], None)]


def test_verification(spark):
    rows = spark.createDataFrame([(i, i, t) for i, (t, _) in enumerate(VERIFICATION)], "id int, batch_id int, response string")
    parsed = ge.parse_verification(rows)
    got = {r.id: (r.qa_index, r.is_faithful, r.is_answerable, r.confidence) for r in ge.explode_verification(parsed, "id").collect()}
    assert got == {i: v for i, (_, v) in enumerate(VERIFICATION) if v}


def test_failed_batches(spark):
    rows = spark.createDataFrame([(None, False), ("HTTP 500" + "x" * 100, False), (None, True), (None, False)], "error string, is_valid boolean")
    got = {r.reason: r["count"] for r in ge.failed_batches(rows).collect()}
    assert got == {"invalid response": 2, ("HTTP 500" + "x" * 100)[:80]: 1}


@pytest.mark.parametrize("share, label", [(6.25, "6.2%"), (18.75, "18.8%"), (31.25, "31.2%"), (100.0, "100.0%"), (0.05, "0.1%"), (33.3333, "33.3%"), (None, None)])
def test_percent_label(spark, share, label):
    got = spark.range(1).select(tx.percent_label(F.lit(share).cast("double")).alias("x")).first().x
    assert got == label


def test_unicode_digits(spark):
    df = spark.createDataFrame([("١٢٣ and ４.５%",), ("$1,234.5",), (None,)], "t string")
    assert [r.n for r in df.select(tx.extract_numbers(F.col("t")).alias("n")).collect()] == [[123.0, 4.5], [1234.5], []]
