from __future__ import annotations

from quaestor.llm.training import labelled_texts


def test_repeated_ids_do_not_widen_the_sample(spark):
    docs = spark.createDataFrame([(1, f"text {k % 7}") for k in range(500)] + [(2, "b"), (3, None), (3, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, label int")
    got = labelled_texts(docs, labels, "label", 10)
    assert got.columns == ["doc_id", "text", "label"]
    rows = sorted(map(tuple, got.collect()))
    assert [(r[0], r[2]) for r in rows] == [(1, 1), (2, 0), (3, 0)]
    assert rows[0][1].startswith("text ") and rows[1][1] == "b" and rows[2][1] is None
