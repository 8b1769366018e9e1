"""Every query and stage on odd tables: nulls in all columns, repeated rows, a very long text, clashing columns, no rows."""

from __future__ import annotations

import pytest

import corpus_pipeline
from quaestor.llm import QUERIES

DOCUMENTS = ("doc_id long, text string, lang string, source string, n_chars long, row_id string, copies int, toxicity string, "
             "line_dedup double, quality_rules int, score string, host string, fp int, _metadata string")
EXTRA = ("x", 1, "z", 0.5, 3, "s", "h", 7, "m")
ROWS = [
    (1, "You idiot moron stupid. " + "w " * 30, "en", "a", 5, *EXTRA), (None,) * 14, (2, "", "en", "a", 0, *EXTRA),
    (2, "", "en", "a", 0, *EXTRA), (3, "the long line of many words here\n" * 3, "en", None, 10, *EXTRA),
    (4, "x" * 300000 + " y" * 20000, "de", "b", 3, *EXTRA), (5, "the long line of many words here", "de", "b", 3, *EXTRA)]
TABLES = {
    "documents": (ROWS, DOCUMENTS),
    "labels": ([(1, 1, 1), (2, 1, 0), (None, None, None), (3, 0, 0), (3, 0, 0), (4, None, 7)], "doc_id long, quality int, toxic int"),
    "benchmark": ([(1, "w " * 20), (None, None), (2, ""), (None, "w w w")], "item_id long, text string"),
    "pages": ([(1, "http://a.org/x", "<p>x</p>", "h", 1), (None,) * 5, (1, "http://a.org/x", "<p>x</p>", "h", 1)],
              "page_id long, url string, html string, host string, shard int"),
    "embeddings": ([(50, [0.5, 0.25], 3, "k", 1), (50, [0.5, 0.25], 3, "k", 1), (None,) * 5, (7, [], 2, "k", 2), (8, [0.4, None], 3, "k", 2),
                    (9, [0.25, 0.25], 2, "k", 2)], "vec_id long, embedding array<float>, label int, key string, leaf int")}
OWN_ROWS = {"op12_hard_negatives": 2, "op13_collocations": 4}  # pairs and phrases instead of a row per document


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    odd, empty = tmp_path_factory.mktemp("odd"), tmp_path_factory.mktemp("empty")
    for name, (rows, schema) in TABLES.items():
        frame = spark.createDataFrame(rows, schema)
        frame.write.parquet(f"{odd}/{name}.parquet")
        frame.limit(0).write.parquet(f"{empty}/{name}.parquet")
    return str(odd), str(empty)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, folders, name):
    odd, empty = folders
    table = "pages" if name.startswith(("op4", "op10")) else "documents"
    assert QUERIES[name](spark, odd).count() == OWN_ROWS.get(name, len(TABLES[table][0]))
    assert QUERIES[name](spark, empty).count() == 0


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage(spark, folders, name, stage):
    odd, empty = folders
    for folder, wanted in ((odd, range(1, len(ROWS) + 1)), (empty, (0,))):
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        out = stage(spark, docs, folder)
        assert out.count() in wanted
        last = name == corpus_pipeline.STAGES[-1][0]
        assert sorted(out.columns) == sorted(docs.columns) if last else out.columns == docs.columns
