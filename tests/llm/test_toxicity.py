from __future__ import annotations

import pyarrow as pa
import pytest

from quaestor.llm.tables import read_table
from quaestor.llm.toxicity import GRAMMAR, PRIOR, Lexicon, drop_toxic, features, op1_toxicity, sigmoid
from tests.conftest import SF_DIR


def kinds(text, stems=()):
    row = features(pa.array([text]), Lexicon.build(dict(stems)))[0]
    return [round(float(x), 3) for x in row[:4]]


@pytest.mark.parametrize("text, kind", [
    ("what an idiot.", 0), ("you are an idiot", 1), ("idiot, you", 1), ("not an idiot", 2), ("he wrote: idiot!", 3),
    ("Never. Idiot!", 0), ("not one of the many many words idiot", 0), ("“Idiot”", 0)])
def test_grammar(text, kind):
    assert [x > 0 for x in kinds(text)] == [k == kind for k in range(4)]


def test_stems_and_folding():
    assert kinds("RÉEUXPA", {"réeux": 3.0}.items())[0] > 1
    assert kinds("pareeux", {"reeux": 3.0}.items())[0] == 0
    assert kinds("idiotic")[0] == 0
    assert GRAMMAR.table.shape == (8, 8)


def test_batches_do_not_mix_texts():
    texts = ["not", "idiot", None, "", "é" * 3000000, "you idiot " * 3]
    together = features(pa.array(texts), Lexicon.build({}))
    for k, t in enumerate(texts):
        assert (features(pa.array([t], pa.string()), Lexicon.build({}))[0] == together[k]).all()
    assert together[2].sum() == together[3].sum() == 0


def test_query(spark):
    docs = {r.doc_id: r for r in read_table(spark, SF_DIR, "documents").collect()}
    toxic = {r.doc_id: r.toxic for r in read_table(spark, SF_DIR, "labels").collect()}
    got = op1_toxicity(spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert sum(r.predicted == toxic[r.doc_id] for r in got if r.doc_id in toxic) / len(toxic) > 0.9


def test_stage_and_odd_rows(spark):
    rows = [(1, "You stupid, worthless idiot. You are a disgusting loser! Pathetic moron.", 0.1), (None, None, 0.2), (2, "", None), (3, "fine words", 1.0),
            (3, "fine words", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxicity double")
    labels = spark.createDataFrame([(None, 1, None), (3, None, 1), (9, 1, 7)], "doc_id long, toxic int, quality int")
    kept = drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "3", "3", "None"]
    assert drop_toxic(docs.limit(0), labels.limit(0)).count() == 0
    assert sigmoid(PRIOR[-1]) < 0.5
