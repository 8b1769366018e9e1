from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline as pipeline
from quaestor.llm.mixing import oracle_sql
from quaestor.llm.tables import pin, read_table
from tests.conftest import SF_DIR
from tests.llm.test_line_dedup import brute
from tests.llm.test_simhash import plain_components, plain_fingerprint


@pytest.fixture(scope="module")
def steps(spark):
    """Rows after each stage, the documents first."""
    docs = read_table(spark, SF_DIR, "documents")
    out = [docs.toPandas()]
    for name, stage in pipeline.STAGES:
        docs = pin(stage(spark, docs, SF_DIR), f"test-{name}")
        out.append(docs.toPandas())
    return out


def test_columns(steps):
    for frame in steps[1:-1]:
        assert list(frame.columns) == list(steps[0].columns)
    assert list(steps[-1].columns) == [*steps[0].columns, "copies"]


def test_toxicity_keeps_clean_documents(spark, steps):
    toxic = {r.doc_id: r.toxic for r in read_table(spark, SF_DIR, "labels").collect()}
    kept = set(steps[1].doc_id)
    clean = [k for k, t in toxic.items() if t == 0]
    assert sum(k in kept for k in clean) / len(clean) > 0.98
    bad = [k for k, t in toxic.items() if t == 1]
    assert sum(k in kept for k in bad) / len(bad) < 0.4


def test_line_dedup_against_brute_force(steps):
    rows = sorted(zip(steps[1].doc_id, steps[1].text, strict=True))
    want = {k: t for k, (t, n) in brute(rows).items() if not n or t.strip()}
    assert dict(zip(steps[2].doc_id, steps[2].text, strict=True)) == want


def test_near_dedup_against_all_pairs(steps):
    fps = {k: plain_fingerprint(t) for k, t in zip(steps[2].doc_id, steps[2].text, strict=True)}
    least = {}
    for k, r in plain_components(fps, 2).items():
        least[r] = min(least.get(r, k), k)
    assert sorted(steps[3].doc_id) == sorted(least.values())


def test_decontamination_against_oracle(steps):
    from quaestor.llm.decontaminate import ORACLE
    con = duckdb.connect()
    con.register("documents", steps[3])
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{SF_DIR}/benchmark.parquet'")
    bad = {r[0] for r in con.execute(f"SELECT doc_id FROM ({ORACLE['op5_decontamination']}) WHERE contaminated").fetchall()}
    assert set(steps[4].doc_id) == set(steps[3].doc_id) - bad


def test_mixing_against_oracle(steps):
    con = duckdb.connect()
    con.register("docs", steps[4])
    want = con.execute(f"WITH {oracle_sql('docs')} SELECT doc_id, taken // size FROM taken WHERE taken > 0").fetchall()
    assert sorted(zip(steps[5].doc_id, steps[5].copies, strict=True)) == sorted(want)


def test_run(spark, steps):
    got = pipeline.run(spark, SF_DIR).toPandas()
    assert sorted(got.doc_id) == sorted(steps[-1].doc_id)
