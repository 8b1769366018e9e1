from __future__ import annotations

import random
import re

import duckdb
import pytest

from quaestor.llm.mixing import mix, mixed, oracle_sql

SCHEMA = "row_id long, doc_id long, source string, text string"


def both(spark, rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE d(doc_id BIGINT, source VARCHAR, text VARCHAR)")
    if rows:
        con.executemany("INSERT INTO d VALUES (?, ?, ?)", rows)
    want = con.execute(f"WITH {oracle_sql('d')} SELECT doc_id, size, source_size, target, taken FROM taken").fetchall()
    got = mix(spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA)).drop("row_id").collect()
    return sorted(map(tuple, got), key=str), sorted(want, key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_oracle(spark, seed):
    rnd = random.Random(seed)
    sources = ["b", "a", "é", "Z", None, ""][:3 + seed]
    rows = [(k, rnd.choice(sources), "w " * rnd.randrange(50)) for k in range(120)]
    rows += [(1000 + k, "big", "x\x0by z " * 400) for k in range(5)] + [(None, "a", "w w"), (7, "a", "w"), (7, "a", "w"), (8, "none", None)]
    got, want = both(spark, rows)
    assert got == want
    total = sum(r[1] for r in got)
    taken = {}
    for _, size, source_size, target, words in got:
        assert words <= 3 * size and target <= 3 * source_size
        taken.setdefault((source_size, target), []).append((size, words))
    assert abs(sum(t for _, t in taken) - total) < 1e-6 * total or len({*taken}) < len(sources) + 2
    for (_, target), docs in taken.items():
        assert abs(sum(w for _, w in docs) - target) <= max(s for s, _ in docs) + 2


def test_odd_rows(spark):
    assert both(spark, []) == ([], [])
    assert both(spark, [(1, None, None)])[0] == [(1, 0, 0, 0.0, 0)]
    docs = spark.createDataFrame([(1, 1, "a", "w w", 5), (2, 2, "b", None, 6), (3, None, None, "w", 7)], SCHEMA + ", Copies int")
    got = mixed(docs)
    assert got.columns == ["row_id", "doc_id", "source", "text", "copies"]
    assert all(r.copies in (1, 2, 3) for r in got.collect())
    assert len(re.findall(r"[^\x20\x09-\x0D]+", "x\x0by z ")) == 2
