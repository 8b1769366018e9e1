from __future__ import annotations

import hashlib
import random
import re

import duckdb
import pytest

from quaestor.llm.decontaminate import ORACLE, contamination, drop_contaminated


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items):
    windows = {}
    for k, t in items:
        w = words(t)
        size = min(len(w), 13)
        for s in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[s:s + size]), set()).add(k)
    out = []
    for k, t in docs:
        w, hit, found = words(t), set(), set()
        for size in {len(x) for x in windows}:
            for s in range(len(w) - size + 1):
                if tuple(w[s:s + size]) in windows:
                    hit |= set(range(s, s + size))
                    found |= windows[tuple(w[s:s + size])]
        ids = ",".join(sorted(str(x) for x in found if x is not None))
        out.append((k, len(w), len(hit), len(found - {None}), hashlib.sha256(ids.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def run(spark, docs, items):
    from pyspark.sql import functions as F
    d = spark.createDataFrame([(i, *r) for i, r in enumerate(docs)], "row_id long, doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = contamination(d, b).withColumn("sha", F.sha2(F.concat_ws(",", "items"), 256)).collect()
    return [(r.doc_id, r.n_words, r.n_hit, r.n_items, r.sha, r.contaminated) for r in got]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    letters = ["a", "B", "É", "c1"] if seed == 1 else [f"w{k}" for k in range(30)]
    text = lambda n: rnd.choice(["", " "]) + "".join(rnd.choice(letters) + rnd.choice([" ", ", ", "\n"]) for _ in range(n))
    items = [(k % 9, text(rnd.choice((1, 2, 5, 12, 13, 14, 40)))) for k in range(10)] + [(50, None), (51, ""), (None, text(20)), (52, "a b")]
    docs = [(k, text(rnd.randrange(60)) + (rnd.choice(items)[1] or "") + text(rnd.randrange(30))) for k in range(25)]
    docs += [(97, None), (98, ""), (None, items[0][1]), (99, (items[12][1] + " ") * 40), (99, text(3000))]
    assert sorted(run(spark, docs, items), key=str) == sorted(plain(docs, items), key=str)


def test_ids_sort_as_strings_and_empty_tables(spark):
    text = " ".join(f"w{k}" for k in range(20))
    docs, items = [(1, text)], [(k, text) for k in (2, 10, 1)]
    assert run(spark, docs, items) == plain(docs, items)
    assert run(spark, docs, []) == plain(docs, [])
    assert run(spark, [], items) == []
    assert run(spark, [], []) == []


def test_stage(spark):
    text = " ".join(f"w{k}" for k in range(20))
    docs = spark.createDataFrame([(1, text, "x"), (2, "fine", "y"), (2, "fine", "y"), (None, None, None)], "doc_id long, text string, row_id string")
    bench = spark.createDataFrame([(1, text)], "item_id long, text string")
    kept = drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["2", "2", "None"]


def test_oracle_sql_agrees_with_brute_force():
    text = " ".join(f"W{k}" for k in range(20))
    con = duckdb.connect()
    con.execute("CREATE TABLE documents(doc_id BIGINT, text VARCHAR)")
    con.execute("CREATE TABLE benchmark(item_id BIGINT, text VARCHAR)")
    docs, items = [(1, text + " x"), (2, "É no"), (3, None)], [(1, text), (10, text), (3, "é"), (4, "NO")]
    con.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", items)
    assert sorted(con.execute(ORACLE["op5_decontamination"]).fetchall()) == sorted(plain(docs, items))
