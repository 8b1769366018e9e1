from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from quaestor.llm.ring import class_bounds, drop_similar, ring_keys, shingle_sets, similar_components
from quaestor.llm.tables import read_table
from tests.conftest import SF_DIR


def plain_set(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)})
    for blank in "\t\n\x0b\x0c\r":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def alike(a, b):
    return a == b or 100 * len(a & b) >= 80 * len(a | b)


def plain_roots(sets):
    """Smallest key that each key reaches over all pairs."""
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k
    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if alike(sets[a], sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


def edited(words, rnd, edits):
    words = list(words)
    for _ in range(edits):
        words[rnd.randrange(len(words))] = f"new{rnd.randrange(10 ** 6)}"
    return " ".join(words)


def test_sets_and_segments():
    texts = ["", None, "one", "A b C d e f", "é É x y z z", "x " * 3000]
    found = list(shingle_sets(pa.array(texts)))
    assert [len(x) for x in found] == [len(plain_set(t)) for t in texts]
    assert found[3].tolist() == next(shingle_sets(pa.array(["a\tB c\n d e  F"]))).tolist()
    for n in range(1, 400):
        low, high = class_bounds(n)
        assert low <= n <= high
        assert -(-n * 80 // 100) >= low or class_bounds(-(-n * 80 // 100))[1] + 1 == low  # partners lie at most one class apart


def test_similar_sets_share_a_segment():
    rnd = np.random.default_rng(4)
    missed = 0
    for _ in range(600):
        n = int(rnd.integers(5, 300))
        base = rnd.integers(0, 2 ** 63, n).astype(np.uint64)
        lost = int(rnd.integers(0, n // 9 + 1))
        other = np.concatenate((base[lost:], rnd.integers(0, 2 ** 63, lost).astype(np.uint64)))
        assert len(np.intersect1d(base, other)) * 100 >= 80 * len(np.union1d(base, other))
        missed += not set(ring_keys(np.sort(base))[0].tolist()) & set(ring_keys(np.sort(other))[0].tolist())
    assert missed == 0


def test_components_against_all_pairs(spark):
    rnd = random.Random(9)
    docs = {}
    for base in range(12):
        words = [f"w{rnd.randrange(3000)}" for _ in range(rnd.choice((7, 40, 120, 400)))]
        for _ in range(12):
            docs[len(docs)] = edited(words, rnd, rnd.randrange(0, 1 + len(words) // 40))
    shared = " ".join(f"p{k}" for k in range(60))
    for _ in range(60):
        docs[len(docs)] = shared + " " + " ".join(f"w{rnd.randrange(3000)}" for _ in range(60))
    want = plain_roots({k: plain_set(t) for k, t in docs.items()})
    frame = spark.createDataFrame([(k, k, t) for k, t in docs.items()], "row_id long, doc_id long, text string")
    got = {r.doc_id: r.component_id for r in similar_components(frame).collect()}
    assert got == want
    assert len(set(want.values())) < len(docs) - 60


def test_given_documents_against_all_pairs(spark):
    docs = {r.doc_id: r.text for r in read_table(spark, SF_DIR, "documents").collect()}
    want = plain_roots({k: plain_set(t) for k, t in docs.items()})
    assert sorted(r.doc_id for r in drop_similar(read_table(spark, SF_DIR, "documents")).collect()) == sorted(set(want.values()))


def test_odd_rows(spark):
    rows = [(None, "a b c d", "s"), (5, "a b c d", "s"), (5, "a b c d", "s"), (7, None, None), (8, " \n", "s"), (9, "q r s t", "x"),
            (10, "v " * 200000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row_id string")
    kept = drop_similar(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [5, 7, 9, 10]
    assert drop_similar(docs.limit(0)).count() == 0
