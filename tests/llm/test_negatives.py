from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quaestor.llm.negatives import UNBOUNDED, Tree, hard_negatives, leaves_of, pack, plant, products, unpack, visited

ARITY = 4
SCHEMA = "vec_id long, label int, embedding array<float>, key string"


def brute(rows, positives=5, negatives=3):
    good = [(i, label, [math.floor(256 * float(x)) for x in v]) for i, label, v, *_ in rows
            if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a in good:
        if a[0] % 5:
            continue
        scores = sorted((-sum(x * y for x, y in zip(a[2], b[2])), b[0], b[1]) for b in good if b is not a)
        for down, pid, _ in [s for s in scores if s[2] == a[1]][:positives]:
            fits = [s for s in scores if s[2] != a[1] and 50 * -down <= 100 * -s[0] <= 95 * -down][:negatives]
            out += [(a[0], pid, k, s[1], -down, -s[0]) for k, s in enumerate(fits, 1)]
    return sorted(out)


def vectors(rng, n):
    centres = rng.normal(size=(6, 8))
    made = [(i, int(rng.integers(0, 3)), (centres[rng.integers(0, 6)] + 0.2 * rng.normal(size=8)).astype(np.float32).tolist()) for i in range(n)]
    made += [(n + i, i % 2, [0.5] * 8) for i in range(30)]  # equal vectors of both labels
    made += [(n + 40, 1, None), (n + 41, None, [0.1] * 8), (n + 42, 1, [math.nan] * 8), (n + 43, 0, [None] + [0.0] * 7), (n + 44, 0, [math.inf] * 8),
             (n + 45, 1, [0.0] * 8), (n + 50, 2, [-0.5] * 8), (None, 1, [0.3] * 8), (n + 55, 1, [0.5, 0.5]),
             (5, made[5][1], made[5][2]), (5, made[5][1], [2.0] * 8), (10, made[10][1], made[10][2])]
    return [(*row, "k") for row in made]


@pytest.mark.parametrize("arity, sample, block_rows", [(ARITY, 64, 1 << 14), (3, 1000, 7), (2, 1, 64)])
def test_equals_brute_force(spark, arity, sample, block_rows):
    rows = vectors(np.random.default_rng(arity), 150)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = hard_negatives(frame, F.col("vec_id") % 5 == 0, arity=arity, sample=sample, block_rows=block_rows)
    got = sorted(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in found.collect())
    assert got == brute(rows) and len(got) > 300


def test_nothing_left_gives_no_rows(spark):
    frame = spark.createDataFrame([(5, 1, None, "k"), (None, 1, [0.5], "k")], SCHEMA)
    assert hard_negatives(frame, F.col("vec_id") % 5 == 0).collect() == []


def test_windows_rule_out_leaves_but_no_row_that_fits():
    rng = np.random.default_rng(3)
    rows = np.rint(256 * np.concatenate([c + 0.1 * rng.normal(size=(80, 8)) for c in rng.normal(size=(12, 8))]))
    tree = plant(rows[::5], ARITY)
    leaf = leaves_of(tree, rows, ARITY)
    shape = (1 + ARITY, ARITY, ARITY)
    tree = Tree(tree.top, tree.below, np.full(shape, np.inf), np.full(shape, -np.inf), np.full((1 + ARITY, ARITY), np.inf), np.full((1 + ARITY, ARITY), -np.inf))
    for x, place in zip(rows, leaf):
        for node, child, points in ((0, place // ARITY, tree.top), (1 + place // ARITY, place % ARITY, tree.below[place // ARITY])):
            far = np.sqrt(((points - x) ** 2).sum(1))
            tree.near[node, :len(points), child] = np.minimum(tree.near[node, :len(points), child], far)
            tree.far[node, :len(points), child] = np.maximum(tree.far[node, :len(points), child], far)
            tree.small[node, child] = min(tree.small[node, child], x @ x)
            tree.large[node, child] = max(tree.large[node, child], x @ x)
    asked = rows[::7]
    scores = products(asked, rows)
    top = np.sort(scores, axis=1)[:, -4]
    low, high = np.stack([top // 2 + 1, top], 1), np.stack([top * 6 // 10, np.full(len(top), UNBOUNDED)], 1)
    went = visited(tree, asked, low.astype(float), high.astype(float), ARITY)
    left_out = 0
    for i, own in enumerate(went):
        needed = {int(p) for p, s in zip(leaf, scores[i]) if any(a <= s <= b for a, b in zip(low[i], high[i]))}
        assert needed <= set(own)
        left_out += len(set(leaf.tolist())) - len(own)
    assert left_out > 0.2 * len(asked) * len(set(leaf.tolist()))


def test_products_are_exact_beyond_doubles():
    small, big = np.array([1, -3, 200]), np.array([1 << 40, 3, -(1 << 40) + 1])
    assert pack(small)[:1] == b"h" and pack(big)[:1] == b"q"
    both = unpack([pack(small), pack(big)])
    assert products(both, both).tolist() == [[40010, (1 << 40) - 9 + 200 * (1 - (1 << 40))],
                                             [(1 << 40) - 9 + 200 * (1 - (1 << 40)), UNBOUNDED]]
    assert unpack([pack(small), pack(small[:1])]).tolist() == [[1, -3, 200], [1, 0, 0]]
