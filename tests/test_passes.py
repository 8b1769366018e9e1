"""The pass over blocks in one task, and what its rounds write."""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from quaestor.operators import dedup, passes


def make_block(seed, n, first=0):
    """Vectors over 60 terms, most of them near copies of a few."""
    rnd = random.Random(seed)
    stems = [rnd.sample(range(60), 12) for _ in range(5)]
    rows = []
    for k in range(n):
        terms = set(rnd.choice(stems)) if rnd.random() < 0.7 else set(rnd.sample(range(60), rnd.randint(1, 12)))
        terms ^= set(rnd.sample(range(60), rnd.choice([0, 0, 1, 2])))
        chosen = sorted(terms or {3})
        rows.append({"node": first + k, "rank": rnd.randint(0, 3), "terms": chosen, "xs": [1.0 + t % 4 for t in chosen]})
    return rows, passes.Block.of(pa.Table.from_pylist(rows, pa.schema([("node", pa.int64()), ("rank", pa.int32()), ("terms", pa.list_(pa.int32())), ("xs", pa.list_(pa.float64()))])), 0.85)


def cosine(a, b):
    x, y = (dict(zip(r["terms"], r["xs"])) for r in (a, b))
    return sum(v * y.get(t, 0.0) for t, v in x.items()) / math.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))


@pytest.mark.parametrize("rows,cells", [(passes.ROWS, passes.CELLS), (7, 90)])
def test_blocks_against_a_double_loop(monkeypatch, rows, cells):
    monkeypatch.setattr(passes, "ROWS", rows)
    monkeypatch.setattr(passes, "CELLS", cells)
    (head, block), (later, behind) = make_block(3, 80), make_block(4, 60, first=80)
    every, gone, want = head + later, set(), set()
    for a in every[:80]:
        if a["node"] in gone:
            continue
        want.add((passes.ROOT, a["node"], a["node"]))
        for b in every[a["node"] + 1:]:
            if b["node"] not in gone and cosine(a, b) > 0.85:
                want.add((passes.REMOVED if a["rank"] >= b["rank"] else passes.FALL, a["node"], b["node"]))
                if a["rank"] >= b["rank"]:
                    gone.add(b["node"])
    out = passes._Rows()
    passes.decide(block, 0.85, out)
    found = out.table("s")
    roots = [r["i"] for r in found.to_pylist() if r["kind"] == passes.ROOT]
    passes.strike(block.take(np.array(roots)), behind, 0.85, out)
    got = out.table("s").to_pylist()
    assert {(r["kind"], r["i"], r["j"]) for r in got} == want and len(got) == len(want)
    assert len(gone) > 20 and any(r["kind"] == passes.FALL for r in got)


def test_pairs_that_only_meet_are_not_moved(spark, monkeypatch):
    """All texts share one rare word, so they all met in one bucket and were summed up pair by pair in a shuffle."""
    written = {}
    plain = dedup._pin

    def counted(df, label):
        out = plain(df, label)
        written[label] = max(written.get(label, 0), out.count())
        return out
    monkeypatch.setattr(dedup, "_pin", counted)
    texts = [f"shared{k % 3} " + " ".join(f"word{(k * 7 + 13 * m) % 89}" for m in range(6)) for k in range(120)]
    df = spark.createDataFrame([(k, t, "easy") for k, t in enumerate(texts)], "ord long, question string, difficulty_estimate string")
    left = dedup.survivors(df, heads=40).count()
    assert 0 < left <= 120 and "decided" in written
    assert all(n <= 4 * 120 for label, n in written.items() if label != "vocabulary"), written
