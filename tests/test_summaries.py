from __future__ import annotations

import random

import pytest

from quaestor.operators.summaries import RANK_ERROR, length_summaries, merged, quantiles


def test_merged_summaries_know_ranks(spark):
    rnd = random.Random(3)
    rows = [(f"f{k % 40}", k % 3, "x" * int(rnd.expovariate(0.01))) for k in range(6000)] + [("none", 0, None)]
    texts = spark.createDataFrame(rows, "doc string, part int, text string").repartition(7)
    stored = length_summaries(texts, "text", ["doc", "part"])
    assert stored.where("doc = 'none'").select("n", "least").collect() == [(0, None)]
    lengths = sorted(len(t) for _, _, t in rows if t is not None)
    found = quantiles(merged(stored), [0, 0.1, 0.5, 0.9, 1]).collect()
    assert [r.n for r in found] == [6000] * 5 and (found[0].length, found[-1].length) == (lengths[0], lengths[-1])
    for r in found:
        below, upto = (sum(x < r.length for x in lengths) / 6000, sum(x <= r.length for x in lengths) / 6000)
        assert below - RANK_ERROR <= r.share <= upto + RANK_ERROR
    parts = quantiles(merged(stored, ["part"]), [0.5]).collect()
    assert len(parts) == 3 and sum(r.n for r in parts) == 6000
    assert all(r.length == pytest.approx(lengths[3000], abs=25) for r in parts)
    assert quantiles(merged(stored.limit(0)), [0.5]).count() == 0
