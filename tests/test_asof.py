from __future__ import annotations

import random

from quaestor.operators.asof import asof_join


def test_equals_a_plain_search(spark):
    """One key holds a third of both tables; times repeat on both sides."""
    rnd = random.Random(1)

    def rows(n):
        return [(k, rnd.choice([1, 1, 2, 3, 4, 5, None]), rnd.choice([None, *range(40)])) for k in range(n)]
    left, right = rows(400), rows(120) + [(500 + k, 1, 20) for k in range(60)]
    found = asof_join(spark.createDataFrame(left, "event long, k int, t long"), spark.createDataFrame(right, "fact long, k int, since long"),
                      ["k"], "t", "since", ["fact"])
    assert found.columns == ["event", "k", "t", "matched"]
    got = {r.event: r.matched and r.matched.fact for r in found.collect()}
    assert len(got) == 400
    for event, k, t in left:
        fits = [(since, fact) for fact, key, since in right if key == k and since is not None and t is not None and since <= t]
        assert got[event] == (max(fits)[1] if k is not None and fits else None), (event, k, t)


def test_state_is_carried_over_many_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        left = spark.range(5000).selectExpr("id", "1 as k", "id + 100 as t")
        right = spark.createDataFrame([(7, 1, 50), (8, 1, 5050)], "fact long, k int, since long")
        got = asof_join(left, right, ["k"], "t", "since").selectExpr("id", "matched.fact AS fact").groupBy("fact").count().collect()
        assert sorted((r["fact"], r["count"]) for r in got) == [(7, 4950), (8, 50)]
        assert asof_join(left, right.limit(0), ["k"], "t", "since").where("matched IS NOT NULL").count() == 0
        assert asof_join(left.limit(0), right, ["k"], "t", "since").count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
