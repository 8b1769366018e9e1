"""The set-wise dedup against a plain double loop."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from quaestor.operators import dedup, tfidf
from quaestor.options import Options

RANK = {"easy": 1, "medium": 2, "hard": 3}


def naive(questions, levels, k=5000, threshold=0.85):
    """Greedy pass over a full similarity table; returns survivors and the number of flagged pairs."""
    docs = []
    for q in questions:
        words = [w for w in re.findall(r"\b\w\w+\b", q.lower()) if w not in tfidf.STOP_WORDS]
        docs.append(Counter(words + [f"{a} {b}" for a, b in zip(words, words[1:])]))
    total, df = Counter(), Counter()
    for d in docs:
        total.update(d)
        df.update(d.keys())
    vocab = set(sorted(total, key=lambda t: (-total[t], t))[:k])
    vecs = []
    for d in docs:
        v = {t: n * (math.log((1 + len(docs)) / (1 + df[t])) + 1) for t, n in d.items() if t in vocab}
        norm = math.sqrt(sum(x * x for x in v.values())) or 1.0
        vecs.append({t: x / norm for t, x in v.items()})
    gone, flagged = set(), 0
    for i in range(len(docs)):
        if i in gone:
            continue
        for j in range(i + 1, len(docs)):
            if j in gone:
                continue
            if sum(x * vecs[j].get(t, 0.0) for t, x in vecs[i].items()) > threshold:
                flagged += 1
                gone.add(j if RANK.get(levels[i], 0) >= RANK.get(levels[j], 0) else i)
    return [i for i in range(len(docs)) if i not in gone], flagged


def make_questions(seed, n):
    rnd = random.Random(seed)
    words = [f"word{i}" for i in range(40)]
    stems = [[rnd.choice(words) for _ in range(12)] for _ in range(6)]
    questions = []
    for _ in range(n):
        base = list(rnd.choice(stems)) if rnd.random() < 0.8 else [rnd.choice(words) for _ in range(8)]
        for _ in range(rnd.choice([0, 0, 1, 1, 2])):
            base[rnd.randrange(len(base))] = rnd.choice(words)
        questions.append(" ".join(base))
    questions += ["", "the of a", "the of a"]
    rnd.shuffle(questions)
    return questions, [rnd.choice(["easy", "medium", "hard", "odd"]) for _ in questions]


@pytest.mark.parametrize("seed,n,heads,fold", [(1, 60, 256, dedup.FOLD), (2, 60, 3, 0)])
def test_matches_double_loop(spark, seed, n, heads, fold):
    questions, levels = make_questions(seed, n)
    want, flagged = naive(questions, levels)
    assert len(want) < len(questions)
    df = spark.createDataFrame([(i, q, d) for i, (q, d) in enumerate(zip(questions, levels))],
                               "ord long, question string, difficulty_estimate string")
    got = dedup.survivors(df, heads=heads, fold=fold)
    assert sorted(r["ord"] for r in got.collect()) == want
    found = dedup.resolve(df, heads=heads, fold=fold)
    row = dedup.summary(found).first()
    assert (row["total"], row["removed"], row["remaining"]) == (len(questions), len(questions) - len(want), len(want))
    assert row["duplicate_pairs"] == flagged


def test_scopes_are_independent(spark):
    first, second = make_questions(5, 30), make_questions(6, 30)
    rows = []
    for name, (questions, levels) in (("a", first), ("b", second)):
        rows += [(name, i, q, d) for i, (q, d) in enumerate(zip(questions, levels))]
    df = spark.createDataFrame(rows, "doc string, ord long, question string, difficulty_estimate string")
    got = dedup.survivors(df, scope="doc", options=Options(max_features=20)).collect()
    for name, (questions, levels) in (("a", first), ("b", second)):
        assert sorted(r["ord"] for r in got if r["doc"] == name) == naive(questions, levels, k=20)[0]


def test_copies_of_one_question(spark):
    levels = ["easy", "medium", "easy", "hard", "medium", "hard"] * 5
    questions = ["revenue growth segment margin"] * len(levels)
    df = spark.createDataFrame([(i, q, d) for i, (q, d) in enumerate(zip(questions, levels))],
                               "ord long, question string, difficulty_estimate string")
    want, flagged = naive(questions, levels)
    assert sorted(r["ord"] for r in dedup.survivors(df).collect()) == want
    assert dedup.summary(dedup.resolve(df)).first()["duplicate_pairs"] == flagged


def drifting(n, order=lambda i: i):
    """Each question is similar to its neighbours only."""
    rows = [(order(i), " ".join(f"word{k:04d}" for k in range(i, i + 24)), "easy") for i in range(n)]
    return rows, "ord long, question string, difficulty_estimate string"


def test_large_order_values(spark):
    rows, schema = drifting(6, lambda i: (1 << 60) + i)
    want = naive([r[1] for r in rows], [r[2] for r in rows])[0]
    got = dedup.survivors(spark.createDataFrame(rows, schema))
    assert sorted(r["ord"] - (1 << 60) for r in got.collect()) == want


def test_steps_do_not_follow_the_chain(spark, monkeypatch):
    rows, schema = drifting(500)
    written = []
    plain = dedup._pin
    monkeypatch.setattr(dedup, "_pin", lambda df, label: written.append(label) or plain(df, label))
    options = Options(max_features=20000, similarity_threshold=0.7)
    got = sorted(r["ord"] for r in dedup.survivors(spark.createDataFrame(rows, schema), options=options).collect())
    assert got == naive([r[1] for r in rows], ["easy"] * 500, k=20000, threshold=0.7)[0] and len(got) < 400
    assert len(written) <= 30, written


def settled(edges, informed):
    """One pass in order over all nodes of a scope: roots and removed ones."""
    roots, dead, blocked = set(), set(), set()
    for node in sorted({n for e in edges for n in e} | set(informed)):
        if node in dead:
            continue
        mine = {j for i, j in edges if i == node}
        if node in informed and node not in blocked:
            roots.add(node)
            dead |= mine
        else:
            blocked |= mine
    return roots, dead


@pytest.mark.parametrize("fold", [3, dedup.FOLD])
def test_parts_of_any_size_settle_like_one_pass(spark, fold):
    rnd = random.Random(fold)
    edges, informed, want = [], [], (set(), set())
    for scope in "abc":
        own = {tuple(sorted(rnd.sample(range(70), 2))) for _ in range(45)} | {(k, k + 1) for k in range(70, 84)} | {(90, k) for k in range(91, 99)}
        knows = {n for n in range(100) if rnd.random() < 0.85}
        edges += [(scope, i, j) for i, j in own]
        informed += [(scope, n) for n in knows]
        for got, more in zip(want, settled(own, knows)):
            got |= {(scope, n) for n in more}
    roots, dead = dedup._settle(spark.createDataFrame(edges, "scope string, i long, j long"), spark.createDataFrame(informed, "scope string, node long"), fold)
    assert {tuple(r) for r in roots.collect()} == want[0]
    assert {tuple(r) for r in dead.collect()} == want[1]


def test_a_chain_longer_than_a_pass_takes_few_writes(spark, monkeypatch):
    import quaestor.operators.components as cc

    written = []
    for module, name in ((dedup, "_pin"), (cc, "pin")):
        plain = getattr(module, name)
        monkeypatch.setattr(module, name, lambda df, label, plain=plain: written.append(label) or plain(df, label))
    edges = spark.createDataFrame([("s", k, k + 1) for k in range(500)], "scope string, i long, j long")
    informed = spark.createDataFrame([("s", k) for k in range(501)], "scope string, node long")
    roots, dead = dedup._settle(edges, informed, fold=250)
    assert sorted(r["node"] for r in roots.collect()) == list(range(0, 501, 2)) and dead.count() == 250
    assert len(written) <= 30, written


def test_components_against_union_find(spark):
    from quaestor.operators.components import components

    rnd = random.Random(4)
    edges = [(s, *rnd.sample(range(60), 2)) for s in "ab" for _ in range(35)] + [("c", k, k + 1) for k in range(40)] + [("c", 7, 7)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for s, i, j in edges:
        low, high = sorted((find((s, i)), find((s, j))))
        root[high] = low
    got = {(r["scope"], r["node"]): r["part"] for r in components(spark.createDataFrame(edges, "scope string, i long, j long")).collect()}
    assert got == {x: find(x)[1] for x in root}


def test_bound_keeps_every_similar_pair_and_few_others(spark):
    questions, levels = make_questions(8, 80)
    df = spark.createDataFrame([(i, q, d) for i, (q, d) in enumerate(zip(questions, levels))], "ord long, question string, difficulty_estimate string")
    rows = dedup._rows(df, "ord", "question", "difficulty_estimate", None)
    texts = dedup.distinct_texts(rows).cache()
    counts = tfidf.term_counts(texts)
    weights = tfidf.weights(texts, counts, tfidf.vocabulary(counts)).cache()
    vectors, threshold = tfidf.vectors(weights), 0.85
    index = tfidf.prefix_entries(weights, threshold)
    met = (index.alias("a").join(index.alias("b"), ["scope", "term_id"]).where("a.text_id < b.text_id")
           .groupBy("scope", dedup.F.col("a.text_id").alias("i"), dedup.F.col("b.text_id").alias("j"))
           .agg(dedup.F.sum(dedup.F.col("a.w") * dedup.F.col("b.w")).alias("_part_sum")))
    met = met.withColumns({"text_id_i": dedup.F.col("i"), "text_id_j": dedup.F.col("j")}).cache()
    kept = {(r.i, r.j) for r in dedup._bounded(met, tfidf.sketches(weights, threshold), threshold).collect()}
    vecs = {r.text_id: r.vec for r in vectors.collect()}
    true = {(a, b) for a in vecs for b in vecs if a < b and sum(x * vecs[b].get(t, 0.0) for t, x in vecs[a].items()) > threshold}
    assert true <= kept and len(kept) < met.count() and len(true) > 5
