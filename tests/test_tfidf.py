"""The vocabulary against a plain count, and what is moved for it."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quaestor.operators import tfidf


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(4)
    words = [f"w{i:02d}" for i in range(40)]
    rows = [(s, i, 1 + i % 3, " ".join(rng.choices(words[:n], [1 / (k + 1) for k in range(n)], k=rng.randrange(0, 30))))
            for s, n in (("a", 40), ("b", 40), ("few", 6), ("none", 1)) for i in range(25)]
    return spark.createDataFrame(rows, "scope string, text_id long, copies long, text string").cache()


def naive(texts, size):
    tf, df = {}, {}
    for r in texts.collect():
        words = r.text.split()
        own = Counter(words + [f"{a} {b}" for a, b in zip(words, words[1:])])
        for t, n in own.items():
            tf.setdefault(r.scope, Counter())[t] += n * r.copies
            df.setdefault(r.scope, Counter())[t] += r.copies
    return {(s, t, c[t], df[s][t], i + 1) for s, c in tf.items() for i, t in enumerate(sorted(c, key=lambda t: (-c[t], t))[:size])}


@pytest.mark.parametrize("size", [3, 6, 15, 5000])
@pytest.mark.parametrize("broadcast", [tfidf.BROADCAST_WORDS, 0])
def test_vocabulary_is_that_of_a_plain_count(texts, monkeypatch, size, broadcast):
    monkeypatch.setattr(tfidf, "BROADCAST_WORDS", broadcast)
    got = tfidf.vocabulary(tfidf.term_counts(texts), size).select("scope", "term", "corpus_tf", "df", "term_id").collect()
    assert len(got) == len(set(map(tuple, got))) and set(map(tuple, got)) == naive(texts, size)


def test_pairs_of_rare_words_are_not_moved_and_entries_stay_in_place(texts, monkeypatch):
    pinned = {}
    real = tfidf.pin
    monkeypatch.setattr(tfidf, "pin", lambda df, label: pinned.setdefault(label, real(df, label)))
    counts = tfidf.term_counts(texts.where("scope = 'a'"))
    vocab = real(tfidf.vocabulary(counts, 10), "vocabulary")
    every = counts.select("term").distinct().count()
    assert pinned["frequent-words"].count() < 15 and pinned["term-stats"].count() < every / 4
    cuts = pinned["term-cuts"].first()["_cut"]
    assert pinned["term-stats"].where(F.col("corpus_tf") < cuts).count() == 0
    plan = tfidf.weights(texts, counts, vocab)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1  # with a pinned table of true size
