"""Scopes that one task decides, and the rounds of larger ones."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quaestor.operators import dedup, passes, tfidf, wordlists
from quaestor.options import Options
from tests.test_dedup import make_questions, naive

SCHEMA = "doc string, ord long, question string, difficulty_estimate string"


def pins(monkeypatch):
    written = []
    for module, name in ((dedup, "_pin"), (tfidf, "pin")):
        plain = getattr(module, name)
        monkeypatch.setattr(module, name, lambda df, label, plain=plain: written.append(label) or plain(df, label))
    return written


def scopes(spark, sizes):
    rows, want, flagged = [], [], 0
    for k, n in enumerate(sizes):
        questions, levels = make_questions(k, n)
        rows += [(f"s{k}", i, q, d) for i, (q, d) in enumerate(zip(questions, levels))]
        left, pairs = naive(questions, levels, k=25)
        want += [(f"s{k}", i) for i in left]
        flagged += pairs
    return spark.createDataFrame(rows, SCHEMA), sorted(want), flagged


@pytest.mark.parametrize("heads,limits", [(8192, {}), (30, {}), (5, {"LEAST": 4, "ROUNDS": 1, "BLOCK": 9, "PART_BYTES": 400})])
def test_both_ways_against_a_double_loop(spark, monkeypatch, heads, limits):
    """One task a scope, both kinds of scopes, and rounds with texts in many parts."""
    for name, value in limits.items():
        monkeypatch.setattr(dedup, name, value)
    df, want, flagged = scopes(spark, (12, 50, 24))
    options = Options(max_features=25)
    assert sorted((r.doc, r.ord) for r in dedup.survivors(df, scope="doc", options=options, heads=heads).collect()) == want
    row = dedup.summary(dedup.resolve(df, scope="doc", options=options, heads=heads)).first()
    assert (row.total, row.remaining, row.duplicate_pairs) == (df.count(), len(want), flagged)


def test_scopes_that_fit_a_task_move_their_texts_once(spark, monkeypatch):
    """Their terms, vocabulary and vectors were written and joined, which took more disk than the texts."""
    written = pins(monkeypatch)
    df, want, _ = scopes(spark, (12, 20))
    found = dedup.resolve(df, scope="doc", options=Options(max_features=25))
    assert sorted(set(written)) == ["decided", "large-scopes"] and len(written) == 2
    assert dedup.kept_nodes(found).count() <= len(want)


def test_a_round_is_one_write(spark, monkeypatch):
    """The next range waited for a write of its own before its nodes were decided."""
    written = pins(monkeypatch)
    monkeypatch.setattr(dedup, "LEAST", 10)
    monkeypatch.setattr(dedup, "ROUNDS", 100)
    df, _, _ = scopes(spark, (57,))
    dedup.resolve(df, scope="doc", heads=10)
    assert Counter(written)["decided"] == 1 + 6 and "struck" not in written


def test_sketches_bound_every_product():
    rng = np.random.default_rng(5)
    size = rng.integers(1, 2 * passes.LONG, 50)
    term = np.concatenate([np.sort(rng.choice(3000, n, replace=False)) for n in size])
    block = passes.Block.made(np.arange(50), np.zeros(50, int), size, term, rng.random(len(term)) + 0.1)
    dense = np.zeros((50, 3000))
    dense[np.repeat(np.arange(50), size), term] = block.w
    assert [kind for kind, _ in block.by_length(np.arange(50))] == [False, True]
    for wide, rows in ((False, np.arange(50)), (True, np.flatnonzero(size > passes.LONG))):
        sketches, own = block.sketches(rows, wide), dense[rows]
        true, bound = own @ own.T, sketches @ sketches.T
        assert (bound >= true - passes.SLACK / 2).all() and (bound > true + 0.01).any()


def test_pairs_of_short_and_long_vectors(monkeypatch):
    monkeypatch.setattr(passes, "LONG", 9)
    monkeypatch.setattr(passes, "ROWS", 7)
    rng = np.random.default_rng(6)
    stems = [rng.choice(200, n, replace=False) for n in (7, 9, 10, 30, 31)]
    terms = [np.setdiff1d(stems[k % 5], stems[k % 5][: k % 2]) for k in rng.integers(0, 10, 60)]
    size = np.array([len(t) for t in terms])
    block = passes.Block.made(np.arange(60), np.zeros(60, int), size, np.concatenate(terms), np.ones(int(size.sum())))
    dense = np.zeros((60, 200))
    dense[np.repeat(np.arange(60), size), block.term] = block.w
    rows, others = np.arange(0, 60, 2), np.arange(5, 60)
    i, j, s = passes.similar(block, rows, block, others, 0.85)
    want = [(a, b) for a in range(len(rows)) for b in range(len(others)) if rows[a] < others[b] and dense[rows[a]] @ dense[others[b]] > 0.85]
    assert list(zip(i.tolist(), j.tolist())) == want and len(set(size > 9)) == 2
    assert np.allclose(s, [dense[rows[a]] @ dense[others[b]] for a, b in want])


def test_words_are_those_of_the_expression(spark):
    """Case, marks, one-letter and stop words, letters beyond 16 bits and other scripts."""
    texts = ["The Cat's hat_2, a b CAT!! of", "", "  ", "Été ÀÇ été 9 10 x1", "\U00010400\U00010401 \U00010428 ab́c İstanbul ΣΑΣ", "数据 処理。テスト ٣٤ a-b-cd", "of the and", "x yz\tcat"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    rows = df.select("id", tfidf.terms(F.col("text")).alias("want"), wordlists.plain_words(F.col("text")).alias("plain")).orderBy("id").collect()
    words = wordlists.Words.of(pa.array([r.plain for r in rows]))
    own = words.words.to_pylist()
    got = [[own[i] for i in part] for part in np.split(words.ids, np.cumsum(words.sizes)[:-1])]
    assert got == [r.want for r in rows] and own == sorted(own, key=str.encode)
    text, term = words.terms()
    assert len(term) == 2 * len(words.ids) - np.count_nonzero(words.sizes)


def test_terms_go_by_their_bytes():
    """Ties at the end of a vocabulary go by the term; pairs stand between words."""
    words = wordlists.Words.of(pa.array(["ab abc", "abc x_ ab", "ab zz ab", "ab é zz"]))
    own = words.words.to_pylist()
    terms = np.unique(words.terms()[1])
    named = [own[f] + (f" {own[s - 1]}" if s else "") for f, s in zip(*np.divmod(terms, len(own) + 1))]
    assert named == sorted(named, key=str.encode)
    number, place = wordlists.numbers(words, pa.array([*named[::-1], "none", "ab none", "none ab"]))
    assert number.tolist() == terms.tolist() and [named[::-1][p] for p in place] == named


def test_counts_of_many_texts_with_large_terms():
    rnd = random.Random(1)
    text, term = np.array([rnd.randrange(5) for _ in range(300)]), np.array([rnd.randrange(9) for _ in range(300)])
    want = sorted((t, k, n) for (t, k), n in Counter(zip(text.tolist(), term.tolist())).items())
    assert list(zip(*(x.tolist() for x in wordlists.counted(text, term)))) == want
    far = [x.tolist() for x in wordlists.counted(text, term << 59)]
    assert [(t, k >> 59, n) for t, k, n in zip(*far)] == want


@pytest.mark.parametrize("kind", [np.uint16, np.uint32])
def test_vectors_as_bytes(kind):
    """Small vocabularies take two bytes a term; blocks are read from slices and several chunks as well."""
    size, place = np.array([2, 3, 1, 4]), np.array([0, 5, 1, 2, 9, 3, 0, 1, 2, 8])
    tf, idf = np.arange(1, 11), np.linspace(1, 3, 10)
    table = pa.table({"node": [3, 1, 2, 0], "rank": pa.array([0, 1, 2, 3], pa.int32()),
                      "terms": wordlists.packed(place, size, kind), "tfs": wordlists.packed(tf, size, np.uint32)})
    whole = passes.Block.packed(table, idf)
    assert whole.node.tolist() == [0, 1, 2, 3] and whole.size.tolist() == [4, 3, 1, 2] and whole.term.tolist() == [0, 1, 2, 8, 1, 2, 9, 3, 0, 5]
    x = (tf * idf[place])[-4:]
    assert np.allclose(whole.w[:4], x / np.sqrt((x * x).sum()))
    parts = pa.concat_tables([table.slice(1, 2), table.slice(3)])
    assert passes.Block.packed(parts, idf).term.tolist() == whole.term.tolist()[:8] and len(passes.Block.packed(table.slice(0, 0), idf)) == 0
