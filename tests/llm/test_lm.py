from __future__ import annotations

import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa

from quaestor.llm import lm
from quaestor.llm.lm import (CLASSES, OFFSETS, PAD, UNKNOWN, VOCABULARY, Network, op7_lm_score, pseudo_likelihood, score_documents, train,
                             vocabulary, windows, word_hashes)
from quaestor.llm.tables import read_table
from quaestor.llm.words import hash_text, pieces
from pyspark.sql import functions as F
from tests.conftest import SF_DIR


def random_net(seed=1):
    rng = np.random.default_rng(seed)
    net = Network.initial(rng.integers(1, 100, VOCABULARY).astype(float))
    net.flat += rng.normal(0, 0.05, net.flat.shape).astype(np.float32)
    return net


def test_probabilities_add_up():
    net = random_net()
    around = np.array([[1, 2, PAD, UNKNOWN]])
    every = net.log_probability(np.repeat(around, VOCABULARY, axis=0), np.arange(VOCABULARY))
    assert abs(np.exp(every).sum() - 1) < 1e-3


def test_gradient_against_differences():
    rng = np.random.default_rng(2)
    net = random_net()
    around, word = rng.integers(0, VOCABULARY, (50, len(OFFSETS))), rng.integers(0, VOCABULARY, 50)
    before, squares = net.flat.copy(), Network(np.zeros_like(net.flat))
    net.learn(around, word, squares)
    moved = before - net.flat
    loss = lambda flat: -Network(flat).log_probability(around, word).mean()
    for at in np.argsort(-squares.flat)[:5]:
        up, down = before.copy(), before.copy()
        up[at] += 1e-2
        down[at] -= 1e-2
        slope = (loss(up) - loss(down)) / 2e-2
        assert np.sign(slope) == np.sign(moved[at]) and abs(abs(slope) - np.sqrt(squares.flat[at])) < 0.1 * abs(slope) + 1e-4


def test_a_step_works_on_the_parameters_of_its_batch_only():
    rng = np.random.default_rng(5)
    net = Network.initial(rng.integers(1, 100, 200 ** 2).astype(float))
    squares, before = Network(np.zeros_like(net.flat)), Network(net.flat.copy())
    around, word = rng.integers(PAD, 300, (50, len(OFFSETS))), rng.integers(0, 600, 50)
    tracemalloc.start()
    net.learn(around, word, squares)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < net.flat.nbytes / 4
    seen = sorted(set(np.where(around < 0, 200 ** 2, around).ravel().tolist()))
    assert sorted(np.flatnonzero((net.embed != before.embed).any(axis=1)).tolist()) == seen
    assert np.flatnonzero((net.word != before.word).any(axis=(1, 2))).tolist() == sorted(set((word // 200).tolist()))


def test_windows_stay_in_their_text():
    assert windows(np.array([0, 0, 0, 1]), np.array([5, 6, 7, 8])).tolist() == [
        [PAD, PAD, 6, 7], [PAD, 5, 7, PAD], [5, 6, PAD, PAD], [PAD, PAD, PAD, PAD]]


def test_vocabulary_counts_all_texts(spark):
    docs = read_table(spark, SF_DIR, "documents")
    words, counts = vocabulary(docs)
    plain = Counter(w for r in docs.collect() for w in "".join(c.lower() if c < "Ā" and c.lower() != c else c for c in r.text).split(" ")
                    for w in w.split() if w)
    assert counts.sum() == sum(plain.values())
    (top, n), = plain.most_common(1)
    assert counts[words.lookup(np.array([hash_text(top)], np.uint64))[0]] == n
    assert CLASSES ** 2 == VOCABULARY


def test_prose_beats_shuffled_words(spark):
    rnd = random.Random(3)
    rows = [(k, " ".join(x for _ in range(60) for x in rnd.choice([("new", "york", "city"), ("red", "wine", "glass"), ("deep", "blue", "sea")])))
            for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    words, net = train(docs)
    shuffled = [(k, " ".join(rnd.sample(t.split(), len(t.split())))) for k, t in rows[:50]]
    mean = lambda r: spark.createDataFrame(r, "doc_id long, text string").select(
        pseudo_likelihood(F.col("text"), words, net).alias("s")).agg(F.avg("s.log_likelihood")).first()[0]
    assert mean(rows[:50]) > 0.8 * mean(shuffled)


def test_scores_are_sums_over_words(spark):
    docs = read_table(spark, SF_DIR, "documents").select("doc_id", "text")
    words, net = train(docs)
    some = [(r.doc_id, r.text) for r in docs.orderBy("doc_id").limit(20).collect()]
    got = {r.doc_id: r.s for r in docs.select("doc_id", pseudo_likelihood(F.col("text"), words, net).alias("s")).collect()}
    for k, text in some:
        (piece,) = pieces(pa.array([text]))
        doc, h = word_hashes(piece)
        ids = words.lookup(h)
        assert got[k].n_tokens == len(ids)
        assert abs(got[k].log_likelihood - net.log_probability(windows(doc, ids), ids).sum()) < 1e-2 * max(1, len(ids))


def test_query_and_odd_rows(spark):
    assert op7_lm_score(spark, SF_DIR).where("log_likelihood < 0").count() == read_table(spark, SF_DIR, "documents").count()
    docs = spark.createDataFrame([(1, None, "x"), (None, "", "y"), (2, "a b", "z"), (2, "a b", "z")], "doc_id long, text string, s string")
    got = sorted((str(r.doc_id), r.n_tokens, r.mean_log_likelihood is None) for r in score_documents(docs).collect())
    assert got == [("1", 0, True), ("2", 2, False), ("2", 2, False), ("None", 0, True)]
    assert score_documents(docs.limit(0)).count() == 0


def test_rare_words_are_predicted_from_whole_counts(spark):
    docs = read_table(spark, SF_DIR, "documents")
    (piece,) = pieces(pa.array(["\n".join(r.text for r in docs.collect())]), 1 << 40)
    n = Counter(word_hashes(piece)[1].tolist())
    words, net = train(docs)
    net_only = {r.doc_id: r.s.log_likelihood for r in docs.select("doc_id", pseudo_likelihood(F.col("text"), words, net).alias("s")).collect()}
    rare_total = sum(k for h, k in n.items() if words.lookup(np.array([h], np.uint64))[0] == UNKNOWN)
    got = {r.doc_id: r.log_likelihood for r in score_documents(docs).collect()}
    shares = 0.0
    for r in docs.orderBy("doc_id").limit(20).collect():
        (piece,) = pieces(pa.array([r.text]))
        h = word_hashes(piece)[1]
        rare = h[words.lookup(h) == UNKNOWN].tolist()
        shares += len(rare)
        assert abs(got[r.doc_id] - net_only[r.doc_id] - sum(np.log(n[x] / rare_total) for x in rare)) < 1e-2 * len(h)
    assert shares > 0


def test_vocabulary_grows_with_the_number_of_words(spark):
    docs = spark.range(40).selectExpr("array_join(transform(sequence(id * 10000, id * 10000 + 9999), x -> concat('w', x)), ' ') AS text")
    words, counts = vocabulary(docs)
    assert len(counts) == len(words.hashes) + 1 > 2 * VOCABULARY and counts.sum() == 400000
    net = Network.initial(counts)
    every = net.log_probability(np.full((len(counts), len(OFFSETS)), PAD), np.arange(len(counts)))
    assert abs(np.exp(every).sum() - 1) < 1e-3 and Network(net.flat.copy()).classes ** 2 == len(counts)


def test_copies_of_any_one_text_train_the_network(spark):
    for text in ("red wine glass", "deep blue sea", "new york city", "one more text"):
        docs = spark.createDataFrame([(k, " ".join([text] * 50)) for k in range(40)], "doc_id long, text string")
        words, net = train(docs)
        assert not np.array_equal(net.flat, Network.initial(vocabulary(docs)[1]).flat)
        assert docs.select(pseudo_likelihood(F.col("text"), words, net).alias("s")).agg(F.avg(F.expr("s.log_likelihood / s.n_tokens"))).first()[0] > -1


def test_work_on_a_word_does_not_grow_with_the_vocabulary():
    """Sixteen times the words may cost four more decisions a word, not four times the outputs."""
    def peaks(classes):
        rng = np.random.default_rng(3)
        size = classes ** 2
        net = Network.initial(size / np.arange(1, size + 1))
        squares = Network(np.full_like(net.flat, 1e-6))
        share = 1 / np.arange(1, size + 1)
        around, word = (rng.choice(size, n, p=share / share.sum()) for n in ((2048, len(OFFSETS)), 2048))
        found = []
        for work in (lambda: net.log_probability(around, word), lambda: net.learn(around, word, squares)):
            tracemalloc.start()
            work()
            found.append(tracemalloc.get_traced_memory()[1])
            tracemalloc.stop()
        return found
    small, large = peaks(64), peaks(256)
    assert large[0] < 2 * small[0] and large[1] < 2 * small[1]


def plain_log_probability(net, around, word):
    """One word by plain recursion over ranges of classes, then of the words of the class."""
    c = net.classes
    weight = 1 / (np.arange(c * c) + 3.0)
    weight[UNKNOWN] = weight.sum() / 4
    h = np.tanh(net.bias + sum(net.embed[a] * p for a, p in zip(around, net.place, strict=True)))

    def walk(low, high, step, goal, first):
        if high - low == 1:
            return 0.0
        total = lambda a, b: weight[a * step:b * step].sum()
        middle = next(m for m in range(low + 1, high) if m == high - 1 or total(low, m) >= total(m, high))
        logit = float(h @ net.output[first + middle] + net.output_bias[first + middle])
        right = goal >= middle
        return -np.log1p(np.exp(-logit if right else logit)) + walk(*((middle, high) if right else (low, middle)), step, goal, first)
    k = word // c
    return walk(0, c, c, k, 0) + walk(k * c, (k + 1) * c, 1, word, c)


def test_probabilities_against_plain_recursion():
    net, rng = random_net(), np.random.default_rng(4)
    net.output += rng.normal(0, 0.5, net.output.shape).astype(np.float32)
    word = np.concatenate(([UNKNOWN, 1, 63, 64, VOCABULARY - 1], rng.integers(0, VOCABULARY, 40)))
    around = rng.integers(PAD, VOCABULARY, (len(word), len(OFFSETS)))
    got = net.log_probability(around, word)
    assert np.allclose(got, [plain_log_probability(net, a, w) for a, w in zip(around, word, strict=True)], atol=1e-4)


def test_runs_are_scored_and_learned_as_their_words():
    rng = np.random.default_rng(6)
    doc = np.repeat(np.arange(9), [1, 40, 0, 3, 100, 2, 70, 31, 1])
    ids = rng.integers(0, 500, len(doc))
    one, two = random_net(), random_net()
    parts = lm.runs(lm.stream(doc, ids), 32)
    around = windows(doc, ids)
    got = np.concatenate([one.log_probability_of_runs(p[None]) for p in parts])
    assert np.allclose(got, one.log_probability(around, ids), atol=1e-5)
    squares = [Network(np.full_like(one.flat, 1e-6)) for _ in range(2)]
    one.learn_runs(parts, squares[0])
    two.learn(around, ids, squares[1])
    assert np.allclose(squares[0].flat, squares[1].flat, rtol=1e-3, atol=1e-8) and np.allclose(one.flat, two.flat, atol=2e-3)


def test_texts_without_words_are_learned_from_and_scored():
    net = random_net()
    before = net.flat.copy()
    parts = lm.runs(lm.stream(np.zeros(0, np.int64), np.zeros(0, np.int64)), 32)
    net.learn_runs(parts, Network(np.zeros_like(net.flat)))
    assert len(net.log_probability_of_runs(parts)) == 0 and np.array_equal(net.flat, before)


def test_sums_of_long_and_short_runs():
    rng = np.random.default_rng(7)
    for sizes in ([1], [1, 1, 2], [lm.LONG, lm.LONG + 1, 1, 3 * lm.LONG, lm.LONG - 1, 2], [500]):
        keys = np.repeat(np.arange(len(sizes)) * 3, sizes)
        values = rng.normal(size=(len(keys), 5))
        keys = rng.permutation(keys)
        found, total = lm._sums(values, np.argsort(keys), keys)
        assert sorted(found.tolist()) == sorted(set(keys.tolist()))
        assert np.allclose(total, [values[keys == k].sum(axis=0) for k in found])


def test_words_are_looked_up_among_hashes_with_the_same_last_bits():
    rng = np.random.default_rng(8)
    for n in (0, 1, 3, 5000):
        known = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        known = rng.permutation(np.unique(np.concatenate((known, known[::3] ^ np.uint64(1 << 50)))))
        ids = {h: k + 1 for k, h in enumerate(known.tolist())}
        asked = np.concatenate((known, known ^ np.uint64(1 << 51), rng.integers(0, 1 << 63, 100).astype(np.uint64)))
        assert lm.Vocabulary(known).lookup(asked).tolist() == [ids.get(h, UNKNOWN) for h in asked.tolist()]
