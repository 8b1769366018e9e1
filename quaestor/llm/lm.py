"""Masked pseudo-likelihood of documents under a bidirectional window network."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cached_property, lru_cache
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from quaestor.llm.tables import pin, read_table, with_row_id
from quaestor.llm.words import Piece, find_words, folded, hash_spans, pieces

CLASSES = 64  # of as many words each, at least
VOCABULARY = CLASSES * CLASSES
GROWTH = 16  # the network knows so many words times the root of the number of different words
UNKNOWN, PAD = 0, -1
OFFSETS = (-2, -1, 1, 2)
REACH = 2
RUN = 32  # words that follow each other, in a batch of runs
WIDTH = 24
SHALLOW = 32  # decisions taken for all words of a batch at once
LONG = 64
ROUNDS = 1  # over all texts
BATCH = 4096
CHUNK = 4096
RATE = 0.2
START = 1e-8  # of the squared gradients
BLOCKS = 32  # parts in which parameters are averaged


class Tree(NamedTuple):
    """Decisions that lead to each word, fixed by the number of classes alone.

    A decision splits a range of classes, or of the words of one class, in two. ``shallow`` decisions are those that
    most words pass, if words are as frequent as their rank says; all that stand above a shallow one are shallow.
    """
    shallow: np.ndarray  # decisions
    sides: np.ndarray  # of each word at the shallow decisions: 1 right, -1 left, 0 not passed
    deep: np.ndarray  # further decisions of each word by depth, -1 beyond the last
    deep_sides: np.ndarray
    length: np.ndarray  # number of further decisions of each word
    rank: np.ndarray  # place of each word if those with most further decisions come first

    @staticmethod
    @lru_cache(maxsize=2)
    def of(classes: int) -> Tree:
        """A decision has the number of the class at which it splits, or that of the word plus ``classes``."""
        words = np.arange(classes * classes, dtype=np.int32)
        within, weight = words // classes, 1 / (words + 3.0)
        weight[UNKNOWN] = weight.sum() / 4
        top = _splits(weight.reshape(classes, classes).sum(axis=1), np.zeros(classes, np.int32), np.full(classes, classes, np.int32))
        path = [(t[within], t[within] <= within) for t in top]
        path += [(np.where(t < 0, -1, t + classes), t <= words) for t in _splits(weight, within * classes, (within + 1) * classes)]
        mass = sum(np.bincount(node + 1, weight, classes * (classes + 1) + 1)[1:] for node, _ in path)
        shallow = np.sort(np.argsort(-mass, kind="stable")[:SHALLOW])
        column = np.full(len(mass) + 1, -1, np.int32)  # the last is that of -1
        column[shallow] = np.arange(len(shallow))
        sides, length = np.zeros((len(words), len(shallow)), np.int8), np.zeros(len(words), np.int32)
        deep = np.full((len(path), len(words)), -1, np.int32)
        deep_sides = np.zeros(deep.shape, np.int8)
        for node, right in path:
            at = column[node]
            here = np.flatnonzero(at >= 0)
            sides[here, at[here]] = np.where(right[here], 1, -1)
            here = np.flatnonzero((node >= 0) & (at < 0))
            deep[length[here], here] = node[here]
            deep_sides[length[here], here] = np.where(right[here], 1, -1)
            length[here] += 1
        depth = int(length.max())
        return Tree(shallow, sides, deep[:depth].copy(), deep_sides[:depth].copy(), length,
                    np.argsort(np.argsort(-length, kind="stable")).astype(np.int32))

    def decisions(self, word: np.ndarray) -> tuple[list[tuple[int, int, int]], np.ndarray, np.ndarray]:
        """Further decisions of words in the order of their rank, by depth, and the sides taken.

        For each depth the number of words that take one, which are the first, and the span of their decisions.
        """
        counts = np.searchsorted(-self.length[word], -np.arange(len(self.deep)), "left").tolist()
        ends = [0, *accumulate(counts)]
        own = [word[:n] for n in counts]
        node = [deep.take(w) for deep, w in zip(self.deep, own, strict=True)]
        sides = [deep.take(w) for deep, w in zip(self.deep_sides, own, strict=True)]
        return list(zip(counts, ends, ends[1:])), np.concatenate(node), np.concatenate(sides)


def _splits(weight: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[np.ndarray]:
    """By depth the places at which the range of each entry is split into halves of like weight; -1 beyond the last."""
    total, entry, found = np.concatenate(([0.0], np.cumsum(weight))), np.arange(len(weight), dtype=np.int32), []
    while (open_ := high - low > 1).any():
        middle = np.clip(np.searchsorted(total, (total[low] + total[high]) / 2).astype(np.int32), low + 1, high - 1)
        found.append(np.where(open_, middle, -1))
        low, high = np.where(open_ & (entry >= middle), middle, low), np.where(open_ & (entry < middle), middle, high)
    return found


class Network:
    """Embeddings of the words around a place, scaled by place, give a hidden layer; it takes the decisions that lead to a word."""

    def __init__(self, flat: np.ndarray):
        self.flat = flat
        square, linear = 2 * WIDTH + 1, WIDTH + 1  # the size is a quadratic function of the number of classes
        self.classes = c = round((math.sqrt(linear ** 2 + 4 * square * (len(flat) - self.size(0))) - linear) / (2 * square))
        at = 0
        for name, shape in self.shapes(c).items():
            size = math.prod(shape)
            setattr(self, name, flat[at:at + size].reshape(shape))
            at += size
        self.word = self.output[c:].reshape(c, c, WIDTH)

    @staticmethod
    def shapes(classes: int) -> dict[str, tuple[int, ...]]:
        """The last row of ``embed`` is that of ``PAD``; ``output`` has the decisions between classes, then those of each class."""
        decisions = classes * (classes + 1)
        return {"embed": (classes * classes + 1, WIDTH), "place": (len(OFFSETS), WIDTH), "bias": (WIDTH,), "output": (decisions, WIDTH),
                "output_bias": (decisions,)}

    @classmethod
    def size(cls, classes: int) -> int:
        return sum(math.prod(s) for s in cls.shapes(classes).values())

    @classmethod
    def initial(cls, counts: np.ndarray) -> Network:
        """Small random weights; the biases hold the counts of the vocabulary, so it starts as a unigram model."""
        rng = np.random.default_rng(7)
        classes = math.isqrt(len(counts))
        net, tree = cls(np.zeros(cls.size(classes), np.float32)), Tree.of(classes)
        net.embed[:] = rng.normal(0, 0.3, net.embed.shape)
        net.place[:] = 1 + rng.normal(0, 0.3, net.place.shape)
        net.output[:] = rng.normal(0, 0.1, net.output.shape)
        smoothed = counts + 0.5
        left, right = np.zeros(len(net.output)), np.zeros(len(net.output))
        for side, into in ((-1, left), (1, right)):
            into[tree.shallow] = [smoothed[tree.sides[:, k] == side].sum() for k in range(len(tree.shallow))]
            for node, sides in zip(tree.deep, tree.deep_sides, strict=True):
                here = sides == side
                into += np.bincount(node[here], smoothed[here], minlength=len(into))
        used = left > 0
        net.output_bias[used] = np.log(right[used] / left[used])
        return net

    def _hidden(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A row per run: the embeddings of its ids one after the other, and the hidden layer of its places but the first and last ``REACH``."""
        embedded = self.embed.take(runs, axis=0).reshape(len(runs), -1)  # PAD is -1, the last row
        length = runs.shape[1] - 2 * REACH
        total = np.tile(self.bias, (len(runs), length))
        work = np.empty_like(total)
        for here, place in zip(_shifts(length), self.place, strict=True):
            total += np.multiply(embedded[:, here], np.tile(place, length), out=work)
        return embedded, np.tanh(total, out=total)

    def log_probability_of_runs(self, runs: np.ndarray) -> np.ndarray:
        """Of each word of the runs in their order, given the ids around it; ``PAD`` and the first and last ``REACH`` ids are no words."""
        tree = Tree.of(self.classes)
        word = runs[:, REACH:-REACH].ravel()
        real = np.flatnonzero(word >= 0)
        order = _order(tree.rank.take(word[real]), self.classes ** 2)
        word, h = word[real[order]], self._hidden(runs)[1].reshape(-1, WIDTH).take(real[order], axis=0)
        sides = tree.sides.take(word, axis=0).astype(np.float32)
        logits = h @ self.output[tree.shallow].T
        logits += self.output_bias[tree.shallow]
        logits *= sides
        loss = np.minimum(logits, 0) @ np.full(logits.shape[1], -1, np.float32)
        part = np.exp(-np.abs(logits, out=logits), out=logits)
        part *= np.abs(sides, out=sides)
        part += 1
        loss += np.log(part.prod(axis=1))
        spans, node, sides = tree.decisions(word)
        logits = np.einsum("ij,ij->i", _repeated(h, spans), self.output.take(node, axis=0))
        logits += self.output_bias.take(node)
        logits *= sides
        more = np.log(1 + np.exp(-np.abs(logits))) - np.minimum(logits, 0)
        for count, low, high in spans:
            loss[:count] += more[low:high]
        out = np.empty(len(word))
        out[order] = -loss
        return out

    def log_probability(self, around: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Of each word, given the words around it."""
        return self.log_probability_of_runs(_short_runs(around, word))

    def learn(self, around: np.ndarray, word: np.ndarray, squares: Network) -> None:
        """One step on words, given the words around each."""
        self.learn_runs(_short_runs(around, word), squares)

    def learn_runs(self, runs: np.ndarray, squares: Network) -> None:
        """One Adagrad step on the words of some runs; ``squares`` gathers the squared gradients.

        Only the embeddings and decisions of the batch have gradients, so only they are touched. Words are put in order of
        their rank, so that those that take a decision of some depth are the first.
        """
        tree = Tree.of(self.classes)
        word = runs[:, REACH:-REACH].ravel()
        real = np.flatnonzero(word >= 0)
        real = real[_order(tree.rank.take(word[real]), self.classes ** 2)]
        word, n = word[real], len(real)
        if not n:
            return

        def step(name: str, at, gradient: np.ndarray) -> None:
            gradient /= np.float32(n)
            values, square = getattr(self, name), getattr(squares, name)
            total = square.take(at, axis=0)
            total += gradient * gradient
            square[at] = total
            np.sqrt(total, out=total)
            total += np.float32(1e-5)
            gradient *= np.float32(RATE)
            gradient /= total
            values[at] = np.subtract(values.take(at, axis=0), gradient, out=gradient)
        embedded, hidden = self._hidden(runs)
        h = hidden.reshape(-1, WIDTH).take(real, axis=0)
        shallow = self.output[tree.shallow]
        logits = h @ shallow.T
        logits += self.output_bias[tree.shallow]
        miss = _slope(logits, tree.sides.take(word, axis=0).astype(np.float32))
        back = miss @ shallow
        gradients, biases, nodes = [miss.T @ h], [_total(miss)], [tree.shallow]
        spans, node, sides = tree.decisions(word)
        if len(node):
            own, weights = _repeated(h, spans), self.output.take(node, axis=0)
            logits = np.einsum("ij,ij->i", own, weights)
            logits += self.output_bias.take(node)
            miss = _slope(logits, sides.astype(np.float32))
            weights *= miss[:, None]
            for count, low, high in spans:
                back[:count] += weights[low:high]
            order = _order(node, len(self.output))
            own *= miss[:, None]
            found, total = _sums(own, order, node)
            gradients.append(total)
            biases.append(np.bincount(node, miss)[found].astype(np.float32))
            nodes.append(found)
        nodes = np.concatenate(nodes)
        step("output", nodes, np.concatenate(gradients))
        step("output_bias", nodes, np.concatenate(biases))
        back *= 1 - h * h
        hidden[:] = 0
        hidden.reshape(-1, WIDTH)[real] = back
        length = runs.shape[1] - 2 * REACH
        around, by_place = np.zeros_like(embedded), []
        work = np.empty_like(hidden)
        for here, place in zip(_shifts(length), self.place, strict=True):
            around[:, here] += np.multiply(hidden, np.tile(place, length), out=work)
            by_place.append(_total(np.multiply(embedded[:, here], hidden, out=work).reshape(-1, WIDTH)))
        flat = np.where(runs < 0, len(self.embed) - 1, runs).ravel()
        order = _order(flat, len(self.embed))
        step("embed", *_sums(around.reshape(-1, WIDTH), order, flat))
        step("place", np.arange(len(OFFSETS)), np.stack(by_place))
        step("bias", np.arange(WIDTH), _total(back))


def _shifts(length: int) -> list[slice]:
    """Columns of the embeddings by offset from each place."""
    return [slice((REACH + by) * WIDTH, (REACH + by + length) * WIDTH) for by in OFFSETS]


def _repeated(h: np.ndarray, spans: list[tuple[int, int, int]]) -> np.ndarray:
    return np.concatenate([h[:count] for count, _, _ in spans])


def _order(ids: np.ndarray, below: int) -> np.ndarray:
    return np.argsort(ids.astype(np.uint16), kind="stable") if below <= 1 << 16 else np.argsort(ids.astype(np.int32))


def _short_runs(around: np.ndarray, word: np.ndarray) -> np.ndarray:
    return np.column_stack((around[:, :REACH], word, around[:, REACH:]))


def _slope(logits: np.ndarray, sides: np.ndarray) -> np.ndarray:
    """Derivative, by the logits, of minus the logarithm of the probability of the sides taken; 0 where none is."""
    logits *= sides
    part = np.exp(np.minimum(logits, 80, out=logits), out=logits)
    part += 1
    np.divide(sides, part, out=part)
    return np.negative(part, out=part)


def _total(rows: np.ndarray) -> np.ndarray:
    """Their sum, as a product, which is faster than ``sum`` for few columns."""
    return np.ones(len(rows), rows.dtype) @ rows


def _sums(values: np.ndarray, order: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys, most frequent first, and the sums of their rows; ``order`` sorts the keys.

    Keys of at most ``LONG`` rows are summed all at once, row by row.
    """
    keys = keys.take(order)
    first = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1))
    count = np.minimum(np.diff(first, append=len(keys)), LONG + 1)
    by_count = np.argsort((LONG + 1 - count).astype(np.uint8), kind="stable")
    last = np.append(first[1:], len(keys))
    first, last = first[by_count], last[by_count]
    ends = np.searchsorted(-count[by_count], -np.arange(1, LONG + 1), "left").tolist()
    long = ends.pop()
    total = values.take(order.take(first), axis=0)
    for k in range(long):
        total[k] = _total(values.take(order[first[k]:last[k]], axis=0))
    for k, end in enumerate(ends, 1):
        if end <= long:
            break
        total[long:end] += values.take(order.take(first[long:end] + k), axis=0)
    return keys[first], total


def word_hashes(piece: Piece) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of each word between white space, capitals folded."""
    words = find_words(piece)
    return words.doc, hash_spans(folded(piece.data), words.start, words.end) if len(words.start) else np.zeros(0, np.uint64)


class Vocabulary:
    """The most frequent words of the corpus by hash; other words share one id, of which ``rare`` occur."""

    def __init__(self, hashes: np.ndarray, rare: float = 0):
        order = np.argsort(hashes)
        self.hashes, self.ids, self.rare = hashes[order], order + UNKNOWN + 1, rare
        self.mask = np.uint64((16 << len(hashes).bit_length()) - 1)

    @cached_property
    def slots(self) -> np.ndarray:
        """Place of the only hash with some last bits, -1 for none, -2 for several; made where it is used and not sent."""
        slot = (self.hashes & self.mask).astype(np.int64)
        slots = np.full(int(self.mask) + 1, -1, np.int32)
        slots[slot] = np.where(np.bincount(slot, minlength=len(slots))[slot] > 1, -2, np.arange(len(slot)))
        return slots

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.full(len(hashes), UNKNOWN)
        at = self.slots.take((hashes & self.mask).astype(np.int64))
        several = np.flatnonzero(at == -2)
        at[several] = np.searchsorted(self.hashes, hashes[several])
        at = np.clip(at, 0, len(self.hashes) - 1)
        return np.where(self.hashes.take(at) == hashes, self.ids.take(at), UNKNOWN)


def stream(doc: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Ids in their order with ``REACH`` times ``PAD`` before, between and after texts."""
    at = np.arange(REACH, len(ids) + REACH) + REACH * np.cumsum(np.diff(doc, prepend=doc[:1]) != 0)
    out = np.full(int(at[-1]) + 1 + REACH if len(at) else 2 * REACH, PAD, np.int64)
    out[at] = ids
    return out


def runs(ids: np.ndarray, length: int) -> np.ndarray:
    """Runs of so many places of a stream, each with ``REACH`` ids more on both sides."""
    count = max(1, -(-(len(ids) - 2 * REACH) // length))
    ids = np.concatenate((ids, np.full(count * length + 2 * REACH - len(ids), PAD)))
    return np.lib.stride_tricks.sliding_window_view(ids, length + 2 * REACH)[::length]


def windows(doc: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Ids around each word; ``PAD`` beyond its text."""
    out = np.full((len(ids), len(OFFSETS)), PAD, np.int64)
    for k, by in enumerate(OFFSETS):
        here = np.arange(max(0, -by), len(ids) - max(0, by))
        here = here[doc[here] == doc[here + by]] if len(here) else here
        out[here, k] = ids[here + by]
    return out


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [word_hashes(p)[1] for p in pieces(batch.column(0))]
        values, counts = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts.astype(np.int64))], ["word", "n"])


def count_words(docs: DataFrame) -> DataFrame:
    """Pinned ``word, n`` of all different words of the texts, by hash."""
    counted = docs.select("text").mapInArrow(_count_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return pin(counted, "lm-words")


def vocabulary(docs: DataFrame, counted: DataFrame | None = None) -> tuple[Vocabulary, np.ndarray]:
    """The most frequent words of all texts, and the counts of all ids.

    There are ``VOCABULARY`` ids, or ``GROWTH`` times the root of the number of
    different words if that is more, rounded up to a square.
    """
    counted = count_words(docs) if counted is None else counted
    types, total = counted.agg(F.count(F.lit(1)), F.sum("n")).first()
    size = max(CLASSES, math.isqrt(GROWTH * math.isqrt(types)) + 1) ** 2
    best = counted.orderBy(F.desc("n"), "word").limit(size - 1).collect()
    counts = np.zeros(size)
    counts[UNKNOWN + 1:UNKNOWN + 1 + len(best)] = [r["n"] for r in best]
    counts[UNKNOWN] = (total or 0) - counts.sum()
    return Vocabulary(np.array([r["word"] for r in best], np.int64).view(np.uint64), counts[UNKNOWN]), counts


def _trainer(words: Vocabulary, start: np.ndarray, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, squares = Network(start.copy()), Network(np.full_like(start, START))
        seen, task = 0, 0
        rng = np.random.default_rng(seed)
        for batch in batches:
            task = batch.column(1)[0].as_py() if batch.num_rows else task
            for piece in pieces(batch.column(0)):
                doc, h = word_hashes(piece)
                parts = runs(stream(doc, words.lookup(h)), RUN)
                order = rng.permutation(len(parts))
                for k in range(0, len(order), BATCH // RUN):
                    net.learn_runs(parts[order[k:k + BATCH // RUN]], squares)
                seen += len(h)
        if seen:
            parts = [p.astype(np.float32).tobytes() for p in np.array_split(net.flat, BLOCKS)]
            yield pa.RecordBatch.from_arrays([pa.array(range(BLOCKS), pa.int32()), pa.array([task] * BLOCKS, pa.int32()),
                                              pa.array([float(seen)] * BLOCKS), pa.array(parts, pa.binary())], ["block", "task", "weight", "values"])
    return run


def _average(rows: pa.Table) -> pa.Table:
    order = np.argsort(rows["task"].to_numpy(), kind="stable")
    weights = rows["weight"].to_numpy()[order]
    values = rows["values"].to_pylist()
    total = np.zeros(len(values[0]) // 4)
    for k, w in zip(order, weights, strict=True):
        total += np.frombuffer(values[k], np.float32) * (w / weights.sum())
    first = rows.slice(0, 1)
    return pa.table({"block": first["block"].cast(pa.int32()), "task": first["task"].cast(pa.int32()), "weight": pa.array([weights.sum()]),
                     "values": pa.array([total.astype(np.float32).tobytes()], pa.binary())})


def train(docs: DataFrame, counted: DataFrame | None = None) -> tuple[Vocabulary, Network]:
    """Vocabulary of the whole corpus, and a network trained on all of its texts.

    Each task trains on the texts of its partition, then the parameters are
    averaged by words seen: block by block, in two steps, so that no group
    holds more than about the square root of the number of tasks. Only the
    averaged network, which grows with the root of the number of different
    words, reaches the driver.
    """
    words, counts = vocabulary(docs, counted)
    net = Network.initial(counts)
    schema = "block int, task int, weight double, values binary"
    texts = docs.select("text").withColumn("task", F.spark_partition_id())
    fan = max(1, math.isqrt(texts.rdd.getNumPartitions()))
    for step in range(ROUNDS):
        rows = pin(texts.mapInArrow(_trainer(words, net.flat, step), schema), "lm-parameters")
        rows = rows.withColumn("shard", F.col("task") % fan).groupBy("block", "shard").applyInArrow(_average, schema)
        averaged = rows.groupBy("block").applyInArrow(_average, schema).orderBy("block").collect()
        if averaged:
            net = Network(np.concatenate([np.frombuffer(r["values"], np.float32) for r in averaged]))
    return words, net


RESULT = StructType([StructField("n_tokens", LongType()), StructField("log_likelihood", DoubleType()), StructField("rare", ArrayType(LongType()))])


def pseudo_likelihood(text: Column, words: Vocabulary, net: Network) -> Column:
    """Struct of the number of words, the sum of the log-probabilities of their ids, each given the ids on both sides, and the
    hashes of the words that share the id ``UNKNOWN``; null counts as empty."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            number, total, n_rare = np.zeros(len(batch), np.int64), np.zeros(len(batch)), np.zeros(len(batch), np.int64)
            rare = [np.zeros(0, np.uint64)]
            for piece in pieces(batch):
                doc, h = word_hashes(piece)
                ids = words.lookup(h)
                scores = [net.log_probability_of_runs(part[None]) for part in runs(stream(doc, ids), CHUNK)]
                own = slice(piece.first, piece.first + piece.count)
                number[own] = np.bincount(doc, minlength=piece.count)
                total[own] = np.bincount(doc, np.concatenate(scores), minlength=piece.count) if scores else 0
                n_rare[own] = np.bincount(doc[ids == UNKNOWN], minlength=piece.count)
                rare.append(h[ids == UNKNOWN])
            ends = np.concatenate(([0], np.cumsum(n_rare))).astype(np.int32)
            hashes = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rare).view(np.int64)))
            yield pa.StructArray.from_arrays([pa.array(number), pa.array(total), hashes], ["n_tokens", "log_likelihood", "rare"])
    return arrow_udf(run, RESULT)(text)


def score_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, log_likelihood, mean_log_likelihood`` per row of ``docs(doc_id, text)``.

    The network predicts the id of a word; a word that shares the id
    ``UNKNOWN`` adds the log-probability of being that one of them, from the
    counts of the whole corpus, which are joined by word. So each word of a
    text is predicted, and the probabilities of all words of the corpus add up
    to one. The mean is null for a text without words. Rows are scored alone;
    repeated rows count as often in the vocabulary as they stand.
    """
    rows, row_id = with_row_id(docs, "lm-rows")
    counted = count_words(rows)
    words, net = train(rows, counted)
    scored = pin(rows.select(F.col(row_id).alias("row_id"), "doc_id", pseudo_likelihood(F.col("text"), words, net).alias("s"))
                 .select("row_id", "doc_id", "s.*"), "lm-scores")
    rare = scored.select("row_id", F.explode("rare").alias("word")).join(counted.hint("merge"), "word")
    rare = rare.groupBy("row_id").agg(F.sum(F.log(F.col("n") / F.lit(float(words.rare or 1)))).alias("more"))
    rows = scored.drop("rare").join(rare.hint("merge"), "row_id", "left")
    rows = rows.select("doc_id", "n_tokens", (F.col("log_likelihood") + F.coalesce("more", F.lit(0.0))).alias("log_likelihood"))
    mean = F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens"))
    return rows.withColumn("mean_log_likelihood", mean)


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read_table(spark, sf_dir, "documents"))


QUERIES = {"op7_lm_score": op7_lm_score}
ORACLE: dict[str, str] = {}
