"""Texts as numbered words, inside one task.

Spark lowers the texts and leaves one blank between words; from there a group
of texts is worked on as arrays of numbers. Words of a group are numbered in
the order of their bytes. A term is one number as well: that of its first
word times ``len(words) + 1``, plus one and the number of the second word if
there is one. A blank comes before every character of a word, so the order of
these numbers is the order of the terms.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

from quaestor.functions import text as tx
from quaestor.operators.tfidf import STOP_WORDS


def plain_words(text: Column) -> Column:
    """The text in lower case, with a blank for whatever stands between words."""
    return F.regexp_replace(F.lower(text), f"[^{tx.WORD}]+", " ")


def whole(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


@dataclass
class Texts:
    """The different texts of a group in the order of their first rows, and their nodes (a node for each difficulty) likewise."""
    first: np.ndarray        # row of each text
    copies: np.ndarray
    node_first: np.ndarray   # row of each node
    node_text: np.ndarray
    node_copies: np.ndarray

    @classmethod
    def of(cls, digest: pa.Array, rank: np.ndarray) -> Texts:
        """From rows in order. Digests tell texts apart."""
        text = digest.dictionary_encode().indices.to_numpy().astype(np.int64)
        n = int(text.max()) + 1 if len(text) else 0
        _, first = np.unique(text, return_index=True)
        keys, node_first, node_copies = np.unique(text * 8 + rank, return_index=True, return_counts=True)
        order = np.argsort(node_first, kind="stable")
        return cls(first, np.bincount(text, minlength=n), node_first[order], keys[order] // 8, node_copies[order])


@dataclass
class Words:
    words: pa.Array      # in order
    ids: np.ndarray      # number of each word of the texts, one text after the other
    sizes: np.ndarray    # words of each text

    @classmethod
    def of(cls, plain: pa.Array) -> Words:
        """Words of two or more characters without stop words."""
        lists = pc.split_pattern(plain, " ")
        found = whole(lists.flatten().dictionary_encode())
        own = found.dictionary
        wanted = pc.and_(pc.greater_equal(pc.utf8_length(own), 2), pc.invert(pc.is_in(own, pa.array(STOP_WORDS))))
        kept = pc.indices_nonzero(wanted)
        kept = kept.take(pc.sort_indices(own.take(kept)))
        number = np.full(len(own) + 1, -1, np.int64)
        number[kept.to_numpy()] = np.arange(len(kept))
        ids = number[found.indices.to_numpy()]
        there = ids >= 0
        text = np.repeat(np.arange(len(plain)), lists.value_lengths().to_numpy())
        return cls(own.take(kept), ids[there], np.bincount(text[there], minlength=len(plain)))

    @property
    def text(self) -> np.ndarray:
        """Text of each word."""
        return np.repeat(np.arange(len(self.sizes)), self.sizes)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, first and second word of each two neighbours."""
        text = self.text
        at = np.flatnonzero(text[1:] == text[:-1])
        return text[at], self.ids[at], self.ids[at + 1]

    def term(self, first: np.ndarray, second: np.ndarray | int = -1) -> np.ndarray:
        return first * (len(self.words) + 1) + (second + 1)

    def terms(self) -> tuple[np.ndarray, np.ndarray]:
        """Text and term of each word and each two neighbours."""
        text, first, second = self.pairs()
        return np.concatenate([self.text, text]), np.concatenate([self.term(self.ids), self.term(first, second)])


def runs(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each run of equal values."""
    start = np.flatnonzero(np.concatenate([np.ones(min(1, len(ordered)), bool), ordered[1:] != ordered[:-1]]))
    return start, np.diff(np.append(start, len(ordered)))


def counted(text: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, term and count of each different term of each text, in this order."""
    width = int(term.max(initial=0)) + 1
    if (int(text.max(initial=0)) + 1) * width < 1 << 62:
        both = np.sort(text * width + term)
        start, tf = runs(both)
        return both[start] // width, both[start] % width, tf
    known, short = np.unique(term, return_inverse=True)
    text, short, tf = counted(text, short)
    return text, known[short], tf


def totals(term: np.ndarray, tf: np.ndarray, copies: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each different term, its count, and the rows that hold it; ``copies`` are those of the text of each entry."""
    order = np.argsort(term, kind="stable")
    start, _ = runs(term[order])
    if not len(start):
        return term, tf, copies
    return term[order][start], np.add.reduceat((tf * copies)[order], start), np.add.reduceat(copies[order], start)


def numbers(words: Words, terms: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Terms of a vocabulary that the words of a group can make: their numbers in order, and their places in the vocabulary."""
    parts = pc.split_pattern(terms, " ")
    sizes = parts.value_lengths().to_numpy()
    known = pc.fill_null(pc.index_in(parts.flatten(), words.words), -1).to_numpy().astype(np.int64)
    start = np.cumsum(sizes) - sizes
    first = known[start]
    second = np.where(sizes > 1, known[np.minimum(start + 1, max(len(known) - 1, 0))], -1)
    place = np.flatnonzero((first >= 0) & ((sizes == 1) | (second >= 0)))
    number = words.term(first[place], second[place])
    order = np.argsort(number)
    return number[order], place[order]


def entries(words: Words, number: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, place and count of each term of each text that is in the vocabulary (``number`` in order), by text and place."""
    first, second = np.divmod(number, len(words.words) + 1)
    single = second == 0
    of_word, starts, ends = np.full(len(words.words) + 1, -1), *np.zeros((2, len(words.words) + 1), bool)
    of_word[first[single]] = place[single]
    starts[first[~single]] = True
    ends[second[~single] - 1] = True
    found = of_word[words.ids]
    text, a, b = words.pairs()
    likely = starts[a] & ends[b]  # few pairs have to be looked up
    text, term = text[likely], words.term(a[likely], b[likely])
    pairs, of_pair = number[~single], place[~single]
    at = np.minimum(np.searchsorted(pairs, term), max(len(pairs) - 1, 0))
    known = pairs[at] == term if len(pairs) else np.zeros(len(term), bool)
    return counted(np.concatenate([words.text[found >= 0], text[known]]), np.concatenate([found[found >= 0], of_pair[at[known]]]))


def best(term: np.ndarray, corpus_tf: np.ndarray, max_features: int) -> np.ndarray:
    """Rows of the most frequent terms, the first ones by term where counts are equal; terms come in order."""
    return np.argsort(-corpus_tf, kind="stable")[:max_features]


def packed(values: np.ndarray, sizes: np.ndarray, kind: type) -> pa.Array:
    """One binary value for each of the given sizes."""
    data = np.ascontiguousarray(values, kind)
    ends = np.concatenate([[0], np.cumsum(sizes)]) * data.itemsize
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])


def lists(values: np.ndarray | pa.Array, sizes: np.ndarray | None = None) -> pa.Array:
    """One list for each of the given sizes, or one of all values."""
    sizes = np.array([len(values)]) if sizes is None else sizes
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), values if isinstance(values, pa.Array) else pa.array(values))
