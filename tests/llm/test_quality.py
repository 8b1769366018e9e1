from __future__ import annotations

import random
import re
from collections import Counter

import pyarrow as pa

from quaestor.llm.quality import COUNTS, MIN_WORDS, counts_of, judge_quality, op8_quality
from quaestor.llm.tables import read_table
from quaestor.llm.words import find_words, hash_spans, pieces
from tests.conftest import SF_DIR


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    hit = {i + k for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for k in range(8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit))


def counted(texts):
    out = []
    for piece in pieces(pa.array(texts, pa.string()), 64):
        words = find_words(piece)
        found = counts_of(piece, words, hash_spans(piece.data, words.start, words.end))
        out += list(zip(*[found[c].tolist() for c in COUNTS], strict=True))
    return out


def test_counts():
    rnd = random.Random(8)
    texts = [None, "", " \n\t", "a", "é\x85b\xa0c", "x " * 40, "a b\na b\n a b\n\n\n", "#*$%&|<>"]
    texts += ["".join(rnd.choice(["a", "bb", "é", "&"]) + rnd.choice(" \n\t") for _ in range(rnd.randrange(60))) for _ in range(200)]
    assert counted(texts) == [plain(t) for t in texts]
    assert counted([]) == []


def test_query(spark):
    docs = {r.doc_id: r.text for r in read_table(spark, SF_DIR, "documents").collect()}
    good = {r.doc_id: r.quality for r in read_table(spark, SF_DIR, "labels").collect()}
    got = op8_quality(spark, SF_DIR).collect()
    assert {r.doc_id: tuple(r[c] for c in COUNTS) for r in got} == {k: plain(t) for k, t in docs.items()}
    for r in got:
        assert r.base_failed == (r.n_words < MIN_WORDS or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (not r.base_failed and r.quality >= 0.5)
    fine = [r.kept == (good[r.doc_id] == 1) for r in got if r.doc_id in good and not r.base_failed]
    assert sum(fine) / len(fine) > 0.9


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "a"), (None, "w " * 30, "b"), (1, None, "a")], "doc_id long, text string, quality_rules string")
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    got = judge_quality(docs, labels)
    assert got.columns == [*docs.columns, "quality_rules_"]
    assert sorted(r.quality_rules_.n_words for r in got.collect()) == [0, 0, 30]
    assert judge_quality(docs.limit(0), labels.limit(0)).count() == 0
