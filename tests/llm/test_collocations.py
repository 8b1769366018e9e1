from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from quaestor.llm import collocations as module
from quaestor.llm.collocations import collocations, frequent_phrases

ASCII_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, least, best, longest=5):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n\v\f\r]", (text or "").translate(ASCII_LOWER)):
            words = [w for w in re.split(r"[ \t]+", piece) if w]
            totals[lang] += len(words)
            counts.update((lang, tuple(words[i:i + m])) for m in range(1, longest + 1) for i in range(len(words) - m + 1))
    frequent = {k: a for k, a in counts.items() if a >= least}
    out = []
    for (lang, words), a in frequent.items():
        if len(words) < 2 or any(
                a <= b and other == lang and len(longer) > len(words)
                and any(longer[i:i + len(words)] == words for i in range(len(longer) - len(words) + 1))
                for (other, longer), b in frequent.items()):
            continue
        cuts = [(1000 * a * totals[lang] // (counts[lang, words[:k]] * counts[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out.append((lang, " ".join(words), a, counts[lang, words[:k]], counts[lang, words[k:]], totals[lang], score))
    ranked = []
    for lang in {r[0] for r in out}:
        own = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        ranked += [(r[0], i, *r[1:]) for i, r in enumerate(own[:best], 1)]
    return sorted(ranked)


def texts(rnd, n):
    words = ["alpha", "Beta", "g", "ünder", "the", "of", "x1", "日本"]
    phrases = ["the of the", "new York city hall tower", "in the case of g", "a b", "a b c d e f"]
    rows = []
    for _ in range(n):
        parts = [rnd.choice(phrases) if rnd.random() < 0.5 else rnd.choice(words) for _ in range(rnd.randint(0, 25))]
        rows.append((rnd.choice(["en", "de", None]), "".join(p + rnd.choice([" ", "  ", "\t", " ", ". ", ",", "\n"]) for p in parts)))
    return rows + [("en", None), ("en", ""), ("fr", "a b"), ("und", "a b c d e f " * 30), (None, "word " * 50)]


@pytest.mark.parametrize("least, best, bits", [(3, 2000, 1 << 16), (5, 10, 128)])
def test_equals_brute_force(spark, least, best, bits):
    rows = texts(random.Random(least), 150)
    frame = spark.createDataFrame([(*r, "s", 1) for r in rows], "lang string, text string, phrase string, n int").repartition(6)
    got = sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
                 for r in collocations(frame, least=least, best=best, bits=bits).collect())
    assert got == brute(rows, least, best) and len(got) > 15


def test_counts_are_exact_and_no_rows_give_none(spark):
    frame = spark.createDataFrame([("en", "A b, a B. a\nb")], "lang string, text string")
    got = {tuple(r.words): r.a for r in frequent_phrases(frame, least=2).collect()}
    assert got == {("a",): 3, ("b",): 3, ("a", "b"): 2, (): 6}
    assert collocations(frame.limit(0)).count() == 0 and collocations(frame).count() == 0


def test_walk_continues_over_the_border_of_a_partition(monkeypatch):
    class Task:
        @staticmethod
        def get():
            return type("T", (), {"partitionId": staticmethod(lambda: 7)})
    monkeypatch.setattr(module, "TaskContext", Task)
    stream = [("en", ["a"], 9), ("en", ["a", "b"], 4), ("en", ["a", "b", "c"], 4), ("en", ["a", "d"], 3), ("fr", ["a"], 5)]
    kinds = pa.schema([("lang", pa.string()), ("words", pa.list_(pa.string())), ("a", pa.int64())])

    def batch(rows):
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds.types)], schema=kinds)
    whole = [r for b in module._walk(iter([batch(stream)]), {}) for r in b.to_pylist()]
    assert [(r["counts"], r["whole"]) for r in whole] == [([9], False), ([9, 4], True), ([9], False)]
    later = [r for b in module._walk(iter([batch(stream[2:4]), batch(stream[4:])]), {7: [9, 4]}) for r in b.to_pylist()]
    assert later == whole[1:]


def test_long_texts_are_cut_between_phrases(monkeypatch):
    rnd = random.Random(2)
    text = "".join(rnd.choice("abc  .") for _ in range(3000)) + "x" * 300 + "." + "ab " * 200
    batch = pa.record_batch([pa.array(["en"]), pa.array([text])], ["lang", "text"])

    def counts():
        keys = np.concatenate([g[f] for langs, piece in module._runs(batch) for g, f in module._Grams(langs, piece).levels(5)])
        return sorted(keys.tolist())
    whole = counts()
    monkeypatch.setattr(module, "BLOCK", 64)
    assert counts() == whole and sum(1 for _ in module._runs(batch)) > 20


def test_phrases_come_in_small_batches_and_add_up(monkeypatch):
    """What a task holds with its words is bounded, and so is each batch that it puts out."""
    import numpy as np
    import pyarrow as pa
    from quaestor.llm import collocations as co

    texts = [f"w{k % 9} x{k % 7} y{k % 5} z" for k in range(400)]
    rows = pa.record_batch({"lang": pa.array(["en", None] * 200), "text": pa.array(texts)})
    everything = [np.full(1 << 10, ~np.uint64(0))] * 3
    want = {}
    for batch in co._count_phrases(iter([rows]), everything):
        for r in batch.to_pylist():
            want[r["lang"], tuple(r["words"])] = want.get((r["lang"], tuple(r["words"])), 0) + r["a"]
    monkeypatch.setattr(co, "PHRASES", 40)
    monkeypatch.setattr(co, "ROWS_OUT", 16)
    got, sizes = {}, []
    for batch in co._count_phrases(iter([rows.slice(k, 50) for k in range(0, 400, 50)]), everything):
        sizes.append(batch.num_rows)
        for r in batch.to_pylist():
            got[r["lang"], tuple(r["words"])] = got.get((r["lang"], tuple(r["words"])), 0) + r["a"]
    assert got == want and max(sizes) <= 16 and got["en", ()] == 800 and got["und", ("z",)] == 200
