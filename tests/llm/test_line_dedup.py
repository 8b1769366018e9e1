from __future__ import annotations

import random
import re
from collections import Counter

from quaestor.llm.line_dedup import (BLANKS, common_blocks, drop_repeated_lines, op3_line_dedup, patience,
                                     without_repeated_lines)
from quaestor.llm.tables import read_table
from tests.conftest import SF_DIR

A, B, C, D = ("the first long line of words", "another long line of some words", "a third line with many words", "and one more line with words")


UNSPACED = re.compile("[\u3040-\u30ff\u3400-\u9fff\u0e00-\u0e7f]")


def weight(line):
    return len(line.split()) + len(UNSPACED.findall(line)) // 4


def windows(lines):
    """(place, lines) of the shortest runs with five words from each place on."""
    for i in range(len(lines)):
        for j in range(i + 1, len(lines) + 1):
            if sum(map(weight, lines[i:j])) >= 5:
                yield i, tuple(lines[i:j])
                break


def brute(docs):
    """Expected (text, removed) of each (order, text), in order: every document against each first holder's whole text."""
    first, out = {}, {}
    seqs = {}
    for key, text in docs:
        lines = [x.strip(BLANKS) for x in (text or "").split("\n")]
        seqs[key] = [(i, x) for i, x in enumerate(lines) if x]
        own = [x for _, x in seqs[key]]
        partners = {first.setdefault(w, key) for _, w in windows(own)} - {key}
        gone = set()
        for p in partners:
            for a, b in common_blocks([x for _, x in seqs[p]], own, [weight(x) for x in own]):
                gone |= set(range(seqs[key][a][0], seqs[key][b][0] + 1))
        left = None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)
        out[key] = (left, len(gone))
    return out


def test_patience_aligns_without_crossings():
    rnd = random.Random(3)
    for _ in range(300):
        a = [rnd.randrange(8) for _ in range(rnd.randrange(12))]
        b = [rnd.randrange(8) for _ in range(rnd.randrange(12))]
        got = patience(a, b)
        assert all(a[x] == b[y] for x, y in got)
        assert all(p < r and q < s for (p, q), (r, s) in zip(got, got[1:]))
    assert patience([1, 2, 3, 4], [1, 9, 3, 4, 2]) == [(0, 0), (2, 2), (3, 3)]
    assert patience([1, 2], [1, 2]) == [(0, 0), (1, 1)]
    assert patience([], [1]) == []


def test_blocks_need_five_words():
    assert common_blocks([1, 2, 3], [9, 2, 3], [1, 1, 5]) == [(1, 2)]
    assert common_blocks([1, 2, 3], [9, 2, 8], [5, 4, 5]) == []
    assert common_blocks([1, 2, 3], [1, 2, 9], [2, 3, 5]) == [(0, 1)]
    assert common_blocks([2, 0, 1], [1, 2], [5, 5]) == [(0, 0), (1, 1)]
    assert [b for b in common_blocks([7], [7] * 3000, [5] * 3000)] == [(k, k) for k in range(3000)]


def test_random_documents_against_sets(spark):
    """Crossing, repeated and short lines: no long line that an earlier document has stays, and nothing else goes."""
    rnd = random.Random(8)
    pool = [A, B, C, D, "two words", "a short one", "x", "一つの長い日本語の行はこのように空白なしで書かれることが多い"]
    docs = [(k, "\n".join(rnd.choice(["", *pool]) for _ in range(rnd.randrange(9)))) for k in range(120)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.text for r in without_repeated_lines(frame.withColumn("rid", frame.doc_id), "rid").collect()}
    earlier = {""}
    for key, text in docs:
        lines, left = text.split("\n"), got[key].split("\n")
        assert not [x for x in left if weight(x) >= 5 and x in earlier], key
        assert set((Counter(lines) - Counter(left)).keys()) <= earlier
        earlier |= set(lines)


def test_missed_before(spark):
    verse = "\n".join(f"line of verse {k}" for k in range(40))
    kanji = "東京都千代田区の朝は静かに始まり人々は駅へ向かって歩いていくそして電車に乗り仕事場へと急ぐのである今日もまた"
    rows = [(1, f"{B}\nother\n{A}"), (2, f"{A}\n{B}"), (3, f"{A}\n{B}\nend"), (4, f"{A}\n{B}"), (5, verse), (6, f"new\n{verse}"),
            (7, f"{kanji}\n{kanji[::-1]}"), (8, f"own\n{kanji}\n{kanji[::-1]}"), (9, f"{A}\n{A}\nlast")]
    kept = {r.doc_id: r.text for r in drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == {1: rows[0][1], 3: "end", 5: verse, 6: "new", 7: rows[6][1], 8: "own", 9: "last"}


def test_query_against_brute_force(spark):
    docs = sorted((r.doc_id, r.text) for r in read_table(spark, SF_DIR, "documents").collect())
    want = brute(docs)
    rows = read_table(spark, SF_DIR, "documents").withColumnRenamed("n_chars", "line_dedup")
    got = {r.doc_id: (r.text, r["line_dedup_"].n_removed)
           for r in without_repeated_lines(rows.withColumn("rid", rows.doc_id), "rid").collect()}
    assert got == want
    assert sum(n for _, n in want.values()) > 50
    assert op3_line_dedup(spark, SF_DIR).count() == len(docs)


def test_stage_and_odd_rows(spark):
    rows = [(1, f"{A}\n{B}\nshort\n{C}", "x"), (2, f"new\n\n{B}\nshort\n{C}\nend", "x"), (3, f"{A}\n{B}\nshort\n{C}", "x"), (3, D, "x"),
            (3, D, "x"), (None, D, "x"), (4, None, "x"), (5, "", "x"), (6, "short", "x"), (7, "short", None), (8, f"{A}\n{A}", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row_id string")
    kept = drop_repeated_lines(docs)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id if r.doc_id is not None else 99), r.text or "") for r in kept.collect())
    assert got == sorted([(1, rows[0][1]), (2, "new\n\nend"), (3, D), (4, ""), (5, ""), (6, "short"), (7, "short")])
    assert drop_repeated_lines(docs.limit(0)).count() == 0
    assert drop_repeated_lines(docs.select("doc_id", "text").where("doc_id = 4")).collect()[0].text is None
