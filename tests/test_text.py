"""Fixed vectors and plain re-expressions of the text functions."""

from __future__ import annotations

import random
import re
import string
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from quaestor.catalog.texts import clean_sql
from quaestor.functions import edgar
from quaestor.functions import scores as sc
from quaestor.functions import text as tx
from quaestor.operators import chunks as ch
from quaestor.operators import scoring as ev


def run(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["r"] for r in df.select("i", fn(F.col("v")).alias("r")).orderBy("i").collect()]


def test_normalize_text(spark):
    got = run(spark, ["The U.S.A. is a $130.5 billion market, an 8% rise.", "l'a été", "the a an", "NVIDIA's",
                      "a b the  c", None], tx.normalize_text)
    assert got == ["us is 1305 billion market 8 rise", "l été", "", "nvidias", "b c", "nan"]


def test_extract_numbers(spark):
    got = run(spark, ["up 114.2%, from $60.9 billion to $130.5 billion.", "FY2025 1.2.3 -5 2024. 1,234,567", "1, 2", "none", None],
              tx.extract_numbers)
    assert got == [[114.2, 60.9, 130.5], [2025.0, 1.2, 3.0, 5.0, 2024.0, 1234567.0], [1.0, 2.0], [], []]


PAIRS = [("$130.5 billion", "Revenue was $130.5 billion.", 0.666667, 1.0), ("", "the", 1.0, 1.0), ("", "x", 0.0, 1.0),
         (None, None, 1.0, 1.0), ("a b b c", "b b b", 0.666667, 1.0), ("about 102", "100", 0.0, 1.0),
         ("102.1", "100", 0.0, 0.0), ("5", "no numbers", 0.0, 1.0), ("0", "0", 1.0, 1.0), ("1", "0", 0.0, 0.0),
         ("100 only", "100 and 98 and 50", 0.285714, 0.333333), ("$130,497 million", "$130.5 billion", 0.0, 0.0)]


def test_scores(spark):
    df = spark.createDataFrame([(i, p, g, "comparison") for i, (p, g, _, _) in enumerate(PAIRS)],
                               "i int, predicted_answer string, ground_truth_answer string, question_type string")
    rows = ev.score_pairs(df).orderBy("i").collect()
    for row, (_, _, f1, num) in zip(rows, PAIRS):
        assert row["token_f1"] == pytest.approx(f1, abs=1e-6), row
        assert row["numeric_match"] == pytest.approx(num, abs=1e-6), row
        if row["exact_match"] == 1.0:
            assert row["token_f1"] == 1.0


def test_token_f1_is_symmetric_and_counts_copies(spark):
    rnd = random.Random(3)
    texts = [" ".join(rnd.choice("b c d e f".split()) for _ in range(rnd.randrange(0, 9))) for _ in range(60)]
    data = [(i, texts[i], texts[(i * 7 + 3) % 60]) for i in range(60)]
    df = spark.createDataFrame(data, "i int, p string, g string")
    pt, gt = tx.normalized_tokens(F.col("p")), tx.normalized_tokens(F.col("g"))
    for row in df.select("p", "g", sc.token_f1(pt, gt).alias("x"), sc.token_f1(gt, pt).alias("y")).collect():
        p, g = row["p"].split(), row["g"].split()
        common = sum((Counter(p) & Counter(g)).values())
        want = float(p == g) if not p or not g else (2 * common / (len(p) + len(g)))
        assert row["x"] == pytest.approx(want) and row["y"] == pytest.approx(want)


def test_overlap_confidence_rounds_like_python(spark):
    def plain(answer, passage):
        if answer == "" or passage == "":
            return 0.8
        words = set(re.findall(r"\w+", str(answer if answer is not None else "nan").lower()))
        other = set(re.findall(r"\w+", str(passage if passage is not None else "nan").lower()))
        return round(0.75 + 0.25 * (len(words & other) / len(words)), 2) if words else 0.8

    cases = [("total is 5", "the total is 5 today"), ("alpha beta", "alpha gamma"), ("", "x"), ("!!!", "x"), (None, "x"),
             ("a b c d e f g h i j", "a b c")]
    cases += [(" ".join(f"w{i}" for i in range(n)), " ".join(f"w{i}" for i in range(k)) or "z")
              for n in (10, 20, 25, 50) for k in range(n + 1)]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, a string, p string")
    rows = df.select("i", sc.overlap_confidence(F.col("a"), F.col("p")).alias("r")).orderBy("i").collect()
    assert [r["r"] for r in rows] == [plain(*c) for c in cases]


def test_fake_flags(spark):
    assert run(spark, [None, "", "consider all facts", "next step", "year-on-year", "5 Times"], tx.is_fake_calculation) \
        == [True, True, True, False, False, False]
    assert run(spark, [None, "One sentence only.", "First one here. Second one here.", "It was $40.4 billion in total."],
               tx.is_fake_multi_step) == [True, True, False, False]


def test_clean_text(spark):
    """Random mixtures of whitespace, numbers and labels, compared with the same steps in DuckDB."""
    rnd = random.Random(5)
    bits = ["\n", "\n", " ", "\t", "\r", "\xa0", "\u2003", "\x0b", "\x1c", "7", "12", "x", "Table of Contents", "TABLE OF CONTENTS", "word."]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randrange(25))) for _ in range(800)]
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INTEGER, v VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(texts)))
    want = [r[0] for r in con.execute(f"SELECT {clean_sql('v')} FROM t ORDER BY i").fetchall()]
    assert run(spark, texts, tx.clean_text) == want
    assert run(spark, ["A\n \n\n\nB", "x\n 12 \ny", "p\n1\n2\nq", ""], tx.clean_text) == ["A\n\nB", "x\ny", "p\n2\nq", ""]


def test_small_functions(spark):
    assert run(spark, ["320193", "0000320193", "0", "12345678901"], edgar.pad_cik) \
        == ["0000320193", "0000320193", "0000000000", "12345678901"]
    assert run(spark, ["x" * 6004, "x" * 6003, "x" * 3204, "x" * 3203], ch.question_count) == [8, 6, 6, 5]
    assert run(spark, ["multi_step_reasoning"], tx.title_label) == ["Multi Step Reasoning"]
    assert run(spark, [12.34, 4.9, 100.0], tx.percent_bar, "double") == ["██", "", "█" * 20]
    assert run(spark, [0, 1, 2], tx.backoff_seconds, "int") == [10, 20, 40]
    assert run(spark, ["HTTP 429", "rate_limit", "bad"], lambda c: tx.is_retryable(c, "gemini")) == [True, False, False]
    assert run(spark, ["x" * 11], tx.estimate_tokens) == [2]
    assert len(string.punctuation) == 32
