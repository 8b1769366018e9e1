from __future__ import annotations

import math
import re

import pytest

from quaestor.functions import text as tx
from quaestor.operators import borders as bd
from quaestor.operators import chunks as ch
from quaestor.options import Options

PLAIN = ["The company sold parts", "We may report other results", "Profit went up", "It was a good year", "They left the market", "Sales fell"]
TAUGHT = " ".join(f"{PLAIN[k % 6]} in {2000 + k}. {PLAIN[(k + 1) % 6]} when the {w} came. They came in {k} and left no market." for k, w in enumerate(["report", "results", "profit", "sales", "market"] * 30))
ABBREVIATED = " ".join(f"Acme Inc. sold {k} parts in the U.S. market. See Note No. {k} on page {k}. Mr. Smith and J. Doe left. The end came." for k in range(60))
TEXTS = [(1, TAUGHT), (2, ABBREVIATED), (3, None), (4, ""), (5, "no mark"), (6, "He said \"Stop.\" Then he left! Why? (It ended.) Wait... what. 3.5 percent.")]


@pytest.fixture(scope="module")
def taught(spark):
    frame = spark.createDataFrame(TEXTS, "doc_id long, text string").cache()
    return frame, bd.train(frame)


def split(spark, model, text, **limits):
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = bd.with_sentences(frame, model, **limits).first()
    assert text == row.sentences[0] + "".join(g + s for g, s in zip(row.gaps, row.sentences[1:], strict=True))
    return row.sentences


@pytest.mark.parametrize("in_row", [bd.IN_ROW, 0])
def test_learned_borders(spark, taught, in_row):
    model = taught[1]
    known = {r.type for r in model.abbreviations.collect()}
    assert {"inc", "u.s", "mr"} <= known and not known & {"came", "market", "left", "page"}
    assert ("no", "#") in {(r["first"], r.second) for r in model.collocations.collect()}
    assert split(spark, model, "Acme Inc. sold parts. See No. 5 in the U.S. market. Sales fell.", in_row=in_row) == [
        "Acme Inc. sold parts.", "See No. 5 in the U.S. market.", "Sales fell."]
    assert split(spark, model, "It works for Acme Inc. They left.", in_row=in_row)[-1] in ("They left.", "It works for Acme Inc. They left.")
    assert split(spark, model, "J. Doe left. \"It ended.\" We  may\nstay? Yes! no", in_row=in_row) == ["J. Doe left.", "\"It ended.\"", "We  may\nstay?", "Yes!", "no"]
    assert split(spark, model, "Wait... what. So... It is", in_row=in_row) == ["Wait... what.", "So...", "It is"]


def test_both_ways_agree_and_nulls_stay(taught):
    frame, model = taught
    here = {r.doc_id: (r.sentences, r.gaps) for r in bd.with_sentences(frame, model).collect()}
    there = {r.doc_id: (r.sentences, r.gaps) for r in bd.with_sentences(frame, model, in_row=0).collect()}
    assert here == there and here[3] == (None, None) and here[4] == ([""], []) and here[5] == (["no mark"], [])
    for key, text in TEXTS:
        if text:
            assert "".join(s + g for s, g in zip(here[key][0], [*here[key][1], ""], strict=True)) == text
            plain = re.split(r"(?<=[.!?])\s+", text)
            assert len(here[key][0]) <= len(plain) + 3


def test_nothing_to_learn_means_a_border_at_every_mark(spark):
    frame = spark.createDataFrame([(1, "One two. three! Four? five")], "doc_id long, text string")
    model = bd.train(frame)
    assert bd.model_rows(model).count() == 0
    assert bd.with_sentences(frame, model).first().sentences == ["One two.", "three!", "Four?", "five"]
    assert bd.model_rows(bd.train(frame.limit(0))).count() == 0


def test_scores_follow_their_formulas(spark):
    frame = spark.createDataFrame([(30, 29, "no.x")], "n long, k long, type string")
    share = 0.05
    got = frame.select(bd.abbreviation_score(frame.n, frame.k, bd.F.lit(share), frame.type).alias("s"),
                       bd.association(bd.F.lit(8), bd.F.lit(10), bd.F.lit(20), bd.F.lit(1000)).alias("a"),
                       bd.association(bd.F.lit(0), bd.F.lit(10), bd.F.lit(20), bd.F.lit(1000)).alias("none")).first()
    ratio = -2 * (29 * math.log(share) + math.log(1 - share) - 29 * math.log(0.99) - math.log(0.01))
    assert got.s == pytest.approx(ratio * math.exp(-3) * 2 / 3)

    def ll(k, n, p):
        return k * math.log(p) + (n - k) * math.log(1 - p)
    assert got.a == pytest.approx(2 * (ll(8, 10, .8) + ll(12, 990, 12 / 990) - ll(8, 10, .02) - ll(12, 990, .02)))
    assert got.none == 0


def test_chunks_can_end_at_learned_borders(spark, taught):
    frame, model = taught
    sections = frame.where("doc_id = 2").withColumnsRenamed({"text": "full_text"})
    options = Options(chunk_size_tokens=30, chunk_overlap_tokens=5, min_chunk_tokens=1)
    ends = {c.text[-4:] for c in ch.chunk_sections(sections, options, model).collect()}
    assert "Inc." not in ends and " No." not in ends and " Mr." not in ends
    plain = {c.text[-4:] for c in ch.chunk_sections(sections, options).collect()}
    assert plain & {"Inc.", " No.", " Mr."}
    assert sections.select(tx.split_sentences(sections.full_text)).count() == 1


@pytest.mark.parametrize("in_row", [bd.IN_ROW, 0])
def test_sentences_alone_at_odd_white_space(spark, taught, in_row):
    model = taught[1]
    text = " Acme Inc. sold\nparts.　See\tNo.\u00855 in it.\n\n\"Why?\"  Sales fell! "
    frame = spark.createDataFrame([(1, text), (2, None), (3, " "), (4, "")], "doc_id long, text string")
    both = {r.doc_id: (r.sentences, r.gaps) for r in bd.with_sentences(frame, model, in_row=in_row).collect()}
    assert both[1] == ([" Acme Inc. sold\nparts.", "See\tNo.\u00855 in it.", "\"Why?\"", "Sales fell!", ""], ["　", "\n\n", "  ", " "])
    assert both[2] == (None, None) and both[3] == ([" "], []) and both[4] == ([""], [])
    alone = bd.with_sentences(frame, model, gaps=None, in_row=in_row)
    assert alone.columns == ["doc_id", "text", "sentences"]
    assert {r.doc_id: r.sentences for r in alone.collect()} == {k: s for k, (s, _) in both.items()}


def test_tokens_are_counted_as_written_before_shapes(spark):
    frame = spark.createDataFrame([(" A b. \"C\" (d!) E b. C",), (None,), ("",), ("b. C",)], "text string")
    counts = bd.token_counts(frame)
    got = {(r["first"], r.type): (r.n, r.n_stops, r.n_lower, r.n_upper, r.n_inner) for r in counts.collect()}
    assert got == {(None, "a"): (1, 0, 0, 1, 0), (None, "b"): (3, 3, 3, 0, 0), ("b", "c"): (3, 0, 0, 3, 0), (None, "d"): (1, 0, 1, 0, 0), (None, "e"): (1, 0, 0, 1, 0)}
    written = next(bd._written_counts(frame.repartition(1).toArrow().to_batches()))
    assert sorted(zip(*written.to_pydict().values(), strict=True), key=str) == sorted([
        (None, True, "A", 1), (None, False, "b.", 2), (None, True, "b.", 1), ("b.", True, "\"C\"", 1), (None, False, "(d!)", 1),
        ("(d!)", True, "E", 1), ("b.", True, "C", 2)], key=str)
