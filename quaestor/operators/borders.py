"""Sentence borders learned from the texts themselves.

A full stop may end a sentence or belong to an abbreviation, an initial or a
number. Three log-likelihood ratios over counts of the whole corpus tell them
apart (after Kiss and Strunk, Unsupervised Multilingual Sentence Boundary
Detection, 2006):

- *abbreviations*: types that nearly always carry a full stop, the shorter and
  the more inner full stops the likelier,
- *collocations*: two types around a full stop that stand together far more
  often than by chance,
- *starters*: types that stand behind a sentence's end far more often than by
  chance.

Training is one pass over the texts into a table of counts, and joins of
tables with a row per type. Texts are then cut inside their rows, with the
learned types that can decide anything as constant sets; a model beyond
``IN_ROW`` types is joined to the places in question instead.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from quaestor.functions.binding import bind
from quaestor.functions.text import SPACE
from quaestor.session import pin

# Marks that open or close around a word, and the shape of a number.
OPENERS = "\"'(\\[{“‘«"
CLOSERS = "\"')\\]}”’»"
TAIL = CLOSERS + ",;:"
NUMBER = r"^[-+$€£]?[0-9][0-9.,/:-]*%?$"
NUMBER_TYPE = "#"

# Thresholds of the method.
ABBREVIATION, COLLOCATION, STARTER = 0.3, 7.88, 30.0
SURE = 0.99  # share of full stops behind an abbreviation

# Where a gap begins; looks back from white space only.
GAP = rf"(?=[{SPACE}])(?<=[.!?][{CLOSERS}]{{0,3}})"
SPACES = "".join(c for c in map(chr, range(0x3001)) if re.match(f"[{SPACE}]", c))
BATCH_ROWS = 2048
IN_ROW = 5000
SEPARATOR = "\x01"


@dataclass(frozen=True)
class Borders:
    """Learned tables; ``decisive`` has the types that open a sentence behind an abbreviation, initial or number."""
    abbreviations: DataFrame  # type, n, n_stops, score
    collocations: DataFrame   # first, second, n, score
    starters: DataFrame       # type, n, score
    decisive: DataFrame       # type


def _core(token: Column) -> Column:
    """A token without what opens and closes around it."""
    return F.regexp_replace(F.regexp_replace(token, f"^[{OPENERS}]+", ""), f"[{TAIL}]+$", "")


def _word(core: Column) -> Column:
    """A core without its end marks."""
    return F.regexp_replace(core, r"[.!?]+$", "")


def _shape_of(core: Column, word: Column) -> Column:
    """Type, full stop, any end mark, and case (1 upper, -1 lower, 0 none) of the first letter."""
    first = F.substring(word, 1, 1)
    return F.struct(
        F.when(word.rlike(NUMBER), NUMBER_TYPE).otherwise(F.lower(word)).alias("type"),
        core.endswith(".").alias("stop"), core.rlike(r"[.!?]$").alias("mark"),
        (F.when(first != F.lower(first), 1).when(first != F.upper(first), -1).otherwise(0)).alias("case"))


def _shape(token: Column) -> Column:
    """The shape of a token inside a row; see :func:`_with_shapes` for columns."""
    return bind(_core(token), lambda core: bind(_word(core), lambda word: _shape_of(core, word)))


def _with_shapes(df: DataFrame, *tokens: str) -> DataFrame:
    """``df`` with ``core_`` and ``shape_`` of columns of tokens; each step is a column, so it is computed once and as compiled code."""
    df = df.withColumns({f"core_{t}": _core(F.col(t)) for t in tokens}).withColumns({f"_word_{t}": _word(F.col(f"core_{t}")) for t in tokens})
    return df.withColumns({f"shape_{t}": _shape_of(F.col(f"core_{t}"), F.col(f"_word_{t}")) for t in tokens}).drop(*[f"_word_{t}" for t in tokens])


def _written_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``before, opens, after, n`` of the tokens of texts: ``before`` is the token ahead, if it ends with a mark."""
    mark = f"[.!?][{TAIL}]*$"
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_ROWS):
            plain = pc.replace_substring_regex(pc.fill_null(batch.column(0).slice(at, BATCH_ROWS), ""), f"[{SPACES}]+", " ")
            lists = pc.split_pattern(plain, " ")
            text, token = pc.list_parent_indices(lists), pc.list_flatten(lists)
            kept = pc.not_equal(token, "")
            text, coded = text.filter(kept).to_numpy(), token.filter(kept).dictionary_encode()
            if not len(text):
                continue
            words, after = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
            marked = pc.match_substring_regex(words, mark).to_numpy(zero_copy_only=False)
            before = np.concatenate(([-1], np.where(text[1:] == text[:-1], after[:-1], -1)))  # -1: none, a text's start
            known = (before >= 0) & marked[before]
            opens = known | (before < 0)
            keys, n = np.unique((np.where(known, before, -1) * 2 + opens) * len(words) + after, return_counts=True)
            left, after = np.divmod(keys, len(words))
            left, opens = np.divmod(left, 2)
            yield pa.RecordBatch.from_arrays(
                [words.take(pa.array(left, mask=left < 0)), pa.array(opens == 1), words.take(pa.array(after)), pa.array(n)], ["before", "opens", "after", "n"])


def token_counts(texts: DataFrame, text: str = "text") -> DataFrame:
    """``first, type, n, n_stops, n_lower, n_upper, n_inner``, pinned.

    ``first`` is the type before, where that carries a full stop, else null.
    ``n_inner`` counts capital forms that don't open a sentence. Tokens are
    counted as they are written first, with the one before only where that has
    an end mark; so shapes are found once per different token.
    """
    written = (texts.select(text).mapInArrow(_written_counts, "before string, opens boolean, after string, n long")
               .groupBy("before", "opens", "after").agg(F.sum("n").alias("n")))
    shaped = _with_shapes(written, "before", "after").select(
        F.when(F.col("shape_before.stop"), F.col("shape_before.type")).alias("first"), "shape_after.*", "opens", "n")

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0))
    upper = F.col("case") == 1
    return pin(shaped.where("type != ''").groupBy("first", "type").agg(
        F.sum("n").alias("n"), total(F.col("stop")).alias("n_stops"), total(F.col("case") == -1).alias("n_lower"),
        total(upper).alias("n_upper"), total(upper & ~F.col("opens")).alias("n_inner")), "border-counts")


def _log_binomial(k: Column, n: Column, p: Column) -> Column:
    """Log-likelihood of ``k`` in ``n``; terms without a count are zero."""
    return (F.when(k > 0, k * F.ln(p)).otherwise(F.lit(0.0))
            + F.when(n - k > 0, (n - k) * F.ln(F.lit(1.0) - p)).otherwise(F.lit(0.0)))


def association(both: Column, first: Column, second: Column, total: Column) -> Column:
    """Log-likelihood ratio of two events that meet ``both`` times; zero if they meet no more than by chance."""
    p, p1 = second / total, both / first
    p2 = (second - both) / (total - first)
    ratio = 2.0 * (_log_binomial(both, first, p1) + _log_binomial(second - both, total - first, p2)
                   - _log_binomial(both, first, p) - _log_binomial(second - both, total - first, p))
    return F.when((p1 > p) & (total > first) & (second < total), ratio).otherwise(F.lit(0.0))


def abbreviation_score(n: Column, n_stops: Column, share: Column, type_: Column) -> Column:
    """How much better ``SURE`` explains the full stops behind a type than the corpus-wide share does, by its length."""
    plain = n - n_stops
    ratio = -2.0 * (n_stops * F.ln(share) + plain * F.ln(F.lit(1.0) - share) - n_stops * F.ln(F.lit(SURE)) - plain * F.ln(F.lit(1.0 - SURE)))
    inner = F.length(type_) - F.length(F.replace(type_, F.lit("."), F.lit("")))
    size = F.greatest(F.length(type_) - inner, F.lit(1))
    return ratio * F.exp(-size.cast("double")) * (inner + 1) * F.pow(size.cast("double"), -plain.cast("double"))


def train(texts: DataFrame, text: str = "text") -> Borders:
    """Learn borders from all texts of a table."""
    counts = token_counts(texts, text)
    types = pin(counts.groupBy("type").agg(*[F.sum(c).alias(c) for c in ("n", "n_stops", "n_lower", "n_inner")]), "border-types")
    total = F.broadcast(types.agg(F.sum("n").alias("_n"), F.sum("n_stops").alias("_stops")))  # one row
    share = F.col("_stops") / F.col("_n")
    scored = (types.where((F.col("n_stops") > 0) & F.col("type").rlike(r"\p{L}")).crossJoin(total).where(F.col("_stops") < F.col("_n"))
              .withColumn("score", abbreviation_score(F.col("n"), F.col("n_stops"), share, F.col("type"))))
    abbreviations = pin(scored.where(F.col("score") >= ABBREVIATION).select("type", "n", "n_stops", "score"), "border-abbreviations")

    pairs = counts.where(F.col("first").isNotNull())
    ends = pairs.join(abbreviations.select(F.col("type").alias("first")), "first", "left_anti")
    opened = ends.groupBy("type").agg(F.sum("n").alias("_both"))
    breaks = F.broadcast(opened.agg(F.sum("_both").alias("_breaks")))  # one row
    starters = pin(opened.join(types.select("type", "n"), "type").crossJoin(total).crossJoin(breaks)
                   .withColumn("score", association(F.col("_both"), F.col("_breaks"), F.col("n"), F.col("_n")))
                   .where(F.col("score") >= STARTER).select("type", F.col("_both").alias("n"), "score"), "border-starters")

    firsts = types.select(F.col("type").alias("first"), F.col("n").alias("_n1"))
    seconds = types.select("type", F.col("n").alias("_n2"))
    met = pairs.where("n > 1 AND first != ''").join(starters, "type", "left_anti").join(firsts, "first").join(seconds, "type")
    collocations = pin(met.crossJoin(total).withColumn("score", association(F.col("n"), F.col("_n1"), F.col("_n2"), F.col("_n")))
                       .where(F.col("score") >= COLLOCATION)
                       .select("first", F.col("type").alias("second"), "n", "score"), "border-collocations")

    # A capital behind an abbreviation or initial opens a sentence if the type is otherwise written small.
    doubtful = (F.col("first") == NUMBER_TYPE) | (F.length("first") == 1)
    behind = (pairs.where("n_upper > 0").where(doubtful).select("type")
              .unionByName(pairs.where("n_upper > 0").join(abbreviations.select(F.col("type").alias("first")), "first", "left_semi").select("type")))
    decisive = pin(types.where("n_lower > 0 AND n_inner = 0").select("type").join(behind.distinct(), "type", "left_semi"), "border-decisive")
    return Borders(abbreviations, collocations, starters, decisive)


def _sides(pieces: Column) -> Column:
    """The ends of the pieces on both sides of each gap, from and up to a plain space; see :func:`_tokens`."""
    def side(i: Column) -> Column:
        return F.struct(i.cast("int").alias("i"), F.substring_index(F.get(pieces, i - 1), " ", -1).alias("before"),
                        F.substring_index(F.ltrim(F.get(pieces, i), F.lit(SPACES)), " ", 1).alias("after"))
    none = F.array().cast("array<struct<i:int,before:string,after:string>>")
    return F.when(F.size(pieces) > 1, F.transform(F.sequence(F.lit(1), F.size(pieces) - 1), side)).otherwise(none)


def _tokens(before: Column, after: Column) -> tuple[Column, Column]:
    """The last token of the end of a piece and the first of the next piece's beginning."""
    return F.regexp_replace(before, f"(?s)^.*[{SPACE}]", ""), F.regexp_replace(after, f"(?s)[{SPACE}].*$", "")


def _dots(core: Column) -> Column:
    return F.regexp_extract(core, r"\.\.+$", 0)


def _places(pieces: Column) -> Column:
    """The shapes on both sides of each gap between pieces."""
    def place(side: Column) -> Column:
        before, after = _tokens(side["before"], side["after"])
        return bind(before, lambda b: F.struct(side["i"].alias("i"), _shape(b).alias("before"), _dots(_core(b)).alias("dots"), _shape(after).alias("after")))
    return F.transform(_sides(pieces), place)


def _ends(place: Column, abbreviation: Column, collocation: Column, starter: Column, decisive: Column) -> Column:
    """Whether a sentence ends at a place."""
    before, after = place["before"], place["after"]
    upper, lower = after["case"] == 1, after["case"] == -1
    doubtful = (before["type"] == NUMBER_TYPE) | (F.length(before["type"]) == 1)
    return (F.when(~before["stop"], F.lit(True))
            .when(place["dots"] != "", ~lower)
            .when(collocation, F.lit(False))
            .when(abbreviation, upper & (decisive | starter))
            .when(doubtful & lower, F.lit(False))
            .when(doubtful & (before["type"] != NUMBER_TYPE) & upper, decisive | starter)
            .otherwise(F.lit(True)))


def _cut(pieces: Column, ends: Column, with_gaps: bool) -> Column:
    """Sentences and, if asked for, the white space between them, from the pieces (with the gap ahead) and the numbers of
    those that open a sentence."""
    def sentence(s: Column, end: Column) -> Column:
        whole = F.when(end - s == 1, F.get(pieces, s)).otherwise(F.array_join(F.slice(pieces, s + 1, end - s), ""))
        return F.when(s == 0, whole).otherwise(F.ltrim(whole, F.lit(SPACES)))

    def gap(s: Column) -> Column:
        return bind(F.get(pieces, s), lambda p: F.substring(p, F.lit(1), F.length(p) - F.length(F.ltrim(p, F.lit(SPACES)))))
    cut = bind(F.concat(F.array(F.lit(0)), ends), lambda starts: F.transform(
        starts, lambda s, k: sentence(s, F.coalesce(F.get(starts, k + 1), F.size(pieces))))).alias("sentences")
    return F.struct(cut, F.transform(ends, gap).alias("gaps")) if with_gaps else F.struct(cut)


def _sets(model: Borders, limit: int) -> list[list[str]] | None:
    """The learned types, or None if one of the tables has more than ``limit`` rows."""
    tables = (model.abbreviations.select("type"), model.collocations.select(F.concat_ws(SEPARATOR, "first", "second").alias("type")),
              model.starters.select("type"), model.decisive.select("type"))
    found = [[r["type"] for r in t.limit(limit + 1).collect()] for t in tables]
    return None if any(len(f) > limit for f in found) else found


def with_sentences(texts: DataFrame, model: Borders, text: str = "text", sentences: str = "sentences", gaps: str | None = "gaps",
                   in_row: int = IN_ROW) -> DataFrame:
    """``texts`` with arrays of their sentences and of the white space between them.

    A null text gives nulls. Without a name for ``gaps`` they are left out. ``in_row`` is the size up to which the learned
    tables become constants of the plan.
    """
    pieces = F.split(F.col(text), GAP)
    shown = {sentences: F.col("_cut.sentences")} | ({gaps: F.col("_cut.gaps")} if gaps else {})
    sets = _sets(model, in_row)
    if sets is not None:
        abbreviations, collocations, starters, decisive = sets

        def ends(place: Column) -> Column:
            pair = F.concat_ws(SEPARATOR, place["before"]["type"], place["after"]["type"])
            return _ends(place, place["before"]["type"].isin(abbreviations), pair.isin(collocations),
                         place["after"]["type"].isin(starters), place["after"]["type"].isin(decisive))

        def whole(p: Column) -> Column:
            return bind(F.transform(F.filter(_places(p), ends), lambda x: x["i"]), lambda e: _cut(p, e, bool(gaps)))
        return texts.withColumn("_cut", F.when(F.col(text).isNotNull(), bind(pieces, whole))).withColumns(shown).drop("_cut")
    kept = pin(texts.withColumn("_row", F.monotonically_increasing_id()), "border-texts")
    before, after = _tokens(F.col("before"), F.col("after"))
    sides = kept.select("_row", F.inline(bind(pieces, _sides))).withColumns({"before": before, "after": after})
    doubts = _with_shapes(sides, "before", "after").select("_row", F.struct(
        "i", F.col("shape_before").alias("before"), _dots(F.col("core_before")).alias("dots"), F.col("shape_after").alias("after")).alias("place")
    ).withColumns({"first": F.col("place.before.type"), "second": F.col("place.after.type")})
    yes = F.lit(True)
    known = (doubts.join(model.abbreviations.select(F.col("type").alias("first"), yes.alias("_a")), "first", "left")
             .join(model.collocations.select("first", "second", yes.alias("_c")), ["first", "second"], "left")
             .join(model.starters.select(F.col("type").alias("second"), yes.alias("_s")), "second", "left")
             .join(model.decisive.select(F.col("type").alias("second"), yes.alias("_d")), "second", "left")
             .fillna(False, ["_a", "_c", "_s", "_d"]))
    ended = (known.where(_ends(F.col("place"), F.col("_a"), F.col("_c"), F.col("_s"), F.col("_d")))
             .groupBy("_row").agg(F.sort_array(F.collect_list("place.i")).alias("_opened")))
    opened = F.coalesce("_opened", F.array().cast("array<int>"))
    cut = kept.join(ended, "_row", "left").withColumn(
        "_cut", F.when(F.col(text).isNotNull(), bind(pieces, lambda p: _cut(p, opened, bool(gaps)))))
    return cut.withColumns(shown).drop("_cut", "_row", "_opened")


def model_rows(model: Borders) -> DataFrame:
    """All learned types as ``kind, first, second, n, score``."""
    def rows(df: DataFrame, kind: str, first: str, second: Column) -> DataFrame:
        return df.select(F.lit(kind).alias("kind"), F.col(first).alias("first"), second.alias("second"), "n", F.round("score", 2).alias("score"))
    none = F.lit("").cast("string")
    return (rows(model.abbreviations, "abbreviation", "type", none).unionByName(rows(model.collocations, "collocation", "first", F.col("second")))
            .unionByName(rows(model.starters, "starter", "type", none)))
