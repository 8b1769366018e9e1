"""Removal of lines that an earlier document already has, by pairwise patience alignment."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StructField, StructType

from quaestor.llm.tables import free_name, pin, read_table, with_row_id

ANCHOR_WORDS = 5
CHARS_A_WORD = 4
# Thai and Lao, Burmese, Khmer, kana, Han: three bytes a character.
UNSPACED = r"[\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u9FFF\uF900-\uFAFF]"
BLANKS = " \t\n\x0b\x0c\r"


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence, of pairs sorted by their first number, with growing second numbers."""
    tops: list[int] = []
    piles: list[int] = []
    back: list[int] = []
    for k, (_, b) in enumerate(pairs):
        at = bisect_left(tops, b)
        back.append(piles[at - 1] if at else -1)
        tops[at:at + 1], piles[at:at + 1] = [b], [k]
    chain = []
    k = piles[-1] if piles else -1
    while k >= 0:
        chain.append(pairs[k])
        k = back[k]
    return chain[::-1]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Places of the lines that patience diff aligns, growing in both lists.

    Common heads and tails are taken first; between them the lines that occur
    once in both lists are anchors, and of these the longest chain without
    crossings; the ranges between anchors are treated in the same way. A range
    without such lines aligns the n-th copies of equal lines instead, again
    without crossings.
    """
    found = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            found.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            found.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        na, nb = Counter(a[a0:a1]), Counter(b[b0:b1])
        once = {x for x, n in na.items() if n == 1 and nb.get(x) == 1}
        if once:
            at = {b[k]: k for k in range(b0, b1) if b[k] in once}
            chain = _increasing([(k, at[a[k]]) for k in range(a0, a1) if a[k] in once])
            found += chain
            bounds = [(a0 - 1, b0 - 1), *chain, (a1, b1)]
            todo += [(p + 1, q, r + 1, s) for (p, r), (q, s) in zip(bounds, bounds[1:], strict=False)]
        else:
            nth = {}
            seen: Counter = Counter()
            for k in range(b0, b1):
                if b[k] in na:
                    nth[b[k], seen[b[k]]] = k
                    seen[b[k]] += 1
            seen.clear()
            same = []
            for k in range(a0, a1):
                place = nth.get((a[k], seen[a[k]]))
                seen[a[k]] += 1
                if place is not None:
                    same.append((k, place))
            found += _increasing(same)
    return sorted(found)


def common_blocks(earlier: list[int], later: list[int], words: list[int]) -> list[tuple[int, int]]:
    """Runs (first, last) of ``later`` that are aligned line by line with ``earlier`` and have five or more words.

    What an alignment leaves is aligned again, so blocks that stand in another
    order or more often than in ``earlier`` go as well; from time to time
    ``earlier`` is taken twice as often, so the number of alignments follows
    the logarithm of the number of copies. If an alignment brings short runs
    only, their lines take no part in the next; ends when no line is left.
    """
    blocks: list[tuple[int, int]] = []
    left = list(range(len(later)))
    known = set(earlier)
    times = 1
    while left := [k for k in left if later[k] in known]:
        runs: list[list[int]] = []
        before = None
        for a, b in patience(earlier * times, [later[k] for k in left]):
            at = left[b]
            if before == (a - 1, at - 1) and a % len(earlier):
                runs[-1][1] = at
            else:
                runs.append([at, at])
            before = (a, at)
        long = [(x, y) for x, y in runs if sum(words[x:y + 1]) >= ANCHOR_WORDS]
        blocks += long
        gone = {k for x, y in long or runs for k in range(x, y + 1)}
        left = [k for k in left if k not in gone]
        times = min(2 * times, len(left))
    return sorted(blocks)


BLOCKS = ArrayType(StructType([StructField("first", IntegerType()), StructField("last", IntegerType())]))


def _aligned(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
    kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
    for earlier, later, words in batches:
        yield pa.array([[{"first": x, "last": y} for x, y in common_blocks(a.as_py(), b.as_py(), c.as_py())]
                        for a, b, c in zip(earlier, later, words, strict=True)], kind)


def _kept(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for totals, spans in batches:
        out = []
        for n, found in zip(totals.to_pylist(), spans.to_pylist(), strict=True):
            keep = [True] * n
            for s in found:
                keep[s["first"]:s["last"] + 1] = [False] * (s["last"] + 1 - s["first"])
            out.append(keep)
        yield pa.array(out, pa.list_(pa.bool_()))


def _window(i: Column) -> Column:
    """Hashes of the lines from place ``i`` on that have five words together; null if the text ends before."""
    words: Column = F.lit(0)
    found = []
    for k in range(ANCHOR_WORDS):
        words = words + F.coalesce(F.get("lines", i + k)["words"], F.lit(0))
        found.append(F.when((words >= ANCHOR_WORDS) & (i + k < F.size("lines")), F.slice("lines", i + 1, F.lit(k + 1))))
    return F.coalesce(*found)


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def repeated_lines(rows: DataFrame) -> DataFrame:
    """``row_id, keep, n_partners`` for the rows of ``rows(row_id, doc_id, text)`` that lose lines.

    ``keep`` has a flag per line. Lines are compared without white space at
    their ends; blank ones are no lines of the alignment. A line and as many
    of those behind it as it takes for five words are an anchor (of scripts
    without spaces, four characters count as a word): it leads each document
    that holds it to the first holder in the order of doc_id, so a passage in a
    third of all documents costs one pair per document, and no frequency has to
    be cut off. Those pairs are aligned by patience diff, in which the lines
    that are rare - once in either document - steer. Aligned runs of five words
    go from the later document, with the blank lines inside them.
    """
    trimmed = F.transform(_lines(F.coalesce("text", F.lit(""))), lambda x: F.trim(x, F.lit(BLANKS)))
    parts = F.transform(trimmed, lambda x, i: F.struct(
        i.alias("pos"), (F.regexp_count(x, F.lit(r"[^\x20\x09-\x0D]+"))
                         + F.when(F.octet_length(x) - F.length(x) >= 2 * CHARS_A_WORD, (F.regexp_count(x, F.lit(UNSPACED)) / CHARS_A_WORD).cast("int"))
                         .otherwise(0)).alias("words"),
        F.xxhash64(x).alias("h1"), F.xxhash64(F.lit(1), x).alias("h2")))
    seqs = rows.select("row_id", "doc_id", parts.alias("all")).select(
        "row_id", "doc_id", F.size("all").alias("n"), F.filter("all", lambda x: x["words"] > 0).alias("lines"))
    seqs = pin(seqs.where(F.size("lines") > 0), "lines-sequences")
    anchor = F.filter(F.transform(F.transform("lines", lambda _, i: F.struct(_window(i).alias("w"), i.alias("at"))), lambda x: F.struct(
        F.when(x["w"].isNotNull(), F.xxhash64(F.transform(x["w"], lambda y: y["h1"]))).alias("h1"),
        F.when(x["w"].isNotNull(), F.xxhash64(F.transform(x["w"], lambda y: y["h2"]))).alias("h2"), x["at"].alias("at"))),
        lambda x: x["h1"].isNotNull())
    held = seqs.select("row_id", "doc_id", F.size("lines").alias("length"), F.explode(anchor).alias("x")).select(
        "row_id", "doc_id", "length", "x.h1", "x.h2", "x.at")
    held = held.groupBy("h1", "h2", "row_id", "doc_id", "length").agg(F.min("at").alias("at"))
    held = pin(held, "lines-held")
    first = held.groupBy("h1", "h2").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_id", "at")).alias("f"), F.count(F.lit(1)).alias("holders"))
    first = pin(first.where("holders > 1").select("h1", "h2", F.col("f.row_id").alias("earlier"), F.col("f.at").alias("there")),
                "lines-first")
    pairs = held.join(first, ["h1", "h2"]).where(F.col("row_id") != F.col("earlier"))
    # An aligned run with an anchor reaches at most as far from it as the later document is long.
    pairs = pin(pairs.groupBy("row_id", "earlier").agg(
        F.greatest(F.min("there") - F.first("length"), F.lit(0)).alias("low"),
        (F.max("there") + F.first("length")).alias("high")), "lines-pairs")
    hashes = F.transform("lines", lambda x: x["h1"])
    part = F.slice("source", F.col("low") + 1, F.col("high") - F.col("low") + 1).alias("source")
    with_first = pairs.join(seqs.select(F.col("row_id").alias("earlier"), hashes.alias("source")), "earlier").select("row_id", part)
    both = with_first.join(seqs.select("row_id", "n", hashes.alias("own"), F.transform("lines", lambda x: x["words"]).alias("words"),
                                       F.transform("lines", lambda x: x["pos"]).alias("places")), "row_id")
    blocks = arrow_udf(_aligned, BLOCKS)("source", "own", "words")
    spans = F.transform("blocks", lambda b: F.struct(F.get("places", b["first"]).alias("first"), F.get("places", b["last"]).alias("last")))
    found = both.withColumn("blocks", blocks).where(F.size("blocks") > 0).select("row_id", "n", spans.alias("spans"))
    found = found.groupBy("row_id", "n").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.count(F.lit(1)).alias("n_partners"))
    return pin(found.select("row_id", arrow_udf(_kept, ArrayType(BooleanType()))("n", "spans").alias("keep"), "n_partners"), "lines-keep")


def without_repeated_lines(rows: DataFrame, row_id: str) -> DataFrame:
    """``rows`` with shortened texts and the columns ``n_lines, n_removed, n_partners`` as a struct ``line_dedup``.

    A null text stays null and has no lines. Repeated rows and repeated ids
    are documents of their own, in the order of ``row_id``; rows without id
    come last.
    """
    found = repeated_lines(rows.select(F.col(row_id).alias("row_id"), "doc_id", "text"))
    # The same join at every size: broadcasting a small table of findings would only hide that the texts move once.
    info = free_name(rows, "line_dedup")
    joined = rows.alias("r").join(found.hint("merge").alias("f"), F.col(f"r.{row_id}") == F.col("f.row_id"), "left")
    lines = _lines(F.col("r.text"))
    left = F.array_join(F.filter(lines, lambda _, i: F.get(F.col("f.keep"), i)), "\n")
    text = F.when(F.col("f.keep").isNull(), F.col("r.text")).otherwise(left)
    removed = F.size(F.filter("f.keep", lambda k: ~k))
    columns = [text.alias(c) if c.lower() == "text" else F.col(f"r.`{c}`") for c in rows.columns]
    return joined.select(*columns, F.struct(
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        F.when(F.col("f.keep").isNull(), 0).otherwise(removed).cast("long").alias("n_removed"),
        F.coalesce("f.n_partners", F.lit(0)).cast("long").alias("n_partners")).alias(info))


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with shortened texts, without the documents of which nothing but blank lines is left."""
    rows, row_id = with_row_id(docs, "lines-rows")
    done = without_repeated_lines(rows, row_id)
    info = done.columns[-1]
    used_up = (F.col(f"{info}.n_removed") > 0) & (F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]")) == 0)
    return done.where(~F.coalesce(used_up, F.lit(False))).select(*[F.col(f"`{c}`") for c in docs.columns])


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, row_id = with_row_id(read_table(spark, sf_dir, "documents"), "lines-rows")
    done = without_repeated_lines(rows.select(row_id, "doc_id", "text"), row_id)
    return done.select("doc_id", "line_dedup.*", F.length("text").cast("long").alias("n_chars"),
                       F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


QUERIES = {"op3_line_dedup": op3_line_dedup}
ORACLE: dict[str, str] = {}
