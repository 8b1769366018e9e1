"""Removal of near-duplicate questions by TF-IDF cosine similarity.

The result is that of a pass over the questions in order: each one still
present removes the later similar ones of equal or lower difficulty, and
falls to a later similar one of higher difficulty that is still present (but
goes on removing). In terms of sets, with similar pairs i < j:

- *roots* are the questions without an earlier similar root of at least
  their difficulty; all others are removed,
- a root falls as well if a similar later question of higher difficulty has
  no remover ahead of that root.

No pair list of a group is built:

- copies (same text and difficulty) become one node up front,
- a scope of at most ``heads`` rows and ``SCOPE_BYTES`` of text goes to one task,
  which does all of it: terms, weights, and the pass. Only its texts move,
- texts of a larger scope are dealt to parts by their hash and numbered word by word once
  (:mod:`quaestor.operators.wordlists`); vocabulary and weights come from these numbers,
- its nodes are numbered and decided in rounds, range by range, a range in one
  task (:mod:`quaestor.operators.passes`). The roots of a round are compared with all later nodes that
  are still there, in parts; the task that compares the next range decides it as well.
  So a group of near copies is gone as soon as its root has been met,
- a pair meets in memory, inside a task. What is moved is each vector once
  per round and the roots of a round once per part behind them.

Order values of any size work: nodes are numbered within their scope first.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from quaestor.operators import passes, tfidf, wordlists
from quaestor.operators.components import components
from quaestor.operators.ordinals import with_ordinal
from quaestor.options import Options
from quaestor.schemas import DIFFICULTY_RANK
from quaestor.session import pin

NODE = ["scope", "node"]
HEADS = 1 << 13  # rows of a scope that goes to one task, and nodes of the first round of a larger one
LEAST = 1 << 14  # nodes that a task of a later round works on at least, in a scope with so many
BLOCK = 3 << 13  # nodes of a scope that one round decides at most: two blocks and their sketches take about 0.4 GB of a task
ROUNDS = 32      # wanted for a scope of up to ROUNDS * BLOCK nodes
SCOPE_BYTES = 16 << 20  # text of a scope that goes to one task
PART_BYTES = 8 << 20    # text of a part of a larger one
FOLD = 200_000


@dataclass
class Resolution:
    rows: DataFrame        # scope, ord, question, rank: the input
    nodes: DataFrame       # scope, node, ord, text_id, rank, copies: those with a vector; node numbers ord in its scope
    roots: DataFrame       # scope, node
    removals: DataFrame    # scope, i, j, similarity: j removed by root i (its first remover)
    falls: DataFrame       # scope, i, j, similarity: root i falls to j
    texts: DataFrame       # scope, text_id, copies, text_hash


def difficulty_rank(difficulty: Column) -> Column:
    rank = F.lit(0)
    for name, value in DIFFICULTY_RANK.items():
        rank = F.when(difficulty == name, value).otherwise(rank)
    return rank


def _pin(df: DataFrame, label: str) -> DataFrame:
    return pin(df, label)


def _rows(df: DataFrame, order: str, text: str, difficulty: str, scope: str | None) -> DataFrame:
    key = F.coalesce(F.col(scope).cast("string"), F.lit("")) if scope else F.lit("")
    return df.select(key.alias("scope"), F.col(order).alias("ord"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                     difficulty_rank(F.col(difficulty)).alias("rank"))


def distinct_texts(rows: DataFrame) -> DataFrame:
    """One row per text: earliest position, number of copies, and a node per difficulty (at most four).

    The texts move once, by their hash. Taking them apart comes next and is
    costly, so the number of partitions is not left to their small size.
    """
    spark = rows.sparkSession
    partitions = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    hashed = rows.withColumn("text_hash", F.xxhash64("text")).repartition(partitions, "scope", "text_hash")
    nodes = hashed.groupBy("scope", "text_hash", "text", "rank").agg(F.min("ord").alias("node"), F.count(F.lit(1)).alias("copies"))
    return (nodes.groupBy("scope", "text_hash", "text")
            .agg(F.min("node").alias("text_id"), F.sum("copies").alias("copies"),
                 F.collect_list(F.struct("node", "rank", "copies")).alias("nodes")))


def _bounded(candidates: DataFrame, sketches: DataFrame, threshold: float) -> DataFrame:
    """Candidates that the norms of both sides still allow, block by block of the vocabulary.

    All terms that both have behind the end of the shorter prefix (in the
    common order) lie in that text's rest, those before it are summed already.
    In each block of terms the product of the rest's norm and the other text's
    whole norm bounds what is left (Cauchy-Schwarz), and most candidates end
    here, with a few hundred bytes looked up instead of two vectors.
    """
    pairs = candidates
    for side in ("i", "j"):
        pairs = pairs.join(sketches.select("scope", F.col("text_id").alias(f"text_id_{side}"),
                                           *[F.col(c).alias(f"{c}_{side}") for c in ("end", "rest", "full")]), ["scope", f"text_id_{side}"])
    first = F.col("end_i") <= F.col("end_j")
    rest, full = F.when(first, F.col("rest_i")).otherwise(F.col("rest_j")), F.when(first, F.col("full_j")).otherwise(F.col("full_i"))
    left = F.aggregate(F.zip_with(rest, full, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)
    return pairs.where(F.col("_part_sum") + left > threshold - 1e-6).select("scope", "i", "j", "text_id_i", "text_id_j")


def _fold(edges: pd.DataFrame) -> pd.DataFrame:
    """One pass over the linked nodes of a scope in order: root (True) and removed (False) ones."""
    informed = set(edges["i"][edges["i_informed"]]) | set(edges["j"][edges["j_informed"]])
    roots, dead, blocked = [], set(), set()
    linked = edges.sort_values("i", kind="stable")
    targets = dict(list(linked.groupby("i")["j"]))
    for node in sorted(set(edges["i"]) | set(edges["j"])):
        if node in dead:
            continue
        if node in informed and node not in blocked:
            roots.append(node)
            dead.update(targets.get(node, ()))
        else:
            blocked.update(targets.get(node, ()))
    gone = sorted(dead)
    return pd.DataFrame({"scope": edges["scope"].iloc[0], "node": [*roots, *gone], "root": [True] * len(roots) + [False] * len(gone)})


def _informed_ends(edges: DataFrame, informed: DataFrame) -> DataFrame:
    """Edges with flags of the ends that know everything ahead of them."""
    knows = informed.withColumn("_informed", F.lit(True))
    return (edges.join(knows.withColumnsRenamed({"node": "i", "_informed": "i_informed"}), ["scope", "i"], "left")
            .join(knows.withColumnsRenamed({"node": "j", "_informed": "j_informed"}), ["scope", "j"], "left")
            .fillna(False, ["i_informed", "j_informed"]))


def _folded(flagged: DataFrame, label: str) -> DataFrame:
    """``scope, node, root`` of the decided nodes of each part, one pass over its edges."""
    kind = flagged.schema["i"].dataType.simpleString()
    return _pin(flagged.groupBy("scope", "part").applyInPandas(_fold, f"scope string, node {kind}, root boolean"), label)


def _settle(edges: DataFrame, informed: DataFrame, fold: int = FOLD) -> tuple[DataFrame, DataFrame]:
    """Roots and removed nodes that follow from the edges of one round.

    An informed node without an open edge towards it is a root and removes
    its targets; removed nodes release theirs. Edges are decided part by part,
    each in one pass in order, whatever the length of its chains: a scope of
    at most ``fold`` edges is one part, a larger one falls into its connected
    components. Components beyond ``fold`` go on in :func:`_settle_giant`.
    """
    scopes = _pin(edges.groupBy("scope").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > fold).select("scope"), "large")
    kind = edges.schema["i"].dataType
    whole = edges.withColumn("part", F.lit(None).cast(kind))
    giant = None
    if scopes.isEmpty():
        ready = whole
    else:
        wide = edges.join(scopes, "scope", "left_semi")
        placed = _pin(wide.join(components(wide).withColumnRenamed("node", "i"), ["scope", "i"]), "parts")
        heavy = placed.groupBy("scope", "part").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > fold).select("scope", "part")
        giant = placed.join(heavy, ["scope", "part"], "left_semi")
        ready = whole.join(scopes, "scope", "left_anti").unionByName(placed.join(heavy, ["scope", "part"], "left_anti"))
    ends = edges.select("scope", F.explode(F.array("i", "j")).alias("node")).distinct()
    alone = informed.join(ends, NODE, "left_anti")
    decided = _folded(_informed_ends(ready, informed), "folded")
    roots = alone.unionByName(decided.where("root").select(*NODE))
    dead = decided.where("NOT root").select(*NODE)
    if giant is None or giant.isEmpty():
        return roots, dead
    inside = giant.select("scope", F.explode(F.array("i", "j")).alias("node")).distinct()
    more, gone = _settle_giant(giant, informed.join(inside, NODE, "left_semi"), fold)
    return roots.unionByName(more), dead.unionByName(gone)


def _removed_by(edges: DataFrame, roots: DataFrame) -> DataFrame:
    return (edges.join(roots.withColumnRenamed("node", "i"), ["scope", "i"], "left_semi")
            .select("scope", F.col("j").alias("node"), F.lit(False).alias("root")).distinct())


def _settle_giant(edges: DataFrame, informed: DataFrame, fold: int) -> tuple[DataFrame, DataFrame]:
    """The same for components of any size, in rounds of two steps.

    A set-wise step finds all nodes that nothing blocks and what they remove,
    which is what large groups of near copies need. Then the first nodes of
    each component, as many as have about ``fold`` edges towards them, are
    decided in one pass: nothing behind them matters for them. So a round
    takes a long chain forward by ``fold`` links.
    """
    shares = [2.0 ** -k for k in range(63)]
    found = []

    def without(decided: DataFrame, edges: DataFrame) -> DataFrame:
        gone = decided.where("NOT root").select(*NODE)
        return (edges.join(gone.withColumnRenamed("node", "i"), ["scope", "i"], "left_anti")
                .join(gone.withColumnRenamed("node", "j"), ["scope", "j"], "left_anti"))

    while True:
        clear = informed.join(edges.select("scope", F.col("j").alias("node")), NODE, "left_anti").withColumn("root", F.lit(True))
        decided = _pin(clear.unionByName(_removed_by(edges, clear.select(*NODE))), "clear")
        found.append(decided)
        informed = informed.join(decided, NODE, "left_anti")
        edges = _pin(without(decided, edges), "giant-edges")
        if edges.isEmpty():
            found.append(informed.withColumn("root", F.lit(True)))
            break
        sizes = edges.groupBy("scope", "part").agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx("j", shares).alias("_cuts"))
        step = F.greatest(F.lit(0), F.ceil(F.log2(F.col("_n") / max(fold, 1)))).cast("int")
        ahead = edges.join(sizes.select("scope", "part", F.get("_cuts", step).alias("_cut")), ["scope", "part"]).where("j <= _cut")
        counted = ahead.groupBy("scope", "part").agg(F.max("_cut").alias("_cut"), F.count(F.lit(1)).alias("_n"))
        cuts = _pin(counted.where(F.col("_n") <= 2 * fold).select("scope", "part", "_cut"), "giant-cuts")
        first = edges.join(cuts, ["scope", "part"]).where("j <= _cut").drop("_cut")
        folded = _folded(_informed_ends(first, informed), "giant-folded")
        # Targets ahead of the cut are decided or wait for a node that knows too little in this round.
        informed = informed.join(first.select("scope", F.col("j").alias("node")), NODE, "left_anti")
        behind = edges.join(cuts, ["scope", "part"], "left").where("_cut IS NULL OR j > _cut").drop("_cut")
        passed = folded.unionByName(_removed_by(behind, folded.where("root").select(*NODE)))
        found.append(passed)
        informed = informed.join(passed, NODE, "left_anti")
        edges = _pin(without(passed, behind), "giant-edges")
        if cuts.isEmpty() and decided.isEmpty():
            break
    every = reduce(DataFrame.unionByName, found)
    return every.where("root").select(*NODE), every.where("NOT root").select(*NODE)


NODES, TEXTS = 3, 4  # kinds of rows beside those of the pass


def _whole_scopes(threshold: float, max_features: int):
    """All of the work on one scope: its findings, nodes and texts."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("ord")
        ords, ranks = wordlists.whole(table["ord"]), table["rank"].to_numpy()
        texts = wordlists.Texts.of(wordlists.whole(table["digest"]), ranks)
        words = wordlists.Words.of(wordlists.whole(table["plain"]).take(pa.array(texts.first)))
        text, term, tf = wordlists.counted(*words.terms())
        known, corpus_tf, df = wordlists.totals(term, tf, texts.copies[text])
        chosen = wordlists.best(known, corpus_tf, max_features)
        place = np.full(len(known) + 1, -1)
        place[chosen] = np.arange(len(chosen))
        place = place[np.searchsorted(known, term)]
        kept = place >= 0
        idf = np.log((len(ords) + 1) / (df[chosen] + 1)) + 1
        size = np.bincount(text[kept], minlength=len(texts.first))
        heard = np.flatnonzero(size)
        vectors = passes.Block.made(heard, heard, size[heard], place[kept], tf[kept] * idf[place[kept]])
        node = np.flatnonzero(size[texts.node_text])
        first = texts.node_first[node]
        block = vectors.take(np.searchsorted(heard, texts.node_text[node]))
        block.node, block.rank = node, ranks[first]
        out = passes._Rows()
        passes.decide(block, threshold, out)
        found, scope = out.table(key[0].as_py()), key[0].as_py()
        parts = [found, pa.table({
            "scope": pa.array([scope] * len(node), pa.string()), "kind": np.full(len(node), NODES, np.int32), "i": node, "ord": ords.take(pa.array(first)),
            "text_id": ords.take(pa.array(texts.first[texts.node_text[node]])), "rank": ranks[first].astype(np.int32), "copies": texts.node_copies[node]}),
            pa.table({"scope": pa.array([scope] * len(texts.first), pa.string()), "kind": np.full(len(texts.first), TEXTS, np.int32),
                      "text_id": ords.take(pa.array(texts.first)), "copies": texts.copies, "text_hash": wordlists.whole(table["text_hash"]).take(pa.array(texts.first))})]
        schema = pa.schema([*passes.FOUND, ("ord", ords.type), ("text_id", ords.type), ("rank", pa.int32()), ("copies", pa.int64()), ("text_hash", pa.int64())])
        return pa.concat_tables(parts, promote_options="default").select(schema.names).cast(schema)
    return run


def _in_parts(key: tuple, table: pa.Table) -> pa.Table:
    """One row about the texts of a part of a scope: the texts, their nodes, and their words as numbers."""
    table = table.combine_chunks().sort_by("ord")
    ords, ranks = wordlists.whole(table["ord"]), table["rank"].to_numpy()
    texts = wordlists.Texts.of(wordlists.whole(table["digest"]), ranks)
    words = wordlists.Words.of(wordlists.whole(table["plain"]).take(pa.array(texts.first)))
    text, word, tf = wordlists.counted(words.text, words.ids)
    _, corpus_tf, df = wordlists.totals(word, tf, texts.copies[text])
    return pa.table({
        "scope": [key[0].as_py()], "part": pa.array([key[1].as_py()], pa.int64()), "rows": pa.array([len(ords)], pa.int64()),
        **{name: wordlists.lists(value) for name, value in (
            ("text_id", ords.take(pa.array(texts.first))), ("copies", texts.copies), ("text_hash", wordlists.whole(table["text_hash"]).take(pa.array(texts.first))),
            ("size", words.sizes.astype(np.int32)), ("node_ord", ords.take(pa.array(texts.node_first))), ("node_text", texts.node_text.astype(np.int32)),
            ("node_rank", ranks[texts.node_first].astype(np.int32)), ("node_copies", texts.node_copies),
            ("words", words.words), ("corpus_tf", corpus_tf), ("df", df), ("ids", words.ids.astype(np.int32)))}})


def _parts_ddl(kind: str) -> str:
    return (f"scope string, part bigint, rows bigint, text_id array<{kind}>, copies array<bigint>, text_hash array<bigint>, size array<int>, node_ord array<{kind}>, "
            "node_text array<int>, node_rank array<int>, node_copies array<bigint>, words array<string>, corpus_tf array<bigint>, df array<bigint>, ids array<int>")


def _each(batches):
    """Rows of parts one by one: values by column, lists as arrays."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield {name: (batch[name][k].values if pa.types.is_list(batch[name].type) else batch[name][k].as_py()) for name in batch.schema.names}


def _words_of(row: dict) -> wordlists.Words:
    return wordlists.Words(row["words"], row["ids"].to_numpy().astype(np.int64), row["size"].to_numpy().astype(np.int64))


PAIRS_DDL = "scope string, pair bigint, corpus_tf bigint, df bigint"


def _pair_totals(batches):
    """Counts of the pairs of ``frequent`` words in each part; a pair is one number made of the places of its words."""
    for row in _each(batches):
        words, frequent = _words_of(row), row["frequent"]
        number = np.append(pc.fill_null(pc.index_in(words.words, frequent), -1).to_numpy().astype(np.int64), -1)
        text, first, second = words.pairs()
        first, second = number[first], number[second]
        kept = (first >= 0) & (second >= 0)
        text, pair, tf = wordlists.counted(text[kept], first[kept] * len(frequent) + second[kept])
        pair, corpus_tf, df = wordlists.totals(pair, tf, row["copies"].to_numpy()[text])
        for k in range(0, len(pair), 1 << 16):
            own = slice(k, k + (1 << 16))
            yield pa.RecordBatch.from_arrays([pa.array([row["scope"]] * len(pair[own]), pa.string()), *(pa.array(x[own]) for x in (pair, corpus_tf, df))],
                                             ["scope", "pair", "corpus_tf", "df"])


def _vectors_ddl(kind: str) -> str:
    return f"scope string, ord {kind}, text_id {kind}, rank int, copies bigint, terms binary, tfs binary"


def _vectors(batches):
    """Each node of a part with the places and counts of its text's terms, as bytes; nodes without a term are left out."""
    for row in _each(batches):
        words = _words_of(row)
        text, place, tf = wordlists.entries(words, *wordlists.numbers(words, row["vocabulary"]))
        size = np.bincount(text, minlength=len(words.sizes)) if len(words.sizes) else np.zeros(0, np.int64)
        terms = wordlists.packed(place, size, np.uint16 if len(row["vocabulary"]) <= 1 << 16 else np.uint32)
        tfs = wordlists.packed(tf, size, np.uint32)
        of = row["node_text"].to_numpy()
        node = np.flatnonzero(size[of])
        for k in range(0, len(node), 4096):
            own = pa.array(node[k:k + 4096])
            owner = pa.array(of[node[k:k + 4096]])
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["scope"]] * len(own), pa.string()), row["node_ord"].take(own), row["text_id"].take(owner), row["node_rank"].take(own),
                 row["node_copies"].take(own), terms.take(owner), tfs.take(owner)], ["scope", "ord", "text_id", "rank", "copies", "terms", "tfs"])


def _by_scope(parts: DataFrame, lists: DataFrame, words: int, how: str) -> DataFrame:
    """Parts with what holds for their scope: it goes to all tasks unless it has too many words."""
    return parts.join(F.broadcast(lists) if words <= tfidf.BROADCAST_WORDS else lists, "scope", how)


def _vocabulary(parts: DataFrame, max_features: int) -> DataFrame:
    """``scope, term, corpus_tf, df, term_id, place``, pinned."""
    words = tfidf.pin(parts.select("scope", F.inline(F.arrays_zip(F.col("words").alias("term"), "corpus_tf", "df")))
                      .groupBy("scope", "term").agg(F.sum("corpus_tf").alias("corpus_tf"), F.sum("df").alias("df")), "word-stats")
    cuts = tfidf._cuts(words, max_features, full=True)
    often = words.join(F.broadcast(cuts), "scope", "left").where(F.col("_cut").isNull() | (F.col("corpus_tf") >= F.col("_cut")))
    frequent = tfidf.pin(often.groupBy("scope").agg(F.collect_list("term").alias("frequent")), "frequent-words")
    n = frequent.agg(F.coalesce(F.sum(F.size("frequent")), F.lit(0))).first()[0]
    totals = (_by_scope(parts.select("scope", "copies", "size", "words", "ids"), frequent, n, "inner").mapInArrow(_pair_totals, PAIRS_DDL)
              .groupBy("scope", "pair").agg(F.sum("corpus_tf").alias("corpus_tf"), F.sum("df").alias("df")))
    enough = totals.join(F.broadcast(cuts), "scope", "left").where(F.col("_cut").isNull() | (F.col("corpus_tf") >= F.col("_cut"))).drop("_cut")
    names = frequent.select("scope", F.posexplode("frequent").alias("_place", "_word"))
    width = frequent.select("scope", F.size("frequent").cast("long").alias("_width"))
    ends = enough.join(F.broadcast(width), "scope").withColumns({"_first": F.expr("cast(pair div _width as int)"), "_second": F.expr("cast(pair % _width as int)")})
    for end in ("_first", "_second"):
        own = names.withColumnsRenamed({"_place": end, "_word": f"{end}_word"})
        ends = ends.join(F.broadcast(own) if n <= tfidf.BROADCAST_WORDS else own, ["scope", end])
    pairs = ends.select("scope", F.concat("_first_word", F.lit(" "), "_second_word").alias("term"), "corpus_tf", "df")
    return _pin(tfidf.placed(tfidf.most_frequent(words, pairs, cuts, max_features)), "vocabulary")


def _placed(parts: DataFrame, idfs: DataFrame, kind: str) -> DataFrame:
    """``scope, node, ord, text_id, rank, copies, terms, tfs`` of the nodes with a vector, pinned."""
    n = idfs.agg(F.coalesce(F.sum(F.size("vocabulary")), F.lit(0))).first()[0]
    wanted = parts.select("scope", "text_id", "size", "words", "ids", "node_ord", "node_text", "node_rank", "node_copies")
    vectors = _pin(_by_scope(wanted, idfs.select("scope", "vocabulary"), n, "inner").mapInArrow(_vectors, _vectors_ddl(kind)), "vectors")
    numbered = with_ordinal(vectors.select("scope", "ord", "rank"), ["ord", "rank"], ["scope"], "node")
    return _pin(vectors.join(numbered, ["scope", "ord", "rank"]), "placed")


NEXT = -1  # the part that is decided


def _in_blocks(threshold: float):
    """A round's work on one group: what roots (rows of ``told`` with terms) do to the nodes of ``block``, and the pass over those of the next range.

    Rows of ``told`` with nothing but a node are those that are gone.
    """
    def run(key: tuple, told: pa.Table, block: pa.Table) -> pa.Table:
        out = passes._Rows()
        if block.num_rows:
            heard = pc.is_valid(told["terms"])
            gone = told.filter(pc.and_(pc.invert(heard), pc.is_valid(told["node"])))["node"]
            idf = told.filter(pc.is_valid(told["idf"]))["idf"].combine_chunks().flatten().to_numpy()
            own = passes.Block.packed(block.filter(pc.invert(pc.is_in(block["node"], gone.combine_chunks()))), idf)
            left = passes.strike(passes.Block.packed(told.filter(heard), idf), own, threshold, out)
            if key[1].as_py() == NEXT:
                passes.decide(own, threshold, out, left)
        return out.table(key[0].as_py())
    return run


def _pass(placed: DataFrame, idfs: DataFrame, threshold: float, heads: int, fold: int) -> DataFrame:
    """``scope, kind, i, j, similarity`` of all roots, first removers and falls, in rounds over ranges of node numbers.

    In a round the roots of the last range act on the nodes behind it, part
    by part; the next range is a part of its own, all earlier roots have acted
    on it then, and the same task decides it. So each pair of a root and a node that is
    there when its turn comes meets once, and a round puts out at most a few
    rows per node. Ranges grow fourfold up to ``fold`` nodes, or fewer in scopes that have enough of them.
    """
    columns = ["scope", "node", "rank", "terms", "tfs"]
    kinds = {f.name: f.dataType for f in placed.schema} | {"idf": idfs.schema["idf"].dataType}

    def nothing(*names: str) -> list[Column]:
        return [F.lit(None).cast(kinds[c]).alias(c) for c in names]
    lasts = _pin(placed.groupBy("scope").agg(F.max("node").alias("_last")).join(idfs.select("scope", "idf"), "scope"), "scopes")
    last, found = lasts.agg(F.max("_last")).first()[0], []
    if last is None:
        return placed.sparkSession.createDataFrame([], passes.FOUND_DDL)
    width = max(LEAST, min(BLOCK, -(-last // ROUNDS)))
    before, low, size = 0, 0, max(1, heads)
    while low <= last:
        high = low + size
        place = F.when(F.col("node") < high, F.lit(NEXT)).otherwise(F.floor((F.col("node") - high) / width)).cast("int").alias("part")
        behind = placed.where(F.col("node") >= low if found else F.col("node") < high).select(place, *columns)
        parts = F.sequence(F.lit(NEXT), F.when((F.col("_last") < high) | F.lit(not found), F.lit(NEXT)).otherwise(F.floor((F.col("_last") - high) / width).cast("int")))
        heirs = lasts.where(F.col("_last") >= low).select("scope", F.explode(parts).alias("part"), "idf")
        told = heirs.select("part", "scope", *nothing("node", "rank", "terms", "tfs"), "idf")
        if found:
            roots = found[-1].where((F.col("kind") == passes.ROOT) & (F.col("i") >= before) & (F.col("i") < low)).select("scope", F.col("i").alias("node"))
            acting = placed.where((F.col("node") >= before) & (F.col("node") < low)).select(*[F.col(c).alias(c) for c in columns]).join(roots, NODE, "left_semi")
            told = told.unionByName(acting.join(heirs.select("scope", "part"), "scope").select("part", *columns, *nothing("idf")))
            removed = [f.where((F.col("kind") == passes.REMOVED) & (F.col("j") >= low)).select("scope", F.col("j").alias("node")) for f in found]
            told = told.unionByName(reduce(DataFrame.unionByName, removed).select(place, *NODE, *nothing("rank", "terms", "tfs", "idf")))
        found.append(_pin(told.groupBy("scope", "part").cogroup(behind.groupBy("scope", "part")).applyInArrow(_in_blocks(threshold), passes.FOUND_DDL), "decided"))
        before, low, size = low, high, max(size, min(4 * size, fold, width))
    return reduce(DataFrame.unionByName, found)


def resolve(df: DataFrame, order: str = "ord", text: str = "question", difficulty: str = "difficulty_estimate",
            scope: str | None = None, options: Options = Options(), heads: int = HEADS,
            fold: int = BLOCK, all_removals: bool = False) -> Resolution:
    """Decide every question of every scope.

    A scope of at most ``heads`` rows is decided in one task; of a larger one,
    ``heads`` is the number of nodes that the first round decides, ``fold``
    that of a later one at most. The first remover of every removed
    node is found on the way, with or without ``all_removals``.
    """
    threshold, max_features = options.similarity_threshold, options.max_features
    rows = _rows(df, order, text, difficulty, scope)
    kind = rows.schema["ord"].dataType.simpleString()
    sizes = rows.groupBy("scope").agg(F.count(F.lit(1)).alias("_n"), F.sum(F.octet_length("text")).alias("_bytes"))
    large = _pin(sizes.where((F.col("_n") > heads) | (F.col("_bytes") > SCOPE_BYTES))
                 .select("scope", F.greatest(F.lit(1), F.ceil(F.col("_bytes") / PART_BYTES)).alias("_parts")), "large-scopes")
    read = (rows.join(F.broadcast(large), "scope", "left").withColumns({
        "text_hash": F.xxhash64("text"), "digest": F.unhex(F.sha2("text", 256)), "plain": wordlists.plain_words(F.col("text"))}).drop("text"))
    every = _pin(read.where("_parts IS NULL").drop("_parts").groupBy("scope").applyInArrow(
        _whole_scopes(threshold, max_features), f"{passes.FOUND_DDL}, ord {kind}, text_id {kind}, rank int, copies bigint, text_hash bigint"), "decided")
    found = every.where(F.col("kind") < NODES).select(*passes.FOUND.names)
    nodes = every.where(F.col("kind") == NODES).select("scope", F.col("i").alias("node"), "ord", "text_id", "rank", "copies")
    texts = every.where(F.col("kind") == TEXTS).select("scope", "text_id", "copies", "text_hash")
    if not large.isEmpty():
        parts = _pin(read.where("_parts IS NOT NULL").withColumn("part", F.pmod("text_hash", F.col("_parts"))).drop("_parts")
                     .groupBy("scope", "part").applyInArrow(_in_parts, _parts_ddl(kind)), "parts")
        vocab = _vocabulary(parts, max_features)
        counted = parts.groupBy("scope").agg(F.sum("rows").alias("_rows"))
        terms = vocab.join(counted, "scope").select("scope", F.struct("place", "term", tfidf.idf(F.col("_rows"), F.col("df")).alias("idf")).alias("t"))
        idfs = _pin(terms.groupBy("scope").agg(F.sort_array(F.collect_list("t")).alias("t")).select("scope", F.col("t.term").alias("vocabulary"), F.col("t.idf").alias("idf")), "idfs")
        placed = _placed(parts, idfs, kind)
        found = found.unionByName(_pass(placed, idfs, threshold, heads, fold))
        nodes = nodes.unionByName(placed.select(*nodes.columns))
        texts = texts.unionByName(parts.select("scope", F.inline(F.arrays_zip("text_id", "copies", "text_hash"))))

    def of(which: int) -> DataFrame:
        return found.where(F.col("kind") == which).select("scope", "i", "j", "similarity")
    return Resolution(rows, nodes, of(passes.ROOT).select("scope", F.col("i").alias("node")), of(passes.REMOVED), of(passes.FALL), texts)


def kept_nodes(found: Resolution) -> DataFrame:
    fallen = found.falls.select("scope", F.col("i").alias("node")).distinct()
    return found.roots.join(fallen, NODE, "left_anti")


def survivors(df: DataFrame, order: str = "ord", text: str = "question", difficulty: str = "difficulty_estimate",
              scope: str | None = None, options: Options = Options(), heads: int = HEADS,
              fold: int = BLOCK) -> DataFrame:
    """The rows that stay. Questions without any term are similar to nothing and stay as well."""
    found = resolve(df, order, text, difficulty, scope, options, heads, fold)
    silent = found.texts.join(found.nodes.select("scope", "text_id"), ["scope", "text_id"], "left_anti")
    tagged = df.withColumn("_scope", F.coalesce(F.col(scope).cast("string"), F.lit("")) if scope else F.lit(""))
    tagged = tagged.withColumn("_text", F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    kept = (kept_nodes(found).join(found.nodes, NODE)
            .select(F.col("scope").alias("_scope"), F.col("ord").alias(order)))
    quiet = silent.select(F.col("scope").alias("_scope"), F.col("text_hash").alias("_text")).distinct()
    return (tagged.join(kept, ["_scope", order], "left_semi")
            .unionByName(tagged.join(quiet, ["_scope", "_text"], "left_semi")).drop("_scope", "_text"))


def duplicate_pairs(found: Resolution) -> DataFrame:
    """Every pair at which the pass removes a question: the order values of both, of the removed one, and the similarity.

    Needs a resolution with ``all_removals``.
    """
    removed = found.removals.withColumn("_falls", F.lit(False))
    pairs = removed.unionByName(found.falls.withColumn("_falls", F.lit(True)))
    for end in ("i", "j"):
        named = found.nodes.select("scope", F.col("node").alias(end), F.col("ord").alias(f"_{end}"))
        pairs = pairs.join(named, ["scope", end]).drop(end)
    return pairs.select("scope", F.col("_i").alias("i"), F.col("_j").alias("j"),
                        F.when(F.col("_falls"), F.col("_i")).otherwise(F.col("_j")).alias("removed"), "similarity")


def summary(found: Resolution) -> DataFrame:
    """Rows, pairs at which the pass removes something, removed and remaining rows."""
    nodes = found.nodes
    in_play = nodes.agg(F.coalesce(F.sum("copies"), F.lit(0))).scalar()
    n_roots = found.roots.agg(F.count(F.lit(1))).scalar()
    n_kept = kept_nodes(found).agg(F.count(F.lit(1))).scalar()
    sizes = nodes.select("scope", F.col("node").alias("j"), "copies")
    n_falls = found.falls.join(sizes, ["scope", "j"]).agg(F.coalesce(F.sum("copies"), F.lit(0))).scalar()
    total = found.texts.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("total"))
    return total.select("total", (in_play - n_roots + n_falls).alias("duplicate_pairs"),
                        (in_play - n_kept).alias("removed"), (F.col("total") - in_play + n_kept).alias("remaining"))
