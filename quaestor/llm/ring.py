"""Near-duplicates by the pigeonring principle on whole shingle sets, for similarities out of reach of 64 bits."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from quaestor.llm.graph import connected_components
from quaestor.llm.tables import pin, with_row_id
from quaestor.llm.words import FOLD, MULTIPLIER, find_words, hash_spans, mix, pieces

SHINGLE = 5
PERCENT = 80
CHAIN = 4
SEGMENTS = 24
SPREAD = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(batch: pa.Array, shingle: int = SHINGLE) -> Iterator[np.ndarray]:
    """Sorted different 64-bit hashes of the word shingles of each text (A-Z lower-cased; fewer words: the whole sequence)."""
    for piece in pieces(batch):
        piece.data = FOLD[piece.data]
        words = find_words(piece)
        hashes = hash_spans(piece.data, words.start, words.end)
        bounds = np.searchsorted(words.doc, np.arange(piece.count + 1)).tolist()
        n = max(len(hashes) - shingle + 1, 0)
        whole = _run_hash([hashes[k:k + n] for k in range(shingle)])
        for at, to in zip(bounds[:-1], bounds[1:], strict=True):
            if to - at >= shingle:
                out = np.sort(whole[at:to - shingle + 1])
                yield out[np.concatenate(([True], out[1:] != out[:-1]))]
            else:
                yield _run_hash([hashes[k:k + 1] for k in range(at, to)]) if to > at else whole[:0]


def _run_hash(words: list[np.ndarray]) -> np.ndarray:
    out = np.full(len(words[0]), len(words), np.uint64)
    for own in words:
        out = mix((out ^ own) * np.uint64(MULTIPLIER))
    return out


def _signatures(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        sigs, sizes = [], []
        for found in shingle_sets(batch):
            sigs.append(int(mix(found + SPREAD).sum(dtype=np.uint64).view(np.int64)) if len(found) else 0)
            sizes.append(len(found))
        yield pa.StructArray.from_arrays([pa.array(sigs, pa.int64()), pa.array(sizes, pa.int32())], ["sig", "n"])


def _sets(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield pa.array([x.view(np.int64) for x in shingle_sets(batch)], pa.list_(pa.int64()))


def class_bounds(n: int, percent: int = PERCENT) -> tuple[int, int]:
    """Smallest and largest size of the class of sets that holds size ``n``; classes grow by about 100 / percent."""
    low = 1
    while True:
        high = max(low, low * 100 // percent)
        if n <= high:
            return low, high
        low = high + 1


def ring_keys(found: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Key of each segment of the set's rings, and the next three segments of each, packed into one number.

    A set stands in the ring of its own class and, as the smaller partner, in
    that of the next one. A ring has more segments than two sets of its class
    may have shingles apart, so one segment at least is equal in both. Of a ring
    of over 24 segments the first 24 are keys, without chains behind them: as
    shingles fall into segments by hash, each is equal with a chance of over
    1/e whatever the texts, and a pair of exactly the least similarity is missed
    with a chance of at most (1 - 1/e) ** 24, two in 100,000.
    """
    n = len(found)
    low, high = class_bounds(n, percent)
    keys, tails = [], []
    for low, high in ((low, high), class_bounds(high + 1, percent)):
        if n * 100 < percent * low:
            continue
        parts = high - -(-high * percent // 100) + 1
        segment = (mix(found ^ SPREAD) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(segment, kind="stable")
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(found[order]), dtype=np.uint64)))
        cuts = np.concatenate(([0], np.cumsum(np.bincount(segment, minlength=parts))))
        counts, sums = np.diff(cuts), sums[cuts[1:]] - sums[cuts[:-1]]
        small = (np.minimum(counts, 15).astype(np.uint64) << np.uint64(16)) | (mix(sums) & np.uint64(0xFFFF))
        tail = np.zeros(parts, np.uint64)
        for k in range(1, CHAIN):
            tail |= np.roll(small, -k) << np.uint64(20 * (k - 1))
        if parts > SEGMENTS:
            tail[:] = 0
        use = np.flatnonzero(counts[:SEGMENTS])
        place = (np.uint64(high) << np.uint64(32)) + use.astype(np.uint64)
        keys.append(mix(sums[use] + mix(place * SPREAD)))
        tails.append(tail[use])
    return np.concatenate(keys), np.concatenate(tails)


KEYS = ArrayType(StructType([StructField("key", LongType()), StructField("tail", LongType())]))


def _keys(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        offsets, keys, tails = [0], [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
        for found in shingle_sets(batch):
            k, t = ring_keys(found) if len(found) else (keys[0], tails[0])
            keys.append(k)
            tails.append(t)
            offsets.append(offsets[-1] + len(k))
        both = pa.StructArray.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (keys, tails)], ["key", "tail"])
        yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), both)


def _chain_fits(a: Column, b: Column) -> Column:
    """Chains of two to four segments differ in no more shingles than segments, less one: each has a budget below one."""
    apart: Column = F.lit(0)
    fits: Column = F.lit(True)
    for k in range(CHAIN - 1):
        x, y = (F.shiftrightunsigned(c, 20 * k).bitwiseAND(F.lit((1 << 20) - 1)) for c in (a, b))
        counts = F.abs(F.shiftrightunsigned(x, 16) - F.shiftrightunsigned(y, 16))
        apart = apart + F.when(x == y, 0).otherwise(F.greatest(counts, F.lit(1)))
        fits = fits & (apart <= k + 1)
    return fits


def similar_components(docs: DataFrame) -> DataFrame:
    """``row_id, doc_id, component_id, keeper`` of every row of ``docs(row_id, doc_id, text)``.

    Texts are linked when the Jaccard similarity of their sets of five-word
    shingles is at least 0.8; this is a Hamming distance between the sets of at
    most a ninth of their sizes, on a fingerprint with a bit per shingle.
    Texts with equal sets are one node. Each node deals its shingles to the
    segments of a ring; if two are linked, a segment exists from which chains
    of one, two, three ... segments stay below the budget. Nodes with an equal
    segment meet, are compared by the chains behind it, then exactly. In the
    bucket of a segment all nodes are compared with the first one, then with
    the next one, two, four ... until all were compared or the bucket is one
    component; nodes that are linked already are not compared. Null texts and such without words have
    the empty set and are one component; shorter texts have their whole
    sequence of words as shingle. Very long texts are treated whole.
    ``component_id`` and ``keeper`` as in ``near_duplicates``.
    """
    sig = arrow_udf(_signatures, StructType([StructField("sig", LongType()), StructField("n", IntegerType())]))(F.col("text"))
    rows = pin(docs.select("row_id", "doc_id", sig.alias("s")).select("row_id", "doc_id", "s.sig", "s.n"), "ring-signatures")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_id")).alias("least")
    nodes = pin(rows.groupBy("sig", "n").agg(least).withColumn("node", F.xxhash64("sig", "n")), "ring-nodes")
    texts = docs.select("row_id", "text").join(nodes.select(F.col("least.row_id").alias("row_id"), "node").hint("merge"), "row_id")
    keys = texts.select("node", F.explode(arrow_udf(_keys, KEYS)("text")).alias("k")).select("node", "k.key", "k.tail")
    keys = pin(keys, "ring-keys")
    twice = pin(keys.groupBy("key").agg(F.min("node").alias("head"), F.max("node").alias("last")).where("head < last").drop("last"), "ring-shared")
    place = F.row_number().over(Window.partitionBy("key").orderBy("node")).alias("place")
    keys = pin(keys.join(twice.hint("shuffle_hash"), "key").select("key", "node", "tail", place), "ring-buckets")
    named = keys.select("node").distinct()
    sets = pin(texts.join(named, "node", "left_semi").select("node", arrow_udf(_sets, ArrayType(LongType()))("text").alias("s")), "ring-sets")
    links = None
    open_keys = keys.withColumn("root", F.col("node"))
    low = 0
    while True:
        high = max(1, 2 * low)
        heads = open_keys.where((F.col("place") > low) & (F.col("place") <= high)).select(
            "key", F.col("node").alias("head"), F.col("root").alias("head_root"), F.col("tail").alias("head_tail"), F.col("place").alias("head_place"))
        others = open_keys.join(heads, "key").where((F.col("place") > F.col("head_place")) & (F.col("root") != F.col("head_root")))
        pairs = others.where(_chain_fits(F.col("tail"), F.col("head_tail"))).select(
            F.greatest("node", "head").alias("u"), F.least("node", "head").alias("v")).distinct()
        new = _similar(pin(pairs, "ring-pairs"), sets)
        if not new.isEmpty():
            links = new if links is None else pin(links.unionByName(new), "ring-links")
            roots = pin(connected_components(links, "ring"), "ring-roots")
        rooted = open_keys if links is None else open_keys.drop("root").join(roots, "node", "left").select(
            "key", "node", "tail", "place", F.coalesce("root", "node").alias("root"))
        still = rooted.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.max("place").alias("m")).where(
            (F.col("a") < F.col("b")) & (F.col("m") > high + 1)).select("key")
        open_keys = pin(rooted.join(still, "key", "left_semi"), "ring-open")
        if open_keys.isEmpty():
            break
        low = high
    if links is None:
        placed = nodes.withColumn("root", F.col("node"))
    else:
        placed = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    leaders = placed.groupBy("root").agg(F.min("least").alias("leader"))
    answer = pin(placed.join(leaders, "root").select("sig", "n", "leader"), "ring-answer")
    return rows.join(answer, ["sig", "n"]).select("row_id", "doc_id", F.col("leader.doc_id").alias("component_id"),
                                                  (F.col("row_id") == F.col("leader.row_id")).alias("keeper"))


def _similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose sets have a Jaccard similarity of at least 0.8."""
    both = pairs.join(sets.select(F.col("node").alias("u"), F.col("s").alias("a")), "u").join(
        sets.select(F.col("node").alias("v"), F.col("s").alias("b")), "v")
    shared = F.size(F.array_intersect("a", "b"))
    return pin(both.where(shared * 100 >= PERCENT * (F.size("a") + F.size("b") - shared)).select("u", "v"), "ring-similar")


def drop_similar(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component of similar texts; columns and order of columns stay."""
    rows, row_id = with_row_id(docs, "ring-rows")
    found = similar_components(rows.select(F.col(row_id).alias("row_id"), "doc_id", "text"))
    kept = found.where("keeper").select(F.col("row_id").alias(row_id))
    return rows.join(kept.hint("merge"), row_id, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
