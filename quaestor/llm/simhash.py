"""Near-duplicates by SimHash, with candidates from the pigeonring principle."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import LongType

from quaestor.llm.graph import connected_components
from quaestor.llm.tables import pin, read_table, with_row_id

SHINGLE = 3
RADIUS = 2
SEGMENTS = 5
PAIR_BUCKET = 64
BLOCK = 1 << 16
SEED = 42


def fingerprint_of(text: bytes | None, shingle: int = SHINGLE) -> int:
    """SimHash of the word shingles of a text, as a signed 64-bit number; 0 without words."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    starts = np.concatenate(([0], np.cumsum(lengths)))
    width = min(shingle, len(words))
    begin, end = starts[:len(words) - width + 1], starts[width:] - 1
    ones = np.zeros(64, np.int64)
    for k in range(0, len(begin), BLOCK):
        cuts = zip(begin[k:k + BLOCK].tolist(), end[k:k + BLOCK].tolist(), strict=True)
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in cuts], np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    bits = np.packbits(2 * ones > len(begin), bitorder="little")
    return int(bits.view(np.int64)[0])


def _fingerprints(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in texts:
        yield pa.array([fingerprint_of(x.as_buffer().to_pybytes() if x.is_valid else None) for x in batch], pa.int64())


def fingerprint(text: str) -> Column:
    return arrow_udf(_fingerprints, LongType())(F.col(text))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def segments(parts: int = SEGMENTS) -> list[tuple[int, int]]:
    """(first bit, width) of each segment of the ring."""
    wide = 64 % parts
    widths = [64 // parts + (k < wide) for k in range(parts)]
    return [(sum(widths[:k]), w) for k, w in enumerate(widths)]


def _mask(which: list[int], parts: int) -> int:
    return sum(((1 << w) - 1) << at for at, w in (segments(parts)[k] for k in which))


def _chain(start: int, length: int, parts: int) -> list[int]:
    return [(start + k) % parts for k in range(length)]


def _exact_length(radius: int, parts: int) -> int:
    """How many segments of a chain have to be equal: those whose budget stays below one bit."""
    return sum(1 for k in range(1, parts + 1) if k * radius < parts)


def linked(fps: DataFrame, radius: int = RADIUS, parts: int = SEGMENTS, pair_bucket: int = PAIR_BUCKET) -> DataFrame:
    """Edges ``(u, v)`` that connect all fingerprints within ``radius`` bits of each other.

    If two fingerprints differ in at most ``radius`` bits, the ring of
    ``parts`` segments has a start from which every chain of k segments
    differs in at most k * radius / parts bits. The first segments of that
    chain are equal and are the bucket's key; the longer chains are compared
    one after another, the whole ring last. In a bucket of over
    ``pair_bucket`` fingerprints no pairs are made: each emits itself and its
    variants with up to radius / 2 other bits of the bucket changed, and those
    that share a variant link to the smallest of them, which for radius 2 are
    exactly the pairs within 2 bits.
    """
    if radius not in (1, 2):
        raise ValueError("radius is 1 or 2")
    exact = _exact_length(radius, parts)
    keys = [F.struct(F.lit(k).alias("chain"), F.col("fp").bitwiseAND(F.lit(_signed(_mask(_chain(k, exact, parts), parts))))
                     .alias("bucket")) for k in range(parts)]
    rows = fps.select("fp", F.explode(F.array(*keys)).alias("k")).select("fp", "k.*")
    sizes = rows.groupBy("chain", "bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    buckets = pin(rows.join(sizes, ["chain", "bucket"]), "simhash-buckets")

    few = buckets.where(F.col("n") <= pair_bucket).select("chain", "bucket", "fp")
    pairs = few.withColumnRenamed("fp", "v").join(few.withColumnRenamed("fp", "u"), ["chain", "bucket"]).where("v < u")
    differing = F.col("u").bitwiseXOR(F.col("v"))
    for length in range(exact + 1, parts + 1):
        within: Column = F.lit(False)
        for k in range(parts):
            mask = _signed(_mask(_chain(k, length, parts), parts))
            within = F.when(F.col("chain") == k, F.bit_count(differing.bitwiseAND(F.lit(mask)))
                            <= length * radius // parts).otherwise(within)
        pairs = pairs.where(within)

    many = buckets.where(F.col("n") > pair_bucket)
    masks = []
    for k in range(parts):
        free = _mask([s for s in range(parts) if s not in _chain(k, exact, parts)], parts)
        masks.append(F.array(*[F.lit(_signed(1 << b)).cast("long") for b in range(64) if free >> b & 1],
                             F.lit(0).cast("long")))
    flips = F.element_at(F.array(*masks), F.col("chain") + 1)
    shared = pin(many.select("chain", "bucket", "fp", F.explode(flips).alias("flip"))
                 .select("chain", "bucket", "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("variant")),
                 "simhash-variants")
    if radius == 1:  # a variant reaches itself only: link what equals a variant
        shared = shared.select("chain", "bucket", "variant", "fp").join(
            many.select("chain", "bucket", F.col("fp").alias("variant")), ["chain", "bucket", "variant"])
        stars = shared.select(F.col("fp").alias("u"), F.col("variant").alias("v"))
    else:
        first = shared.groupBy("chain", "bucket", "variant").agg(F.min("fp").alias("v"))
        stars = shared.join(first, ["chain", "bucket", "variant"]).select(F.col("fp").alias("u"), "v")
    return pairs.select("u", "v").unionByName(stars.where("u != v")).distinct()


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """``row_id, doc_id, fp, component_id, keeper`` of every row of ``docs(row_id, doc_id, text)``.

    Rows are linked when their fingerprints differ in at most ``radius``
    bits; equal fingerprints meet in one node first, so a group of copies
    costs one row. ``component_id`` is the smallest doc_id that a row reaches
    (null if none of them has an id), ``keeper`` marks one row of each
    component: that of the smallest doc_id, among repeated ids the one with the
    smallest row_id. Null and empty texts, and texts of white space, have fingerprint 0
    and are linked like all others.
    """
    if shingle != SHINGLE:
        raise ValueError("the fingerprint is defined on three-word shingles")
    rows = pin(docs.select("row_id", "doc_id", fingerprint("text").alias("fp")), "simhash-fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_id")).alias("least")
    nodes = pin(rows.groupBy("fp").agg(first), "simhash-nodes")
    roots = pin(connected_components(linked(nodes.select("fp"), radius), "simhash"), "simhash-roots")
    placed = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    placed = pin(placed, "simhash-placed")
    leaders = placed.groupBy("root").agg(F.min("least").alias("leader"))
    answer = placed.join(leaders, "root").select("fp", F.col("leader.doc_id").alias("component_id"),
                                                 F.col("leader.row_id").alias("leader_row"))
    return rows.join(pin(answer, "simhash-answer"), "fp").select(
        "row_id", "doc_id", "fp", "component_id", (F.col("row_id") == F.col("leader_row")).alias("keeper"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component of near-duplicates; columns and order of columns stay."""
    rows, row_id = with_row_id(docs, "simhash-rows")
    found = near_duplicates(rows.select(F.col(row_id).alias("row_id"), "doc_id", "text"))
    kept = found.where("keeper").select(F.col("row_id").alias(row_id))
    return rows.join(kept.hint("merge"), row_id, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select(F.monotonically_increasing_id().alias("row_id"), "doc_id", "text")
    found = near_duplicates(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op2_simhash": op2_simhash}
ORACLE: dict[str, str] = {}
