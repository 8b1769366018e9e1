"""Mixing sources to target weights by nested hash thresholds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from quaestor.llm.tables import pin, read_table, with_row_id
from quaestor.operators.ordinals import with_ordinal

WEIGHTS = (1, 2, 3)
REPEATS = 3
HASH_BITS = 60
LEVEL_BITS = 12


def size_of(text: Column) -> Column:
    """Number of words between white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def hash_of(doc_id: Column, text: Column) -> Column:
    """60 bits of the id's MD5; of the text's for a row without id."""
    key = F.coalesce(doc_id.cast("string"), F.concat(F.lit("text:"), F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size, target`` for ``sizes(source, source_size)``, one row per source.

    Sources are numbered by code point, null last, and weigh 1, 2, 3,
    repeating. Targets are in proportion to weight and add up to all sizes,
    but none is above three times its source's size: what is cut off goes to
    the others by weight until none is above. Each round is one aggregate over
    the sources; its single row is all that the driver sees.
    """
    keyed = sizes.withColumn("no_source", F.col("source").isNull())
    ranked = with_ordinal(keyed, ["no_source", "source"])
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("ordinal") % len(WEIGHTS)).cast("int") + 1).cast("long")
    ranked = pin(ranked.select("source", "source_size", weight.alias("weight")), "mixing-sources")
    limit = REPEATS * F.col("source_size")
    full = F.lit(False)
    known = None
    while True:
        r = ranked.agg(F.sum("source_size").alias("all"), F.sum(F.when(full, limit)).alias("capped"),
                       F.sum(F.when(~full, F.col("weight"))).alias("weights"), F.count(F.when(full, 1)).alias("n")).first()
        rest, weights = (r["all"] or 0) - (r["capped"] or 0), r["weights"]
        if r["n"] == known or not weights:
            break
        known = r["n"]
        full = full | (F.lit(rest) * F.col("weight") > limit * F.lit(weights))
    share = F.lit(float(rest)) * F.col("weight") / F.lit(float(weights or 1))
    return ranked.select("source", "source_size", F.when(full, limit.cast("double")).otherwise(share).alias("target"))


def _thresholds(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``sid, threshold``: rows up to that hash come nearest to the source's budget.

    A histogram of sizes by source and the hash's first 12 bits finds the
    bucket in which the budget ends; the rows of that bucket alone are split
    by the next 12 bits, and so on. The running sums cover the at most 4096
    buckets of one source, never its rows.
    """
    state = sources.select("sid", F.col("budget").alias("left"), F.lit(0).cast("long").alias("prefix"))
    done = None
    running = Window.partitionBy("sid").orderBy("bucket")
    for used in range(0, HASH_BITS, LEVEL_BITS):
        shift = HASH_BITS - used - LEVEL_BITS
        inside = rows.join(state, "sid").where(F.shiftright("hash", shift + LEVEL_BITS) == F.col("prefix"))
        buckets = (inside.groupBy("sid", "left", F.shiftright("hash", shift).alias("bucket"))
                   .agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")))
        below = buckets.withColumn("to", F.sum("size").over(running)).withColumn("from", F.col("to") - F.col("size"))
        edge = below.where((F.col("from") <= F.col("left")) & (F.col("left") < F.col("to")))
        edge = pin(edge.select("sid", "bucket", "n", (F.col("left") - F.col("from")).alias("left"), "size"), "mixing-edge")
        last = (F.col("n") == 1) | F.lit(shift == 0)
        take = F.col("size") - F.col("left") < F.col("left")  # with the whole bucket the sum is nearer
        upto = F.when(take, F.shiftleft(F.col("bucket") + 1, shift) - 1).otherwise(F.shiftleft("bucket", shift) - 1)
        found = edge.where(last).select("sid", upto.alias("threshold"))
        done = found if done is None else done.unionByName(found)
        state = edge.where(~last).select("sid", "left", F.col("bucket").alias("prefix"))
        if state.isEmpty():
            break
    return done


def mix(docs: DataFrame) -> DataFrame:
    """``row_id, doc_id, size, source_size, target, taken`` of each row of ``docs(row_id, doc_id, source, text)``.

    A source is taken whole as often as its target holds it; the rest comes
    from the documents with the lowest hashes, up to the threshold that is
    nearest to the budget, the lower one if two are. No document is taken more
    than three times. Rows of one id have one hash and go together. Null and
    empty texts have size 0; a null source is a source of its own.
    """
    rows = pin(docs.select("row_id", "doc_id", "source", size_of(F.col("text")).alias("size"),
                           hash_of(F.col("doc_id"), F.col("text")).alias("hash")), "mixing-sizes")
    targets = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    sources = pin(targets.withColumn("sid", F.xxhash64(F.col("source").isNull(), F.coalesce("source", F.lit(""))))
                  .withColumn("whole", whole)
                  .withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size")), "mixing-targets")
    small = rows.select(F.xxhash64(F.col("source").isNull(), F.coalesce("source", F.lit(""))).alias("sid"), "hash", "size")
    limits = pin(sources.join(_thresholds(small.where("size > 0"), sources.where("budget > 0")), "sid", "left")
                 .select("source", "source_size", "target", "whole", "threshold"), "mixing-limits")
    taken = F.col("size") * (F.col("whole") + F.when(F.col("hash") <= F.col("threshold"), 1).otherwise(0))
    return (rows.alias("r").join(limits.alias("s"), F.col("r.source").eqNullSafe(F.col("s.source")))
            .select("row_id", "doc_id", "size", "source_size", "target", taken.cast("long").alias("taken")))


def mixed(docs: DataFrame) -> DataFrame:
    """The rows that the mix takes, with ``copies``, how often each is taken.

    An existing column of that name is replaced. Rows without words bring
    nothing to a mix that is counted in words and are not taken.
    """
    rows, row_id = with_row_id(docs, "mixing-rows")
    found = mix(rows.select(F.col(row_id).alias("row_id"), "doc_id", "source", "text"))
    kept = found.where("taken > 0").select(F.col("row_id").alias(row_id), F.expr("taken div size").alias("copies"))
    columns = [c for c in docs.columns if c.lower() != "copies"]
    return (rows.alias("r").join(pin(kept, "mixing-kept").hint("merge").alias("k"), row_id)
            .select(*[F.col(f"r.`{c}`") for c in columns], F.col("k.copies")))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return mix(docs.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", "source", "text")).drop("row_id")


def oracle_sql(documents: str = "documents") -> str:
    """The same mix with a running sum over all documents of a source, without the last SELECT."""
    return rf"""
d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
             CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'text:' || coalesce(text, ''))), 1, 15) AS BIGINT) AS h
      FROM {documents}),
s AS (SELECT source, sum(size) AS source_size, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
      FROM d GROUP BY source),
o AS (SELECT *, row_number() OVER (ORDER BY source_size::DOUBLE / weight, source NULLS LAST) AS k FROM s),
c AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS rest,
             (sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS weights FROM o),
f AS (SELECT min_by(rest, k) AS rest, min_by(weights, k) AS weights, min(k) AS k FROM c WHERE rest * weight <= 3 * source_size * weights),
t AS (SELECT c.source, c.source_size::BIGINT AS source_size,
             CASE WHEN c.k < f.k THEN (3 * c.source_size)::DOUBLE ELSE f.rest::DOUBLE * c.weight / f.weights::DOUBLE END AS target FROM c, f),
w AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t),
g AS (SELECT source, h, sum(size) AS size FROM d GROUP BY source, h),
r AS (SELECT w.source, g.h, g.size, w.target - w.whole * w.source_size AS budget,
             sum(g.size) OVER (PARTITION BY w.source ORDER BY g.h) AS upto
      FROM g JOIN w ON g.source IS NOT DISTINCT FROM w.source),
m AS (SELECT source, max(CASE WHEN upto <= budget OR upto - budget < budget - (upto - size) THEN h END) AS threshold FROM r GROUP BY source),
taken AS (SELECT d.doc_id, d.size, w.source_size, w.target,
                 CAST(d.size * (w.whole + CASE WHEN d.h <= m.threshold THEN 1 ELSE 0 END) AS BIGINT) AS taken
          FROM d JOIN w ON d.source IS NOT DISTINCT FROM w.source JOIN m ON d.source IS NOT DISTINCT FROM m.source)"""


QUERIES = {"op6_mixing": op6_mixing}
ORACLE = {"op6_mixing": f"WITH {oracle_sql()} SELECT doc_id, size, source_size, target, taken FROM taken"}
