"""Consecutive numbers in a given order without pulling an order into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from quaestor.session import use_checkpoints

_ROW_BITS = (1 << 33) - 1


def with_ordinal(df: DataFrame, order_by: Sequence[str], scope: Sequence[str] = (),
                 name: str = "ordinal") -> DataFrame:
    """Number the rows of every scope from zero in the given order.

    Rows are range-partitioned by scope and order, so a scope that holds a
    third of the table spreads over a third of the partitions. Each partition
    numbers its own rows; the numbers before it are added from a table with
    one row per partition and scope. Partition numbers have to stay what they
    were, hence the checkpoint in between.
    """
    use_checkpoints(df.sparkSession)
    keys = [*scope, *order_by]
    local = (df.repartitionByRange(*keys).sortWithinPartitions(*keys)
             .withColumn("_pid", F.spark_partition_id())
             .withColumn("_row", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)))
             .checkpoint())
    blocks = local.groupBy("_pid", *scope).agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    earlier = Window.partitionBy(*scope).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("_pid", *scope, (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first"))
                            .alias("_shift"))
    joined = local.alias("l").join(
        offsets.alias("o"),
        [F.col("l._pid") == F.col("o._pid"), *[F.col(f"l.{s}").eqNullSafe(F.col(f"o.{s}")) for s in scope]])
    return joined.select(*[F.col(f"l.{c}") for c in df.columns],
                         (F.col("l._row") + F.col("o._shift")).alias(name))


def batch_of(ordinal: Column, size: int) -> tuple[Column, Column]:
    """Batch number and place inside the batch."""
    return F.floor(ordinal / size), (ordinal % size).cast("int")
