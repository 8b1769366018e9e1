"""For every row the last row of another table at or before its time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from quaestor.session import use_checkpoints


def asof_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_time: str, right_time: str,
              tie: Sequence[str] = ()) -> DataFrame:
    """The columns of ``left``, and as struct ``matched`` the row of ``right`` with the same keys that was the last
    one up to ``left_time``; null if there is none.

    Rows of ``right`` at the same time rank by ``tie``. A null key or time
    matches nothing. Both tables are range-partitioned together by key and
    time, so a key that holds a third of the rows spreads over a third of the
    partitions; equal times are spread by a hash. What is in force at the end
    of a partition is carried to the later ones through a table of one row per
    partition and key, so no window covers a whole key.
    """
    use_checkpoints(left.sparkSession)
    known = F.col(right_time).isNotNull()
    for name in on:
        known = known & F.col(name).isNotNull()
    told = right.where(known).select(
        F.struct(*on).alias("_key"), F.col(right_time).alias("_time"), F.lit(0).alias("_side"), F.struct(F.lit(0), *tie).alias("_tie"),
        F.lit(None).cast(left.schema).alias("_left"), F.struct("*").alias("_right"))
    asked = left.select(
        F.struct(*on).alias("_key"), F.col(left_time).alias("_time"), F.lit(1).alias("_side"), F.lit(None).cast(told.schema["_tie"].dataType).alias("_tie"),
        F.struct("*").alias("_left"), F.lit(None).cast(right.schema).alias("_right"))
    order = ["_time", "_side", "_tie", "_spread"]
    both = (told.unionByName(asked).withColumn("_spread", F.xxhash64("_left", "_right"))
            .repartitionByRange("_key", *order).withColumn("_pid", F.spark_partition_id()).checkpoint())
    here = Window.partitionBy("_pid", "_key").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = both.withColumn("_own", F.last("_right", ignorenulls=True).over(here)).where("_side = 1")
    is_told = F.col("_side") == 0
    ends = both.groupBy("_pid", "_key").agg(F.max_by(F.when(is_told, F.col("_right")), F.when(is_told, F.struct(*order))).alias("_end"))
    earlier = Window.partitionBy("_key").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(F.col("_pid").alias("_p"), F.col("_key").alias("_k"), F.last("_end", ignorenulls=True).over(earlier).alias("_carried"))
    joined = local.join(carried, (F.col("_pid") == F.col("_p")) & F.col("_key").eqNullSafe(F.col("_k")))
    complete = F.col("_time").isNotNull()
    for name in on:
        complete = complete & F.col(f"_key.{name}").isNotNull()
    return joined.select("_left.*", F.when(complete, F.coalesce("_own", "_carried")).alias("matched"))
