"""Request counts in a trailing window, for rate limits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

MICROS = 1_000_000


def trailing_window(requests: DataFrame, ts: str = "ts", client: Sequence[str] = (), rpm: int = 6,
                    seconds: int = 60) -> DataFrame:
    """Requests of the last ``seconds`` seconds up to each request, and the wait a limiter would ask for.

    A request belongs to the time slice it falls into and is handed to the
    next slice as history. Slices are as long as the window, so each one can
    be counted alone: a busy client spreads over its slices instead of
    filling one task, and equal times are counted once ahead of the shuffle.

    Every row is kept. Requests of a NULL client form a group of their own; a
    row without a time is in no window: its count and wait are NULL.
    """
    width = seconds * MICROS
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(ts).cast("timestamp_ntz"))
    points = (requests.withColumn("_us", micros).where(F.col("_us").isNotNull()).groupBy(*client, "_us").agg(F.count(F.lit(1)).alias("_n")))
    slice_of = F.floor(F.col("_us") / width)
    shared = points.select("*", F.explode(F.array(slice_of, slice_of + 1)).alias("_slice"))
    frame = (Window.partitionBy(*client, "_slice").orderBy("_us").rangeBetween(-(width - 1), Window.currentRow))
    counted = (shared.withColumn("in_window", F.sum("_n").over(frame))
               .withColumn("_oldest", F.min("_us").over(frame))
               .where(F.col("_slice") == slice_of)
               .select(*client, "_us", "in_window", "_oldest"))
    waits = F.when(F.col("in_window") > rpm,
                   F.lit(float(seconds + 1)) - (F.col("_us") - F.col("_oldest")) / F.lit(float(MICROS))).otherwise(0.0)
    counted = counted.select("in_window", waits.alias("wait_seconds"), F.col("_us").alias("_at"),
                             *[F.col(c).alias(f"_by_{c}") for c in client])
    on = [F.col("_us") == F.col("_at"), *[F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in client]]
    return (requests.withColumn("_us", micros).join(counted, on, "left")
            .drop("_us", "_at", *[f"_by_{c}" for c in client]))
