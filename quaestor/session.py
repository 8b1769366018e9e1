"""Session construction and the shared folder used to cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "quaestor", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, skew handling and UTC timestamps.

    Shuffle partition counts are left to the cluster's configuration; adaptive
    execution merges small ones.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints, as named by ``spark.checkpoint.dir``.

    Local sessions without that setting (tests) get a temporary folder. A
    cluster session without it is an error: a folder on one machine would be
    lost together with that machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    made = tempfile.mkdtemp(prefix="quaestor-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def use_checkpoints(spark: SparkSession) -> None:
    """Point the context at the shared folder unless it already has one."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_dir(spark))


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def pin(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and gives true sizes to the join planner."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str, rows: int | None = None) -> DataFrame:
    """Give costly row-wise work to all cores when a scan has fewer partitions than there are cores.

    A scan of many files already has enough partitions and stays as it is, so
    nothing is shuffled at scale. Hashing by a key keeps retried tasks the same.
    With ``rows`` a partition gets about that many rows at most: short rows
    that are costly to work on fill few splits, and tasks would grow with the table.
    """
    wanted = df.sparkSession.sparkContext.defaultParallelism
    if rows:
        wanted = max(wanted, -(-df.count() // rows))
    return df.repartition(wanted, *keys) if df.rdd.getNumPartitions() < wanted else df
