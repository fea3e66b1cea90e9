"""Session helpers shared by operators that have to cut lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Directory for reliable checkpoints.

    The shared folder named by ``spark.checkpoint.dir`` is used when the session
    has one. A temporary folder is created only for a local master; on a cluster
    an unset folder is an error, because executors do not share local disks.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    local = tempfile.mkdtemp(prefix="quantelle-checkpoint-")
    sc.setCheckpointDir(local)
    return local


def pin(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and continue from the written rows.

    Needed where a value depends on how rows were placed (for example the
    partition index): after a lost executor the rows are read again, never
    placed again. The job's plan is not that of ``df``, so its shuffle files are not kept
    for as long as the caller holds ``df``.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.select("*").checkpoint(eager=True)


def drop_finished(spark: SparkSession) -> None:
    """Let the shuffle files of finished jobs go. Spark deletes them when the driver's JVM
    collects their plans, which with little to collect may be long after the job."""
    spark.sparkContext._jvm.System.gc()
