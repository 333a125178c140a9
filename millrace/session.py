"""Session-dependent helpers: table loading and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """The Parquet table ``name`` under ``base``."""
    return spark.read.parquet(f"{base}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder every node can reach, as named by ``spark.checkpoint.dir``.

    On a cluster the setting must be present: a machine-local folder would lose
    its files with the machine.  A local session without it gets a fresh
    temporary folder, remembered for the rest of the session.
    """
    root = spark.conf.get(CHECKPOINT_SETTING, None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    root = context.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder shared by all nodes")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
    return context.getCheckpointDir().rstrip("/")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write a derived table to the shared folder and read it back.

    It is computed once, survives lost executors, and has a known size, by which the
    optimiser decides whether a join may broadcast it.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path for one job's output under the shared folder."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
