"""Session helpers shared by every operator: table access, partition spread and checkpoints."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table *name* below *sf_dir*; projections and filters reach the scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Give a scan of very few splits one partition per core.

    A tiny table is one Parquet row group and would feed a Python stage from a single
    task. Scans that already have at least half as many splits as cores pass unchanged,
    so at scale no shuffle is added.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() * 2 > cores:
        return df
    return df.repartition(cores)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder of spark.checkpoint.dir; only where it is unset (tests) a local one is made."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    shared = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="glosswright-checkpoint-")
        atexit.register(shutil.rmtree, shared, ignore_errors=True)
    sc.setCheckpointDir(shared)


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: lineage ends at files that survive the loss of any executor."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def small(df: DataFrame, rows: int = 100_000) -> bool:
    """Whether *df* was counted to have at most *rows* rows."""
    return df.limit(rows + 1).count() <= rows


def if_small(keys: DataFrame, rows: int = 100_000) -> DataFrame:
    """Marks a table of keys for broadcast after counting that it has at most *rows* of them; a larger one is left to a shuffle join."""
    return F.broadcast(keys) if small(keys, rows) else keys


def scratch(spark: SparkSession) -> str:
    """A fresh folder beside the checkpoints, which all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/scratch-{uuid.uuid4().hex}"
