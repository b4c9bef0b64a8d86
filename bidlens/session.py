"""Session helpers shared by jobs and tests."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a new temp folder in local mode only."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured


def new_folder(spark: SparkSession, name: str) -> str:
    """A name of its own in the shared folder; Spark creates it on the first write."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stable(df: DataFrame) -> DataFrame:
    """Write to the shared checkpoint folder and read back: no lineage, and only the columns and rows a query asks for."""
    path = new_folder(df.sparkSession, "stable")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, rows: int = 0, per_task: int = 0) -> DataFrame:
    """Repartition an input that has fewer splits than the cluster has cores.

    A large table has many splits already and is left as it is, unshuffled. Where a
    short row makes much work, ``rows`` is their number and ``per_task`` how many
    of them a task is to hold: the tasks then stay short, however large the table.
    """
    wanted = df.sparkSession.sparkContext.defaultParallelism
    if per_task:
        wanted = max(wanted, -(-rows // per_task))
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df


def keep(df: DataFrame, condition: Column) -> DataFrame:
    """A filter that stays where it is written.

    A plain filter on an analysed column is pushed below the analysis by copying
    its expressions into the filter, so that they run twice (and a chain of such
    filters multiplies). Exploding a one- or zero-element array drops the same
    rows and leaves nothing to push.
    """
    once = F.when(condition, F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>"))
    return df.withColumn("_keep", F.explode(once)).drop("_keep")
