"""Where snapshots, changes and runs are kept: partitioned parquet folders.

A run writes whole partitions under its own name (date or batch), so a rerun or
a retried task replaces its own output and never adds to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidlens.session import new_folder


def write_partition(df: DataFrame, path: str, column: str, value: str) -> None:
    """Replace one partition of a parquet folder, also by an empty result."""
    df.write.mode("overwrite").parquet(f"{path}/{column}={value}")


def write_bucketed(df: DataFrame, buckets: int | None = None, key: str = "identity_key") -> DataFrame:
    """Store a snapshot in buckets of its key, sorted in each, and read it back: joins on the key leave its rows where they are.

    ``buckets`` is the number of shuffle partitions unless given; a later join deals
    the other side over as many. The files are in the shared folder, the table's name
    is known to this session.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = new_folder(spark, "bucketed")
    name = "bucketed_" + path.rsplit("-", 1)[1]
    df.repartition(n, key).write.bucketBy(n, key).sortBy(key).option("path", path).saveAsTable(name)
    return spark.table(name)


def read_partition(spark: SparkSession, path: str, column: str, value: str) -> DataFrame:
    return spark.read.parquet(path).filter(F.col(column) == value).drop(column)


def changes_for(spark: SparkSession, path: str, identity_key: str, on: str) -> DataFrame:
    """Changes of one bid on one day; only that day's folder is read."""
    return spark.read.parquet(path).filter((F.col("detected_on") == on) & (F.col("identity_key") == identity_key))
