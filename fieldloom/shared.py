"""Cluster helpers: shared scratch folder, size-checked broadcast."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the folder that the cluster names in
    ``spark.checkpoint.dir``.  Only a local master may go without: it gets a
    folder of the application's own, and its settings stay as they are."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = f"{tempfile.gettempdir()}/fieldloom-{spark.sparkContext.applicationId}"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage by a table in the shared folder (survives executor loss)."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *by: str) -> DataFrame:
    """Hash the rows over all cores before work that is heavy per row: small
    files with few splits would otherwise do it in few tasks."""
    return df.repartition(cores(df.sparkSession), *by)


def cores(spark: SparkSession) -> int:
    """Number of tasks that keeps the whole cluster at work."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def fits(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` holds at most ``max_rows`` rows (reads no further)."""
    return df.limit(max_rows + 1).count() <= max_rows


def sized_join(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner",
               max_rows: int = 100_000) -> DataFrame:
    """Broadcast ``small`` only after its row count was checked (by the caller's
    bound on narrow rows), otherwise leave the join to Spark: adaptive execution
    splits the partitions of hot keys."""
    return big.join(F.broadcast(small) if fits(small, max_rows) else small, on, how)
