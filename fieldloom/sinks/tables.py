"""Parquet table writers.

Partitioned writes are rebalanced on the partition columns first: adaptive
execution then splits a partition that holds far more rows than the others
and merges the tiny ones, so neither skew nor small files pile up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import DQ_RESULTS


def _partitioned(df: DataFrame, parts: list[str]) -> DataFrame:
    return df.hint("rebalance", *[F.col(p) for p in parts]) if parts else df


def replace(df: DataFrame, path: str, parts: list[str] | None = None) -> None:
    parts = parts or []
    _partitioned(df, parts).write.mode("overwrite").partitionBy(*parts).parquet(path)


def replace_partitions(df: DataFrame, path: str, parts: list[str]) -> None:
    """Replace only the partitions that ``df`` holds."""
    (_partitioned(df, parts).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path))


def append(df: DataFrame, path: str, parts: list[str]) -> None:
    _partitioned(df, parts).write.mode("append").partitionBy(*parts).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Does the table folder exist?  Any other failure is not swallowed."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in files.listStatus(target)] if files.exists(target) else []


def holds_rows(spark: SparkSession, path: str) -> bool:
    """Has anything been written to the table folder yet (other than hidden folders)?"""
    return any(not n.startswith(("_", ".")) for n in children(spark, path))


def remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def append_audit(checks: DataFrame, path: str) -> None:
    """Check rows (few, one per check) into one file of the audit table."""
    (checks.withColumn("run_at", F.current_timestamp()).select(*DQ_RESULTS.names)
     .coalesce(1).write.mode("append").parquet(path))


def write_wide(df: DataFrame, path: str) -> None:
    """Full-precision drop."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
