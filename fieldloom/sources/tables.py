"""Table scans: scoped reads, run history, reads as of a run, slice merge."""

from __future__ import annotations

from datetime import date as Date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def in_scope(df: DataFrame, tiles: list | None = None, seasons: list | None = None,
             dates: list[Date] | None = None) -> DataFrame:
    """Rows of the scope; an absent list does not restrict."""
    for column, wanted in (("mgrs_tile", tiles), ("season", seasons), ("date", dates)):
        if wanted is not None:
            df = df.filter(F.col(column).isin(wanted))
    return df


def selected_in_tiles(scenes: DataFrame, tiles: list | None = None) -> DataFrame:
    return in_scope(scenes.filter("selected"), tiles=tiles)


def latest_runs(runs: DataFrame, n: int = 2) -> DataFrame:
    return runs.orderBy(F.desc("committed_at"), F.desc("run_seq")).limit(n)


def as_of(table: DataFrame, run_seq) -> DataFrame:
    """Rows that were committed up to ``run_seq`` (a partition column)."""
    return table.filter(F.col("run_seq") <= run_seq)


def newest_per_key(df: DataFrame, keys: list[str], newest: list[str], k: int = 1) -> DataFrame:
    """The ``k`` newest rows of each key.  Spark cuts every map task's input
    to k rows per key before the shuffle, so a hot key stays small."""
    order = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in newest])
    return df.withColumn("__rn", F.row_number().over(order)).filter(F.col("__rn") <= k).drop("__rn")


def merge_slices(spark: SparkSession, expected: DataFrame, root: str) -> DataFrame:
    """Concatenate per-slice exports ``root/slice=<name>``; a slice that is
    expected but has no rows fails the job instead of vanishing."""
    data = spark.read.parquet(root)
    present = data.select(F.col("slice").cast("string").alias("slice")).distinct()
    checked = (expected.select(F.col("slice").cast("string").alias("slice"))
               .join(present.withColumn("__found", F.lit(True)), "slice", "left")
               .select("slice", F.when(F.col("__found"), F.lit(True)).otherwise(
                   F.raise_error(F.concat(F.lit("missing slice export: "), F.col("slice")))
                   .cast("boolean")).alias("__ok")))
    gate = checked.agg(F.bool_and("__ok")).scalar()
    return data.filter(gate)
