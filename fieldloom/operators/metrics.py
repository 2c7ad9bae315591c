"""Run metrics, gathered while a job runs but for the number of partitions."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

METRICS = ("stage string, scope string, rows_in bigint, rows_out bigint, partitions bigint, "
           "wall_s double")


def run_with_metrics(source: DataFrame, job: Callable[[DataFrame], DataFrame], path: str,
                     stage: str, scope: str, part: str) -> DataFrame:
    """Write ``job(source)`` to ``path`` and return one metrics row.

    ``partitions`` counts the distinct input values of ``part``: a pass of its own over
    that column, which costs next to nothing where the table is cut by it."""
    read, written = Observation(), Observation()
    seen = source.observe(read, F.count(F.lit(1)).alias("rows"))
    out = job(seen).observe(written, F.count(F.lit(1)).alias("rows"))
    start = time.monotonic()
    out.write.mode("overwrite").parquet(path)
    wall = time.monotonic() - start
    parts = source.select(part).filter(F.col(part).isNotNull()).distinct().count()
    row = (stage, scope, read.get["rows"], written.get["rows"], parts, wall)
    return source.sparkSession.createDataFrame([row], METRICS)
