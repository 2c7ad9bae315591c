"""Ledger of written partitions: which keys a table holds, without opening the table.

Beside a table's data lies ``_ledger``, which readers of the table pass over.  A run first
notes its keys as begun, then adds its rows, then notes the keys as done.  A run
that was cut off between the two is settled by the next one: if rows of its keys are
in the table, its job had committed.  Done keys are only ever added; after ``COMPACT``
runs they are written together as the next generation, so reading stays cheap.

A key that gave no rows counts as done too, so it is not tried again for ever.  (That
all rows of a job appear together is the file committer's promise, not the ledger's.)
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import sized_join
from ..sinks import tables as sink

COMPACT = 32
BASE = "run=base"


def _at(path: str, *parts: str) -> str:
    return "/".join([path.rstrip("/"), "_ledger", *parts])


def _runs(spark: SparkSession, folder: str) -> list[str]:
    """Complete runs of a folder."""
    return [n for n in sink.children(spark, folder) if n.startswith("run=")
            and sink.exists(spark, f"{folder}/{n}/_SUCCESS")]


def generation(spark: SparkSession, path: str) -> int:
    """The newest generation whose base is whole (0: no base yet)."""
    found = [int(n[2:]) for n in sink.children(spark, _at(path, "done")) if n.startswith("g=")
             and sink.exists(spark, _at(path, "done", n, BASE, "_SUCCESS"))]
    return max(found, default=0)


def done(spark: SparkSession, path: str, keys: str) -> DataFrame:
    """The keys (``keys``: their DDL) that the table at ``path`` holds."""
    folder = _at(path, "done", f"g={generation(spark, path)}")
    runs = [f"{folder}/{n}" for n in _runs(spark, folder)]
    return spark.read.schema(keys).parquet(*runs) if runs else spark.createDataFrame([], keys)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{n}` {t}" for n, t in df.dtypes)


def note(keys: DataFrame, path: str, run: str | None = None) -> None:
    """Note ``keys`` as done.  The distinct keys are written by the tasks that found them:
    there may be as many as the table has rows."""
    spark = keys.sparkSession
    now = generation(spark, path)
    folder = _at(path, "done", f"g={now}")
    keys.distinct().write.mode("overwrite").parquet(f"{folder}/{run or 'run=' + uuid.uuid4().hex}")
    if len(_runs(spark, folder)) >= COMPACT:
        whole = done(spark, path, _ddl(keys)).distinct()
        whole.write.mode("overwrite").parquet(_at(path, "done", f"g={now + 1}", BASE))
        sink.remove(spark, folder)


def settle(spark: SparkSession, path: str) -> None:
    """Decide the runs that were begun and never noted as done."""
    closed = set(_runs(spark, _at(path, "done", f"g={generation(spark, path)}")))
    for run in _runs(spark, _at(path, "begun")):
        folder = _at(path, "begun", run)
        keys = spark.read.parquet(folder)
        if run not in closed and sink.holds_rows(spark, path):
            if not spark.read.parquet(path).join(keys, keys.columns, "left_semi").isEmpty():
                note(keys, path, run)
        sink.remove(spark, folder)


def missing(rows: DataFrame, path: str, keys: list[str]) -> DataFrame:
    """The rows whose keys are not done yet.  Reads the ledger only."""
    held = done(rows.sparkSession, path, _ddl(rows.select(*keys)))
    return sized_join(rows, held.distinct(), keys, "left_anti", max_rows=1_000_000)


def add(rows: DataFrame, keys: DataFrame, path: str, parts: list[str]) -> None:
    """Append ``rows`` and note ``keys``, the distinct keys the run worked on."""
    spark, run = rows.sparkSession, "run=" + uuid.uuid4().hex
    begun = _at(path, "begun", run)
    keys.distinct().write.parquet(begun)
    sink.append(rows, path, parts)
    note(spark.read.parquet(begun), path, run)
    sink.remove(spark, begun)


def adopt(rows: DataFrame, path: str, keys: list[str]) -> None:
    """Make the ledger of a table that was written without one (its rows are read once)."""
    note(rows.select(*[F.col(k) for k in keys]).distinct(), path)
