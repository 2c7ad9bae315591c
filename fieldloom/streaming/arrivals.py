"""Streaming: arrival of catalogue items and the ten-day roll-up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..contracts import DEFAULTS
from ..operators import incremental
from ..shared import materialize
from ..sinks import tables as sink


def read_stream(spark: SparkSession, path: str, schema: T.StructType, pattern: str | None = None,
                files_per_trigger: int | None = None, fmt: str = "parquet") -> DataFrame:
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.format(fmt).load(path)


def first_arrivals(stream: DataFrame, key: str, ts: str = "ts", delay: str = "30 days") -> DataFrame:
    """Each key once; copies that arrive within the delay are dropped, rows
    older than the watermark are late and dropped."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def dekad_rollup(stream: DataFrame, value: str, by: str, ts: str = "ts", delay: str = "2 days",
                 start: str = "3 days") -> DataFrame:
    """Ten-day tumbling count and mean per ``by``; emitted once a window can
    no longer change.  ``start`` lines the windows up with the year's periods
    (windows count from 1970-01-01, years do not)."""
    return (stream.withWatermark(ts, delay)
            .groupBy(F.window(ts, "10 days", startTime=start).alias("w"), by)
            .agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean_value"))
            .select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), by, "n",
                    "mean_value"))


def drain(df: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Run the stream over everything available into a parquet table and wait."""
    query = (df.writeStream.format("parquet").outputMode("append")
             .option("path", out).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def classify(stream: DataFrame, key: str, out: str, checkpoint: str, ts: str = "ts",
             delay: str = "30 days") -> StreamingQuery:
    """Every arrived row with its ``kind``: ``first`` of its key, ``copy`` of one that arrived before (or
    in the same batch: the earliest by time and value is the first), or ``late``: older than
    the newest time of all earlier batches less the delay.  No row is dropped.

    Rows go to ``out``, cut by batch and kind.  A batch reads what earlier batches left
    (firsts young enough to have copies, and the newest time), so a batch that is run again
    replaces its own rows and nothing else."""
    def step(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        edge = before = None
        if sink.holds_rows(spark, out):
            before = spark.read.parquet(out).filter(F.col("batch") < batch)
            edge = before.agg((F.max(ts) - F.expr(f"INTERVAL {delay}")).alias("edge")).first()[0]
        old = F.lit(False) if edge is None else F.coalesce(F.col(ts) < F.lit(edge), F.lit(False))
        # equal rows are counted first, so a key that arrives very often stays small
        counted = materialize(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("__n"))
                              .withColumn("__late", old), "arrived")
        line = F.struct(ts, *[c for c in sorted(rows.columns) if c not in (key, ts)])
        firsts = counted.filter(~F.col("__late")).groupBy(key).agg(F.min(line).alias("__first"))
        if edge is not None:
            # a first is remembered until it is older than the edge by the delay
            known = (before.filter("kind = 'first'").filter(F.col(ts) >= F.lit(edge) - F.expr(f"INTERVAL {delay}"))
                     .select(F.col(key).alias("__seen")))
            firsts = firsts.join(known, F.col(key).eqNullSafe(F.col("__seen")), "left_anti")
        firsts = firsts.select(F.col(key).alias("__key"), "__first")
        found = counted.join(firsts, F.col(key).eqNullSafe(F.col("__key")) & line.eqNullSafe(F.col("__first"))
                             & ~F.col("__late"), "left")
        copies = F.array_repeat(F.when(F.col("__late"), "late").otherwise("copy"), F.col("__n").cast("int") - 1)
        head = (F.when(F.col("__late"), "late").when(F.col("__first").isNotNull(), "first").otherwise("copy"))
        sink.replace_partitions(found.select(
            *rows.columns, F.lit(batch).cast("long").alias("batch"),
            F.explode(F.concat(F.array(head), copies)).alias("kind")), out, ["batch", "kind"])

    return _each_batch(stream, step, checkpoint)


def refresh_from(stream: DataFrame, path: str, checkpoint: str, days: int = DEFAULTS.trailing_days) -> StreamingQuery:
    """Take arriving items into the stored manifest, batch by batch."""
    return _each_batch(stream, lambda rows, _: incremental.refresh(path, rows, days), checkpoint)


def _each_batch(stream: DataFrame, step, checkpoint: str) -> StreamingQuery:
    query = (stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def late_rows(query: StreamingQuery) -> int:
    """Rows that all stateful operators dropped as late."""
    return sum(op.numRowsDroppedByWatermark
               for p in query.recentProgress for op in p.stateOperators)
