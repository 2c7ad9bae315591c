"""Increments: absent partitions, trailing-window refresh, catch-up report."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import DEFAULTS
from ..shared import materialize, sized_join
from ..sinks import tables as sink
from . import ledger
from .ordered import running_sums
from .scenes import quality_gate, season_mode

PART = ["date", "mgrs_tile"]
WINDOW_PARTS = ["season", "dekad"]  # partitions of the stored manifest


def todo(selected: DataFrame, written: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Selected scenes whose partition is not written yet.  The distinct
    partition keys are few compared with the rows they stand for."""
    keys = keys or PART
    return sized_join(selected, written.select(*keys).distinct(), keys, "left_anti",
                      max_rows=1_000_000)


def run_increment(selected: DataFrame, path: str,
                  process: Callable[[DataFrame], DataFrame],
                  layout: list[str] | None = None) -> None:
    """Process the scenes whose (date, tile) is not in the table yet and add them.

    The restart unit is one scene's own (date, tile), whatever folders (``layout``)
    the table is cut into: a scene that arrives late in a season long written is still
    missing.  What is written is read from the table's ledger, never from the table.
    Running it again adds nothing; a run that failed half-way has added none and is
    repeated."""
    ledger.settle(selected.sparkSession, path)
    open_ = ledger.missing(selected, path, PART)
    if open_.isEmpty():
        return
    # scenes are spread one by one, all in one job
    ledger.add(process(open_.repartition("scene_id")), open_.select(*PART), path, layout or PART)


def append_new(df: DataFrame, path: str, parts: list[str], keys: list[str]) -> None:
    """Append the rows whose ``keys`` the table's ledger does not hold: a repeat adds none."""
    ledger.settle(df.sparkSession, path)
    new = ledger.missing(df, path, keys)
    if not new.isEmpty():
        ledger.add(new, new.select(*keys), path, parts)


def trailing(items: DataFrame, days: int = DEFAULTS.trailing_days) -> DataFrame:
    """Rows of the last ``days`` days before the newest date."""
    newest = items.agg(F.max("date")).scalar()
    return items.withColumn("__newest", newest).filter(
        F.col("date") >= F.date_sub("__newest", days)).drop("__newest")


def reselect(scenes: DataFrame, late: DataFrame, days: int = DEFAULTS.trailing_days,
             gate_first: bool = False) -> DataFrame:
    """Manifest after late items arrived: windows that reach into the trailing
    days are selected anew, the selection of older ones stays as it was.

    A window that straddles the edge is resolved over all its scenes.  ``late``
    items older than the trailing days only add rows, never a selection."""
    keys = ["mgrs_tile", "season", "dekad"]
    both = (scenes.unionByName(late.withColumn("selected", F.lit(None).cast("boolean")),
                               allowMissingColumns=True))
    newest = both.agg(F.max("date")).scalar()
    dated = both.withColumn("__fresh", F.col("date") >= F.date_sub(newest, days))
    live = dated.filter("__fresh").select(*keys).distinct().withColumn("__live", F.lit(True))
    marked = sized_join(dated, live, keys, "left", max_rows=1_000_000)
    fresh = season_mode(quality_gate(marked.filter("__live").drop("selected")), gate_first)
    old = quality_gate(marked.filter(F.col("__live").isNull())).withColumn(
        "selected", F.coalesce("selected", F.lit(False)))
    return fresh.unionByName(old).drop("__fresh", "__live")


def refresh(path: str, late: DataFrame, days: int = DEFAULTS.trailing_days) -> None:
    """Take ``late`` items into the stored manifest at ``path`` (cut by ``WINDOW_PARTS``).

    Only partitions that reach into the trailing days are read, selected anew and
    overwritten; items of older partitions are added to them, never selected, and leave
    the files there as they are.  Items the table already holds are passed over, so a
    repeated batch changes nothing."""
    spark = late.sparkSession
    known, late = spark.read.parquet(path), materialize(late.dropDuplicates(["scene_id"]), "late")
    newest = max(filter(None, (known.agg(F.max("date")).first()[0], late.agg(F.max("date")).first()[0])), default=None)
    if newest is None:
        return
    fresh = F.col("date") >= F.date_sub(F.lit(newest), days)
    # as many as the trailing days have windows
    spots = (known.filter(fresh).select(*WINDOW_PARTS).unionByName(late.filter(fresh).select(*WINDOW_PARTS))
             .distinct().collect())
    live = reduce(or_, [(F.col("season") == s) & (F.col("dekad") == d) for s, d in spots], F.lit(False))
    arrived = late.join(known.select("scene_id", *WINDOW_PARTS), ["scene_id", *WINDOW_PARTS], "left_anti")
    arrived = materialize(quality_gate(arrived), "arrived")
    before = known.filter(live)
    now = reselect(before, arrived.filter(live).drop("usable"), days).select(*known.columns)
    sink.replace_partitions(materialize(now, "refreshed"), path, WINDOW_PARTS)
    closed = arrived.filter(~live).withColumn("selected", F.lit(False)).select(*known.columns)
    if not closed.isEmpty():
        sink.append(closed, path, WINDOW_PARTS)


def catch_up_report(selected: DataFrame, written: DataFrame) -> DataFrame:
    """Per season: partitions expected, present and missing."""
    want = selected.select("season", *PART).distinct()
    have = written.select(*PART).distinct().withColumn("__w", F.lit(1))
    return (want.join(have, PART, "left").groupBy("season")
            .agg(F.count(F.lit(1)).alias("expected"), F.count("__w").alias("present"),
                 F.count_if(F.col("__w").isNull()).alias("missing")))


BATCHED = ["scene_id", "x", "y"]


def batch_plan(tiles: DataFrame, most: int, bytes_of: Column | None = None) -> DataFrame:
    """scene_id, x, y, batch (from 0): tiles packed in order until a batch holds ``most``
    bytes (a larger tile is a batch of its own).  Bands count four bytes a pixel unless
    ``bytes_of`` says otherwise; pixels are not read.  The running sum is taken over range
    partitions, so neither a scene nor the table has to fit a task."""
    size = F.col("w").cast("bigint") * F.col("h") * 12 if bytes_of is None else bytes_of
    sized = tiles.select(*BATCHED, size.alias("__bytes"))
    summed = running_sums(sized, [], "scene_id", {"__upto": "__bytes"}, ["x", "y"])
    # by the byte a tile begins at: a batch is exceeded by less than one tile
    return summed.select(*BATCHED, F.floor((F.col("__upto") - F.col("__bytes")) / F.lit(most)).alias("batch"))
