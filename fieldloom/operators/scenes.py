"""Scene selection: quality gate, best scene per window, coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import DEFAULTS


def quality_gate(scenes: DataFrame, cloud_max: float = DEFAULTS.cloud_max,
                 nodata_max: float = DEFAULTS.nodata_max) -> DataFrame:
    ok = (F.col("cloud_cover") <= cloud_max) & (F.col("nodata_pct") <= nodata_max)
    return scenes.withColumn("usable", ok)


def best_scene(scenes: DataFrame, keys: list[str], gate: str = "after") -> DataFrame:
    """Flag the least cloudy scene per key as ``selected`` (ties: scene_id).

    gate="after":  the best scene must also be usable, else none is chosen;
    gate="before": best among the usable ones;  gate="none": no gate.
    The winner is a partial aggregate, then joined back on the unique
    scene_id, so a key with very many scenes never meets in one task."""
    pool = scenes.filter("usable") if gate == "before" else scenes
    best = (pool.groupBy(*keys).agg(F.min(F.struct("cloud_cover", "scene_id")).alias("b"))
            .select(F.col("b.scene_id").alias("scene_id"), F.lit(True).alias("__best")))
    chosen = F.coalesce(F.col("__best"), F.lit(False))
    if gate == "after":
        chosen = chosen & F.col("usable")
    return scenes.join(best, "scene_id", "left").withColumn("selected", chosen).drop("__best")


def season_mode(scenes: DataFrame, gate_first: bool = False) -> DataFrame:
    return best_scene(scenes, ["mgrs_tile", "season", "dekad"],
                      "before" if gate_first else "after")


def event_mode(scenes: DataFrame) -> DataFrame:
    return best_scene(scenes, ["mgrs_tile", "date"], "none")


def selected_counts(scenes: DataFrame) -> DataFrame:
    return (scenes.filter("selected").groupBy("season", "mgrs_tile")
            .agg(F.count(F.lit(1)).alias("n_selected")))


def coverage(scenes: DataFrame, seasons: list[int], tiles: list | None = None) -> DataFrame:
    """Every expected (season, tile) with its number of selected scenes.
    Without a tile list the tiles seen in any season are expected."""
    if tiles is None:
        base = scenes.select("mgrs_tile").distinct()
    else:
        spark = scenes.sparkSession
        base = spark.createDataFrame([(t,) for t in tiles],
                                     f"mgrs_tile {scenes.schema['mgrs_tile'].dataType.simpleString()}")
    expected = base.withColumn("season", F.explode(F.array(*[F.lit(s) for s in seasons])))
    return (expected.join(selected_counts(scenes), ["season", "mgrs_tile"], "left")
            .select("season", "mgrs_tile",
                    F.coalesce("n_selected", F.lit(0).cast("bigint")).alias("n_selected")))


def latest_present_season(obs: DataFrame, seasons: list[int]) -> DataFrame:
    """One row: the newest configured season that has data (null if none)."""
    return obs.filter(F.col("season").isin(seasons)).agg(F.max("season").alias("season"))
