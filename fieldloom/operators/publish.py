"""Publishing: before/after pivots, season pivot, quantised features, tiles."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..contracts import DEFAULTS
from ..functions import scalars as S
from ..shared import spread
from .ordered import running_sums


def on_date(day: str) -> Column:
    return F.col("date") == F.to_date(F.lit(day))


def before_after(obs: DataFrame, before: Column, after: Column, valid: str = "max",
                 valid_min: float | None = None, both: bool = False) -> DataFrame:
    """One row per field: value and validity on both sides of the event.

    valid="max" is the publishing variant, "min" the study variant;
    ``valid_min`` drops observations first, ``both`` keeps fields that have a
    value on both sides."""
    pick = {"max": F.max, "min": F.min}[valid]
    if valid_min is not None:
        obs = obs.filter(F.col("valid_frac") >= valid_min)
    wide = obs.groupBy("field_id").agg(
        F.max(F.when(before, F.col("mean_ndvi"))).alias("pre"),
        pick(F.when(before, F.col("valid_frac"))).alias("pre_vf"),
        F.max(F.when(after, F.col("mean_ndvi"))).alias("post"),
        pick(F.when(after, F.col("valid_frac"))).alias("post_vf"))
    return wide.filter(F.col("pre").isNotNull() & F.col("post").isNotNull()) if both else wide


def best_row(obs: DataFrame, season: Column | None = None) -> DataFrame:
    """Per (field, dekad) the row with the highest validity; value and
    validity come from that same row."""
    if season is not None:
        obs = obs.filter(F.col("season") == season)
    win = F.max(F.struct("valid_frac", "mean_ndvi"))
    return (obs.groupBy("field_id", "dekad").agg(win.alias("b"))
            .select("field_id", "dekad", F.col("b.mean_ndvi").alias("mean_ndvi"),
                    F.col("b.valid_frac").alias("valid_frac")))


def season_pivot(narrow: DataFrame, dekads: list[int],
                 valid_min: float = DEFAULTS.valid_frac_min) -> DataFrame:
    """Narrow (field, dekad) rows -> one code column ``d<dekad>`` per period,
    255 where the field has no valid row."""
    codes = narrow.select("field_id", "dekad",
                          S.quantise("mean_ndvi", "valid_frac", valid_min=valid_min).alias("q"))
    return codes.groupBy("field_id").agg(*[
        F.coalesce(F.max(F.when(F.col("dekad") == d, F.col("q"))), F.lit(255)).alias(f"d{d}")
        for d in dekads])


def season_wide(obs: DataFrame, season: Column, dekads: list[int],
                valid_min: float = DEFAULTS.valid_frac_min) -> DataFrame:
    """best_row, then its codes gathered into one map per field (a dekad is one row there, so a
    field has as many entries as the season has periods) and laid out as columns: two narrow
    aggregations, whatever the number of periods."""
    code = S.quantise("mean_ndvi", "valid_frac", valid_min=valid_min)
    entry = F.when(F.col("dekad").isin(dekads), F.struct("dekad", code.alias("q")))
    codes = best_row(obs, season).groupBy("field_id").agg(F.map_from_entries(F.collect_list(entry)).alias("codes"))
    return codes.select("field_id", *[
        F.coalesce(F.try_element_at("codes", F.lit(d)), F.lit(255)).alias(f"d{d}") for d in dekads])


def first_dates(obs: DataFrame, season: Column | None = None) -> DataFrame:
    if season is not None:
        obs = obs.filter(F.col("season") == season)
    return obs.groupBy("dekad").agg(F.min("date").alias("min_date"))


def coded(wide: DataFrame, valid_min: float = DEFAULTS.valid_frac_min) -> DataFrame:
    return (wide.withColumn("pre_q", S.quantise("pre", "pre_vf", valid_min=valid_min))
            .withColumn("post_q", S.quantise("post", "post_vf", valid_min=valid_min))
            .withColumn("drop_q", S.quantise_change("pre", "post", "pre_vf", "post_vf",
                                                    valid_min=valid_min)))


def tile_index(lon: Column, lat: Column, zoom: Column) -> tuple[Column, Column]:
    """Web-mercator tile of a position (degrees)."""
    n = F.pow(F.lit(2.0), zoom)
    rad = F.radians(lat)
    x = F.floor((lon + 180.0) / 360.0 * n)
    y = F.floor((1 - F.log(F.tan(rad) + 1 / F.cos(rad)) / math.pi) / 2 * n)
    top = n.cast("bigint") - 1
    clip = lambda c: F.greatest(F.lit(0), F.least(c, top)).cast("int")
    return clip(x), clip(y)


SPREAD = 4  # a tile's features are spread over 2^4 x 2^4 cells


def budget_tiles(fields: DataFrame, z0: int, z1: int, budget: int, size: str = "bytes",
                 key: str = "field_id", weight: str = "area_m2") -> DataFrame:
    """Features per (zoom, tile) whose ``size`` adds up to ``budget`` bytes at most: z, tx,
    ty, key, size.

    The densest places lose first: a tile's cells (tiles four zooms deeper) take turns, largest
    ``weight`` of each first, and the tile is filled in the order of these turns until the budget is
    reached.  Both steps are running sums over range partitions, so the one tile that holds all
    features at a low zoom is cut like any other."""
    zoomed = fields.withColumn("z", F.explode(F.sequence(F.lit(z0), F.lit(z1))))
    tx, ty = tile_index(F.col("lon"), F.col("lat"), F.col("z"))
    cx, cy = tile_index(F.col("lon"), F.col("lat"), F.col("z") + SPREAD)
    spots = zoomed.select("z", tx.alias("tx"), ty.alias("ty"), cx.alias("__cx"), cy.alias("__cy"), key,
                          F.col(size).cast("bigint").alias(size), (-F.col(weight)).alias("__light"),
                          F.lit(1).cast("bigint").alias("__one"))
    turns = running_sums(spots, ["z", "tx", "ty", "__cx", "__cy"], "__light", {"__turn": "__one"}, [key])
    filled = running_sums(turns, ["z", "tx", "ty"], "__turn", {"__upto": size}, ["__light", key])
    return filled.filter(F.col("__upto") <= budget).select("z", "tx", "ty", key, size)


def thin_tiles(fields: DataFrame, z0: int, z1: int, k: int, size: str = "area_m2",
               key: str = "field_id") -> DataFrame:
    """Features per (zoom, tile); a tile keeps its ``k`` largest.

    What a tile keeps is among what its parts at the next zoom keep: the deepest tiles choose first, among
    rows spread over all cores, and only the rows they keep are laid out for every zoom.  Each
    map task keeps k rows per tile before the shuffle, so dense tiles stay small."""
    def largest(rows: DataFrame) -> DataFrame:
        order = Window.partitionBy("z", "tx", "ty").orderBy(F.desc(size), key)
        return rows.withColumn("__rn", F.row_number().over(order)).filter(F.col("__rn") <= k).drop("__rn")

    z0, z1 = min(z0, z1), max(z0, z1)
    tx, ty = tile_index(F.col("lon"), F.col("lat"), F.lit(z1))
    deepest = largest(spread(fields.select(F.lit(z1).alias("z"), tx.alias("tx"), ty.alias("ty"), key, size)))
    up = F.lit(z1) - F.col("zoom")
    zoomed = deepest.withColumn("zoom", F.explode(F.sequence(F.lit(z0), F.lit(z1)))).select(
        F.col("zoom").alias("z"), *[F.call_function("shiftright", F.col(c), up).alias(c) for c in ("tx", "ty")], key, size)
    return largest(zoomed)
