"""Shared pieces of the raster queries."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions import raster as R
from ..operators import grid, zonal
from ..shared import materialize


def scene_grid(spark: SparkSession, sf: str) -> DataFrame:
    """Stored scene table."""
    return grid.scene_table(grid.scene_grids(fx.tiles(spark, sf)).withColumn("epsg", F.lit(fx.EPSG)))


def field_boxes(spark: SparkSession, sf: str, ell: bool = False) -> DataFrame:
    f = fx.fields(spark, sf, ell).select(
        "field_id", (F.col("w") * F.col("h")).cast("double").alias("area_m2"),
        F.lit(fx.EPSG).alias("epsg"), "poly")
    return grid.field_boxes(f)


def assigned(spark: SparkSession, sf: str, ell: bool = False,
             grids: DataFrame | None = None) -> DataFrame:
    """(grid_id, x, y, field) assignment."""
    grids = grids if grids is not None else scene_grid(spark, sf)
    return grid.assign_tiles(grid.shared_grids(grids), field_boxes(spark, sf, ell), fx.CELL)


def scene_tiles(spark: SparkSession, sf: str, grids: DataFrame | None = None) -> DataFrame:
    """Tiles with their grid_id and the index array."""
    grids = grids if grids is not None else scene_grid(spark, sf)
    named = zonal.sized_join(fx.tiles(spark, sf), grids.select("scene_id", "grid_id"), ["scene_id"])
    return named.withColumn("ndvi", R.tile_ndvi("red", "nir", "scl"))


def stored_masks(spark: SparkSession, sf: str, grids: DataFrame, ell: bool = False) -> DataFrame:
    """Zone raster of :func:`assigned`."""
    return materialize(grid.field_pixels(assigned(spark, sf, ell, grids), fx.TILE_PX), "masks")


def index_tiles(spark: SparkSession, sf: str, grids: DataFrame) -> DataFrame:
    """What the zonal statistics need of :func:`scene_tiles`."""
    return scene_tiles(spark, sf, grids).select("scene_id", *zonal.SPOT, "w", "ndvi")


def pairs(spark: SparkSession, sf: str, ell: bool = False) -> DataFrame:
    """Per (scene, tile, field) sum and count of the valid pixels."""
    grids = scene_grid(spark, sf)
    return zonal.pair_stats(stored_masks(spark, sf, grids, ell), index_tiles(spark, sf, grids))
