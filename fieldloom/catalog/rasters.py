"""Queries: raster functions."""

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions import raster as R
from ..operators import grid, zonal
from ..shared import materialize
from .base import query
from .zonal_parts import assigned, pairs, scene_grid, scene_tiles

ELL_ON = """cx >= x0 AND cx < x0 + w AND cy >= y0 AND cy < y0 + h
  AND NOT (field_id % 4 = 0 AND cx >= mx AND cy >= my)"""
ZONAL = f"""SELECT scene_id, field_id, px.x, px.y, count(ndvi) AS n, round(sum(ndvi), 6) AS total
  FROM px JOIN fl ON {ELL_ON} GROUP BY ALL HAVING count(ndvi) > 0"""


def r6(c):
    return F.round(c, 6)


def checksum(df, column, keys=("scene_id", "x", "y")):
    """Position-weighted sum of an array column, per tile."""
    px = df.select(*keys, F.posexplode(column).alias("i", "v"))
    return px.groupBy(*keys).agg(F.count("v").alias("n"), r6(F.sum(
        F.col("v").cast("double") * F.col("i"))).alias("checksum"))


@query("ra1_envelope", "rt", """SELECT scene_id, x, y, (40.0 * x)::DOUBLE AS xmin, (360.0 - 40 * y)::DOUBLE AS ymin,
  (40.0 * x + 40)::DOUBLE AS xmax, (400.0 - 40 * y)::DOUBLE AS ymax FROM rt""")
def _(spark, sf):
    return fx.tiles(spark, sf).select("scene_id", "x", "y", R.envelope().alias("e")).select(
        "scene_id", "x", "y", "e.*")


@query("ra2_resample", "px", """SELECT scene_id, x, y, count(*) AS n, round(CAST(sum(
  ((vec_id * 5 + (((i // 8) // 2) * 4 + (i % 8) // 2) * 7) % 12) * i) AS DOUBLE), 6) AS checksum FROM px GROUP BY ALL""")
def _(spark, sf):
    coarse = fx.tiles(spark, sf).withColumn("scl", F.slice("scl", 1, 16))
    return checksum(coarse.withColumn("fine", R.resample_nearest("scl", "w", 2)), "fine")


@query("ra3_band_stack", "px", """SELECT scene_id, x, y, round(sum(red), 6) AS red, round(sum(nir), 6) AS nir,
  CAST(sum(scl) AS BIGINT) AS scl FROM px GROUP BY ALL""")
def _(spark, sf):
    px = fx.tiles(spark, sf).select("scene_id", "x", "y", F.inline(R.stack("red", "nir", "scl")))
    total = lambda c: r6(F.sum(F.col(c).cast("double"))).alias(c)
    return px.groupBy("scene_id", "x", "y").agg(total("red"), total("nir"), F.sum("scl").alias("scl"))


NDVI = """SELECT scene_id, x, y, count(ndvi) AS n, round(sum(ndvi * i), 6) AS checksum FROM px GROUP BY ALL"""


@query("ra4_masked_ndvi", "px", NDVI)
def _(spark, sf):
    # pixel rows: the index itself stays inside code generation
    px = fx.tiles(spark, sf).select("scene_id", "x", "y", F.posexplode(
        R.stack("red", "nir", "scl")).alias("i", "p")).select("scene_id", "x", "y", "i", "p.*")
    value = px.withColumn("v", R.pixel_ndvi("red", "nir", "scl"))
    return value.groupBy("scene_id", "x", "y").agg(
        F.count("v").alias("n"), r6(F.sum(F.col("v") * F.col("i"))).alias("checksum"))


@query("ra5_ndvi_arrow", "px", NDVI)
def _(spark, sf):
    return checksum(fx.tiles(spark, sf).withColumn(
        "ndvi", R.tile_ndvi_arrow("red", "nir", "scl")), "ndvi")


@query("ra6_masked_fraction", "px", """SELECT scene_id, x, y,
  avg(CASE WHEN scl IN (0, 1, 3, 8, 9, 10, 11) THEN 1.0 ELSE 0.0 END) AS masked_frac FROM px GROUP BY ALL""")
def _(spark, sf):
    return fx.tiles(spark, sf).select("scene_id", "x", "y",
                                      R.masked_fraction("scl").alias("masked_frac"))


@query("ra7_zonal_direct", "px fl", ZONAL)
def _(spark, sf):
    grids = scene_grid(spark, sf)
    tiles = scene_tiles(spark, sf, grids).select("scene_id", *zonal.SPOT, "ndvi")
    stats = zonal.pixel_stats(tiles, materialize(assigned(spark, sf, True, grids), "spots"), fx.TILE_PX)
    return stats.select("scene_id", "field_id", "x", "y", F.col("count").alias("n"),
                        r6("sum").alias("total"))


@query("ra8_zone_raster", "px fl", ZONAL)
def _(spark, sf):
    return pairs(spark, sf, ell=True).select("scene_id", "field_id", "x", "y",
                                             F.col("count").alias("n"), r6("sum").alias("total"))


@query("ra9_reflectance", "px", """SELECT scene_id, x, y, count(*) AS n, round(sum(i * CASE WHEN vec_id % 2 = 0
  THEN red ELSE red * 0.5 - 0.125 END), 6) AS checksum FROM px GROUP BY ALL""")
def _(spark, sf):
    done = F.col("x") % 2 == 0  # these tiles were scaled by their reader
    return checksum(fx.tiles(spark, sf).withColumn("v", R.reflectance(
        "red", F.lit(0.5), F.lit(-0.125), done)), "v")


@query("ra10_decimate", "px", """SELECT scene_id, x, y, count(*) AS n, round(sum(red * k), 6) AS checksum FROM (
  SELECT *, ((i // 8) // 3) * 3 + (i % 8) // 3 AS k FROM px WHERE (i // 8) % 3 = 0 AND (i % 8) % 3 = 0)
  GROUP BY ALL""")
def _(spark, sf):
    return checksum(fx.tiles(spark, sf).withColumn("v", R.decimate("red", "w", 3)), "v")


@query("ra11_terrain", "px fl", f"""SELECT px.scene_id, field_id, count(*) AS n, round(avg(px.red), 6) AS elev,
  round(avg(degrees(atan(sqrt(((e.red - w_.red) / 10) ** 2 + ((s.red - n_.red) / 10) ** 2)))), 6) AS slope
  FROM px JOIN fl ON {ELL_ON}
  LEFT JOIN px e ON e.scene_id = px.scene_id AND e.col = px.col + 1 AND e.row_ = px.row_
  LEFT JOIN px w_ ON w_.scene_id = px.scene_id AND w_.col = px.col - 1 AND w_.row_ = px.row_
  LEFT JOIN px s ON s.scene_id = px.scene_id AND s.col = px.col AND s.row_ = px.row_ + 1
  LEFT JOIN px n_ ON n_.scene_id = px.scene_id AND n_.col = px.col AND n_.row_ = px.row_ - 1 GROUP BY ALL""")
def _(spark, sf):
    grids = scene_grid(spark, sf)
    dem = scene_tiles(spark, sf, grids).withColumn("data", F.col("red").cast("array<double>"))
    spots = assigned(spark, sf, True, grids)
    out = zonal.terrain(dem, materialize(grid.field_pixels(spots, fx.TILE_PX), "masks"))
    return out.select("scene_id", "field_id", "n", r6("elev").alias("elev"), r6("slope").alias("slope"))
