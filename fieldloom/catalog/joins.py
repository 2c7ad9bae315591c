"""Queries: joins."""

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions import raster as R
from ..operators import bands, grid, incremental, ledger, publish, scenes, spatial, study, zonal
from ..shared import materialize, shared_folder, sized_join
from .base import query
from .zonal_parts import assigned, field_boxes, scene_grid, scene_tiles

PAIR_ON = "cx > x0 AND cx < x0 + w AND cy > y0 AND cy < y0 + h"


@query("j1_band_join", "px", """SELECT scene_id, x, y, count(*) AS n, round(sum(red + 2 * nir + 3 * scl), 6)
  AS checksum FROM px GROUP BY ALL""")
def _(spark, sf):
    b = fx.bands(spark, sf)
    stacked = zonal.stack_bands(*[b.filter(F.col("band") == n) for n in ("red", "nir", "scl")])
    px = stacked.select("scene_id", "x", "y", F.inline(R.stack("red", "nir", "scl")))
    d = lambda c: F.col(c).cast("double")
    return px.groupBy("scene_id", "x", "y").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum(d("red") + 2 * d("nir") + 3 * d("scl")), 6).alias("checksum"))


@query("j2_scene_dimension", "meta", """SELECT scene_id, x, y, mgrs_tile, date, dekad, season, epsg
  FROM rt JOIN meta USING (scene_id)""")
def _(spark, sf):
    tiles = fx.tiles(spark, sf).select("scene_id", "x", "y")
    return sized_join(tiles, fx.tile_meta(spark, sf), ["scene_id"])


TILE_HIT = """t.x BETWEEN floor(x0 / 40) AND floor((x0 + w) / 40)
  AND t.y BETWEEN floor((400 - y0 - h) / 40) AND floor((400 - y0) / 40)"""


@query("j3_needed_tiles", "rt fl", f"""SELECT scene_id, x, y FROM rt t WHERE EXISTS (SELECT 1 FROM fl
  WHERE {TILE_HIT})""")
def _(spark, sf):
    grids = scene_grid(spark, sf)
    return zonal.keep_needed(scene_tiles(spark, sf, grids), assigned(spark, sf, grids=grids)).select(
        "scene_id", "x", "y")


@query("j4_unmasked_tiles", "px", """SELECT scene_id, x, y FROM px GROUP BY ALL
  HAVING count(*) FILTER (scl NOT IN (0, 1, 3, 8, 9, 10, 11) AND vec_id % 7 <> 0) > 0""")
def _(spark, sf):
    # every seventh tile is clouded over completely
    k = F.col("scene_id") * 100 + F.col("y") * 10 + F.col("x")
    tiles = fx.tiles(spark, sf).withColumn("scl", F.when(
        k % 7 == 0, F.transform("scl", lambda v: F.lit(9))).otherwise(F.col("scl")))
    return zonal.drop_masked(tiles, tiles.select(*zonal.TILE, "scl")).select("scene_id", "x", "y")


@query("j5_tile_assignment", "rt fl", f"""SELECT t.scene_id, field_id, t.x, t.y FROM rt t JOIN fl
  ON {TILE_HIT}""")
def _(spark, sf):
    grids = scene_grid(spark, sf)
    spots = assigned(spark, sf, grids=grids).select("grid_id", "field_id", "x", "y")
    return sized_join(spots, grids.select("grid_id", "scene_id"), ["grid_id"]).select(
        "scene_id", "field_id", "x", "y")


@query("j6_tile_field_pairs", "px fl", f"""SELECT scene_id, field_id, x, y, count(*) AS n_pixels
  FROM px JOIN fl ON {PAIR_ON} GROUP BY ALL""")
def _(spark, sf):
    grids = scene_grid(spark, sf)
    spots = assigned(spark, sf, grids=grids)
    masks = materialize(grid.field_pixels(spots, fx.TILE_PX).select("grid_id", "x", "y", "field_id", "runs"), "masks")
    ones = scene_tiles(spark, sf, grids).select("scene_id", *zonal.SPOT, "w",
                                         F.transform("scl", lambda v: F.lit(1.0)).alias("one"))
    return zonal.pair_stats(masks, ones, "one").select(
        "scene_id", "field_id", "x", "y", F.col("count").alias("n_pixels"))


@query("j7_zone_class", "wind", "SELECT * FROM wind")
def _(spark, sf):
    return spatial.zone_class(fx.field_points(spark, sf), fx.zones(spark, sf), "field_id", fx.CELL)


@query("j8_todo", "sel ob", """SELECT scene_id, date, mgrs_tile FROM sel WHERE selected AND NOT EXISTS (
  SELECT 1 FROM ob WHERE ob.date = sel.date AND ob.mgrs_tile % 29 = sel.mgrs_tile)""")
def _(spark, sf):
    chosen = scenes.season_mode(scenes.quality_gate(fx.scenes(spark, sf))).filter("selected")
    written = fx.observations(spark, sf).select("date", (F.col("mgrs_tile") % 29).alias("mgrs_tile"))
    path = shared_folder(spark, "j8")
    ledger.adopt(written, path, incremental.PART)
    return ledger.missing(chosen, path, incremental.PART).select("scene_id", "date", "mgrs_tile")


@query("j9_region_filter", "fl rg", """SELECT field_id FROM fl WHERE EXISTS (SELECT 1 FROM rg
  WHERE state = 2 AND mx >= rx0 AND mx < rx0 + 200 AND my >= ry0 AND my < ry0 + 200)""")
def _(spark, sf):
    region = fx.regions(spark, sf).filter("state = 2")
    return spatial.inside(fx.field_points(spark, sf), region, "field_id", fx.CELL).select("field_id")


COVERAGE = """SELECT season, mgrs_tile, count(scene_id) AS n_selected FROM
  (SELECT unnest([1996, 1997, 1998, 2022])::INT AS season) CROSS JOIN (SELECT DISTINCT mgrs_tile FROM sc)
  LEFT JOIN (SELECT * FROM sel WHERE selected) USING (season, mgrs_tile) GROUP BY ALL"""


@query("j10_coverage", "sel", COVERAGE)
def _(spark, sf):
    chosen = scenes.season_mode(scenes.quality_gate(fx.scenes(spark, sf)))
    return scenes.coverage(chosen, [1996, 1997, 1998, 2022])


@query("j11_obs_fields", "ob fl", """SELECT field_id, crop, area_m2, count(*) AS n,
  round(avg(mean_ndvi), 6) AS mean FROM ob JOIN fl USING (field_id) GROUP BY ALL""")
def _(spark, sf):
    # aggregated per field before the join: a field with very many rows costs one
    per_field = fx.observations(spark, sf).groupBy("field_id").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("mean_ndvi"), 6).alias("mean"))
    return per_field.join(fx.field_points(spark, sf).select("field_id", "crop", "area_m2"),
                          "field_id")


def frame(spark, sf, valid="max", valid_min=0.5):
    """The study frame of the fixtures (all crops)."""
    wide = publish.before_after(fx.observations(spark, sf), F.expr(fx.BEFORE), F.expr(fx.AFTER),
                                valid)
    points = fx.field_points(spark, sf)
    wind = spatial.zone_class(points, fx.zones(spark, sf), "field_id", fx.CELL)
    return study.event_frame(wide, points, wind, valid_min=valid_min)


def sides(spark, sf):
    ok = materialize(frame(spark, sf).filter("usable")
                     .select("field_id", "wind", "lat", "lon", "delta"), "frame")
    return ok.filter("wind > 0"), ok.filter("wind = 0")


@query("j12_band_match", "frame", """SELECT t.field_id, count(c.delta) AS ctrl_n,
  CASE WHEN count(c.delta) >= 5 THEN round(avg(c.delta), 9) END AS ctrl_delta
  FROM (SELECT * FROM frame WHERE usable AND wind > 0) t
  LEFT JOIN (SELECT * FROM frame WHERE usable AND wind = 0) c ON c.lat BETWEEN t.lat - 10 AND t.lat + 10
  GROUP BY ALL""")
def _(spark, sf):
    return bands.match_lat(*sides(spark, sf), 10).select(
        "field_id", "ctrl_n", F.round("ctrl_delta", 9).alias("ctrl_delta"))


@query("j13_band_match_2d", "frame", """SELECT t.field_id, count(c.delta) AS ctrl_n,
  CASE WHEN count(c.delta) >= 5 THEN round(avg(c.delta), 9) END AS ctrl_delta
  FROM (SELECT * FROM frame WHERE usable AND wind > 0) t
  LEFT JOIN (SELECT * FROM frame WHERE usable AND wind = 0) c ON c.lat >= t.lat - 160
  AND c.lat < t.lat + 160 AND abs(c.lon - t.lon) <= 160 GROUP BY ALL""")
def _(spark, sf):
    return bands.match_lat_lon(*sides(spark, sf), 160, 160).select(
        "field_id", "ctrl_n", F.round("ctrl_delta", 9).alias("ctrl_delta"))


@query("j14_overlap_area", "fl wz", """SELECT field_id, CAST(sum(
  greatest(0, least(x0 + w, zx1) - greatest(x0, zx0)) * greatest(0, least(y0 + h, zy1) - greatest(y0, zy0)))
  AS DOUBLE) AS area FROM fl, wz WHERE gust_class = 3 GROUP BY field_id HAVING area > 0""")
def _(spark, sf):
    top = fx.zones(spark, sf).filter("gust_class = 3")
    area = spatial.overlap_area(fx.fields(spark, sf), top, "field_id", fx.CELL)
    return area.withColumn("area", F.round("area", 6))


@query("j15_subregion", "frame rg", """SELECT frame.field_id, wind, usable FROM frame
  JOIN fl USING (field_id) WHERE EXISTS (SELECT 1 FROM rg WHERE geoid = 12 AND mx >= rx0
  AND mx < rx0 + 200 AND my >= ry0 AND my < ry0 + 200)""")
def _(spark, sf):
    f = frame(spark, sf).withColumn("x", F.col("lon") / 2).withColumn("y", F.col("lat") / 2)
    region = fx.regions(spark, sf).filter("geoid = 12")
    return spatial.inside(f, region, "field_id", fx.CELL).select("field_id", "wind", "usable")


@query("j16_join_cardinality", "rt fl", f"""SELECT (SELECT count(*) FROM rt) AS n_tiles,
  (SELECT count(DISTINCT x) FROM rt) AS n_tile_x, (SELECT count(*) FROM fl) AS n_fields,
  (SELECT count(*) FROM rt t JOIN fl ON {TILE_HIT}) AS n_pairs""")
def _(spark, sf):
    tiles = fx.tiles(spark, sf)
    # pairs = tiles per spot x fields per spot: counted without building them
    grids = scene_grid(spark, sf)
    per_spot = assigned(spark, sf, grids=grids).groupBy(*zonal.SPOT).agg(
        F.count(F.lit(1)).alias("f"))
    spots = (sized_join(tiles.select("scene_id", "x", "y"), grids.select("scene_id", "grid_id"),
                        ["scene_id"])
             .groupBy(*zonal.SPOT).agg(F.count(F.lit(1)).alias("t")))
    n_pairs = spots.join(per_spot, zonal.SPOT).agg(F.sum(F.col("t") * F.col("f"))).scalar()
    n_fields = field_boxes(spark, sf).agg(F.count(F.lit(1))).scalar()
    return (tiles.agg(F.count(F.lit(1)).alias("n_tiles"), F.count_distinct("x").alias("n_tile_x"))
            .select("n_tiles", "n_tile_x", n_fields.alias("n_fields"),
                    F.coalesce(n_pairs, F.lit(0)).alias("n_pairs")))
