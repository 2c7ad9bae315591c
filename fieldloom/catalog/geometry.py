"""Queries: geometry functions and map tiles."""

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions import geometry as G
from ..functions import projection as P
from ..operators import publish, quality, spatial
from ..sinks import features
from ..sources import polygons
from .base import query
from .projection_sql import lonlat_sql, utm_sql

CUT = "field_id % 4 = 0"


def ells(spark, sf):
    return fx.fields(spark, sf, ell=True)


def in_metres(spark, sf):
    """Fields moved into the extent of the equal-area projection."""
    return fx.fields(spark, sf).withColumn("poly", G.map_points(
        "poly", lambda x, y: (100000.0 + 100 * x, 2000000.0 + 100 * y)))


METRES = ("100000.0::DOUBLE + 100 * x0", "2000000.0::DOUBLE + 100 * y0")


@query("g1_area", "fl", f"""SELECT field_id, CAST(CASE WHEN {CUT} THEN 0.75 ELSE 1.0 END * w * h AS DOUBLE)
  AS area FROM fl""")
def _(spark, sf):
    return ells(spark, sf).select("field_id", G.area("poly").alias("area"))


@query("g2_centroid", "fl", f"""SELECT field_id,
  round(CASE WHEN {CUT} THEN x0 + w * 5 / 12 ELSE mx END, 6) AS cx,
  round(CASE WHEN {CUT} THEN y0 + h * 5 / 12 ELSE my END, 6) AS cy FROM fl""")
def _(spark, sf):
    c = G.centroid("poly")
    return ells(spark, sf).select("field_id", F.round(c["x"], 6).alias("cx"),
                                  F.round(c["y"], 6).alias("cy"))


@query("g3_bbox", "fl", """SELECT field_id, x0::DOUBLE AS xmin, y0::DOUBLE AS ymin,
  (x0 + w)::DOUBLE AS xmax, (y0 + h)::DOUBLE AS ymax FROM fl""")
def _(spark, sf):
    return ells(spark, sf).select("field_id", G.bbox("poly").alias("b")).select("field_id", "b.*")


@query("g4_reproject", "fl", f"""SELECT field_id, zone, round(lon, 6) AS lon, round(lat, 6) AS lat,
  round(east, 3) AS east, round(north, 3) AS north FROM (SELECT *, {utm_sql('lon', 'lat', 'zone')} FROM (
  SELECT *, CAST(floor((lon + 180) / 6) + 1 AS INT) AS zone FROM (
  SELECT field_id, {lonlat_sql(*METRES)} FROM fl)))""")
def _(spark, sf):
    degrees = in_metres(spark, sf).withColumn("deg", G.map_points("poly", P.conus_to_degrees))
    corner = F.col("deg")[0][0]
    zoned = degrees.withColumn("zone", G.utm_zone(corner["x"]))
    utm = zoned.withColumn("utm", G.map_points(
        "deg", lambda x, y: P.degrees_to_utm(x, y, F.col("zone"))))
    spot = F.col("utm")[0][0]
    return utm.select("field_id", "zone", F.round(corner["x"], 6).alias("lon"),
                      F.round(corner["y"], 6).alias("lat"), F.round(spot["x"], 3).alias("east"),
                      F.round(spot["y"], 3).alias("north"))


@query("g5_utm_zone", "fl", """SELECT field_id, CAST(floor((lon / 10.0 - 100 + 180) / 6) + 1 AS INT) AS zone
  FROM fl""")
def _(spark, sf):
    lon = F.col("lon") / 10 - 100
    return fx.field_points(spark, sf).select("field_id", G.utm_zone(lon).alias("zone"))


@query("g6_inset_membership", "fl px", """SELECT field_id, count(*) AS n FROM fl JOIN
  (SELECT DISTINCT cx, cy FROM px) ON least(cx - x0, x0 + w - cx, cy - y0, y0 + h - cy) >= 1.5
  GROUP BY field_id""")
def _(spark, sf):
    hits = spatial.locate(pixel_centres(spark, sf), fx.fields(spark, sf).select(
        "field_id", "poly", F.col("poly").alias("ring")), fx.CELL)
    deep = G.edge_distance("ring", "x", "y") >= 1.5
    return hits.filter(deep).groupBy("field_id").agg(F.count(F.lit(1)).alias("n"))


def pixel_centres(spark, sf):
    """Distinct pixel centres of the tile table."""
    at = F.explode(F.sequence(F.lit(0), F.lit(fx.TILE_PX ** 2 - 1)))
    spots = fx.tiles(spark, sf).select("ulx", "uly").distinct().select("ulx", "uly", at.alias("at"))
    return spots.select((F.col("ulx") + (F.col("at") % 8 + 0.5) * fx.PIXEL).alias("x"),
                        (F.col("uly") - (F.floor(F.col("at") / 8) + 0.5) * fx.PIXEL).alias("y"))


@query("g7_point_in_polygon", "fl px", f"""SELECT field_id, count(*) AS n FROM fl JOIN
  (SELECT DISTINCT cx, cy FROM px) ON cx >= x0 AND cx < x0 + w AND cy >= y0 AND cy < y0 + h
  AND NOT ({CUT} AND cx >= mx AND cy >= my) GROUP BY field_id""")
def _(spark, sf):
    hits = spatial.locate(pixel_centres(spark, sf), ells(spark, sf).select("field_id", "poly"),
                          fx.CELL)
    return hits.groupBy("field_id").agg(F.count(F.lit(1)).alias("n"))


@query("g8_wkb_round_trip", "fl", f"""SELECT field_id, CAST(13 + 16 * CASE WHEN {CUT} THEN 7 ELSE 5 END AS INT)
  AS n_bytes, true AS same FROM fl""")
def _(spark, sf):
    coded = polygons.encode_wkb(ells(spark, sf).select("field_id", "poly"), "poly", "wkb")
    kept = coded.withColumn("n_bytes", F.length("wkb"))
    back = polygons.decode_wkb(kept, "wkb", "again")
    return back.join(ells(spark, sf).select("field_id", "poly"), "field_id").select(
        "field_id", "n_bytes", (F.col("again") == F.col("poly")).alias("same"))


@query("g9_overlap_by_class", "fl wz", """SELECT field_id, gust_class, CAST(sum(
  greatest(0, least(x0 + w, zx1) - greatest(x0, zx0)) * greatest(0, least(y0 + h, zy1) - greatest(y0, zy0)))
  AS DOUBLE) AS area FROM fl, wz GROUP BY ALL HAVING area > 0""")
def _(spark, sf):
    area = spatial.overlap_area(fx.fields(spark, sf), fx.zones(spark, sf), "field_id", fx.CELL,
                                by="gust_class")
    return area.withColumn("area", F.round("area", 6))


@query("g10_text", "fl", """SELECT field_id, 'POLYGON ((' || x0 || ' ' || y0 || ', ' || (x0 + w) || ' ' || y0
  || ', ' || (x0 + w) || ' ' || (y0 + h) || ', ' || x0 || ' ' || (y0 + h) || ', ' || x0 || ' ' || y0 || '))'
  AS wkt FROM fl""")
def _(spark, sf):
    return fx.fields(spark, sf).select("field_id", G.as_text("poly").alias("wkt"))


@query("g11_tile_epsg", "sc", """SELECT scene_id, CAST(14 + mgrs_tile % 3 AS VARCHAR) || 'TV' || chr(mgrs_tile + 65)
  AS tile, CAST(14 + mgrs_tile % 3 AS INT) AS zone, CAST(32614 + mgrs_tile % 3 AS INT) AS epsg FROM sc""")
def _(spark, sf):
    code = F.concat(F.lit("MGRS-"), (F.col("mgrs_tile") % 3 + 14).cast("string"), F.lit("TV"),
                    F.char(F.col("mgrs_tile") + 65))
    tile = fx.scenes(spark, sf).select("scene_id", G.tile_name(code).alias("tile"))
    return tile.select("scene_id", "tile", G.tile_zone("tile").alias("zone"),
                       G.tile_epsg("tile").alias("epsg"))


def in_degrees(spark, sf):
    """Field centres spread over a few degrees."""
    f = fx.field_points(spark, sf)
    return f.withColumn("lon", F.col("lon") / 200.0 - 96).withColumn("lat", F.col("lat") / 200.0 + 40)


@query("v1_thin_tiles", "fl", """SELECT z, tx, ty, field_id, area_m2 FROM (SELECT *, row_number() OVER (
  PARTITION BY z, tx, ty ORDER BY area_m2 DESC, field_id) AS rn FROM (SELECT z, field_id, area_m2,
  CAST(floor((lon / 200.0 - 96 + 180) / 360 * pow(2, z)) AS INT) AS tx, CAST(floor((1 - ln(tan(radians(
  lat / 200.0 + 40)) + 1 / cos(radians(lat / 200.0 + 40))) / pi()) / 2 * pow(2, z)) AS INT) AS ty
  FROM fl, (SELECT CAST(unnest(range(6, 13)) AS INT) AS z))) WHERE rn <= 10""")
def _(spark, sf):
    return publish.thin_tiles(in_degrees(spark, sf), 6, 12, 10)


LINE = """octet_length(encode('{"type":"Feature","properties":{"field_id":' || field_id ||
  '},"geometry":{"type":"Polygon","coordinates":[[[' || x0 || '.0,' || y0 || '.0],[' || (x0 + w) || '.0,'
  || y0 || '.0],[' || (x0 + w) || '.0,' || (y0 + h) || '.0],[' || x0 || '.0,' || (y0 + h) || '.0],[' || x0
  || '.0,' || y0 || '.0]]]}}')) + 1"""
TILE_BYTES = 2000
BUDGET = f"""SELECT z, tx, ty, field_id, CAST(bytes AS BIGINT) AS bytes FROM (
  SELECT *, sum(bytes) OVER (PARTITION BY z, tx, ty ORDER BY turn, area_m2 DESC, field_id) AS upto FROM (
  SELECT *, row_number() OVER (PARTITION BY z, tx, ty, cx, cy ORDER BY area_m2 DESC, field_id) AS turn FROM (
  SELECT z, field_id, area_m2, {LINE} AS bytes,
  CAST(floor(east * pow(2, z)) AS INT) AS tx, CAST(floor(south * pow(2, z)) AS INT) AS ty,
  CAST(floor(east * pow(2, z + 4)) AS INT) AS cx, CAST(floor(south * pow(2, z + 4)) AS INT) AS cy
  FROM (SELECT *, (lon / 200.0 - 96 + 180) / 360 AS east, (1 - ln(tan(radians(lat / 200.0 + 40))
  + 1 / cos(radians(lat / 200.0 + 40))) / pi()) / 2 AS south FROM fl),
  (SELECT CAST(unnest(range(6, 13)) AS INT) AS z)))) WHERE upto <= {TILE_BYTES}"""


def budgeted(spark, sf):
    sized = in_degrees(spark, sf).withColumn("bytes", quality.line_bytes(features.feature_json(["field_id"])))
    return publish.budget_tiles(sized, 6, 12, TILE_BYTES)


@query("v1_budget_tiles", "fl", BUDGET)
def _(spark, sf):
    return budgeted(spark, sf)


@query("v2_tile_budget", "fl", f"""SELECT 'tile_size_budget' AS check_name, 'demo' AS scope,
  '<= {TILE_BYTES} bytes a tile' AS expected, '0 of ' || count(*) || ' tiles above, largest ' || max(b) || ' bytes'
  AS observed, true AS passed FROM (SELECT sum(bytes) AS b FROM ({BUDGET}) GROUP BY z, tx, ty)""")
def _(spark, sf):
    return quality.tile_budget_check(budgeted(spark, sf), TILE_BYTES, "demo")


@query("v2_size_budget", "fl", f"""SELECT 'output_size_budget' AS check_name, 'demo' AS scope,
  '< 90000000 bytes' AS expected, sum({LINE}) || ' bytes' AS observed, true AS passed FROM fl""")
def _(spark, sf):
    lines = features.feature_lines(fx.fields(spark, sf), ["field_id"])
    return quality.size_budget_check(lines, 90_000_000, "demo")
