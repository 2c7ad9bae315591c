"""Queries: scans and sources."""

from datetime import datetime, timezone

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixtures as fx
from ..functions import geometry as G
from ..functions import projection as P
from ..operators import quality
from ..shared import shared_folder
from ..sinks import features
from ..sources import catalogue, polygons, rasters, tables
from .base import query
from .projection_sql import lonlat_sql

COLLECTION = "field-imagery"
HOSTS = {"https://imagery.example.org/": "s3a://imagery/", "https://mirror.example.net/": "s3a://mirror/"}


def items(spark, sf):
    """Catalogue items with some members absent, from the scene fixture."""
    s = F.col("scene_id")
    tile = F.concat((F.col("mgrs_tile") % 3 + 14).cast("string"), F.lit("TV"),
                    F.char(F.col("mgrs_tile") + 65))
    host = F.when(s % 2 == 0, F.lit("https://imagery.example.org/")).otherwise(
        F.lit("https://mirror.example.net/"))
    band = lambda b: F.struct(
        F.concat(host, s.cast("string"), F.lit(f"/{b}.tif")).alias("href"),
        F.when(s % 4 != 0, F.array(F.struct(F.lit(0.0001).alias("scale"),
                                            F.lit(-0.1).alias("offset")))).alias("raster:bands"))
    return fx.scenes(spark, sf).select(
        s.cast("string").alias("id"),
        F.when(s % 13 == 0, F.lit("other")).otherwise(F.lit(COLLECTION)).alias("collection"),
        F.struct(
            F.concat(F.col("date").cast("string"), F.lit("T17:00:00Z")).alias("datetime"),
            F.concat(F.lit("MGRS-"), tile).alias("grid:code"),
            F.when(s % 10 != 0, F.col("cloud_cover").cast("double")).alias("eo:cloud_cover"),
            F.when(s % 11 != 0, F.col("nodata_pct").cast("double"))
            .alias("s2:nodata_pixel_percentage"),
            F.when(s % 3 != 0, F.lit(32615)).alias("proj:epsg")).alias("properties"),
        F.create_map(F.lit("red"), band("red"), F.lit("nir"), band("nir"),
                     F.lit("scl"), band("scl")).alias("assets"))


ITEM_SQL = """SELECT *, CAST(scene_id AS VARCHAR) AS id,
  CAST(mgrs_tile % 3 + 14 AS VARCHAR) || 'TV' || chr(mgrs_tile + 65) AS tile,
  CASE WHEN scene_id % 2 = 0 THEN 's3a://imagery/' ELSE 's3a://mirror/' END || scene_id AS base FROM sc"""


@query("s1_polygon_scan", "fl", """SELECT field_id,
  CAST(CASE WHEN field_id % 4 = 0 THEN 0.75 ELSE 1.0 END * w * h AS DOUBLE) AS area,
  CAST(CASE WHEN field_id % 4 = 0 THEN 7 ELSE 5 END AS INT) AS n_points FROM fl""")
def _(spark, sf):
    path = shared_folder(spark, "s1")
    polygons.encode_wkb(fx.fields(spark, sf, ell=True).select("field_id", "poly"),
                        "poly").write.parquet(path)
    return polygons.read_wkb_polygons(spark, path).select(
        "field_id", G.area("poly").alias("area"), F.size(F.col("poly")[0]).alias("n_points"))


@query("s2_retile", "px", """SELECT scene_id, CAST(col // 16 AS INT) AS x, CAST(row_ // 16 AS INT) AS y,
  count(*) AS n, round(sum(((row_ % 16) * 16 + col % 16) * red), 6) AS checksum FROM px GROUP BY ALL""")
def _(spark, sf):
    px = rasters.tiles_to_pixels(fx.tiles(spark, sf), ["scene_id"], "red")
    tiles = rasters.pixels_to_tiles(px, ["scene_id"], 16)
    positions = F.posexplode("data").alias("at", "v")
    return (tiles.select("scene_id", "x", "y", positions).groupBy("scene_id", "x", "y")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.round(F.sum(F.col("at") * F.col("v").cast("double")), 6).alias("checksum")))


@query("s3_tagged_scan", "rt", """SELECT scene_id, count(*) AS n_tiles, CAST(sum(x) AS BIGINT) AS sum_x
  FROM rt GROUP BY scene_id""")
def _(spark, sf):
    root = shared_folder(spark, "s3")
    named = fx.tiles(spark, sf).withColumn("folder", F.concat(F.lit("scene_"), "scene_id"))
    named.drop("scene_id").write.partitionBy("folder").parquet(root)
    manifest = fx.tile_meta(spark, sf).select(
        "scene_id", F.concat(F.lit("folder=scene_"), "scene_id").alias("href"))
    return (rasters.read_tagged(spark, root, manifest).groupBy("scene_id")
            .agg(F.count(F.lit(1)).alias("n_tiles"), F.sum("x").alias("sum_x")))


@query("s4_table_scan", "ob", """SELECT season, count(*) AS n, round(sum(mean_ndvi), 6) AS total
  FROM ob WHERE season IN (1996, 1997) GROUP BY season""")
def _(spark, sf):
    path = shared_folder(spark, "s4")
    fx.observations(spark, sf).write.partitionBy("season").parquet(path)
    scan = tables.in_scope(spark.read.parquet(path), seasons=[1996, 1997])
    return scan.groupBy("season").agg(F.count(F.lit(1)).alias("n"),
                                      F.round(F.sum("mean_ndvi"), 6).alias("total"))


@query("s5_item_manifest", "sc", f"""SELECT id AS scene_id, tile AS mgrs_tile, date, dekad, season,
  CASE WHEN scene_id % 10 <> 0 THEN CAST(cloud_cover AS DOUBLE) ELSE 100.0 END AS cloud_cover,
  CASE WHEN scene_id % 11 <> 0 THEN CAST(nodata_pct AS DOUBLE) ELSE 0.0 END AS nodata_pct,
  CAST(CASE WHEN scene_id % 3 <> 0 THEN 32615 ELSE 32614 + mgrs_tile % 3 END AS INT) AS epsg,
  base || '/red.tif' AS red_href, base || '/nir.tif' AS nir_href, base || '/scl.tif' AS scl_href,
  CASE WHEN scene_id % 4 <> 0 THEN 0.0001 ELSE 1.0 END::DOUBLE AS red_scale,
  CASE WHEN scene_id % 4 <> 0 THEN -0.1 ELSE 0.0 END::DOUBLE AS red_offset,
  CASE WHEN scene_id % 4 <> 0 THEN 0.0001 ELSE 1.0 END::DOUBLE AS nir_scale,
  CASE WHEN scene_id % 4 <> 0 THEN -0.1 ELSE 0.0 END::DOUBLE AS nir_offset, true AS stamped FROM ({ITEM_SQL})""")
def _(spark, sf):
    path = shared_folder(spark, "s5")
    items(spark, sf).write.json(path)
    stored = shared_folder(spark, "s5-manifest")
    before = datetime.now(timezone.utc)
    catalogue.manifest_rows(catalogue.read_items(spark, path), HOSTS).write.parquet(stored)
    after = datetime.now(timezone.utc)
    rows = spark.read.parquet(stored)
    in_time = F.col("ingested_at").between(F.lit(before), F.lit(after))
    return rows.withColumn("stamped", in_time).drop("ingested_at")


@query("s6_item_search", "sc", f"""SELECT id, tile, date FROM ({ITEM_SQL}) WHERE scene_id % 13 <> 0
  AND mgrs_tile < 20 AND (date BETWEEN DATE '1996-04-30' AND DATE '1996-09-29'
  OR date BETWEEN DATE '1997-05-01' AND DATE '1997-09-30')""")
def _(spark, sf):
    root = shared_folder(spark, "s6")
    page = F.floor(F.col("id").cast("bigint") / 50)
    pages = (items(spark, sf).groupBy(page.alias("page"))
             .agg(F.collect_list(F.struct("id", "collection", "properties", "assets"))
                  .alias("features")).select("features"))
    pages.write.json(f"{root}/first", compression="lz4")
    # the same items on a second set of pages
    spark.read.text(f"{root}/first").write.text(f"{root}/again", compression="lz4")
    found = catalogue.search(
        catalogue.read_pages(spark, f"{root}/first", f"{root}/again"), COLLECTION,
        [f"{14 + t % 3}TV{chr(65 + t)}" for t in range(20)],
        [("1996-04-30", "1996-09-29"), ("1997-05-01", "1997-09-30")])
    return found.select("id", G.tile_name("properties.`grid:code`").alias("tile"),
                        F.to_date(F.substring("properties.datetime", 1, 10)).alias("date"))


@query("s7_vector_layer", "pc", f"""SELECT geoid, round(lon, 6) AS lon, round(lat, 6) AS lat FROM (
  SELECT geoid, {lonlat_sql('100000.0 + 100 * rx0', '2000000.0 + 100 * ry0')} FROM pc WHERE state = 2)""")
def _(spark, sf):
    path = shared_folder(spark, "s7")
    moved = fx.parcels(spark, sf).withColumn(
        "poly", G.map_points("poly", lambda x, y: (100000.0 + 100 * x, 2000000.0 + 100 * y)))
    features.write_features(moved, ["geoid", "state"], path)
    props = T.StructType([T.StructField("geoid", T.LongType()),
                          T.StructField("state", T.IntegerType())])
    layer = polygons.read_geojson_lines(spark, path, props).filter("state = 2")
    degrees = layer.withColumn("poly", G.map_points("poly", P.conus_to_degrees))
    corner = F.col("poly")[0][0]
    return degrees.select("geoid", F.round(corner["x"], 6).alias("lon"),
                          F.round(corner["y"], 6).alias("lat"))


@query("s8_prefix_extract", "fl", """SELECT csbid, crop, n_min FROM (
  SELECT lpad(CAST(field_id % 50 AS VARCHAR), 2, '0') || lpad(CAST(field_id AS VARCHAR), 9, '0') AS csbid,
  crop FROM fl) , (SELECT true AS n_min) WHERE csbid LIKE '19%'""")
def _(spark, sf):
    path = shared_folder(spark, "s8")
    key = F.concat(F.lpad((F.col("field_id") % 50).cast("string"), 2, "0"),
                   F.lpad(F.col("field_id").cast("string"), 9, "0"))
    fx.fields(spark, sf).select(key.alias("csbid"), "crop").write.parquet(path)
    state = polygons.prefix_extract(spark.read.parquet(path), "csbid", "19")
    enough = quality.row_count_check(state, "state", 1, "extract").select("passed").scalar()
    return state.select("csbid", "crop", enough.alias("n_min"))


def runs(spark, sf):
    """One run per season of the observations."""
    return (fx.observations(spark, sf).groupBy(F.col("season").alias("run_seq"))
            .agg(F.max("date").alias("committed_at"), F.count(F.lit(1)).alias("n_rows")))


RUNS_SQL = """SELECT season AS run_seq, max(date) AS committed_at, count(*) AS n_rows FROM ob GROUP BY season"""


@query("s9_latest_runs", "ob", f"SELECT * FROM ({RUNS_SQL}) ORDER BY committed_at DESC, run_seq DESC LIMIT 2")
def _(spark, sf):
    return tables.latest_runs(runs(spark, sf))


@query("s10_as_of", "ob", """SELECT season AS run_seq, count(*) AS n FROM ob WHERE season <= 1996 GROUP BY season""")
def _(spark, sf):
    path = shared_folder(spark, "s10")
    fx.observations(spark, sf).withColumn("run_seq", F.col("season")).write.partitionBy(
        "run_seq").parquet(path)
    return (tables.as_of(spark.read.parquet(path), 1996).groupBy("run_seq")
            .agg(F.count(F.lit(1)).alias("n")))


@query("s11_newest_row", "sc", """SELECT scene_id, mgrs_tile,
  CAST(CASE WHEN scene_id % 2 = 0 THEN cloud_cover + 1 ELSE cloud_cover END AS INT) AS cloud_cover,
  CAST(CASE WHEN scene_id % 2 = 0 THEN 2 ELSE 1 END AS INT) AS ingested_at FROM sc""")
def _(spark, sf):
    root = shared_folder(spark, "s11")
    first = fx.scenes(spark, sf).select("scene_id", "mgrs_tile", "cloud_cover",
                                        F.lit(1).alias("ingested_at"))
    first.write.parquet(f"{root}/a")
    (first.filter("scene_id % 2 = 0")
     .select("scene_id", "mgrs_tile", (F.col("cloud_cover") + 1).cast("int").alias("cloud_cover"),
             F.lit(2).alias("ingested_at")).write.parquet(f"{root}/b"))
    return tables.newest_per_key(spark.read.parquet(f"{root}/*"), ["scene_id"], ["ingested_at"])


@query("s12_window_read", "px", """SELECT scene_id, count(*) AS n, round(sum(red), 6) AS red,
  round(sum(nir), 6) AS nir, CAST(sum(coarse) AS BIGINT) AS coarse FROM (SELECT px.*,
  (vec_id * 5 + (((i // 8) // 2) * 4 + (i % 8) // 2) * 7) % 12 AS coarse FROM px)
  WHERE cx BETWEEN 100 AND 300 AND cy BETWEEN 60 AND 260 GROUP BY scene_id""")
def _(spark, sf):
    from ..functions import raster as R
    tiles = fx.tiles(spark, sf).withColumn(
        "fine", R.resample_nearest(F.slice("scl", 1, 16), "w", 2))
    px = rasters.window_pixels(tiles, ["red", "nir", "fine"], 100, 60, 300, 260)
    total = lambda c: F.round(F.sum(F.col(c).cast("double")), 6).alias(c)
    return px.groupBy("scene_id").agg(F.count(F.lit(1)).alias("n"), total("red"), total("nir"),
                                      F.sum("fine").alias("coarse"))


@query("s13_slice_merge", "ob", """SELECT CAST(mgrs_tile % 6 AS INT) AS slice, count(*) AS n,
  round(sum(valid_frac), 6) AS total FROM ob GROUP BY ALL""")
def _(spark, sf):
    root = shared_folder(spark, "s13")
    (fx.observations(spark, sf).withColumn("slice", F.col("mgrs_tile") % 6)
     .write.partitionBy("slice").parquet(root))
    expected = spark.createDataFrame([(str(i),) for i in range(6)], "slice string")
    return (tables.merge_slices(spark, expected, root).groupBy("slice")
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("valid_frac"), 6).alias("total")))
