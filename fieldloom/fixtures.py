"""Domain inputs derived from the given tables by integer arithmetic, so that
both engines agree on them exactly."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import geometry as G
from .functions import scalars as S

TILE_PX = 8
PIXEL = 5.0
STRIDE = 40.0
GRID_TOP = 400.0
DEKADS = range(37)  # every ten days of a year
EPSG = 32615
CELL = 100.0
BEFORE = "season = 1998 and dekad < 18"
AFTER = "season = 1998 and dekad >= 18"
BAND = 30


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """One of the given tables; its schema is read from the file once."""
    path = f"{sf}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def scenes(spark: SparkSession, sf: str) -> DataFrame:
    date = F.col("o_orderdate").cast("date")
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("scene_id"),
        (F.col("o_custkey") % 29).cast("int").alias("mgrs_tile"), date.alias("date"),
        F.year(date).alias("season"), S.dekad(date).alias("dekad"),
        ((F.col("o_orderkey") * 7919) % 101).cast("int").alias("cloud_cover"),
        ((F.col("o_orderkey") * 104729) % 41).cast("int").alias("nodata_pct"))


def fields(spark: SparkSession, sf: str, ell: bool = False) -> DataFrame:
    """Rectangles; with ``ell`` every fourth one lacks its upper right quarter."""
    k = F.col("p_partkey")
    base = table(spark, sf, "part").select(
        k.alias("field_id"), ((k * 37) % 1000).cast("int").alias("x0"),
        ((k * 91) % 1000).cast("int").alias("y0"),
        (F.col("p_size") % 13 + 4).cast("int").alias("w"),
        (k % 11 + 4).cast("int").alias("h"), (F.col("p_size") % 5).cast("int").alias("crop"))
    x0, y0 = F.col("x0"), F.col("y0")
    x1, y1 = x0 + F.col("w"), y0 + F.col("h")
    xm, ym = x0 + F.col("w") / 2, y0 + F.col("h") / 2
    poly = G.rectangle(x0, y0, x1, y1)
    if ell:
        cut = F.array(F.array(G.point(x0, y0), G.point(x1, y0), G.point(x1, ym), G.point(xm, ym),
                              G.point(xm, y1), G.point(x0, y1), G.point(x0, y0)))
        poly = F.when(F.col("field_id") % 4 == 0, cut).otherwise(poly)
    return base.withColumn("poly", poly)


def field_points(spark: SparkSession, sf: str) -> DataFrame:
    """Fields with centre (x, y), integer position units and area."""
    return (fields(spark, sf)
            .withColumn("x", F.col("x0") + F.col("w") / 2)
            .withColumn("y", F.col("y0") + F.col("h") / 2)
            .withColumn("lat", 2 * F.col("y0") + F.col("h"))
            .withColumn("lon", 2 * F.col("x0") + F.col("w"))
            .withColumn("area_m2", (F.col("w") * F.col("h")).cast("double")))


def zones(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("r_regionkey")
    ax, bx = 100 + 120 * k, 700 - 40 * k
    ay, by = 150 + 60 * k, 800 - 90 * k
    return table(spark, sf, "region").select(
        k.alias("zone_id"), (k % 3 + 1).cast("int").alias("gust_class"),
        G.rectangle(F.least(ax, bx), F.least(ay, by), F.greatest(ax, bx), F.greatest(ay, by))
        .alias("poly"))


def regions(spark: SparkSession, sf: str) -> DataFrame:
    """25 counties of 200 x 200 units, by nation."""
    k = F.col("n_nationkey")
    x, y = (k % 5) * 200, F.floor(k / 5) * 200
    return table(spark, sf, "nation").select(
        k.alias("geoid"), F.col("n_regionkey").alias("state"),
        G.rectangle(x, y, x + 200, y + 200).alias("poly"))


def parcels(spark: SparkSession, sf: str) -> DataFrame:
    """Boundary layer of 50 x 50 unit squares, by supplier."""
    k = F.col("s_suppkey")
    x, y = (k * 53) % 1000, (k * 71) % 1000
    return table(spark, sf, "supplier").select(
        k.alias("geoid"), (F.col("s_nationkey") % 5).alias("state"),
        G.rectangle(x, y, x + 50, y + 50).alias("poly"))


def tiles(spark: SparkSession, sf: str) -> DataFrame:
    v = F.col("vec_id")
    x, y = (v % 10).cast("int"), (F.floor(v / 10) % 10).cast("int")
    scl = F.transform(F.sequence(F.lit(0), F.lit(63)),
                      lambda i: ((v * 5 + i * 7) % 12).cast("int"))
    return table(spark, sf, "embeddings").select(
        F.floor(v / 100).alias("scene_id"), x.alias("x"), y.alias("y"),
        (x * STRIDE).alias("ulx"), (F.lit(GRID_TOP) - y * STRIDE).alias("uly"),
        F.lit(PIXEL).alias("scale_x"), F.lit(-PIXEL).alias("scale_y"),
        F.lit(TILE_PX).alias("w"), F.lit(TILE_PX).alias("h"),
        F.col("embedding").alias("red"), F.reverse("embedding").alias("nir"), scl.alias("scl"))


def bands(spark: SparkSession, sf: str) -> DataFrame:
    """Long form: one row per (scene, band, tile)."""
    named = F.array(*[F.struct(F.lit(b).alias("band"),
                               F.col(b).cast("array<float>").alias("data"))
                      for b in ("red", "nir", "scl")])
    keep = ["scene_id", "x", "y", "ulx", "uly", "scale_x", "scale_y", "w", "h"]
    return tiles(spark, sf).select(*keep, F.inline(named))


def tile_meta(spark: SparkSession, sf: str) -> DataFrame:
    """Scene attributes of the tile table."""
    s = F.col("scene_id")
    date = F.date_add(F.to_date(F.lit("2020-05-01")), (s * 7).cast("int"))
    return (tiles(spark, sf).select("scene_id").distinct().select(
        s, F.element_at(F.array(F.lit("15TVF"), F.lit("15TVG"), F.lit("15TVH")),
                        (s % 3 + 1).cast("int")).alias("mgrs_tile"),
        date.alias("date"), S.dekad(date).alias("dekad"), F.year(date).alias("season"),
        F.lit(EPSG).alias("epsg")))


def observations(spark: SparkSession, sf: str) -> DataFrame:
    date = F.col("l_shipdate").cast("date")
    return table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("field_id"), date.alias("date"), F.year(date).alias("season"),
        S.dekad(date).alias("dekad"), F.col("l_suppkey").cast("int").alias("mgrs_tile"),
        (F.col("l_discount") * 10 - 0.2).alias("mean_ndvi"),
        (F.col("l_quantity") / 50).alias("valid_frac"))


def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")
