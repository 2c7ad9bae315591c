"""Queries: projections, filters, predicates."""

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..contracts import GUST_CLASSES
from ..functions import geometry as G
from ..operators import fields, grid, publish, scenes, study
from ..sources import catalogue, polygons, tables
from .base import query
from .sources import HOSTS
from .zonal_parts import pairs


@query("f1_min_area", "fl", "SELECT field_id, area_m2 FROM fl WHERE area_m2 >= 60")
def _(spark, sf):
    return fields.min_area(fx.fields(spark, sf), 60).select("field_id", "area_m2")


@query("f2_inset_nonempty", "fl", "SELECT field_id, w, h FROM fl WHERE least(w, h) > 6")
def _(spark, sf):
    return fields.inset_nonempty(fx.fields(spark, sf), 3).select("field_id", "w", "h")


@query("f3_scene_gate", "sg", "SELECT scene_id, cloud_cover, nodata_pct, usable FROM sg")
def _(spark, sf):
    return scenes.quality_gate(fx.scenes(spark, sf)).select(
        "scene_id", "cloud_cover", "nodata_pct", "usable")


@query("f4_scope", "ob", """SELECT field_id, date, mgrs_tile FROM ob WHERE mgrs_tile IN (1, 2, 3, 5, 8)
  AND season IN (1995, 1996)""")
def _(spark, sf):
    return tables.in_scope(fx.observations(spark, sf), [1, 2, 3, 5, 8], [1995, 1996]).select(
        "field_id", "date", "mgrs_tile")


@query("f5_selected_in_tiles", "sel", """SELECT scene_id, mgrs_tile, date FROM sel WHERE selected
  AND mgrs_tile IN (0, 4, 7, 11, 28)""")
def _(spark, sf):
    chosen = scenes.season_mode(scenes.quality_gate(fx.scenes(spark, sf)))
    return tables.selected_in_tiles(chosen, [0, 4, 7, 11, 28]).select(
        "scene_id", "mgrs_tile", "date")


@query("f6_crop_class", "fl", "SELECT field_id, crop FROM fl WHERE crop = 1")
def _(spark, sf):
    return fx.fields(spark, sf).filter("crop = 1").select("field_id", "crop")


@query("f7_nonempty_pairs", "px fl", """SELECT scene_id, field_id, x, y, count(ndvi) AS n FROM px
  JOIN fl ON cx > x0 AND cx < x0 + w AND cy > y0 AND cy < y0 + h GROUP BY ALL HAVING count(ndvi) > 0""")
def _(spark, sf):
    return pairs(spark, sf).select("scene_id", "field_id", "x", "y", F.col("count").alias("n"))


@query("f8_usable", "frame", "SELECT field_id, pre, post, pre_vf, post_vf, usable, strict FROM (SELECT *, "
       "coalesce(pre IS NOT NULL AND post IS NOT NULL AND pre_vf >= 0.8 AND post_vf >= 0.8, false) AS strict"
       " FROM frame)")
def _(spark, sf):
    wide = publish.before_after(fx.observations(spark, sf), F.expr(fx.BEFORE), F.expr(fx.AFTER))
    strict = study.usable(wide, 0.8).withColumnRenamed("usable", "strict")
    return study.usable(strict).select("field_id", "pre", "post", "pre_vf", "post_vf", "usable",
                                       "strict")


@query("f9_grid_overlap", "fl", """SELECT field_id, ix0, ix1, iy0, iy1 FROM (SELECT field_id,
  CAST(floor(x0 / 40) AS INT) AS ix0, CAST(floor((x0 + w) / 40) AS INT) AS ix1,
  CAST(floor((400 - y0 - h) / 40) AS INT) AS iy0, CAST(floor((400 - y0) / 40) AS INT) AS iy1 FROM fl)
  WHERE ix1 >= 0 AND ix0 <= 9 AND iy1 >= 0 AND iy0 <= 9""")
def _(spark, sf):
    b = G.bbox("poly")
    index = lambda v: F.floor(v / fx.STRIDE).cast("int")
    ranged = fx.fields(spark, sf).select(
        "field_id", index(b["xmin"]).alias("ix0"), index(b["xmax"]).alias("ix1"),
        index(fx.GRID_TOP - b["ymax"]).alias("iy0"), index(fx.GRID_TOP - b["ymin"]).alias("iy1"))
    last = F.lit(9)
    return ranged.filter(grid.numbers_between(F.col("ix0"), F.col("ix1"), last).isNotNull()
                         & grid.numbers_between(F.col("iy0"), F.col("iy1"), last).isNotNull())


@query("f10_prefix_columns", "fl", """SELECT field_id, crop AS "CDL2020", (crop + 1) % 5 AS "cdl2021" FROM fl""")
def _(spark, sf):
    wide = fx.fields(spark, sf).withColumn("CDL2020", F.col("crop")).withColumn(
        "cdl2021", (F.col("crop") + 1) % 5)
    return wide.select("field_id", *polygons.with_prefix_columns(wide, "CDL"))


@query("f11_ordinal_class", "fl", """SELECT field_id, CAST(crop % 3 + 1 AS INT) AS gust_class,
  ['60-79 mph', '80-99 mph', '100+ mph'][crop % 3 + 1] AS label FROM fl""")
def _(spark, sf):
    names = F.array(*[F.lit(n) for n in GUST_CLASSES])
    labelled = fx.fields(spark, sf).select(
        "field_id", F.element_at(names, F.col("crop") % 3 + 1).alias("label"))
    return fields.ordinal_class(labelled, "label", GUST_CLASSES)


@query("f12_prefix_rewrite", "sc", """SELECT scene_id, CASE WHEN scene_id % 2 = 0 THEN 's3a://imagery/'
  ELSE 's3a://mirror/' END || scene_id || '/red.tif' AS href FROM sc""")
def _(spark, sf):
    host = F.when(F.col("scene_id") % 2 == 0, F.lit("https://imagery.example.org/")).otherwise(
        F.lit("https://mirror.example.net/"))
    href = F.concat(host, F.col("scene_id").cast("string"), F.lit("/red.tif"))
    return fx.scenes(spark, sf).select("scene_id", href.alias("href")).select(
        "scene_id", catalogue.rewrite_prefix(F.col("href"), HOSTS).alias("href"))


@query("f13_latest_season", "ob", "SELECT max(season) AS season FROM ob WHERE season IN (1995, 1997, 2020)")
def _(spark, sf):
    return scenes.latest_present_season(fx.observations(spark, sf), [1995, 1997, 2020])


@query("f14_before_after_label", "ob", """SELECT CASE WHEN date < DATE '1996-08-10' THEN 'before'
  ELSE 'after' END AS side, count(*) AS n FROM ob GROUP BY ALL""")
def _(spark, sf):
    side = F.when(F.col("date") < F.to_date(F.lit("1996-08-10")), "before").otherwise("after")
    return fx.observations(spark, sf).groupBy(side.alias("side")).agg(F.count(F.lit(1)).alias("n"))
