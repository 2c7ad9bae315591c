"""Queries: aggregations, windows, sorts and set operations."""

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions import geometry as G
from ..operators import grid, incremental, ordered, publish, scenes, spatial, study, zonal
from ..plans import stages
from ..shared import materialize
from ..sources import tables
from .base import DEKADS, DID, query
from .joins import frame
from .sources import RUNS_SQL, runs
from .zonal_parts import assigned, index_tiles, scene_grid, stored_masks


OBS = fx.observations


def count(name):
    return F.count(F.lit(1)).alias(name)


def r6(c):
    return F.round(c, 6)


ROLLED = """SELECT field_id, date, dekad, season, mgrs_tile,
  CAST(32615 - 32600 AS INT) AS utm_zone, min(scene_id) AS scene_id, round(avg(ndvi), 6) AS mean_ndvi,
  CAST(count(ndvi) AS INT) AS valid_px, CAST(ceil(any_value(area_m2) / 25) AS INT) AS total_px,
  round(least(1.0, count(ndvi) / ceil(any_value(area_m2) / 25)), 6) AS valid_frac
  FROM px JOIN fl ON cx > x0 AND cx < x0 + w AND cy > y0 AND cy < y0 + h JOIN meta USING (scene_id)
  GROUP BY ALL HAVING count(ndvi) > 0"""


@query("a1_zonal_rollup", "px fl meta", ROLLED)
def _(spark, sf):
    grids = scene_grid(spark, sf)
    rolled = zonal.observe(stored_masks(spark, sf, grids), index_tiles(spark, sf, grids), fx.tile_meta(spark, sf),
                           "ndvi", fx.PIXEL ** 2)
    return rolled.withColumn("mean_ndvi", r6("mean_ndvi")).withColumn("valid_frac", r6("valid_frac"))


INSET = 2.0


@query("a1_zonal_stage", "px fl meta", f"""SELECT field_id, date, dekad, season, mgrs_tile,
  CAST(32615 - 32600 AS INT) AS utm_zone, min(scene_id) AS scene_id, round(avg(ndvi), 6) AS mean_ndvi,
  CAST(count(ndvi) AS INT) AS valid_px, CAST(ceil(any_value(area_m2) / 25) AS INT) AS total_px,
  round(least(1.0, count(ndvi) / ceil(any_value(area_m2) / 25)), 6) AS valid_frac
  FROM px JOIN fl ON cx >= x0 + {INSET} AND cx <= x0 + w - {INSET} AND cy >= y0 + {INSET} AND cy <= y0 + h - {INSET}
  JOIN meta USING (scene_id) GROUP BY ALL HAVING count(ndvi) > 0""")
def _(spark, sf):
    # the stage as a run does it: zone raster with an inset, stored; needed tiles only; roll-up
    fields = fx.fields(spark, sf).withColumn("epsg", F.lit(fx.EPSG)).withColumn("area_m2", G.area("poly"))
    grids = scene_grid(spark, sf)
    masks = materialize(stages.zone_raster(grids, fields, fx.TILE_PX, INSET, fx.CELL), "masks")
    rolled = stages.zonal_stage(fx.tiles(spark, sf), fx.tile_meta(spark, sf), grids, masks, fx.PIXEL ** 2)
    return rolled.withColumn("mean_ndvi", r6("mean_ndvi")).withColumn("valid_frac", r6("valid_frac"))


@query("a2_grid_recovery", "rt", """SELECT scene_id, 0.0::DOUBLE AS x0, 400.0::DOUBLE AS y0,
  40.0::DOUBLE AS stride, max(x) AS x_hi, max(y) AS y_hi FROM rt GROUP BY scene_id""")
def _(spark, sf):
    return grid.scene_grids(fx.tiles(spark, sf))


@query("a3_wide_max", "wide", "SELECT * FROM wide")
def _(spark, sf):
    return publish.before_after(OBS(spark, sf), F.expr(fx.BEFORE), F.expr(fx.AFTER))


@query("a4_wide_min", "ob", """SELECT field_id, max(mean_ndvi) FILTER (season = 1998 AND dekad < 18) AS pre,
  min(valid_frac) FILTER (season = 1998 AND dekad < 18) AS pre_vf,
  max(mean_ndvi) FILTER (season = 1998 AND dekad >= 18) AS post,
  min(valid_frac) FILTER (season = 1998 AND dekad >= 18) AS post_vf FROM ob GROUP BY field_id""")
def _(spark, sf):
    return publish.before_after(OBS(spark, sf), F.expr(fx.BEFORE), F.expr(fx.AFTER), "min")


BOTH = """SELECT field_id, max(mean_ndvi) FILTER (season = 1998 AND dekad < 18) AS pre,
  max(mean_ndvi) FILTER (season = 1998 AND dekad >= 18) AS post FROM ob WHERE valid_frac >= 0.5
  GROUP BY field_id HAVING pre IS NOT NULL AND post IS NOT NULL"""


@query("a5_wide_both_sides", "ob", BOTH)
def _(spark, sf):
    return publish.before_after(OBS(spark, sf), F.expr(fx.BEFORE), F.expr(fx.AFTER),
                                valid_min=0.5, both=True).select("field_id", "pre", "post")


BEST = """SELECT field_id, dekad, max(struct_pack(v := valid_frac, m := mean_ndvi)).m AS mean_ndvi,
  max(struct_pack(v := valid_frac, m := mean_ndvi)).v AS valid_frac FROM ob WHERE season = 1997
  GROUP BY field_id, dekad"""


@query("a6_best_row", "ob", BEST)
def _(spark, sf):
    return publish.best_row(OBS(spark, sf), F.lit(1997))


QUANT = "round_even(greatest(0, least(1, (mean_ndvi - -0.2) / (1.0 - -0.2))) * 200, 0)"
PIVOT = ", ".join(f"CAST(coalesce(max(q) FILTER (dekad = {d}), 255) AS INT) AS d{d}"
                  for d in DEKADS)


@query("a7_season_pivot", "ob", f"""SELECT field_id, {PIVOT} FROM (SELECT *, CASE WHEN valid_frac >= 0.5
  THEN {QUANT} ELSE 255 END AS q FROM ({BEST})) GROUP BY field_id""")
def _(spark, sf):
    return publish.season_wide(OBS(spark, sf), F.lit(1997), list(DEKADS))


@query("a7_pivot_of_best_rows", "ob", f"""SELECT field_id, {PIVOT} FROM (SELECT *, CASE WHEN valid_frac >= 0.5
  THEN {QUANT} ELSE 255 END AS q FROM ({BEST})) GROUP BY field_id""")
def _(spark, sf):
    return publish.season_pivot(publish.best_row(OBS(spark, sf), F.lit(1997)), list(DEKADS))


@query("a8_first_date", "ob", "SELECT dekad, min(date) AS min_date FROM ob WHERE season = 1997 GROUP BY dekad")
def _(spark, sf):
    return publish.first_dates(OBS(spark, sf), F.lit(1997))


@query("a9_max_class", "wind", "SELECT wind, count(*) AS n FROM wind GROUP BY wind")
def _(spark, sf):
    wind = spatial.zone_class(fx.field_points(spark, sf), fx.zones(spark, sf), "field_id", fx.CELL)
    return wind.groupBy("wind").agg(count("n"))


@query("a10_class_mean", "frame", """SELECT wind, count(*) AS n, round_even(avg(delta::DECIMAL(20, 12)), 4) AS mean_delta
  FROM frame WHERE usable GROUP BY wind""")
def _(spark, sf):
    return frame(spark, sf).filter("usable").groupBy("wind").agg(
        count("n"), F.bround(study.exact_avg("delta"), 4).alias("mean_delta"))


@query("a11_did_summary", "m10", f"{DID} FROM m10 GROUP BY wind")
def _(spark, sf):
    return study.did_table(study.matched(frame(spark, sf), 10))


ATTRITION = """SELECT f.wind, corn_fields, cloud_ok, matched,
  round_even(100 * (1 - cloud_ok / corn_fields), 1) AS dropped_pct,
  ['control', '60-79 mph', '80-99 mph', '100+ mph'][f.wind + 1] AS label FROM
  (SELECT wind, count(*) AS corn_fields, count(*) FILTER (usable) AS cloud_ok FROM {f} GROUP BY wind) f
  LEFT JOIN (SELECT wind, count(*) AS matched FROM {m} GROUP BY wind) m USING (wind)"""


@query("a12_attrition", "m10", ATTRITION.format(m="m10", f="frame"))
def _(spark, sf):
    f = materialize(frame(spark, sf), "frame")
    return study.attrition(f, study.matched(f, 10))


@query("a13_distinct_ids", "ob", """SELECT count(*) AS rows, count(DISTINCT field_id) AS ids,
  count(DISTINCT (field_id, date)) AS field_dates FROM ob""")
def _(spark, sf):
    # one hash aggregation per key set instead of expanding every row per distinct
    obs = OBS(spark, sf)
    dates = obs.groupBy("field_id", "date").agg(count("n")).groupBy("field_id").agg(
        F.sum("n").alias("n"), count("d"))
    return dates.agg(F.sum("n").alias("rows"), count("ids"), F.sum("d").alias("field_dates"))


@query("a14_usable_fraction", "ob", """SELECT mgrs_tile, date, count(*) AS field_obs,
  round(avg(CASE WHEN mean_ndvi IS NOT NULL AND valid_frac >= 0.5 THEN 1.0 ELSE 0.0 END), 3) AS usable_frac
  FROM ob WHERE season = 1998 GROUP BY mgrs_tile, date""")
def _(spark, sf):
    ok = F.col("mean_ndvi").isNotNull() & (F.col("valid_frac") >= 0.5)
    return OBS(spark, sf).filter("season = 1998").groupBy("mgrs_tile", "date").agg(
        count("field_obs"), F.round(F.avg(F.when(ok, 1.0).otherwise(0.0)), 3).alias("usable_frac"))


@query("a15_class_profile", "frame", """SELECT wind, count(*) AS n, round(avg(pre), 6) AS mean_pre,
  round(avg(post), 6) AS mean_post, round(avg(delta), 6) AS mean_delta, round(avg(lat), 6) AS mean_lat,
  round(avg(lon), 6) AS mean_lon, round(quantile_cont(lon, 0.1), 6) AS lon_p10,
  round(quantile_cont(lon, 0.9), 6) AS lon_p90 FROM frame WHERE usable GROUP BY wind""")
def _(spark, sf):
    prof = study.class_profile(frame(spark, sf))
    return prof.select("wind", "n", *[r6(c).alias(c) for c in prof.columns[2:]])


@query("a16_global_quantiles", "ob", """SELECT round(quantile_cont(valid_frac, 0.1), 6) AS p10,
  round(quantile_cont(valid_frac, 0.5), 6) AS p50, round(quantile_cont(valid_frac, 0.9), 6) AS p90 FROM ob""")
def _(spark, sf):
    q = ordered.quantiles(OBS(spark, sf), [], "valid_frac", {"p10": 0.1, "p50": 0.5, "p90": 0.9})
    return q.select(*[r6(c).alias(c) for c in ("p10", "p50", "p90")])


TERCILE = """SELECT wind, CASE WHEN lon <= c1 THEN 'west' WHEN lon <= c2 THEN 'mid' ELSE 'east' END AS bin,
  count(*) AS n, round_even(avg(did::DECIMAL(20, 12)), 4) AS did FROM {m}, (SELECT quantile_cont(lon, 1/3) AS c1,
  quantile_cont(lon, 2/3) AS c2 FROM {m}) GROUP BY ALL"""


@query("a17_tercile_effect", "m10", TERCILE.format(m="m10"))
def _(spark, sf):
    return study.tercile_effect(study.matched(frame(spark, sf), 10))


@query("a18_masked_tally", "px", """SELECT count(*) AS total, count(*) FILTER (open = 0) AS fully_masked FROM (
  SELECT vec_id, count(*) FILTER (scl NOT IN (0, 1, 3, 8, 9, 10, 11) AND vec_id % 7 <> 0) AS open
  FROM px GROUP BY vec_id)""")
def _(spark, sf):
    k = F.col("scene_id") * 100 + F.col("y") * 10 + F.col("x")
    return zonal.mask_tally(fx.tiles(spark, sf).withColumn("scl", F.when(
        k % 7 == 0, F.transform("scl", lambda v: F.lit(9))).otherwise(F.col("scl"))))


@query("a19_selected_counts", "sel", """SELECT season, mgrs_tile, count(*) AS n_selected FROM sel
  WHERE selected GROUP BY ALL""")
def _(spark, sf):
    return scenes.selected_counts(scenes.season_mode(scenes.quality_gate(fx.scenes(spark, sf))))


SERIES = """SELECT date, count(*) AS fields, round(avg(mean_ndvi::DECIMAL(20, 12)), 4) AS corn_mean_ndvi,
  round(avg(valid_frac::DECIMAL(20, 12)), 3) AS avg_valid_frac FROM ob JOIN fl USING (field_id)
  WHERE crop = 1 AND valid_frac >= 0.5 GROUP BY date"""


@query("a20_crop_series", "ob fl", SERIES)
def _(spark, sf):
    return study.crop_series(OBS(spark, sf), fx.fields(spark, sf), 1)


@query("a21_run_signature", "ob", """SELECT count(*) AS n, count(DISTINCT field_id) AS fields,
  round(sum(mean_ndvi), 4) AS sum_mean, CAST(sum(CAST(floor(valid_frac * 50 + 0.5) AS BIGINT)) AS BIGINT) AS sum_px,
  round(sum(valid_frac), 4) AS sum_frac FROM ob""")
def _(spark, sf):
    per_field = OBS(spark, sf).groupBy("field_id").agg(
        count("n"), F.sum("mean_ndvi").alias("m"),
        F.sum(F.floor(F.col("valid_frac") * 50 + 0.5)).alias("p"), F.sum("valid_frac").alias("v"))
    return per_field.agg(F.sum("n").alias("n"), count("fields"),
                         F.round(F.sum("m"), 4).alias("sum_mean"), F.sum("p").alias("sum_px"),
                         F.round(F.sum("v"), 4).alias("sum_frac"))


SWEEP = """SELECT '{label}' AS label, wind, count(*) AS fields, round_even(avg(did::DECIMAL(20, 12)), 4) AS did FROM (
  SELECT t.wind, t.delta - avg(c.delta) AS did FROM fr t JOIN fr c ON c.lat BETWEEN t.lat - {b} AND t.lat + {b}
  WHERE t.pre_vf >= {v} AND t.post_vf >= {v} AND c.pre_vf >= {v} AND c.post_vf >= {v} AND t.wind > 0
  AND c.wind = 0 GROUP BY t.field_id, t.wind, t.delta HAVING count(*) >= 5) GROUP BY wind"""


VARIANTS = (("vf0.5", 30, 0.5), ("vf0.8", 30, 0.8), ("narrow", 10, 0.5))


@query("a22_sensitivity", "frame", "SELECT * FROM (WITH fr AS (SELECT * FROM frame WHERE pre IS NOT NULL "
       "AND post IS NOT NULL) " + " UNION ALL ".join(
           SWEEP.format(label=n, b=b, v=v) for n, b, v in VARIANTS) + ")")
def _(spark, sf):
    return study.sensitivity(frame(spark, sf), {n: (v, b) for n, b, v in VARIANTS})


@query("a23_distinct_keys", "sc", "SELECT DISTINCT season, mgrs_tile, date FROM sc")
def _(spark, sf):
    return fx.scenes(spark, sf).select("season", "mgrs_tile", "date").distinct()


# --- windows ----------------------------------------------------------------

@query("w1a_best_scene_season", "sel", "SELECT scene_id, usable, selected FROM sel")
def _(spark, sf):
    return scenes.season_mode(scenes.quality_gate(fx.scenes(spark, sf))).select(
        "scene_id", "usable", "selected")


@query("w1a_gate_first", "sg", """SELECT scene_id FROM (SELECT *, row_number() OVER (
  PARTITION BY mgrs_tile, season, dekad ORDER BY cloud_cover, scene_id) AS rn FROM sg WHERE usable) WHERE rn = 1""")
def _(spark, sf):
    return scenes.season_mode(scenes.quality_gate(fx.scenes(spark, sf)), gate_first=True).filter(
        "selected").select("scene_id")


@query("w1b_best_scene_event", "sc", """SELECT scene_id, row_number() OVER (PARTITION BY mgrs_tile, date
  ORDER BY cloud_cover, scene_id) = 1 AS selected FROM sc""")
def _(spark, sf):
    return scenes.event_mode(fx.scenes(spark, sf)).select("scene_id", "selected")


@query("w2_newest_per_key", "sc", """SELECT mgrs_tile, season, scene_id, date FROM (SELECT *, row_number() OVER (
  PARTITION BY mgrs_tile, season ORDER BY date DESC, scene_id DESC) AS rn FROM sc) WHERE rn = 1""")
def _(spark, sf):
    return tables.newest_per_key(fx.scenes(spark, sf), ["mgrs_tile", "season"],
                                 ["date", "scene_id"]).select("mgrs_tile", "season", "scene_id", "date")


ANOMALY = """SELECT field_id, date, dekad, mgrs_tile, mean_ndvi, round(median, 6) AS median,
  round(iqr, 6) AS iqr, CASE WHEN iqr > 0 THEN round((mean_ndvi - median) / (iqr / 1.349), 6) END AS z FROM ob
  JOIN (SELECT field_id, dekad, quantile_cont(mean_ndvi, 0.5) AS median, quantile_cont(mean_ndvi, 0.75)
  - quantile_cont(mean_ndvi, 0.25) AS iqr FROM ob GROUP BY ALL) USING (field_id, dekad)"""


@query("w3_climatology_anomaly", "ob", ANOMALY)
def _(spark, sf):
    return study.anomaly(OBS(spark, sf)).select(
        "field_id", "date", "dekad", "mgrs_tile", "mean_ndvi", r6("median").alias("median"),
        r6("iqr").alias("iqr"), r6("z").alias("z"))


@query("w4_top2_valid", "ob", """SELECT field_id, season, dekad, date, mgrs_tile, valid_frac FROM (SELECT *,
  row_number() OVER (PARTITION BY field_id, season, dekad ORDER BY valid_frac DESC, date DESC, mgrs_tile DESC)
  AS rn FROM ob) WHERE rn <= 2""")
def _(spark, sf):
    return tables.newest_per_key(OBS(spark, sf), ["field_id", "season", "dekad"],
                                 ["valid_frac", "date", "mgrs_tile"], 2).select(
        "field_id", "season", "dekad", "date", "mgrs_tile", "valid_frac")


# --- sorts and set operations ------------------------------------------------

@query("t1_ordered_dates", "ob", """SELECT dekad, min(date) AS min_date FROM ob WHERE season = 1996
  GROUP BY dekad ORDER BY dekad""")
def _(spark, sf):
    return publish.first_dates(OBS(spark, sf), F.lit(1996)).orderBy("dekad")


@query("t2_latest_two_runs", "ob", f"SELECT run_seq FROM ({RUNS_SQL}) ORDER BY run_seq DESC LIMIT 2")
def _(spark, sf):
    return tables.latest_runs(runs(spark, sf)).select("run_seq")


@query("t3_top_overlap", "fl wz", """SELECT field_id, CAST(sum(
  greatest(0, least(x0 + w, zx1) - greatest(x0, zx0)) * greatest(0, least(y0 + h, zy1) - greatest(y0, zy0)))
  AS DOUBLE) AS area FROM fl, wz WHERE gust_class = 3 GROUP BY field_id HAVING area > 0
  ORDER BY area DESC, field_id LIMIT 5""")
def _(spark, sf):
    top = fx.zones(spark, sf).filter("gust_class = 3")
    area = spatial.overlap_area(fx.fields(spark, sf), top, "field_id", fx.CELL)
    return area.withColumn("area", F.round("area", 6)).orderBy(F.desc("area"), "field_id").limit(5)


@query("u1_union_by_name", "ob", """SELECT season, count(*) AS n FROM ob GROUP BY season
  UNION ALL SELECT season, count(*) FROM ob GROUP BY season""")
def _(spark, sf):
    n = OBS(spark, sf).groupBy("season").agg(count("n"))
    return n.unionByName(n.select("n", "season"))


@query("u2_distinct_tiles", "rt fl", """SELECT DISTINCT t.x, t.y FROM rt t JOIN fl
  ON t.x BETWEEN floor(x0 / 40) AND floor((x0 + w) / 40)
  AND t.y BETWEEN floor((400 - y0 - h) / 40) AND floor((400 - y0) / 40)""")
def _(spark, sf):
    return assigned(spark, sf).select("x", "y").distinct()


@query("u3_difference", "sc ob", """SELECT DISTINCT date, mgrs_tile FROM sc EXCEPT
  SELECT DISTINCT date, mgrs_tile FROM ob""")
def _(spark, sf):
    keys = fx.scenes(spark, sf).select("date", "mgrs_tile").distinct()
    return incremental.todo(keys, OBS(spark, sf))


@query("u4_intersection", "ob", """SELECT DISTINCT season FROM ob WHERE season IN (1990, 1995, 1998, 2020)""")
def _(spark, sf):
    wanted = spark.createDataFrame([(y,) for y in (1990, 1995, 1998, 2020)], "season int")
    return OBS(spark, sf).select("season").intersect(wanted)
