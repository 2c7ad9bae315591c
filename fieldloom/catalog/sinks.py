"""Queries: sinks, each returning what was written."""

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..operators import incremental, ordered, quality
from ..plans import stages
from ..shared import materialize, shared_folder
from ..sinks import features
from ..sinks import tables as sink
from .base import query


@query("k1_replace_partitioned", "fl", """SELECT CAST(14 + x0 // 400 AS INT) AS utm_zone, count(*) AS n,
  CAST(sum(w * h) AS BIGINT) AS area FROM fl GROUP BY ALL""")
def _(spark, sf):
    path = shared_folder(spark, "k1")
    df = fx.fields(spark, sf).withColumn("utm_zone", F.floor(F.col("x0") / 400 + 14).cast("int"))
    sink.replace(df.limit(0), path, ["utm_zone"])
    sink.replace(df, path, ["utm_zone"])
    return spark.read.parquet(path).groupBy("utm_zone").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("w") * F.col("h")).alias("area"))


@query("k2_dynamic_overwrite", "sc", """SELECT season, mgrs_tile, count(*) AS n,
  CAST(sum(CASE WHEN season >= 1996 AND mgrs_tile < 5 THEN 0 ELSE cloud_cover END) AS BIGINT) AS cloud
  FROM sc GROUP BY ALL""")
def _(spark, sf):
    path, parts = shared_folder(spark, "k2"), ["season", "mgrs_tile"]
    df = fx.scenes(spark, sf)
    sink.replace_partitions(df, path, parts)
    sink.replace_partitions(df.filter("season >= 1996 and mgrs_tile < 5")
                            .withColumn("cloud_cover", F.lit(0)), path, parts)
    return spark.read.parquet(path).groupBy(*parts).agg(
        F.count(F.lit(1)).alias("n"), F.sum("cloud_cover").alias("cloud"))


@query("k3_append_partitioned", "ob", """SELECT season, count(*) AS n, round(sum(mean_ndvi), 6) AS total
  FROM ob GROUP BY season""")
def _(spark, sf):
    path = shared_folder(spark, "k3")
    df = fx.observations(spark, sf)
    day = ["date", "mgrs_tile"]
    incremental.append_new(df.filter("dekad < 20"), path, ["season"], day)
    incremental.append_new(df, path, ["season"], day)  # the rest
    incremental.append_new(df, path, ["season"], day)  # nothing
    return spark.read.parquet(path).groupBy("season").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("mean_ndvi"), 6).alias("total"))


@query("k4_audit_append", "ob", """SELECT 'field_ndvi_' || c || '_range' AS check_name, 'demo' AS scope,
  'in [0.0, 0.5]' AS expected, format('{} of {} rows failed', bad, n) AS observed, bad = 0 AS passed FROM (
  SELECT 'mean_ndvi' AS c, count(*) FILTER (NOT mean_ndvi BETWEEN 0.0 AND 0.5) AS bad, count(*) AS n FROM ob)
  UNION ALL SELECT 'field_ndvi_row_count_gt_zero', 'demo', '>= 1 row', CAST(count(*) AS VARCHAR), count(*) > 0 FROM ob
  UNION ALL SELECT 'extract', 'demo', '>= 10 rows', CAST(count(*) AS VARCHAR), count(*) >= 10 FROM ob""")
def _(spark, sf):
    path = shared_folder(spark, "k4")
    obs = fx.observations(spark, sf)
    sink.append_audit(quality.table_checks(obs, "demo", {"mean_ndvi": (0.0, 0.5)}), path)
    sink.append_audit(quality.row_count_check(obs, "demo", 10, "extract"), path)
    return spark.read.parquet(path).drop("run_at")


def published(spark, sf):
    """Wide feature table of the event, with two season periods."""
    return stages.publish_stage(
        fx.observations(spark, sf), fx.field_points(spark, sf), fx.zones(spark, sf),
        F.expr(fx.BEFORE), F.expr(fx.AFTER), F.lit(1998), list(fx.DEKADS), fx.CELL)


@query("k5_wide_drop", "pub", """SELECT field_id, pre, pre_vf, post, post_vf, crop, area_m2, wind, pre_q,
  post_q, drop_q FROM pub""")
def _(spark, sf):
    path = shared_folder(spark, "k5")
    sink.write_wide(published(spark, sf).drop(*[f"d{d}" for d in fx.DEKADS]), path)
    return spark.read.parquet(path).drop("poly")


DEKAD_PROPS = [f"d{d}" for d in fx.DEKADS]
PROPS = ["fid", "crop", "wind", "pre_q", "post_q", "drop_q", *DEKAD_PROPS]
DEKAD_TEXT = "".join(f""" || ',"{d}":' || {d}""" for d in DEKAD_PROPS)


@query("k6_feature_lines", "pub", f"""SELECT '{{"type":"Feature","properties":{{"fid":' || (row_number() OVER (
  ORDER BY field_id) - 1) || ',"crop":' || crop || ',"wind":' || wind || ',"pre_q":' || pre_q || ',"post_q":'
  || post_q || ',"drop_q":' || drop_q{DEKAD_TEXT} || '}},"geometry":{{"type":"Polygon",'
  || '"coordinates":[[[' || x0 || '.0,' || y0 || '.0],[' || (x0 + w) || '.0,' || y0 || '.0],[' || (x0 + w)
  || '.0,' || (y0 + h) || '.0],[' || x0 || '.0,' || (y0 + h) || '.0],[' || x0 || '.0,' || y0 || '.0]]]}}}}'
  AS value FROM pub""")
def _(spark, sf):
    path = shared_folder(spark, "k6")
    wide = materialize(published(spark, sf), "published")
    ids = ordered.dense_ids(wide.select("field_id"), "field_id")
    features.write_features(wide.join(ids, "field_id"), PROPS, path)
    return spark.read.text(path)


@query("k7_boundary", "pc", """SELECT '{"type":"Feature","properties":{"geoid":' || geoid ||
  '},"geometry":{"type":"Polygon","coordinates":[[[' || rx0 || '.0,' || ry0 || '.0],[' || (rx0 + 50) || '.0,'
  || ry0 || '.0],[' || (rx0 + 50) || '.0,' || (ry0 + 50) || '.0],[' || rx0 || '.0,' || (ry0 + 50) || '.0],['
  || rx0 || '.0,' || ry0 || '.0]]]}}' AS value FROM pc WHERE geoid = 7""")
def _(spark, sf):
    path = shared_folder(spark, "k7")
    features.write_features(fx.parcels(spark, sf).filter("geoid = 7"), ["geoid"], path)
    return spark.read.text(path)


@query("k8_season_manifest", "ob", """SELECT '{"season":1998,"dekads":[' || string_agg('{"prop":"d' || dekad ||
  '","date":"' || d || '","label":"' || strftime(d, '%b %d') || '"}', ',' ORDER BY dekad) || ']}' AS value
  FROM (SELECT dekad, min(date) AS d FROM ob WHERE season = (SELECT max(season) FROM ob
  WHERE season IN (1996, 1997, 1998, 2020)) GROUP BY dekad)""")
def _(spark, sf):
    from ..operators import scenes
    path = shared_folder(spark, "k8")
    obs = fx.observations(spark, sf)
    season = scenes.latest_present_season(obs, [1996, 1997, 1998, 2020]).scalar()
    features.season_manifest(obs, season).write.text(path)
    return spark.read.text(path)
