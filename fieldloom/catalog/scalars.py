"""Queries: scalar functions."""

from datetime import datetime, timezone

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..contracts import CLASS_LABELS, CROP_LABELS
from ..functions import scalars as S
from ..operators import ordered, publish, quality
from ..shared import shared_folder
from ..sources import catalogue
from .base import query
from .aggregates import QUANT

OBS = fx.observations


@query("x1_dekad_season", "", """SELECT o_orderkey AS scene_id,
  CAST((dayofyear(CAST(o_orderdate AS DATE)) - 1) // 10 AS INT) AS dekad,
  CAST(year(o_orderdate) AS INT) AS season FROM orders""")
def _(spark, sf):
    date = F.col("o_orderdate").cast("date")
    return fx.table(spark, sf, "orders").select(F.col("o_orderkey").alias("scene_id"),
                                                S.dekad(date).alias("dekad"),
                                                S.season(date).alias("season"))


@query("x2_season_range", "sc", """SELECT DISTINCT season, CAST(make_date(season, 1, 1) + 120 AS DATE) AS start,
  CAST(make_date(season, 1, 1) + 272 AS DATE) AS "end" FROM sc""")
def _(spark, sf):
    return catalogue.date_ranges(fx.scenes(spark, sf).select("season").distinct(), (121, 273))


@query("x3_valid_fraction", "fl", """SELECT field_id, CAST(ceil(area_m2 / 25) AS INT) AS total_px,
  least(1.0, (field_id % 7) / ceil(area_m2 / 25)) AS valid_frac FROM fl""")
def _(spark, sf):
    df = fx.field_points(spark, sf).select("field_id", S.total_pixels("area_m2", 25.0)
                                           .alias("total_px"))
    return df.withColumn("valid_frac", S.valid_fraction(F.col("field_id") % 7, "total_px"))


@query("x4_quantise", "ob", f"""SELECT CAST(CASE WHEN valid_frac >= 0.5 THEN {QUANT} ELSE 255 END AS INT) AS q,
  count(*) AS n FROM ob GROUP BY ALL""")
def _(spark, sf):
    return OBS(spark, sf).groupBy(S.quantise("mean_ndvi", "valid_frac").alias("q")).agg(
        F.count(F.lit(1)).alias("n"))


CHANGE = "round_even(greatest(0, least(1, ((post - pre) - -0.4) / (0.1 - -0.4))) * 200, 0)"


@query("x5_quantise_change", "wide", f"""SELECT field_id, CAST(CASE WHEN post - pre IS NOT NULL
  AND least(pre_vf, post_vf) >= 0.5 THEN {CHANGE} ELSE 255 END AS INT) AS drop_q FROM wide""")
def _(spark, sf):
    wide = publish.before_after(OBS(spark, sf), F.expr(fx.BEFORE), F.expr(fx.AFTER))
    return publish.coded(wide).select("field_id", "drop_q")


@query("x6_dequantise", "ob", f"""SELECT field_id, date, mgrs_tile, round(CASE WHEN valid_frac >= 0.5
  THEN -0.2 + {QUANT} / 200 * 1.2 END, 6) AS v FROM ob""")
def _(spark, sf):
    q = S.quantise("mean_ndvi", "valid_frac")
    return OBS(spark, sf).select("field_id", "date", "mgrs_tile",
                                 F.round(S.dequantise(q), 6).alias("v"))


@query("x7_month_day", "sc", "SELECT scene_id, strftime(date, '%b %d') AS label FROM sc")
def _(spark, sf):
    return fx.scenes(spark, sf).select("scene_id", S.month_day("date").alias("label"))


@query("x8_dense_id", "fl", """SELECT field_id, CAST(row_number() OVER (ORDER BY field_id) - 1 AS BIGINT) AS fid
  FROM fl""")
def _(spark, sf):
    return ordered.dense_ids(fx.fields(spark, sf).select("field_id"), "field_id")


@query("x9_basic_scalars", "fl", """SELECT field_id, k, CAST(greatest(w, h) AS INT) AS longest,
  CAST(least(w, h) AS INT) AS shortest, CAST(floor(w / 3) AS BIGINT) AS thirds,
  coalesce(nullif(crop, 0), -1) AS crop, round(w / 7, 3) AS sevenths FROM fl,
  LATERAL (SELECT CAST(unnest(range(0, 3)) AS INT) AS k)""")
def _(spark, sf):
    return fx.fields(spark, sf).select(
        "field_id", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("k"),
        F.greatest("w", "h").alias("longest"), F.least("w", "h").alias("shortest"),
        F.floor(F.col("w") / 3).alias("thirds"),
        F.coalesce(F.nullif(F.col("crop"), F.lit(0)), F.lit(-1)).alias("crop"),
        F.round(F.col("w") / 7, 3).alias("sevenths"))


@query("x10_ingest_time", "sc", "SELECT scene_id, true AS stamped FROM sc")
def _(spark, sf):
    # stored first: every row keeps the moment of that write, between two clock readings
    path, before = shared_folder(spark, "x10"), datetime.now(timezone.utc)
    (fx.scenes(spark, sf).select("scene_id", F.current_timestamp().alias("ingested_at"))
     .write.parquet(path))
    after = datetime.now(timezone.utc)
    in_time = F.col("ingested_at").between(F.lit(before), F.lit(after))
    return spark.read.parquet(path).select("scene_id", in_time.alias("stamped"))


@query("x11_labels", "wind", """SELECT field_id,
  ['control', '60-79 mph', '80-99 mph', '100+ mph'][wind + 1] AS wind_label,
  CASE crop WHEN 1 THEN 'Corn' WHEN 5 THEN 'Soybeans' ELSE 'Other' END AS crop_label
  FROM wind JOIN fl USING (field_id)""")
def _(spark, sf):
    from ..operators import spatial
    wind = spatial.zone_class(fx.field_points(spark, sf), fx.zones(spark, sf), "field_id", fx.CELL)
    crops = fx.fields(spark, sf).select("field_id", "crop")
    return wind.join(crops, "field_id").select(
        "field_id", S.label("wind", CLASS_LABELS).alias("wind_label"),
        S.label("crop", CROP_LABELS, "Other").alias("crop_label"))


@query("x12_observed_text", "ob", """SELECT season, format('{} of {} rows failed', count(*) FILTER
  (valid_frac < 0.5), count(*)) AS observed FROM ob GROUP BY season""")
def _(spark, sf):
    return (OBS(spark, sf).groupBy("season")
            .agg(F.count_if(F.col("valid_frac") < 0.5).alias("bad"), F.count(F.lit(1)).alias("n"))
            .select("season", quality.failed_of(F.col("bad"), F.col("n")).alias("observed")))
