"""Queries: event study and feature table."""

from dataclasses import replace

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..contracts import DEFAULTS
from ..operators import publish, spatial, study
from ..plans import stages
from .aggregates import ANOMALY, ATTRITION, BOTH, TERCILE
from .base import DID, query


CROP, VALID_MIN = 1, 0.1


def event(spark, sf, band, lon_band=None, regions=None, crop=CROP, valid="min", valid_min=VALID_MIN):
    """The study as published: one crop, lowest validity on either side."""
    return stages.event_study(
        fx.observations(spark, sf), fx.field_points(spark, sf), fx.zones(spark, sf),
        F.expr(fx.BEFORE), F.expr(fx.AFTER), band, fx.CELL, crop, lon_band, valid,
        replace(DEFAULTS, valid_frac_min=valid_min), regions)


def all_crops(spark, sf, band, lon_band=None):
    """The wider variant: every crop, highest validity on either side."""
    return event(spark, sf, band, lon_band, None, None, "max", DEFAULTS.valid_frac_min)


@query("e1_event_frame", "sframe", """SELECT field_id, pre, pre_vf, post, post_vf, lat, lon, wind, delta,
  usable FROM sframe""")
def _(spark, sf):
    wide = publish.before_after(fx.observations(spark, sf), F.expr(fx.BEFORE), F.expr(fx.AFTER), "min")
    points = fx.field_points(spark, sf)
    wind = spatial.zone_class(points, fx.zones(spark, sf), "field_id", fx.CELL)
    return study.event_frame(wide, points, wind, CROP, VALID_MIN)


@query("e2_did", "sm30", f"{DID} FROM sm30 GROUP BY wind")
def _(spark, sf):
    return study.did_table(event(spark, sf, fx.BAND)[1])


@query("e2_did_all_crops", "m30", f"{DID} FROM m30 GROUP BY wind")
def _(spark, sf):
    return study.did_table(all_crops(spark, sf, fx.BAND)[1])


@query("e3_monotonic", "sm30", f"""SELECT coalesce(bool_and(did < prev), true) AS monotonic FROM (
  SELECT did, lag(did) OVER (ORDER BY wind) AS prev FROM ({DID} FROM sm30 GROUP BY wind))""")
def _(spark, sf):
    return study.monotonic(study.did_table(event(spark, sf, fx.BAND)[1]))


@query("e4_attrition", "sm30", ATTRITION.format(m="sm30", f="sframe"))
def _(spark, sf):
    return study.attrition(*event(spark, sf, fx.BAND))


@query("e5_did_lat_lon", "sm2", f"{DID} FROM sm2 GROUP BY wind")
def _(spark, sf):
    return study.did_table(event(spark, sf, 160, 160)[1])


@query("e5_did_lat_lon_all_crops", "m2", f"{DID} FROM m2 GROUP BY wind")
def _(spark, sf):
    return study.did_table(all_crops(spark, sf, 160, 160)[1])


@query("e6_tercile", "sm30", TERCILE.format(m="sm30"))
def _(spark, sf):
    return study.tercile_effect(event(spark, sf, fx.BAND)[1])


REGION = """SELECT sframe.* FROM sframe JOIN (SELECT field_id, mx, my FROM fl) USING (field_id)
  WHERE EXISTS (SELECT 1 FROM rg WHERE state <> 2 AND mx >= rx0 AND mx < rx0 + 200 AND my >= ry0
  AND my < ry0 + 200)"""


@query("e7_subregion_did", "sframe rg", f"""{DID} FROM (SELECT *, delta - ctrl_delta AS did FROM (
  SELECT t.field_id, t.wind, t.delta, avg(c.delta) AS ctrl_delta FROM ({REGION}) t JOIN ({REGION}) c
  ON c.lat BETWEEN t.lat - 30 AND t.lat + 30 WHERE t.usable AND t.wind > 0 AND c.usable AND c.wind = 0
  GROUP BY ALL HAVING count(*) >= 5)) GROUP BY wind""")
def _(spark, sf):
    return study.did_table(event(spark, sf, fx.BAND,
                                 regions=fx.regions(spark, sf).filter("state <> 2"))[1])


@query("e8_raw_drop", "ob wind fl", f"""SELECT wind AS gust_class, count(*) AS fields,
  round(avg(pre::DECIMAL(20, 12)), 4) AS pre, round(avg(post::DECIMAL(20, 12)), 4) AS post,
  round(avg((post - pre)::DECIMAL(20, 12)), 4) AS drop FROM ({BOTH}) JOIN wind USING (field_id)
  JOIN (SELECT field_id, crop FROM fl) USING (field_id) WHERE crop = 1 GROUP BY wind""")
def _(spark, sf):
    wide = publish.before_after(fx.observations(spark, sf), F.expr(fx.BEFORE), F.expr(fx.AFTER),
                                valid_min=0.5, both=True)
    points = fx.field_points(spark, sf)
    wind = spatial.zone_class(points, fx.zones(spark, sf), "field_id", fx.CELL)
    return study.raw_drop(wide, points, wind, CROP)


@query("e9_feature_table", "ob wind", f"""SELECT a.*, crop, area_m2, wind, date >= DATE '1998-06-30' AS after_event
  FROM ({ANOMALY}) a JOIN (SELECT field_id, crop, area_m2 FROM fl) USING (field_id)
  JOIN wind USING (field_id)""")
def _(spark, sf):
    feats = stages.feature_table(fx.observations(spark, sf), fx.field_points(spark, sf),
                                 fx.zones(spark, sf), "1998-06-30", fx.CELL)
    six = lambda c: F.round(c, 6).alias(c)
    return feats.select("field_id", "date", "dekad", "mgrs_tile", "mean_ndvi", six("median"),
                        six("iqr"), six("z"), "crop", "area_m2", "wind", "after_event")
