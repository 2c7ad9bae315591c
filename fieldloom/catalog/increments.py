"""Queries: incremental runs and streaming."""

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions import geometry as G
from ..operators import incremental, ledger, scenes
from ..plans import stages
from ..shared import materialize, shared_folder
from ..sinks import tables as sink
from ..streaming import arrivals
from .aggregates import ROLLED, count, r6
from .base import query
from .zonal_parts import scene_grid


def chosen(spark, sf):
    return scenes.season_mode(scenes.quality_gate(fx.scenes(spark, sf)))


@query("i1_incremental_run", "sel", """SELECT season, count(*) AS n, CAST(sum(scene_id) AS BIGINT) AS ids
  FROM sel WHERE selected GROUP BY season""")
def _(spark, sf):
    path = shared_folder(spark, "i1")
    todo = chosen(spark, sf).filter("selected").select("scene_id", "season", "dekad", "date", "mgrs_tile")
    layout = ["season"]
    same = lambda df: df
    incremental.run_increment(todo.filter("dekad < 18"), path, same, layout)
    incremental.run_increment(todo, path, same, layout)  # late scenes of the same seasons
    incremental.run_increment(todo, path, same, layout)  # nothing left
    return spark.read.parquet(path).groupBy("season").agg(count("n"), F.sum("scene_id").alias("ids"))


TRAILING = """SELECT scene_id, CASE WHEN live THEN coalesce(again, false)
  ELSE coalesce(before, false) END AS selected FROM (SELECT sg.*,
  usable AND row_number() OVER (PARTITION BY mgrs_tile, season, dekad ORDER BY cloud_cover, scene_id) = 1 AS again,
  CASE WHEN scene_id % 5 <> 0 THEN usable AND row_number() OVER (PARTITION BY scene_id % 5 = 0, mgrs_tile, season,
  dekad ORDER BY cloud_cover, scene_id) = 1 END AS before,
  max(date) OVER (PARTITION BY mgrs_tile, season, dekad) >= (SELECT max(date) FROM sg) - 30 AS live FROM sg)"""


@query("i2_trailing_reselect", "sg", TRAILING)
def _(spark, sf):
    base = fx.scenes(spark, sf)
    known = scenes.season_mode(scenes.quality_gate(base.filter("scene_id % 5 <> 0")))
    late = scenes.quality_gate(base.filter("scene_id % 5 = 0"))
    return incremental.reselect(known, late).select("scene_id", "selected")


@query("i3_catch_up", "sel ob", """SELECT season, count(*) AS expected, count(*) FILTER (hit) AS present,
  count(*) FILTER (NOT hit) AS missing FROM (SELECT DISTINCT season, date, mgrs_tile, EXISTS (SELECT 1 FROM ob
  WHERE ob.date = sel.date AND ob.mgrs_tile = sel.mgrs_tile) AS hit FROM sel WHERE selected) GROUP BY season""")
def _(spark, sf):
    path = shared_folder(spark, "i3")
    ledger.adopt(fx.observations(spark, sf), path, incremental.PART)
    return incremental.catch_up_report(chosen(spark, sf).filter("selected"),
                                       ledger.done(spark, path, "date date, mgrs_tile int"))


@query("i2_refreshed_table", "sg", TRAILING)
def _(spark, sf):
    # the stored manifest, then late items as a stream: only open partitions are overwritten
    path, mark, drop = (shared_folder(spark, f"i2-{x}") for x in ("table", "mark", "drop"))
    base = fx.scenes(spark, sf)
    sink.replace(scenes.season_mode(scenes.quality_gate(base.filter("scene_id % 5 <> 0"))), path,
                 incremental.WINDOW_PARTS)
    late = base.filter("scene_id % 5 = 0")
    late.write.parquet(drop)
    arrivals.refresh_from(arrivals.read_stream(spark, drop, late.schema), path, mark)
    arrivals.refresh_from(arrivals.read_stream(spark, drop, late.schema), path, mark)  # nothing new
    return spark.read.parquet(path).select("scene_id", "selected")


BATCH_BYTES = 256 << 10


@query("i4_scene_batches", "px fl meta", ROLLED)
def _(spark, sf):
    fields = fx.fields(spark, sf).withColumn("epsg", F.lit(fx.EPSG)).withColumn("area_m2", G.area("poly"))
    grids = scene_grid(spark, sf)
    masks = materialize(stages.zone_raster(grids, fields, fx.TILE_PX, 0.0, fx.CELL), "masks")
    rolled = stages.zonal_batches(fx.tiles(spark, sf), fx.tile_meta(spark, sf), grids, masks,
                                  shared_folder(spark, "i4"), BATCH_BYTES, fx.PIXEL ** 2)
    return rolled.withColumn("mean_ndvi", r6("mean_ndvi")).withColumn("valid_frac", r6("valid_frac"))


def event_stream(spark, sf, pattern="events.parquet"):
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    raw = arrivals.read_stream(spark, sf, schema, pattern)
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


@query("r1_stream_arrivals", "", "SELECT event_id, user_id, event_type, value FROM events")
def _(spark, sf):
    out, mark = shared_folder(spark, "r1-out"), shared_folder(spark, "r1-mark")
    twice = event_stream(spark, sf).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    arrivals.drain(arrivals.first_arrivals(twice.drop("copy"), "event_id"), out, mark)
    return spark.read.parquet(out).select("event_id", "user_id", "event_type", "value")


@query("r1_classified_arrivals", "", """SELECT event_id, kind, count(*) AS n FROM (
  SELECT event_id, 'first' AS kind FROM events WHERE event_id % 3 <> 0
  UNION ALL SELECT event_id, CASE WHEN ts < edge THEN 'late' WHEN event_id % 3 <> 0 OR part = 2 THEN 'copy' ELSE 'first' END
  FROM (SELECT event_id, ts, 1 AS part FROM events WHERE event_id % 3 = 0
  UNION ALL SELECT event_id, ts, 2 FROM events WHERE event_id % 4 = 0),
  (SELECT max(ts) - INTERVAL 10 DAY AS edge FROM events WHERE event_id % 3 <> 0)) GROUP BY ALL""")
def _(spark, sf):
    # two files: two thirds of the events, then the rest with every fourth event once more
    drop, out, mark = (shared_folder(spark, f"r1k-{x}") for x in ("drop", "out", "mark"))
    events = fx.events(spark, sf)
    for rows in (events.filter("event_id % 3 <> 0"),
                 events.filter("event_id % 3 = 0").unionByName(events.filter("event_id % 4 = 0"))):
        rows.write.mode("append").parquet(drop)
        arrivals.classify(arrivals.read_stream(spark, drop, rows.schema), "event_id", out, mark, delay="10 days")
    return spark.read.parquet(out).groupBy("event_id", "kind").agg(count("n"))


@query("r2_stream_dekads", "", """SELECT CAST(start AS DATE) AS start, event_type, count(*) AS n,
  round(avg(value), 6) AS mean_value FROM (SELECT *, time_bucket(INTERVAL 10 DAY, ts, TIMESTAMP '2024-01-01')
  AS start FROM events) WHERE start + INTERVAL 10 DAY <= (SELECT max(ts) FROM events) - INTERVAL 2 DAY
  GROUP BY ALL""")
def _(spark, sf):
    out, mark = shared_folder(spark, "r2-out"), shared_folder(spark, "r2-mark")
    arrivals.drain(arrivals.dekad_rollup(event_stream(spark, sf), "value", "event_type"), out, mark)
    return spark.read.parquet(out).select(F.col("start").cast("date").alias("start"), "event_type",
                                          "n", F.round("mean_value", 6).alias("mean_value"))
