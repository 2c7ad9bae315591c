"""The five stages and the event study as composed DataFrame jobs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..contracts import DEFAULTS, Thresholds
from ..functions import geometry as G
from ..functions import projection as P
from ..functions import raster as R
from ..operators import fields as prepare
from ..operators import grid, incremental, publish, quality, scenes, spatial, study, zonal
from ..shared import materialize, sized_join
from ..sinks import tables as sink
from ..sources import tables


def fields_stage(polygons: DataFrame, key: str, t: Thresholds = DEFAULTS,
                 regions: DataFrame | None = None, cell: float = 10_000.0,
                 keep: list[str] | None = None) -> DataFrame:
    """Equal-area polygons -> fields: area filter on the whole polygon,
    optional region filter by centroid, polygons that the inset leaves empty
    dropped, UTM zone, degrees polygon.  The original ring is kept: the inset is
    applied at the pixels."""
    big = (polygons.withColumn("area_m2", G.area("poly"))
           .filter(F.col("area_m2") >= t.min_area_m2))
    if regions is not None:
        c = G.centroid("poly")
        spots = big.withColumn("x", c["x"]).withColumn("y", c["y"])
        big = spatial.inside(spots, regions, key, cell).drop("x", "y")
    big = prepare.inset_nonempty(big, t.inset_m)
    degrees = big.withColumn("poly_deg", G.map_points("poly", P.conus_to_degrees))
    return degrees.select(
        F.col(key).alias("field_id"), *(keep or []), "area_m2",
        G.utm_zone(G.centroid("poly_deg")["x"]).alias("utm_zone"), "poly", "poly_deg")


def in_utm(fields: DataFrame) -> DataFrame:
    """Polygons in the metres of the field's own zone, with its EPSG code."""
    return (fields.withColumn("epsg", F.col("utm_zone") + 32600)
            .withColumn("poly", G.map_points(
                "poly", lambda x, y: P.conus_to_utm(x, y, F.col("utm_zone")))))


def scenes_stage(manifest: DataFrame, t: Thresholds = DEFAULTS, event: bool = False,
                 gate_first: bool = False) -> DataFrame:
    gated = scenes.quality_gate(manifest, t.cloud_max, t.nodata_max)
    return scenes.event_mode(gated) if event else scenes.season_mode(gated, gate_first)


def scene_grids(tiles: DataFrame, meta: DataFrame) -> DataFrame:
    """Stored scene table (scene_id, grid_id, grid): reads georeferences only."""
    return grid.scene_table(sized_join(grid.scene_grids(tiles), meta.select("scene_id", "epsg"),
                                       ["scene_id"]))


def zone_raster(grids: DataFrame, fields: DataFrame, tile_px: int, inset: float = 0.0,
                cell: float = 100_000.0) -> DataFrame:
    """The fields' pixels per grid tile.  It depends on the grids and fields
    only: compute it once, store it, use it for every scene and every run."""
    boxes = grid.field_boxes(fields.select("field_id", "area_m2", "epsg", "poly"))
    return grid.field_pixels(grid.assign_tiles(grid.shared_grids(grids), boxes, cell),
                             tile_px, inset)


def zonal_stage(tiles: DataFrame, meta: DataFrame, grids: DataFrame, masks: DataFrame,
                pixel_m2: float = 100.0, engine: str = "arrow") -> DataFrame:
    """Stacked tiles + scene attributes + scene table + stored zone raster ->
    field observations.  Tiles that no field needs are dropped before the
    index is computed; tile arrays are shuffled to their fields (see ``zonal.observe``)."""
    return zonal.observe(masks, needed_tiles(tiles, grids, masks, engine), meta, "ndvi", pixel_m2)


def needed_tiles(tiles: DataFrame, grids: DataFrame, masks: DataFrame, engine: str = "arrow") -> DataFrame:
    """The tiles that a field needs, with their spot and index."""
    named = sized_join(tiles, grids.select("scene_id", "grid_id"), ["scene_id"])
    return zonal.keep_needed(named, masks).select(
        "scene_id", *zonal.SPOT, "w", R.ENGINES[engine]("red", "nir", "scl").alias("ndvi"))


def tile_sums(tiles: DataFrame, grids: DataFrame, masks: DataFrame, engine: str, dates: DataFrame,
              planned: zonal.Blocks) -> DataFrame:
    """Sum and count of ``tiles`` for every field and date; ``whole`` rows are all there is of theirs.  ``dates``:
    scene attributes and whether all tiles of the date are here (``alone``)."""
    sums = zonal.totals(masks, needed_tiles(tiles, grids, masks, engine), dates, planned, also=["alone"])
    return reduce(DataFrame.unionByName, [df.withColumn("whole", F.col("alone") & F.lit(one)).drop("alone")
                                          for df, one in zip(sums, (True, False), strict=True) if df is not None])


JOBS = 8  # of a run in batches: what a stop can lose


def zonal_batches(tiles: DataFrame, meta: DataFrame, grids: DataFrame, masks: DataFrame, path: str,
                  most: int, pixel_m2: float = 100.0, engine: str = "arrow") -> DataFrame:
    """:func:`zonal_stage` in batches of about ``most`` bytes of tiles, ``JOBS`` jobs at most
    however many batches there are: a job takes its share of them in a row.

    A job leaves its sums per field and date in a folder under ``path`` that names its batches, and
    these are passed over when it is there, so a run that was stopped goes on where it was.  A field
    may lie in tiles of several batches: the roll-up comes last, and only dates of several jobs are added up."""
    spark = tiles.sparkSession
    plan = materialize(incremental.batch_plan(tiles, most), "batches")
    last = plan.agg(F.max("batch")).first()[0]
    if last is None:
        return zonal_stage(tiles, meta, grids, masks, pixel_m2, engine)
    held = [tuple(map(int, n[len(SUMS):].split("-"))) for n in sink.children(spark, path) if n.startswith(SUMS)
            and sink.exists(spark, f"{path}/{n}/_SUCCESS")]
    spots = sized_join(plan, grids.select("scene_id", "grid_id"), ["scene_id"])
    planned = zonal.blocks(masks, spots, tiles.select(F.size("red")).first(), min(last + 1, JOBS))
    date = Window.partitionBy(*zonal.OBSERVED)
    dates = sized_join(meta, plan.groupBy("scene_id").agg(F.min("batch").alias("lo"), F.max("batch").alias("hi")), ["scene_id"])
    dates = materialize(dates.withColumns({"lo": F.min("lo").over(date), "hi": F.max("hi").over(date)}), "dates")
    share, k = -(-(last + 1) // JOBS), 0
    while k <= last:
        if through := [b for a, b in held if a <= k <= b]:
            k = through[0] + 1
            continue
        end = min([k + share - 1, last, *[a - 1 for a, _ in held if a > k]])
        part = sized_join(tiles, plan.filter(F.col("batch").between(k, end)).drop("batch"), incremental.BATCHED,
                          "left_semi")
        here = dates.withColumn("alone", (F.col("lo") >= k) & (F.col("hi") <= end))
        tile_sums(part, grids, masks, engine, here, planned).write.mode("overwrite").parquet(f"{path}/{SUMS}{k}-{end}")
        held.append((k, end))
        k = end + 1
    # what a stopped job left is not read
    sums = spark.read.parquet(*[f"{path}/{SUMS}{a}-{b}" for a, b in held])
    rest = zonal.summed(sums.filter("not whole"))
    return zonal.measured(sums.filter("whole").drop("whole").unionByName(rest), pixel_m2)


SUMS = "observed="  # folders of a run in batches


def publish_stage(obs: DataFrame, fields: DataFrame, zones: DataFrame, before: Column,
                  after: Column, season: Column, dekads: list[int], cell: float) -> DataFrame:
    """Wide, quantised feature table: one row per field."""
    wide = publish.coded(publish.before_after(obs, before, after))
    codes = publish.season_wide(obs, season, dekads)
    wind = spatial.zone_class(fields, zones, "field_id", cell)
    masked = [F.coalesce(f"d{d}", F.lit(255)).alias(f"d{d}") for d in dekads]
    attrs = [c for c in ("crop", "area_m2", "poly") if c in fields.columns]
    return (wide.join(fields.select("field_id", *attrs), "field_id").join(wind, "field_id")
            .join(codes, "field_id", "left")
            .select(*wide.columns, *attrs, "wind", *masked))


def quality_stage(manifest: DataFrame, obs: DataFrame, scope: str, seasons: list[int],
                  tiles: list | None = None, runs: DataFrame | None = None) -> DataFrame:
    """Audit rows of one scope: only its seasons (and tiles) are judged, so another
    scope's rows can't fail it.  With ``runs`` (and run_seq in ``obs``) the row count
    is compared with that of the previous run, in the same scope."""
    cover = scenes.coverage(manifest, seasons, tiles)
    obs = tables.in_scope(obs, seasons=seasons, tiles=tiles)
    delta = [] if runs is None else [quality.delta_check(obs, runs, scope)]
    return quality.audit([
        quality.nonempty_scope_check(cover, scope),
        quality.coverage_check(cover, scope, named=True),
        quality.table_checks(obs, scope, {"mean_ndvi": (-1.0, 1.0), "valid_frac": (0.0, 1.0)}),
        quality.unique_check(obs, scope, ["field_id", "date", "mgrs_tile"],
                             "field_ndvi_no_duplicate_field_date"),
        *delta,
    ])


def event_study(obs: DataFrame, fields: DataFrame, zones: DataFrame, before: Column,
                after: Column, lat_band, cell: float, crop: int | None = None,
                lon_band=None, valid: str = "min", t: Thresholds = DEFAULTS,
                regions: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(frame, matched treated fields).  ``regions`` restricts treated and
    control fields alike."""
    if regions is not None:
        fields = spatial.inside(fields, regions, "field_id", cell)
    wide = publish.before_after(obs, before, after, valid)
    wind = spatial.zone_class(fields, zones, "field_id", cell)
    frame = materialize(study.event_frame(wide, fields, wind, crop, t.valid_frac_min), "study")
    return frame, study.matched(frame, lat_band, lon_band, t.min_controls)


def feature_table(obs: DataFrame, fields: DataFrame, zones: DataFrame, event_day: str,
                  cell: float) -> DataFrame:
    """Model features: observation, anomaly, field attributes, event label."""
    wind = spatial.zone_class(fields, zones, "field_id", cell)
    attrs = fields.select("field_id", "crop", "area_m2").join(wind, "field_id")
    return (study.anomaly(obs).join(attrs, "field_id")
            .withColumn("after_event", F.col("date") >= F.to_date(F.lit(event_day))))
