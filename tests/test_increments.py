"""Ledger, stored refresh, batches of bounded bytes and classified arrivals."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from fieldloom.operators import incremental, ledger, scenes
from fieldloom.shared import shared_folder
from fieldloom.sinks import tables as sink
from fieldloom.streaming import arrivals

KEYS = ["date", "mgrs_tile"]
ITEM = "scene_id int, mgrs_tile int, date date, season int, dekad int, cloud_cover int, nodata_pct int"


def day(n):
    return dt.date(2020, 5, 1) + dt.timedelta(days=n)


def rows(spark, spots):
    return spark.createDataFrame([(day(d), t, i) for i, (d, t) in enumerate(spots)], "date date, mgrs_tile int, v int")


def held(spark, path):
    return sorted((r.date, r.mgrs_tile) for r in ledger.done(spark, path, "date date, mgrs_tile int").distinct().collect())


def test_the_ledger_is_read_not_the_table(spark, monkeypatch):
    path = shared_folder(spark, "ledger")
    df = rows(spark, [(0, 1), (0, 2), (1, 1)])
    incremental.append_new(df, path, ["mgrs_tile"], KEYS)
    assert held(spark, path) == [(day(0), 1), (day(0), 2), (day(1), 1)]
    more = rows(spark, [(0, 1), (1, 1), (2, 5), (2, 5)])
    new = ledger.missing(more, path, KEYS)
    files = {f for f in new.inputFiles()}
    assert all("/_ledger/" in f for f in files) and sorted(r.mgrs_tile for r in new.collect()) == [5, 5]
    incremental.append_new(more, path, ["mgrs_tile"], KEYS)
    incremental.append_new(more, path, ["mgrs_tile"], KEYS)
    assert spark.read.parquet(path).count() == 5 and len(held(spark, path)) == 4


def test_many_keys_are_noted_by_many_tasks(spark):
    path = shared_folder(spark, "manykeys")
    many = spark.range(4000).select(F.date_add(F.lit(day(0)), (F.col("id") % 500).cast("int")).alias("date"),
                                    F.floor(F.col("id") / 500).cast("int").alias("mgrs_tile"))
    was = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ledger.adopt(many.union(many), path, KEYS)
        noted = ledger.done(spark, path, "date date, mgrs_tile int")
        assert len(noted.inputFiles()) > 1 and noted.count() == 4000
        ledger.add(many.withColumn("v", F.lit(1)).limit(0), many, f"{path}-b", ["mgrs_tile"])
        noted = ledger.done(spark, f"{path}-b", "date date, mgrs_tile int")
        assert len(noted.inputFiles()) > 1 and noted.count() == 4000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", was)


def test_a_key_without_rows_is_not_tried_again(spark):
    path, tried = shared_folder(spark, "norows"), []
    todo = spark.createDataFrame([(1, day(0), 1), (2, day(1), 1)], "scene_id int, date date, mgrs_tile int")

    def process(df):
        tried.append(sorted(r.scene_id for r in df.collect()))
        return df.filter("scene_id = 1")

    incremental.run_increment(todo, path, process)
    incremental.run_increment(todo, path, process)
    assert tried == [[1, 2]] and spark.read.parquet(path).count() == 1


@pytest.mark.parametrize("written", [True, False])
def test_a_run_cut_off_is_settled(spark, written):
    """Begun, then lost: before its rows came (done again) or after (not done twice)."""
    path = shared_folder(spark, "cut")
    df = rows(spark, [(0, 1), (1, 2)])
    incremental.append_new(df.filter("v = 0"), path, ["mgrs_tile"], KEYS)
    df.filter("v = 1").select(*KEYS).write.parquet(f"{path}/_ledger/begun/run=lost")
    if written:
        sink.append(df.filter("v = 1"), path, ["mgrs_tile"])
    incremental.append_new(df, path, ["mgrs_tile"], KEYS)
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [0, 1]
    assert sink.children(spark, f"{path}/_ledger/begun") == []


def test_the_ledger_is_compacted(spark, monkeypatch):
    monkeypatch.setattr(ledger, "COMPACT", 3)
    path = shared_folder(spark, "compact")
    for n in range(7):
        ledger.note(rows(spark, [(n, 1)]).select(*KEYS), path)
    assert ledger.generation(spark, path) >= 2 and len(held(spark, path)) == 7
    assert len(sink.children(spark, f"{path}/_ledger/done")) == 1


def files(path):
    return {os.path.relpath(os.path.join(d, f), path) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_refresh_touches_open_partitions_only(spark):
    path = shared_folder(spark, "refresh")
    base = spark.createDataFrame([(1, 0, dt.date(2020, 5, 1), 2020, 12, 9, 0), (2, 0, dt.date(2020, 8, 1), 2020, 21, 9, 0),
                                  (5, 1, dt.date(2020, 8, 2), 2020, 21, 3, 0), (6, 0, dt.date(2020, 6, 1), 2020, 15, 3, 0)], ITEM)
    late = spark.createDataFrame([(3, 0, dt.date(2020, 5, 2), 2020, 12, 1, 0), (4, 0, dt.date(2020, 8, 2), 2020, 21, 1, 0),
                                  (4, 0, dt.date(2020, 8, 2), 2020, 21, 1, 0)], ITEM)
    sink.replace(scenes.season_mode(scenes.quality_gate(base)), path, incremental.WINDOW_PARTS)
    before = files(path)
    incremental.refresh(path, late)
    after = files(path)
    gone, new = before - after, after - before
    assert gone and all("dekad=21" in f for f in gone)
    assert {f.split("/")[1] for f in new} == {"dekad=21", "dekad=12"}  # 12: added, not overwritten
    want = {1: True, 2: False, 3: False, 4: True, 5: True, 6: True}
    assert {r.scene_id: r.selected for r in spark.read.parquet(path).collect()} == want
    incremental.refresh(path, late)  # a repeated batch
    assert sorted((r.scene_id, r.selected) for r in spark.read.parquet(path).collect()) == sorted(want.items())
    closed = {f for f in after if "dekad=21" not in f}
    assert closed <= files(path)
    incremental.refresh(path, late.limit(0))


def test_batches_hold_bounded_bytes(spark):
    tiles = spark.range(500).select((F.col("id") / 100).cast("int").alias("scene_id"), (F.col("id") % 10).cast("int").alias("x"),
                                    (F.col("id") / 10 % 10).cast("int").alias("y"), F.lit(4).alias("w"),
                                    F.when(F.col("id") == 250, 400).otherwise(5).alias("h"))
    plan = incremental.batch_plan(tiles, 1000).join(tiles, incremental.BATCHED)
    sizes = plan.groupBy("batch").agg(F.sum(F.col("w") * F.col("h") * 12).alias("b"), F.max(F.col("w") * F.col("h") * 12).alias("m"))
    got = sizes.collect()
    assert plan.count() == 500 and len(got) > 50 and all(r.b < 1000 + r.m for r in got)
    assert incremental.batch_plan(tiles.limit(0), 1000).count() == 0


def test_a_stopped_batch_run_goes_on(spark, sf, monkeypatch):
    from fieldloom import fixtures as fx
    from fieldloom.catalog.zonal_parts import scene_grid
    from fieldloom.functions import geometry as G
    from fieldloom.operators import zonal
    from fieldloom.plans import stages
    from fieldloom.shared import materialize
    fields = fx.fields(spark, sf).withColumn("epsg", F.lit(fx.EPSG)).withColumn("area_m2", G.area("poly"))
    tiles, meta, grids = fx.tiles(spark, sf), fx.tile_meta(spark, sf), scene_grid(spark, sf)
    masks = materialize(stages.zone_raster(grids, fields, fx.TILE_PX, 0.0, fx.CELL), "masks")
    path, done = shared_folder(spark, "batched"), []
    whole = stages.tile_sums

    def watched(part, *args):
        if len(done) == 2:
            done.append("stop")
            raise KeyboardInterrupt
        done.append(part.count())
        return whole(part, *args)

    monkeypatch.setattr(stages, "tile_sums", watched)
    most = 30 * 64 * 12
    with pytest.raises(KeyboardInterrupt):
        stages.zonal_batches(tiles, meta, grids, masks, path, most)
    got = stages.zonal_batches(tiles, meta, grids, masks, path, most)
    assert sum(n for n in done if n != "stop") == tiles.count()  # no tile twice
    monkeypatch.setattr(stages, "tile_sums", whole)
    want = stages.zonal_stage(tiles, meta, grids, masks)
    r = lambda df: sorted((x.field_id, x.date, x.valid_px, round(x.mean_ndvi, 9)) for x in df.collect())
    assert r(got) == r(want) and got.count() > 0 and zonal


def test_many_batches_take_few_jobs(spark, sf, monkeypatch):
    from fieldloom import fixtures as fx
    from fieldloom.catalog.zonal_parts import scene_grid
    from fieldloom.functions import geometry as G
    from fieldloom.plans import stages
    from fieldloom.shared import materialize
    fields = fx.fields(spark, sf).withColumn("epsg", F.lit(fx.EPSG)).withColumn("area_m2", G.area("poly"))
    tiles, meta, grids = fx.tiles(spark, sf), fx.tile_meta(spark, sf), scene_grid(spark, sf)
    masks = materialize(stages.zone_raster(grids, fields, fx.TILE_PX, 0.0, fx.CELL), "masks")
    jobs, whole, path = [], stages.tile_sums, shared_folder(spark, "fewjobs")

    def watched(part, *args):
        jobs.append(part.count())
        return whole(part, *args)

    monkeypatch.setattr(stages, "tile_sums", watched)
    n = tiles.count()
    got = stages.zonal_batches(tiles, meta, grids, masks, path, 64 * 12)  # a batch holds one tile
    assert n > 3 * stages.JOBS and len(jobs) <= stages.JOBS and sum(jobs) == n
    assert stages.zonal_batches(tiles, meta, grids, masks, path, 64 * 12).count() == got.count() and sum(jobs) == n
    monkeypatch.setattr(stages, "tile_sums", whole)
    r = lambda df: sorted((x.field_id, x.date, x.valid_px, round(x.mean_ndvi, 9)) for x in df.collect())
    assert r(got) == r(stages.zonal_stage(tiles, meta, grids, masks)) and got.count() > 0


def test_arrivals_are_first_copy_or_late(spark):
    drop, out, mark = (shared_folder(spark, f"kinds-{x}") for x in ("drop", "out", "mark"))
    schema = "event_id int, ts timestamp, value int"
    at = lambda d: dt.datetime(2024, 1, 1) + dt.timedelta(days=d)
    files_ = [[(1, at(0), 1), (1, at(0), 1), (1, at(1), 2), (2, at(40), 1), (None, at(30), 1)],
              [(1, at(0), 1), (2, at(41), 9), (3, at(31), 1), (4, at(29), 1), (None, at(31), 2), (5, None, 1)],
              [(3, at(32), 1), (2, at(35), 1), (6, at(30), 1)]]
    for f in files_:
        spark.createDataFrame(f, schema).coalesce(1).write.mode("append").parquet(drop)
        stream = arrivals.read_stream(spark, drop, spark.createDataFrame(f, schema).schema)
        arrivals.classify(stream, "event_id", out, mark, delay="10 days")
    got = sorted(((r.batch, r.event_id, r.ts, r.kind) for r in spark.read.parquet(out).collect()), key=str)
    kinds = [["first", "copy", "copy", "first", "first"], ["late", "copy", "first", "late", "copy", "first"],
             ["copy", "copy", "late"]]
    want = sorted(((b, r[0], r[1], k) for b, (f, ks) in enumerate(zip(files_, kinds)) for r, k in zip(f, ks)), key=str)
    assert got == want
