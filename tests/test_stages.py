"""Stages, increments, failures and streams."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fieldloom import fixtures as fx
from fieldloom.contracts import FIELD_NDVI
from fieldloom.functions import geometry as G
from fieldloom.operators import fields, incremental, quality, scenes, study
from fieldloom.plans import stages
from fieldloom.shared import materialize, shared_folder
from fieldloom.sinks import features
from fieldloom.sinks import tables as sink
from fieldloom.sources import catalogue, polygons, tables
from fieldloom.streaming import arrivals


def plan_of(df):
    return df._jdf.queryExecution().toString()


def failing(df, text):
    with pytest.raises(Exception, match=text):
        df.collect()


def test_fields_stage_drops_empty_insets(spark):
    sides = [(5_000.0, 29.5), (5_000.0, 30.0), (5_000.0, 30.25), (400.25, 400.25)]
    df = spark.createDataFrame([(i, w, h) for i, (w, h) in enumerate(sides)], "field_id long, w double, h double")
    metres = df.withColumn("poly", G.rectangle(F.lit(0.25), F.lit(2_100_000.25), F.col("w") + 0.25, F.col("h") + 2_100_000.25))
    assert {r.field_id for r in stages.fields_stage(metres, "field_id").collect()} == {2, 3}


def test_fields_to_observations_end_to_end(spark, sf):
    """Stage 01 -> 03 with real projections: fields in equal-area metres, a
    tile grid in UTM metres around them."""
    metres = fx.fields(spark, sf).filter("field_id <= 40").withColumn("poly", G.map_points(
        "poly", lambda x, y: (x * 40.0, 2_100_000 + y * 40.0)))
    prepared = stages.fields_stage(metres, "field_id")
    utm = materialize(stages.in_utm(prepared), "utm")
    assert {r.utm_zone for r in utm.select("utm_zone").distinct().collect()} <= {14, 15}
    b = utm.select("epsg", G.bbox("poly").alias("b")).groupBy("epsg").agg(
        F.floor(F.min("b.xmin") / 640).alias("gx"), F.ceil(F.max("b.ymax") / 640).alias("gy"),
        F.ceil(F.max("b.xmax") / 640).alias("ex"), F.floor(F.min("b.ymin") / 640).alias("ey"))
    cells = (b.withColumn("x", F.explode(F.expr("sequence(0, cast(ex - gx as int))")))
             .withColumn("y", F.explode(F.expr("sequence(0, cast(gy - ey as int))"))))
    flat = lambda v: F.transform(F.sequence(F.lit(0), F.lit(4095)), lambda i: F.lit(v))
    tiles = cells.select(
        F.col("epsg").alias("scene_id"), "x", "y", ((F.col("gx") + F.col("x")) * 640.0).alias("ulx"),
        ((F.col("gy") - F.col("y")) * 640.0).alias("uly"), F.lit(10.0).alias("scale_x"),
        F.lit(-10.0).alias("scale_y"), F.lit(64).alias("w"), F.lit(64).alias("h"),
        flat(0.1).alias("red"), flat(0.5).alias("nir"), flat(4).alias("scl"))
    day = dt.date(2020, 8, 4)
    meta = spark.createDataFrame([(e, str(e), day, 21, 2020, e) for e in (32614, 32615)],
                                 "scene_id int, mgrs_tile string, date date, dekad int, season int, epsg int")
    grids = stages.scene_grids(tiles, meta)
    masks = materialize(stages.zone_raster(grids, utm, 64, inset=15.0), "masks")
    obs = stages.zonal_stage(tiles, meta, grids, masks)
    rows = {r.field_id: r for r in obs.collect()}
    assert set(obs.columns) == {f.name for f in FIELD_NDVI}
    for f in prepared.select("field_id", "area_m2").collect():
        assert rows[f.field_id].mean_ndvi == pytest.approx(2 / 3, abs=1e-6)
        assert rows[f.field_id].total_px == -(-f.area_m2 // 100)
        assert 0 < rows[f.field_id].valid_frac < 1  # inset pixels over the whole area


def test_publish_stage(spark, sf):
    out = stages.publish_stage(
        fx.observations(spark, sf), fx.field_points(spark, sf), fx.zones(spark, sf),
        F.expr(fx.BEFORE), F.expr(fx.AFTER), F.lit(1998), [3, 4, 30], fx.CELL)
    rows = out.collect()
    assert len({r.field_id for r in rows}) == len(rows) > 0
    assert all(0 <= r[c] <= 200 or r[c] == 255 for r in rows
               for c in ("pre_q", "post_q", "drop_q", "d3", "d4", "d30"))


def test_increment_twice_equals_once(spark, sf):
    path = shared_folder(spark, "inc")
    todo = fx.scenes(spark, sf).filter("season = 1996 and dekad < 4").select(
        "scene_id", "date", "mgrs_tile")
    incremental.run_increment(todo, path, lambda df: df)
    first = spark.read.parquet(path).count()
    seen = []
    incremental.run_increment(todo, path, lambda df: seen.append(df.count()) or df)
    assert seen == [] and spark.read.parquet(path).count() == first == todo.count()


def test_partition_overwrite_keeps_the_others(spark):
    path = shared_folder(spark, "dyn")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    sink.replace_partitions(df, path, ["p"])
    sink.replace_partitions(df.filter("p = 'a'").withColumn("v", F.lit(9)), path, ["p"])
    assert sorted((r.v, r.p) for r in spark.read.parquet(path).collect()) == [(2, "b"), (9, "a")]
    assert not sink.exists(spark, path + "-absent")


def test_late_scene_changes_only_open_windows(spark):
    schema = "scene_id int, mgrs_tile int, date date, season int, dekad int, cloud_cover int, nodata_pct int"
    base = spark.createDataFrame([(1, 0, dt.date(2020, 5, 1), 2020, 12, 9, 0),
                                  (2, 0, dt.date(2020, 8, 1), 2020, 21, 9, 0)], schema)
    late = spark.createDataFrame([(3, 0, dt.date(2020, 5, 2), 2020, 12, 1, 0),
                                  (4, 0, dt.date(2020, 8, 2), 2020, 21, 1, 0)], schema)
    known = scenes.season_mode(scenes.quality_gate(base))
    got = {r.scene_id: r.selected for r in incremental.reselect(known, scenes.quality_gate(late)).collect()}
    assert got == {1: True, 2: False, 3: False, 4: True}


def test_failures_stop_the_job(spark):
    bad = spark.createDataFrame([("ftp://x/1.tif",)], "href string")
    failing(bad.select(catalogue.rewrite_prefix(F.col("href"), {"https://a/": "s3a://a/"})),
            "no rewrite is known")
    failing(fields.ordinal_class(bad, "href", {"a": 1}), "unexpected label")
    root = shared_folder(spark, "slices")
    spark.createDataFrame([(1, "a")], "v int, slice string").write.partitionBy("slice").parquet(root)
    want = spark.createDataFrame([("a",), ("b",)], "slice string")
    failing(tables.merge_slices(spark, want, root), "missing slice export: b")


def test_gate_raises_only_on_hard_failures(spark):
    rows = [("field_ndvi_row_count_vs_previous_snapshot", "s", "e", "o", False)]
    schema = "check_name string, scope string, expected string, observed string, passed boolean"
    quality.enforce(spark.createDataFrame(rows, schema))
    with pytest.raises(quality.QualityFailure):
        quality.enforce(spark.createDataFrame([("x", "s", "e", "o", False)], schema))


def test_first_run_passes_the_delta_check(spark):
    table = spark.createDataFrame([(1,), (1,)], "run_seq int")
    runs = spark.createDataFrame([(1,)], "run_seq int")
    row = quality.delta_check(table, runs, "s").first()
    assert row.passed and row.observed == "none (first snapshot)"
    two = spark.createDataFrame([(1,), (2,)], "run_seq int")
    assert quality.delta_check(table.union(spark.createDataFrame([(2,)], "run_seq int")), two,
                               "s").first().observed == "3 (delta +1)"


def test_empty_season_manifest_is_explicit(spark, sf):
    none = features.season_manifest(fx.observations(spark, sf), F.lit(2050)).first().value
    assert none == '{"season":null,"dekads":[]}'


def test_empty_scope_has_an_audit_row(spark, sf):
    empty = scenes.season_mode(scenes.quality_gate(fx.scenes(spark, sf).limit(0)))
    row = quality.nonempty_scope_check(scenes.coverage(empty, [2020]), "s").first()
    assert not row.passed


def test_monotonic_gate(spark):
    t = spark.createDataFrame([(1, -0.01), (2, -0.02), (3, -0.02)], "wind int, did double")
    assert not study.monotonic(t).first().monotonic
    assert study.monotonic(t.filter("wind < 3")).first().monotonic


def test_scans_prune_and_push_down(spark, sf):
    path = shared_folder(spark, "prune")
    fx.observations(spark, sf).withColumn("key", F.col("field_id").cast("string")).write.partitionBy(
        "season").parquet(path)
    df = tables.in_scope(spark.read.parquet(path), seasons=[1996]).select("field_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "season" in plan.split("PartitionFilters")[1][:80]
    assert "ReadSchema: struct<field_id:bigint>" in plan
    pushed = polygons.prefix_extract(spark.read.parquet(path), "key", "19")
    assert "StringStartsWith(key,19)" in pushed._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["j5_tile_assignment", "j7_zone_class", "j12_band_match",
                                  "j13_band_match_2d", "j14_overlap_area", "ra8_zone_raster"])
def test_no_nested_loop_joins(spark, sf, name):
    from fieldloom.catalog import QUERIES
    plan = plan_of(QUERIES[name](spark, sf))
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_stream_equals_batch_and_drops_late_rows(spark, sf):
    """Files arrive in order; the last one holds only rows older than the
    watermark, which must not change the closed windows."""
    root = shared_folder(spark, "in")
    ev = fx.events(spark, sf).select("event_id", "ts", "event_type", "value")
    cut = "ts < timestamp'2024-01-20'"
    late = ev.filter("ts < timestamp'2024-01-05'").withColumn("event_id", F.col("event_id") + 10**9)
    schema = ev.schema

    def drain(folders):
        out, mark = shared_folder(spark, "out"), shared_folder(spark, "mark")
        n_late = 0
        for f in folders:
            f.coalesce(1).write.mode("append").parquet(root)
            q = arrivals.drain(arrivals.dekad_rollup(
                arrivals.read_stream(spark, root, schema), "value", "event_type"), out, mark)
            n_late += arrivals.late_rows(q)
        return spark.read.parquet(out), n_late

    got, n_late = drain([ev.filter(cut), ev.filter(f"not ({cut})"), late])
    limit = ev.agg(F.max("ts") - F.expr("interval 2 days")).first()[0]
    want = (ev.groupBy(F.window("ts", "10 days", startTime="3 days").alias("w"), "event_type")
            .agg(F.count(F.lit(1)).alias("n")).filter(F.col("w.end") <= F.lit(limit))
            .select(F.col("w.start").alias("start"), "event_type", "n"))
    mine = got.select("start", "event_type", "n")
    assert mine.exceptAll(want).count() == 0 and want.exceptAll(mine).count() == 0
    assert n_late > 0


def test_stream_keeps_first_arrival(spark, sf):
    root, out, mark = (shared_folder(spark, n) for n in ("a", "b", "c"))
    ev = fx.events(spark, sf).select("event_id", "ts")
    for _ in range(2):  # every item arrives twice, in two batches
        ev.coalesce(1).write.mode("append").parquet(root)
        arrivals.drain(arrivals.first_arrivals(
            arrivals.read_stream(spark, root, ev.schema), "event_id"), out, mark)
    assert spark.read.parquet(out).count() == ev.count()


def test_observations_of_shared_blocks_leave_no_pairs_to_shuffle(spark, monkeypatch):
    """Fields of one or two spots, repeated and null fields, two scenes of a day, a second grid."""
    from fieldloom.operators import zonal
    monkeypatch.setattr(zonal, "BLOCK_FIELDS", 8)
    monkeypatch.setattr(zonal, "BLOCK_TILES", 4)
    run = [(0, 0, 1)]
    masks = [(1, x, 0, f, f % 7 + 1.0, run) for f in range(120) for x in ((0, 1) if f % 2 else (f // 2 % 2,))]
    masks += [(1, 0, 0, 5, 99.0, run), (1, 0, 0, None, 3.0, run), (2, 0, 0, 7, 1.0, run), (1, 5, 5, 300, 1.0, run), (None, 0, 0, 9, 1.0, run)]
    masks = spark.createDataFrame(masks, "grid_id long, x int, y int, field_id long, area_m2 double, "
                                  "runs array<struct<row: int, first: int, last: int>>")
    tiles = spark.createDataFrame(
        [(s, g, x, 0, 2, [float(s), None if (s + x) % 3 == 0 else 1.0] if s % 4 else [None, None]) for s in range(24)
         for g in (1, 2) if (s % 6 == 0) == (g == 2) for x in (0, 1)] + [(3, 1, 0, 0, 2, [2.0, 2.0]), (4, 1, 1, 0, 2, None)],
        "scene_id long, grid_id long, x int, y int, w int, ndvi array<double>")
    meta = spark.createDataFrame([(s, f"2020-06-{s // 2 + 1:02d}", s % 5, 2020, None if s == 2 else "T", 32615) for s in range(22)],
                                 "scene_id long, date string, dekad int, season int, mgrs_tile string, epsg int")
    want = zonal.roll_up(zonal.pair_stats(masks, tiles), meta)
    got = zonal.observe(masks, tiles, meta)
    rows = lambda df: sorted((tuple(map(str, r)) for r in df.collect()))
    assert rows(got) == rows(want) and got.count() > 500
    most = zonal.observe(masks.filter("field_id < 120 and grid_id = 1 and field_id <> 7"), tiles, meta)
    plan = most._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "Exchange" in line and "date#" in line]


def test_tiles_are_thinned_from_the_deepest_up(spark):
    """The many rows choose once, spread over the cores; zooms are laid out from what is left."""
    from fieldloom.operators import publish
    fields = [(i % 90, float(i * 37 % 11) if i % 13 else None, -96.0 + (i * 7 % 50) / 40, 40.0 + (i * 11 % 60) / 50) for i in range(400)]
    fields += [(1000, 5.0, None, 40.0), (None, 50.0, -500.0, 41.0), (1002, 1.0, 999.0, float("nan"))]
    df = spark.createDataFrame(fields, "field_id long, area_m2 double, lon double, lat double").coalesce(1)
    tx, ty = publish.tile_index(F.col("lon"), F.col("lat"), F.col("z"))
    rows = df.withColumn("z", F.explode(F.sequence(F.lit(6), F.lit(12)))).select("z", tx.alias("tx"), ty.alias("ty"), "field_id", "area_m2")
    rank = F.row_number().over(Window.partitionBy("z", "tx", "ty").orderBy(F.desc("area_m2"), "field_id"))
    want = rows.withColumn("rn", rank).filter("rn <= 3").drop("rn")
    got = publish.thin_tiles(df, 6, 12, 3)
    shown = lambda d: sorted(str(tuple(r)) for r in d.collect())
    assert shown(got) == shown(want) and got.schema.simpleString() == want.schema.simpleString()
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("explode(") < plan.index("Repartition")


def test_pages_of_a_search_are_shuffled_once_and_compressed(spark, sf, monkeypatch):
    from fieldloom.catalog import QUERIES, sources
    roots = []
    monkeypatch.setattr(sources, "shared_folder", lambda *a: roots.append(shared_folder(*a)) or roots[-1])
    found = QUERIES["s6_item_search"](spark, sf)
    assert found.count() == found.select("id").distinct().count() > 50
    raw = sources.items(spark, sf).select(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0]
    for part in ("first", "again"):
        path = f"{roots[0]}/{part}"
        assert catalogue.read_pages(spark, path).select("id").distinct().count() == 1500
        size = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0]
        assert size < raw / 3
