"""Pairs of fields and tiles as array operations, against one pair after the other."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fieldloom.operators import slices, zonal
from fieldloom.shared import materialize, shared_folder

RUN = pa.struct([("row", pa.int32()), ("first", pa.int32()), ("last", pa.int32())])
MASK = pa.struct([("x", pa.int32()), ("field_id", pa.int64()), ("area", pa.float64()), ("runs", pa.list_(RUN)), ("pixels", pa.list_(pa.int32()))])
TILE = pa.struct([("x", pa.int32()), ("day", pa.string()), ("scene", pa.int64()), ("w", pa.int32()), ("v", pa.list_(pa.float64())),
                  ("u", pa.list_(pa.float64()))])


def inputs(seed):
    """Sorted rows of three slices: (key, side, mask, tile)."""
    rnd = random.Random(seed)
    rows = []
    for key in (1, 2, 5):
        masks = []
        for f in range(rnd.randint(5, 12)):
            for x in rnd.sample((0, 1, 2), rnd.randint(1, 3)):
                runs = [dict(row=r, first=(a := rnd.randint(0, 3)), last=rnd.randint(a, 4)) for r in rnd.sample(range(4), rnd.randint(0, 3))]
                masks.append(dict(x=x, field_id=f or None, area=rnd.choice([1.0, 2.0, None]) if f < 4 else 3.0, runs=runs,
                                  pixels=rnd.sample(range(18), rnd.randint(0, 5))))
        tiles = []
        for scene in range(rnd.randint(4, 14)):
            for x in (0, 1, 2, 3):
                n = rnd.choice((16, 16, 16, 8, None))
                v, u = ([rnd.choice([None, 1.0, 2.0, 3.0]) for _ in range(n)] if n else None for _ in "vu")
                tiles += [dict(x=x, day=rnd.choice(["a", "b", None]), scene=scene, w=rnd.choice((4, 4, 4, 2, None)), v=v, u=u)] * rnd.choice((1, 1, 2, 0))
        tiles.sort(key=lambda t: (t["day"] or "", t["scene"]))
        rows += [(key, 0, m, None) for m in masks] * (key != 5) + [(key, 1, None, t) for t in tiles]
    return rows


def batches(rows, size):
    for i in range(0, len(rows), size):
        key, side, a, b = zip(*rows[i:i + size])
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(side, pa.int32()), pa.array(a, MASK), pa.array(b, TILE)],
                                         ["key", "__side", "__a", "__b"])


def read(m, t, value, shape):
    cells = t[value] or []
    if shape == "pixels":
        hit = [cells[p] for p in m["pixels"] if p < len(cells)]
    else:
        w = t["w"]
        hit = [] if w is None else [cells[r["row"] * w + c] for r in m["runs"] if r["row"] < len(cells) // w and r["last"] < w
                                    for c in range(r["first"], r["last"] + 1)]
    return [c for c in hit if c is not None]


@pytest.mark.parametrize("shape", ["runs", "pixels"])
@pytest.mark.parametrize("cells, size", [(1, 3), (40, 7), (1 << 18, 10_000)])
def test_totals_equal_one_pair_after_the_other(monkeypatch, shape, cells, size):
    monkeypatch.setattr(slices, "CELLS", cells)
    for seed in range(6):
        # tiles of one width, runs inside their rows
        rows = [(k, s, a and {**a, "runs": [r for r in a["runs"] if r["last"] < 4]}, b and {**b, "w": 4 if b["w"] else None})
                for k, s, a, b in inputs(seed)]
        pairs = [(k, m, t) for k, s, m, _ in rows if s == 0 for j, q, _, t in rows if q == 1 and j == k and m["x"] == t["x"]]
        for empty in (False, True):
            want = {}
            for k, m, t in pairs:
                v, u = (read(m, t, c, shape) for c in "vu")
                if v or empty:
                    got = want.setdefault((k, m["field_id"], t["day"]), [[], [], [], []])
                    for have, more in zip(got, ([m["area"]] if v and m["area"] else [], [t["scene"]] if v else [], v, u)):
                        have += more
            if empty:
                job = slices.Job(("key",), ("x",), shape, ("v", "u"), ("field_id",), ("day",), True, True, empty=True)
                want = [(*k, sum(v), len(v), sum(u), len(u)) for k, (_, _, v, u) in want.items()]
            else:
                job = slices.Job(("key",), ("x",), shape, ("v",), ("field_id", "area"), ("day",), True, True, "scene", "area")
                want = [(*k[:2], max(area, default=None), k[2], min(scene), sum(v), len(v)) for k, (area, scene, v, _) in want.items()]
            got = [r for part in slices._sums(batches(rows, size), job) for r in zip(*(c.to_pylist() for c in part))]
            assert sorted(got, key=str) == sorted(want, key=str) and got
        job = slices.Job(("key",), ("x",), shape, ("v",), ("field_id", "area"), ("scene", "day"))
        got = [r for part in slices._sums(batches(rows, size), job) for r in zip(*(c.to_pylist() for c in part))]
        want = [(k, m["field_id"], m["area"], t["scene"], t["day"], sum(v), len(v)) for k, m, t in pairs if (v := read(m, t, "v", shape))]
        assert sorted(got, key=str) == sorted(want, key=str)


def test_handed_back_rows_come_in_large_batches(monkeypatch):
    monkeypatch.setattr(slices, "ROWS", 10)
    got = [b.num_rows for b in slices.packed(([pa.array([i] * 4)] for i in range(6)), ["a"])]
    assert got == [12, 12] and not list(slices.packed([], ["a"]))


def ring(spark, n):
    """``n`` fields of two spots and tiles of 12 scenes there, two of a day."""
    run = F.array(*[F.struct((F.col("id") % 2).cast("int").alias("row"), F.lit(0).alias("first"), F.lit(1).alias("last"))])
    masks = spark.range(n).select(F.lit(1).alias("grid_id"), F.explode(F.array(F.lit(0), F.lit(1))).alias("x"), F.lit(0).alias("y"),
                                  "id").withColumn("runs", run).withColumn("area_m2", F.col("id") + 1.0).withColumnRenamed("id", "field_id")
    tiles = spark.range(24).select(F.lit(1).alias("grid_id"), (F.col("id") % 2).cast("int").alias("x"), F.lit(0).alias("y"),
                                   F.floor(F.col("id") / 2).alias("scene_id"), F.lit(2).alias("w"), F.lit(2).alias("h"), F.lit(1.0).alias("scale_x"),
                                   F.transform(F.sequence(F.lit(1), F.lit(4)), lambda k: (k * F.col("id")).cast("double")).alias("ndvi"))
    meta = spark.range(12).select(F.col("id").alias("scene_id"), F.lit("T").alias("mgrs_tile"), F.date_add(
        F.to_date(F.lit("2020-05-01")), F.floor(F.col("id") / 2).cast("int")).alias("date"), F.lit(1).alias("dekad"),
        F.lit(2020).alias("season"), F.lit(32615).alias("epsg"))
    return materialize(masks, "m"), materialize(tiles, "t"), meta


def exchanges(df, *names):
    plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    return [line for line in plan if "Exchange" in line and all(n in line for n in names)]


def test_terrain_of_shared_blocks_shuffles_no_pairs(spark, monkeypatch):
    masks, tiles, _ = ring(spark, 100)
    got = zonal.terrain(tiles.withColumnRenamed("ndvi", "data"), masks)
    assert not exchanges(got, "scene_id", "field_id")
    monkeypatch.setattr(zonal, "PAIR_BYTES", 0)
    pairs = zonal.terrain(tiles.withColumnRenamed("ndvi", "data"), masks)
    assert exchanges(pairs, "scene_id", "field_id")
    show = lambda df: sorted(str(tuple(r)) for r in df.collect())
    assert show(got) == show(pairs) and len(show(got)) == 1200


def test_pairs_are_no_rows_before_they_have_a_sum(spark):
    masks, tiles, _ = ring(spark, 5)
    plan = zonal.pair_stats(masks, tiles)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "SortMergeJoin" not in plan.split("MapInArrow")[0]


def test_pixels_are_tested_once_a_spot_not_once_a_scene(spark, sf):
    from fieldloom import fixtures as fx
    from fieldloom.catalog.zonal_parts import assigned, scene_tiles
    spots = materialize(assigned(spark, sf, ell=True), "spots")
    tiles = scene_tiles(spark, sf).select("scene_id", *zonal.SPOT, "ndvi")
    got = zonal.pixel_stats(tiles, spots, fx.TILE_PX)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "posexplode" not in plan and not exchanges(got, "scene_id", "field_id")
    # one centre after the other, in plain Python
    want = {}
    where = [r.asDict(True) for r in spots.collect()]
    for t in tiles.collect():
        for s in where:
            if (s["grid_id"], s["x"], s["y"]) != (t.grid_id, t.x, t.y):
                continue
            for at, v in enumerate(t.ndvi):
                cx = s["x0"] + s["x"] * s["stride"] + (at % 8 + 0.5) * s["stride"] / 8
                cy = s["y0"] - s["y"] * s["stride"] - (at // 8 + 0.5) * s["stride"] / 8
                odd = sum((e["ay"] > cy) != (e["by"] > cy) and cx < (e["bx"] - e["ax"]) * (cy - e["ay"]) / (e["by"] - e["ay"]) + e["ax"]
                          for e in s["__edges"]) % 2
                if v is not None and odd:
                    a, n = want.get((t.scene_id, s["field_id"], t.x, t.y), (0.0, 0))
                    want[t.scene_id, s["field_id"], t.x, t.y] = a + v, n + 1
    rows = {(r.scene_id, r.field_id, r.x, r.y): (round(r["sum"], 9), r["count"]) for r in got.collect()}
    assert rows == {k: (round(a, 9), n) for k, (a, n) in want.items()} and len(rows) == got.count() > 0


def test_jobs_leave_a_row_for_each_field_and_date(spark, monkeypatch):
    """Pairs are not stored, and only dates of several jobs are added up."""
    from fieldloom.plans import stages
    masks, tiles, meta = ring(spark, 100)
    masks = materialize(masks, "masks")
    bands = tiles.withColumns({"red": F.transform("ndvi", lambda v: v * 0 + 1), "nir": F.transform("ndvi", lambda v: v + 2),
                               "scl": F.array(*[F.lit(4)] * 4)}).drop("grid_id", "ndvi")
    grids = spark.range(12).select(F.col("id").alias("scene_id"), F.lit(1).alias("grid_id"))
    path = shared_folder(spark, "jobs")
    got = stages.zonal_batches(bands, meta, grids, masks, path, 5 * 2 * 48)  # of five tiles: a date is cut
    stored = spark.read.parquet(*[f"{path}/{n}" for n in stages.sink.children(spark, path)])
    assert 600 < stored.count() < 1000 and 0 < stored.filter("not whole").count() < 600
    show = lambda df: sorted(str(r.asDict()) for r in df.withColumn("mean_ndvi", F.round("mean_ndvi", 9)).select(
        sorted(df.columns)).collect())
    want = stages.zonal_stage(bands, meta, grids, masks)
    assert show(got) == show(want) and got.count() == 600
    again = []
    monkeypatch.setattr(stages, "tile_sums", lambda *a: again.append(1))
    assert stages.zonal_batches(bands, meta, grids, masks, path, 5 * 2 * 48).count() == 600 and not again
