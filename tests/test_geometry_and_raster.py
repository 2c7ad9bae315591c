"""Geometry, projection and raster functions against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldloom import fixtures as fx
from fieldloom.contracts import POLYGON
from fieldloom.functions import geometry as G
from fieldloom.functions import projection as P
from fieldloom.functions import raster as R
from fieldloom.operators import fields, grid, spatial, zonal
from fieldloom.sources import polygons

SHELL = [(0, 0), (10, 0), (12, 6), (5, 11), (-2, 5), (0, 0)]
HOLE = [(3, 3), (3, 6), (6, 6), (6, 3), (3, 3)]


def poly_df(spark, polys):
    rows = [(i, [[(float(x), float(y)) for x, y in ring] for ring in p]) for i, p in enumerate(polys)]
    from pyspark.sql import types as T
    return spark.createDataFrame(rows, T.StructType([T.StructField("id", T.IntegerType()),
                                                     T.StructField("poly", POLYGON)]))


def shoelace(ring):
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:])) / 2


def inside(p, x, y):
    odd = False
    for ring in p:
        for (ax, ay), (bx, by) in zip(ring, ring[1:]):
            if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                odd = not odd
    return odd


def distance(p, x, y):
    best = math.inf
    for ring in p:
        for (ax, ay), (bx, by) in zip(ring, ring[1:]):
            dx, dy = bx - ax, by - ay
            t = max(0, min(1, ((x - ax) * dx + (y - ay) * dy) / (dx * dx + dy * dy)))
            best = min(best, math.hypot(x - ax - t * dx, y - ay - t * dy))
    return best


def test_area_and_centroid_with_hole(spark):
    row = poly_df(spark, [[SHELL, HOLE], [SHELL], [SHELL[::-1]]]).select(
        G.area("poly").alias("a"), G.centroid("poly").alias("c")).collect()
    assert row[0].a == pytest.approx(abs(shoelace(SHELL)) - 9)
    assert row[1].a == row[2].a == pytest.approx(abs(shoelace(SHELL)))
    whole, hole = abs(shoelace(SHELL)), 9.0
    assert row[0].c.x == pytest.approx((row[1].c.x * whole - 4.5 * hole) / (whole - hole))
    assert row[0].c.y == pytest.approx((row[1].c.y * whole - 4.5 * hole) / (whole - hole))


def test_point_tests_agree_with_brute_force(spark):
    p = [SHELL, HOLE]
    r = random.Random(1)
    spots = [(r.uniform(-3, 13), r.choice([r.uniform(-1, 12), 3.0, 6.0, 5.0])) for _ in range(400)]
    df = poly_df(spark, [p]).crossJoin(spark.createDataFrame(spots, "x double, y double"))
    edges = G.all_edges("poly")
    out = df.select("x", "y", G.contains("poly", "x", "y").alias("in_"),
                    G.edge_distance("poly", "x", "y").alias("d"),
                    G.inset_contains("poly", "x", "y", 1.2).alias("deep"),
                    G.on_row(G.scan_row(edges, F.col("y")), F.col("x")).alias("row_in"),
                    G.on_row(G.scan_row(edges, F.col("y"), 1.2), F.col("x")).alias("row_deep"),
                    ).collect()
    assert sum(o.in_ for o in out) > 50 and sum(o.deep for o in out) > 10
    for o in out:
        assert o.in_ == o.row_in == inside(p, o.x, o.y)
        assert o.d == pytest.approx(distance(p, o.x, o.y))
        assert o.deep == o.row_deep == (inside(p, o.x, o.y) and distance(p, o.x, o.y) >= 1.2)


def test_grid_spatial_join_equals_brute_force(spark):
    r = random.Random(2)
    polys = [[[(x + 30 * i - 20, y * (1 + i % 3)) for x, y in ring] for ring in (SHELL, HOLE)]
             for i in range(8)]
    spots = [(i, r.uniform(-30, 240), r.uniform(-2, 34)) for i in range(1500)]
    pts = spark.createDataFrame(spots, "pid int, x double, y double")
    for cell in (2.0, 7.0, 500.0):
        got = {(row.pid, row.id) for row in spatial.locate(pts, poly_df(spark, polys), cell).collect()}
        want = {(i, k) for i, x, y in spots for k, p in enumerate(polys) if inside(p, x, y)}
        assert got == want and want


def test_inset_membership_of_zone_raster(spark):
    """Rasterised pixels = brute-force pixels, with holes, inset and tile clipping."""
    polys = [[[(x * 7 + 3 + 5 * i, y * 7 + 2 + 3 * i) for x, y in ring] for ring in (SHELL, HOLE)]
             for i in range(3)]
    f = poly_df(spark, polys).select(F.col("id").alias("field_id"), F.lit(1).alias("epsg"),
                                     F.lit(1.0).alias("area_m2"), "poly")
    g = spark.createDataFrame([(1, 0.0, 120.0, 40.0, 2, 2, 9)],
                              "epsg int, x0 double, y0 double, stride double, x_hi int, y_hi int, grid_id int")
    for inset in (0.0, 6.0):
        masks = grid.field_pixels(grid.assign_tiles(g, grid.field_boxes(f), 50.0), 8, inset)
        flat = masks.select("field_id", "x", "y", grid.positions("runs", 8).alias("idx")).collect()
        got = {(m.field_id, m.x, m.y, i) for m in flat for i in m.idx}
        want = set()
        for k, p in enumerate(polys):
            for tx in range(3):
                for ty in range(3):
                    for i in range(64):
                        x, y = tx * 40 + (i % 8 + .5) * 5, 120 - ty * 40 - (i // 8 + .5) * 5
                        if inside(p, x, y) and distance(p, x, y) >= inset:
                            want.add((k, tx, ty, i))
        assert got == want and want


def test_inset_nonempty_drops_slivers(spark):
    thin = [[(0, 0), (20, 0), (20, 3), (0, 3), (0, 0)]]
    exact = [[(0, 0), (20, 0), (20, 4), (0, 4), (0, 0)]]
    kept = fields.inset_nonempty(poly_df(spark, [thin, exact, [SHELL]]), 2).collect()
    assert [k.id for k in kept] == [2]


def test_inset_nonempty_off_grid(spark):
    """Cores thinner than any lattice: rectangles by their sides (quarter units, turned
    ones too), triangles by the radius of the circle inside, holes."""
    rnd = random.Random(11)

    def box(x, y, w, h, angle=0.0):
        c, s = math.cos(angle), math.sin(angle)
        return [(x + u * c - v * s, y + u * s + v * c) for u, v in ((0, 0), (w, 0), (w, h), (0, h), (0, 0))]

    shapes, want = [[box(0, 0, 6.4, 6.4)]], [True]  # a core 0.4 wide
    for _ in range(60):
        w, h = rnd.randint(20, 30) / 4, rnd.randint(20, 30) / 4
        x, y = rnd.randint(0, 4000) / 4, rnd.randint(0, 4000) / 4
        shapes.append([box(x, y, w, h)]), want.append(min(w, h) > 6)
        off = 6 + rnd.choice([-1, 1]) * 10.0 ** -rnd.randint(1, 5)
        shapes.append([box(x, y, off, 40, rnd.uniform(0, 6))]), want.append(off > 6)
        a, b, c = [(x + rnd.uniform(0, 25), y + rnd.uniform(0, 25)) for _ in range(3)]
        sides = math.dist(a, b), math.dist(b, c), math.dist(c, a)
        twice = abs((b[0] - a[0]) * (c[1] - a[1]) - (c[0] - a[0]) * (b[1] - a[1]))
        shapes.append([[a, b, c, a]]), want.append(twice / sum(sides) > 3)
    for w in (6.0, 6.01):  # what is left beside and around a hole, whose middle is not inside
        shapes.append([box(0.25, 0.25, 2 * w + 4, 2 * w + 4), box(w + 0.25, w + 0.25, 4, 4)])
        want.append(True)  # the corners hold more than the sides
        shapes.append([box(0.25, 0.25, w + 4, 5), box(50.1, 0, w, w)]), want.append(w > 6)
    kept = {k.id for k in fields.inset_nonempty(poly_df(spark, shapes), 3).collect()}
    assert [i in kept for i in range(len(shapes))] == want


def test_core_of_random_polygons():
    """Against a fine lattice: what it finds is found, and nothing without a deep point."""
    rnd = random.Random(12)
    for _ in range(60):
        n = rnd.randint(3, 14)
        ring = [(10 + r * math.cos(2 * math.pi * k / n), 10 + r * math.sin(2 * math.pi * k / n))
                for k in range(n) for r in [rnd.uniform(1, 10)]]
        edges = np.array([(*a, *b) for a, b in zip(ring, ring[1:] + ring[:1])])
        at = np.arange(0, 20, 0.05) + 0.013
        x, y = (v.ravel() for v in np.meshgrid(at, at))
        gaps = np.min([fields._gaps(x, y, e[None]) for e in edges], axis=0)
        deepest = gaps[fields._inside(x, y, edges)].max()  # at most 0.036 below the true one
        assert fields.has_core(edges, deepest - 1e-6)
        assert not fields.has_core(edges, deepest + 0.036)


def test_wkb_round_trip_with_hole(spark):
    df = poly_df(spark, [[SHELL, HOLE], [SHELL]])
    df = df.unionByName(df.select((F.col("id") + 5).alias("id"), F.lit(None).cast(POLYGON).alias("poly")))
    back = polygons.decode_wkb(polygons.encode_wkb(df.coalesce(1), "poly", "g"), "g")
    order = lambda d: sorted(d.collect(), key=lambda r: r.id)
    assert order(back) == order(df)


def test_projection_known_points(spark):
    """Central meridian and a forward/inverse round trip of the cone."""
    lon, lat = -93.123, 42.05
    s = math.sin(math.radians(lat))
    rho = P.SEMI_MAJOR * math.sqrt(P.CONE_C - P.CONE_N * P._q(math.asin(s))) / P.CONE_N
    th = P.CONE_N * math.radians(lon + 96)
    x, y = rho * math.sin(th), P.RHO_0 - rho * math.cos(th)
    df = spark.createDataFrame([(x, y)], "x double, y double")
    lon_c, lat_c = P.conus_to_degrees(F.col("x"), F.col("y"))
    east, north = P.degrees_to_utm(F.lit(-93.0), F.lit(42.0), F.lit(15))
    row = df.select(lon_c.alias("lon"), lat_c.alias("lat"), east.alias("e"), north.alias("n")).first()
    assert row.lon == pytest.approx(lon, abs=1e-9) and row.lat == pytest.approx(lat, abs=1e-8)
    assert row.e == pytest.approx(500000, abs=1e-6) and row.n == pytest.approx(4649776.22, abs=0.01)


def test_ndvi_engines_agree(spark, sf):
    df = fx.tiles(spark, sf).select("red", "nir", "scl").unionByName(
        spark.createDataFrame([([0.0, -0.1, 0.2], [0.0, 0.5, -0.1], [4, 4, 4]), ([], [], []),
                               (None, [0.1], [4]), ([0.1], None, [4]), ([0.1], [0.2], None), ([0.1, 0.2], [0.3], [4]),
                               ([0.1], [0.4], [4, 4]), ([0.1], [0.5], [4])],
                              "red array<float>, nir array<float>, scl array<int>")).select(
        R.tile_ndvi("red", "nir", "scl").alias("a"), R.tile_ndvi_arrow("red", "nir", "scl").alias("b"))
    assert df.filter(~F.col("a").eqNullSafe(F.col("b"))).count() == 0
    nan = spark.createDataFrame([([float("nan"), 0.2, 0.1], [0.5, 0.6, None], [4, 9, 4])],
                                "red array<float>, nir array<float>, scl array<int>")
    assert nan.select(R.tile_ndvi_arrow("red", "nir", "scl").alias("v")).first().v == [None] * 3


def test_zone_raster_equals_direct_path(spark, sf):
    from fieldloom.catalog.zonal_parts import assigned, pairs, scene_tiles
    a = pairs(spark, sf, ell=True).select("scene_id", "field_id", "x", "y", "count", F.round("sum", 9))
    tiles = scene_tiles(spark, sf).select("scene_id", *zonal.SPOT, "ndvi")
    b = zonal.pixel_stats(tiles, assigned(spark, sf, ell=True), fx.TILE_PX).select(
        "scene_id", "field_id", "x", "y", "count", F.round("sum", 9))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0 and a.count() > 0


def test_assignment_is_unique_for_any_cell(spark, sf):
    from fieldloom.catalog.zonal_parts import field_boxes, scene_grid
    g, f = grid.shared_grids(scene_grid(spark, sf)), field_boxes(spark, sf)
    sizes = set()
    for cell in (37.0, 100.0, 5000.0):
        spots = grid.assign_tiles(g, f, cell).select("grid_id", "field_id", "x", "y")
        assert spots.count() == spots.distinct().count()
        sizes.add(spots.count())
    assert len(sizes) == 1


def test_slope_of_a_plane(spark):
    rows = [(0, tx, ty, 4, 4, 2.0, [float(3 * (tx * 4 + i % 4) * 2 + 4 * (ty * 4 + i // 4) * 2)
                                    for i in range(16)]) for tx in range(3) for ty in range(3)]
    dem = spark.createDataFrame(rows, "scene_id int, x int, y int, w int, h int, scale_x double, data array<double>")
    got = np.array([r.slope for r in zonal.slope_per_tile(dem).filter("x = 1 and y = 1").collect()][0])
    assert got == pytest.approx(np.full(16, math.degrees(math.atan(5))))
    corner = zonal.slope_per_tile(dem).filter("x = 0 and y = 0").first().slope
    assert corner[0] is None and corner[5] is not None


def outline(*points):
    return [[{"x": float(x), "y": float(y)} for x, y in (*ring, ring[0])] for ring in points]


def test_overlap_is_exact_off_the_grid(spark):
    from fieldloom.operators import spatial
    square = lambda x, y, s: ((x, y), (x + s, y), (x + s, y + s), (x, y + s))
    regions = [(1, outline(square(0.25, 0.25, 0.5))), (2, outline(square(10.05, 3.05, 0.9))),
               (3, outline(square(-3, -3, 9), square(-1, -1, 2))), (4, outline(((0, 0), (8, 0), (0, 8)))),
               (5, outline(square(30, 30, 1), square(33, 33, 1)))]
    zones = [(1, outline(square(0, 0, 20))), (2, outline(((0, 6), (6, 6), (6, 0)))), (1, outline(square(29, 29, 1.5)))]
    schema = "array<array<struct<x:double,y:double>>>"
    r = spark.createDataFrame(regions, f"field_id int, poly {schema}")
    z = spark.createDataFrame(zones, f"k int, poly {schema}")
    want = {(1, 1): 0.25, (2, 1): 0.81, (3, 1): 36 - 1, (4, 1): 32.0, (5, 1): 0.25, (3, 2): 18.0, (4, 2): 10.0}
    for cell in (1.0, 2.7, 100.0):
        got = {(x.field_id, x.k): x.area for x in spatial.overlap_area(r, z, "field_id", cell, "k").collect()}
        assert got == {k: pytest.approx(v) for k, v in want.items()}, cell


def test_multipart_polygons(spark, tmp_path):
    import json
    import struct

    from pyspark.sql import types as T

    from fieldloom.sources import polygons
    rings = [[(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)], [(1, 1), (2, 1), (2, 2), (1, 2), (1, 1)],
             [(10, 0), (12, 0), (12, 1), (10, 1), (10, 0)]]

    def wkb(parts, end="<"):
        out = []
        for part in parts:
            body = struct.pack(end + "BII", end == "<", 3, len(part))
            for r in part:
                body += struct.pack(end + "I", len(r)) + b"".join(struct.pack(end + "dd", *p) for p in r)
            out.append(body)
        return out[0] if len(out) == 1 else struct.pack(end + "BII", end == "<", 6, len(out)) + b"".join(out)

    blobs = [wkb([rings[:2], rings[2:]]), wkb([rings[:2], rings[2:]], ">"), wkb([rings[:2]]), None, wkb([rings[2:]], ">")]
    for some in (blobs, [blobs[2], None, wkb([rings[2:]]), wkb([rings[:2]])]):
        df = spark.createDataFrame([(i, bytearray(b) if b else None) for i, b in enumerate(some)], "i int, g binary")
        got = polygons.decode_wkb(df.coalesce(1), "g").select(
            "i", G.area("poly").alias("a"), G.bbox("poly")["xmax"].alias("x"), F.size("poly").alias("n")).orderBy("i").collect()
        both, first, last = (17.0, 12.0, 3), (15.0, 4.0, 2), (2.0, 12.0, 1)
        want = [both, both, first, None, last] if len(some) == 5 else [first, None, last, first]
        assert [None if r.a is None else (r.a, r.x, r.n) for r in got] == want
    with pytest.raises(Exception, match="not a plane polygon"):
        polygons.decode_wkb(spark.createDataFrame([(bytearray(struct.pack("<BII", 1, 2, 0)),)], "g binary"), "g").collect()

    features = [("MultiPolygon", [rings[:2], rings[2:]]), ("Polygon", rings[:2]), (None, None)]
    path = tmp_path / "layer.json"
    path.write_text("\n".join(json.dumps({"type": "Feature", "properties": {"k": i}, "geometry": t and {
        "type": t, "coordinates": c}}) for i, (t, c) in enumerate(features)))
    props = T.StructType([T.StructField("k", T.LongType())])
    rows = polygons.read_geojson_lines(spark, str(path), props).select("k", G.area("poly").alias("a")).orderBy("k").collect()
    assert [(r.k, r.a) for r in rows] == [(0, 17.0), (1, 15.0), (2, None)]
    path.write_text(json.dumps({"type": "Feature", "properties": {"k": 1}, "geometry": {"type": "Point", "coordinates": [1, 2]}}))
    with pytest.raises(Exception, match="not a polygon"):
        polygons.read_geojson_lines(spark, str(path), props).collect()


def test_masks_are_runs_and_sums_take_two_reads(spark):
    """Twice the size: four times the pixels, twice the runs; sums equal a walk over all pixels."""
    def mask(scale):
        ring = [(x * scale, y * scale) for x, y in SHELL]
        f = poly_df(spark, [[ring]]).select(F.col("id").alias("field_id"), F.lit(1).alias("epsg"),
                                            F.lit(1.0).alias("area_m2"), "poly")
        g = spark.createDataFrame([(1, 0.0, 512.0, 512.0, 0, 0, 9)],
                                  "epsg int, x0 double, y0 double, stride double, x_hi int, y_hi int, grid_id int")
        return grid.field_pixels(grid.assign_tiles(g, grid.field_boxes(f), 1000.0), 256)
    small, large = mask(4), mask(8)
    counts = [m.select(F.size("runs").alias("r"), F.size(grid.positions("runs", 256)).alias("p")).first() for m in (small, large)]
    assert counts[1].r < 2.3 * counts[0].r and counts[1].p > 3.5 * counts[0].p
    rnd = random.Random(4)
    values = [None if rnd.random() < .2 else rnd.uniform(-1, 1) for _ in range(256 * 256)]
    tiles = spark.createDataFrame([(1, 9, 0, 0, 256, values), (2, 9, 0, 0, 256, None), (3, 9, 0, 0, 256, [None] * 65536)],
                                  "scene_id int, grid_id int, x int, y int, w int, ndvi array<double>")
    got = zonal.pair_stats(large, tiles).collect()
    idx = large.select(grid.positions("runs", 256).alias("i")).first().i
    want = [values[i] for i in idx if values[i] is not None]
    assert [(r.scene_id, r["count"]) for r in got] == [(1, len(want))] and got[0]["sum"] == pytest.approx(sum(want))
