"""Adaptive cell covers and the overlap sweep against plain even-odd tests."""

import math
import time
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldloom.operators import cover, spatial
from fieldloom.operators.sweep import Outline, shared_area


def ring(n, x, y, r, wiggle, seed):
    g = np.random.default_rng(seed)
    t = np.sort(g.uniform(0, 2 * math.pi, n))
    far = r * (1 + wiggle * g.uniform(-1, 1, n))
    p = np.stack([x + far * np.cos(t), y + far * np.sin(t)], 1)
    return np.concatenate([p, np.roll(p, -1, 0)], 1)


def odd(edges, x, y):
    ax, ay, bx, by = edges.T
    with np.errstate(all="ignore"):
        at = (bx - ax) * (y - ay) / (by - ay) + ax
    return int((((ay > y) != (by > y)) & (x < at)).sum() % 2)


def plain_area(one, two):
    """By slabs between all heights at which anything can change."""
    e = np.concatenate([one, two])
    ys = [e[:, 1], e[:, 3]]
    for i in range(len(e)):
        d, f = e[i, 2:] - e[i, :2], e[:, 2:] - e[:, :2]
        with np.errstate(all="ignore"):
            t = ((e[:, 0] - e[i, 0]) * f[:, 1] - (e[:, 1] - e[i, 1]) * f[:, 0]) / (d[0] * f[:, 1] - d[1] * f[:, 0])
        ys.append(e[i, 1] + t[(t > 0) & (t < 1)] * d[1])
    ys = np.unique(np.concatenate(ys))
    total = 0.0
    for low, high in zip(ys[:-1], ys[1:]):
        y = (low + high) / 2
        xs = np.sort(np.concatenate([[ax + (bx - ax) * (y - ay) / (by - ay) for ax, ay, bx, by in s if (ay > y) != (by > y)]
                                     for s in (one, two)]))
        for a, b in zip(xs[:-1], xs[1:]):
            if odd(one, (a + b) / 2, y) and odd(two, (a + b) / 2, y):
                total += (b - a) * (high - low)
    return total


def polygons(spark, outlines, names="id int"):
    """Each outline: a list of edge arrays, one a ring."""
    rows = [(i, [[{"x": float(p[0]), "y": float(p[1])} for p in [*e[:, :2], e[0, :2]]] for e in rings])
            for i, rings in enumerate(outlines)]
    return spark.createDataFrame(rows, f"{names}, poly array<array<struct<x: double, y: double>>>")


def shapes():
    out = [[ring(4, 0, 0, 3, 0, 1)], [ring(9, 2, 1, 5, .8, 2), ring(5, 2, 1, 2, .3, 3)], [ring(120, -3, 2, 6, .5, 4)],
           [ring(7, 4, -4, 4, .2, 5), ring(6, -8, -8, 1, .1, 6)]]
    grid = [[np.round(r) for r in rings] for rings in out]  # level edges, shared heights, edges without length
    block = np.array([[0, 0, 40, 0], [40, 0, 40, 30], [40, 30, 0, 30], [0, 30, 0, 0]], float)
    return out + grid + [[block], [block + 3, block[:, [2, 3, 0, 1]][::-1] / 4 + 8]]


@pytest.mark.parametrize("cell", [0.9, 4.0, 300.0])
def test_location_equals_the_even_odd_rule(spark, cell):
    outlines = shapes()
    g = np.random.default_rng(9)
    spots = np.concatenate([g.uniform(-12, 48, (400, 2)), np.round(g.uniform(-9, 45, (300, 2))),
                            *[r[:, :2] for rings in outlines for r in rings]])
    points = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(spots)], "pid int, x double, y double")
    got = sorted((r.pid, r.id) for r in spatial.locate(points, polygons(spark, outlines), cell).collect())
    want = sorted((i, k) for i, (x, y) in enumerate(spots) for k, rings in enumerate(outlines)
                  if odd(np.concatenate(rings), x, y))
    assert got == want


def test_zones_empty_and_points_without_place(spark):
    points = spark.createDataFrame([(1, 1.0, 1.0), (2, None, None), (3, 99.0, 1.0)], "pid int, x double, y double")
    none = polygons(spark, [], "k int")
    assert spatial.locate(points, none, 5.0).count() == 0
    got = spatial.zone_class(points, none.withColumn("gust_class", F.col("k")), "pid", 5.0).collect()
    assert sorted((r.pid, r.wind) for r in got) == [(1, 0), (2, 0), (3, 0)]
    one = polygons(spark, [[ring(4, 1, 1, 2, 0, 1)]], "gust_class int").withColumn("gust_class", F.lit(7))
    got = spatial.zone_class(points, one, "pid", 5.0).collect()
    assert sorted((r.pid, r.wind) for r in got) == [(1, 7), (2, 0), (3, 0)]


@pytest.mark.parametrize("cell", [1.3, 6.0, 300.0])
def test_overlap_areas_equal_plain_slabs(spark, cell):
    outlines = shapes()
    regions = polygons(spark, outlines, "field_id int")
    zones = polygons(spark, outlines[::-1], "k int")
    got = {(r.field_id, r.k): r.area for r in spatial.overlap_area(regions, zones, "field_id", cell, "k").collect()}
    flat = [np.concatenate(rings) for rings in outlines]
    for i, one in enumerate(flat):
        for k, two in enumerate(flat[::-1]):
            assert got.get((i, k), 0.0) == pytest.approx(plain_area(one, two), abs=1e-6), (i, k)


def test_large_outlines_sweep_fast_in_little_memory():
    whole = lambda e: Outline(e, np.empty(0), False)
    one, two = ring(2000, 0, 0, 10, .05, 1), ring(2000, 1, .5, 10, .05, 2)
    tracemalloc.start()
    start = time.perf_counter()
    got = shared_area(whole(one), whole(two), -32., -32., 32., 32.)
    took, peak = time.perf_counter() - start, tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert took < 5 and peak < 200e6
    # the parts of the plane add up, in boxes that cut the edges anywhere
    cuts = [-32., -7.1, 0.3, 5.77, 32.]
    parts = sum(shared_area(whole(one), whole(two), a, c, b, d) for a, b in zip(cuts, cuts[1:]) for c, d in zip(cuts, cuts[1:]))
    assert parts == pytest.approx(got, rel=1e-9)
    assert shared_area(whole(one), whole(one), -32., -32., 32., 32.) == pytest.approx(
        abs(sum(a * d - b * c for a, b, c, d in one.tolist())) / 2)


def test_rows_grow_with_the_border():
    """Eight times the size: about eight times the cells and edges, not 64 times."""
    def cost(r):
        edges, cells = cover.cells_of(ring(2000, 0, 0, r, .01, 3), 10.0)
        return len(cells), sum(len(c.index) + len(c.jumps) for c in cells)
    (rows, held), (more_rows, more_held) = cost(400.0), cost(3200.0)
    assert more_rows < 12 * rows and more_held < 6 * held
    edges, cells = cover.cells_of(ring(4, 0, 0, 1000, 0, 1), 10.0)
    assert max(c.level for c in cells if not len(c.index)) >= 2  # the inside is a few large cells


def test_broadcast_is_decided_by_bytes(spark):
    cells = cover.covered(polygons(spark, [[ring(300, 0, 0, 50, .1, 1)]]).withColumn("name", F.lit("x" * 1000)), 5.0)
    sizes = cover.level_sizes(cells)
    n = cells.count()
    assert sum(sizes.values()) > 1000 * n
    assert cover.hinted(cells, {0: cover.BROADCAST_BYTES + 1}) is cells and cover.hinted(cells, sizes) is not cells


def batch_of(seed, n, spread):
    rnd, parts = np.random.default_rng(seed), [np.empty((0, 4))]
    for k in range(n):
        p = rnd.uniform(-300, 300, 2) + rnd.uniform(-spread, spread, (rnd.integers(3, 7), 2))
        p = np.round(p / 10) * 10 if k % 3 == 0 else p
        parts.append(np.column_stack([p, np.roll(p, -1, axis=0)]))
    return parts, np.concatenate([[0], np.cumsum([len(p) for p in parts])]), np.concatenate(parts)


def test_small_covers_in_one_go_equal_those_one_by_one():
    parts, starts, flat = batch_of(3, 300, 60)
    simple, source, cx, cy, base, (jumps, n_jumps), (held, n_held) = cover.few(flat, starts, 100.0)
    j, h, got = np.concatenate([[0], np.cumsum(n_jumps)]), np.concatenate([[0], np.cumsum(n_held)]), {}
    for k, i in enumerate(source.tolist()):
        got.setdefault(i, []).append((0, cx[k], cy[k], base[k], jumps[j[k]:j[k + 1]].tolist(), held[h[k]:h[k + 1]].tolist()))
    assert 100 < simple.sum() < 301
    for i in np.flatnonzero(simple).tolist():
        own, cells = cover.cells_of(parts[i], 100.0)
        assert sorted(got.get(i, [])) == sorted(
            (c.level, c.cx, c.cy, c.base, c.jumps.tolist(), own[c.index].tolist()) for c in cells)


def test_boxes_swept_together_equal_boxes_one_by_one():
    from fieldloom.operators.sweep import shared_areas
    (_, at, one), (_, to, two) = batch_of(5, 400, 90), batch_of(6, 400, 90)
    one[at[200]:] = np.round(one[at[200]:] / 50) * 50
    none, n = np.empty(0), len(at) - 1
    odd = np.arange(n) % 2
    left, low = np.full(n, -200.), np.full(n, -200.)
    sides = [(one, at, none, np.zeros(n + 1, int), odd), (two, to, np.array([-50., 50.]), np.minimum(np.arange(n + 1), 2), 1 - odd)]
    got = shared_areas(sides, left, low, np.full(n, 400.))
    for i in range(n):
        want = shared_area(*[Outline(e[a[i]:a[i + 1]], v[b[i]:b[i + 1]], bool(o[i])) for e, a, v, b, o in sides],
                           -200., -200., 200., 200.)
        assert np.isnan(got[i]) or got[i] == pytest.approx(want, abs=1e-6)
    assert (got > 0).sum() > 20


def test_polygons_of_one_split_are_covered_by_many_tasks(spark):
    from fieldloom.functions import geometry as G
    x = F.col("id") % 100 * 7
    rows = spark.range(0, 2000, 1, 1).select("id", G.rectangle(x, x, x + 5, x + 5).alias("poly"))
    out = cover.covered(rows, 100.0)
    assert len(out.inputFiles()) > 1 and out.select("id").distinct().count() == 2000
