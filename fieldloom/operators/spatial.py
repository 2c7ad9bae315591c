"""Spatial joins as integer equi-joins on the cells of adaptive covers, with an exact recheck."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import cover
from .cover import FAN, flat_edges
from .sweep import MANY, Outline, shared_area, shared_areas

CELL = ["__level", "__cx", "__cy"]
INNER = [*CELL, "__base", "__jumps", "__edges"]


def cell_range(lo: Column, hi: Column, cell: float) -> Column:
    return F.sequence(F.floor(lo / cell).cast("bigint"), F.floor(hi / cell).cast("bigint"))


def _met(points: DataFrame, polygons: DataFrame, cell: float, poly: str, how: str) -> DataFrame:
    """``points`` (x, y) joined with the polygons' cover rows of their cells."""
    cells = cover.covered(polygons, cell, poly)
    sizes = cover.level_sizes(cells)
    return cover.spots(points, cell, sorted(sizes)).join(cover.hinted(cells, sizes), CELL, how)


def locate(points: DataFrame, polygons: DataFrame, cell: float, poly: str = "poly") -> DataFrame:
    """Pairs (point row, polygon attributes) where the polygon contains (x, y)."""
    return _met(points, polygons, cell, poly, "inner").filter(cover.holds(F.col("x"), F.col("y"))).drop(*INNER)


def zone_class(points: DataFrame, zones: DataFrame, key: str, cell: float,
               value: str = "gust_class", out: str = "wind") -> DataFrame:
    """(key, highest zone value that contains the point, 0 outside all).

    The outer join keeps the points outside, so that the maximum per key is
    the only shuffle when the zones' cover fits a broadcast."""
    pairs = _met(points.select(key, "x", "y"), zones.select(value, "poly"), cell, "poly", "left")
    hit = cover.holds(F.col("x"), F.col("y"))
    return pairs.groupBy(key).agg(F.coalesce(F.max(F.when(hit, F.col(value))), F.lit(0)).alias(out))


def inside(points: DataFrame, regions: DataFrame, key: str, cell: float) -> DataFrame:
    """Rows of ``points`` that lie in at least one region."""
    hits = locate(points.select(key, "x", "y"), regions.select("poly"), cell).select(key).distinct()
    return points.join(hits, key, "left_semi")


TOGETHER = 512  # boxes whose few edges are swept at once


def _shared_areas(cell: float):
    @F.arrow_udf(T.DoubleType())
    def areas(a: pa.Array, ja: pa.Array, ba: pa.Array, b: pa.Array, jb: pa.Array, bb: pa.Array,
              level: pa.Array, cx: pa.Array, cy: pa.Array) -> pa.Array:
        sides = []
        for edges, jumps, base in ((a, ja, ba), (b, jb, bb)):
            to = np.concatenate([[0], np.cumsum(jumps.value_lengths().to_numpy())])
            sides.append((*flat_edges(edges), jumps.flatten().to_numpy(zero_copy_only=False), to,
                          base.to_numpy(zero_copy_only=False).astype(np.int64)))
        size = cell * float(FAN) ** level.to_numpy().astype(float)
        left, low = cx.to_numpy() * size, cy.to_numpy() * size
        out = np.empty(len(size))
        for s in range(0, len(out), TOGETHER):
            here = slice(s, s + TOGETHER)
            parts = [(f, at[s:s + TOGETHER + 1], h, to[s:s + TOGETHER + 1], odd[here]) for f, at, h, to, odd in sides]
            sizes = [np.diff(p[k]) for p in parts for k in (1, 3)]
            if max(int(n.max(initial=0)) for n in sizes) <= MANY:
                out[here] = shared_areas(parts, left[here], low[here], size[here])
            else:
                out[here] = np.nan
            empty = sum(sizes) == 0  # the cell lies wholly inside both
            out[here][empty] = size[here][empty] ** 2
        for i in np.flatnonzero(np.isnan(out)).tolist():  # many edges, or lines that cross
            one, two = (Outline(f[at[i]:at[i + 1]], h[to[i]:to[i + 1]], bool(odd[i])) for f, at, h, to, odd in sides)
            out[i] = shared_area(one, two, left[i], low[i], left[i] + size[i], low[i] + size[i])
        return pa.array(out, pa.float64())
    return areas


def overlap_area(regions: DataFrame, zones: DataFrame, key: str, cell: float,
                 by: str | None = None) -> DataFrame:
    """(key, area), or (key, ``by``, area) per zone class, of the exact overlap of
    every region with every zone.  Of two cells one holds the other: covers meet at every
    level of either, and the shared area is taken inside the smaller cell."""
    attrs = [by] if by else []
    one = cover.covered(regions.select(key, "poly"), cell)
    two = cover.covered(zones.select(*attrs, "poly"), cell)
    size_one, size_two = cover.level_sizes(one), cover.level_sizes(two)
    one = one.withColumnsRenamed({c: f"{c}1" for c in INNER})
    two = two.withColumnsRenamed({c: f"{c}2" for c in INNER})

    def meeting(small: DataFrame, s: str, large: DataFrame, b: str, levels: dict, sizes: dict, equal: bool) -> DataFrame:
        inner = cover.enclosing(small.withColumnsRenamed({f"{c}{s}": c for c in CELL}), sorted(levels), equal)
        on = [F.col(i) == F.col(f"{c}{b}") for i, c in zip(("__in", "__ix", "__iy"), CELL)]
        return inner.join(cover.hinted(large, sizes), on).select(
            key, *attrs, *CELL, *[f"{c}{x}" for x in "12" for c in ("__edges", "__jumps", "__base")])

    pairs = meeting(one, "1", two, "2", size_two, size_two, True).unionByName(
        meeting(two, "2", one, "1", size_one, size_one, False))
    shared = _shared_areas(cell).asNondeterministic()(
        "__edges1", "__jumps1", "__base1", "__edges2", "__jumps2", "__base2", *CELL)
    return (pairs.select(key, *attrs, shared.alias("part")).groupBy(key, *attrs)
            .agg(F.sum("part").alias("area")).filter("area > 0"))
