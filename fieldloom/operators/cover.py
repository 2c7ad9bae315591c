"""Adaptive cell cover of polygons: a tree of square cells, each split into 4 x 4.

A cell that no edge reaches is wholly inside (kept, however large) or outside (dropped).
Level edges need no place: they never count in the even-odd rule.
Cells at the border are split down to the wanted size, and further where many edges
crowd.  A border cell holds the edges that reach it.  The even-odd rule also needs the edges to
its right; over the cell's heights these only matter by their number, odd or even, so
the cell keeps that bit and the heights where it changes: ends of edges that leave the cell to
the right.  What a polygon costs grows with its border, not with its area or its edges squared.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions import geometry as G
from ..shared import materialize, spread

FAN = 4
CROWDED = 16      # edges a border cell may hold before it is split below the wanted size
FINEST = -5       # levels below the wanted size
MARGIN = 1e-9     # of the coordinates' size: cells are taken that much larger
BROADCAST_BYTES = 64 << 20
EDGE = "array<struct<ax: double, ay: double, bx: double, by: double>>"
COVER = f"__level int, __cx long, __cy long, __base boolean, __jumps array<double>, __edges {EDGE}"


class Cell:
    """A cell while the tree grows: edges that reach it, bit and heights of those right of it."""
    __slots__ = ("level", "cx", "cy", "index", "base", "jumps")

    def __init__(self, level, cx, cy, index, base, jumps):
        self.level, self.cx, self.cy = level, cx, cy
        self.index, self.base, self.jumps = index, base, jumps


def split(edges: np.ndarray, of: Cell | None, level: int, xs: np.ndarray, ys: np.ndarray, cell: float,
          margin: float) -> list[Cell]:
    """The cells (xs, ys) of ``level`` with what they need, from the edges of ``of``."""
    index = np.arange(len(edges)) if of is None else of.index
    held = np.empty(0) if of is None else of.jumps
    base = False if of is None else of.base
    ax, ay, bx, by = edges[index].T
    size = cell * float(FAN) ** level
    half = size / 2 + margin
    mx, my = (xs[:, None] + 0.5) * size, (ys[:, None] + 0.5) * size
    e_low, e_high = np.minimum(ay, by), np.maximum(ay, by)
    rows = (e_low <= my + half) & (e_high >= my - half)
    dx, dy = bx - ax, by - ay
    reach = (rows & (np.minimum(ax, bx) <= mx + half) & (np.maximum(ax, bx) >= mx - half)
             & (np.abs(dx * (my - ay) - dy * (mx - ax)) <= (np.abs(dx) + np.abs(dy)) * half))
    # over the cell's heights an edge that misses the cell lies wholly to one side of it
    y = (np.maximum(e_low, my - half) + np.minimum(e_high, my + half)) / 2
    right = rows & ~reach & (ax + dx * (y - ay) / dy > mx)
    out = []
    for i in range(len(xs)):
        ends = np.concatenate([held, ay[right[i]], by[right[i]]])
        low, high = my[i, 0] - half, my[i, 0] + half
        odd = bool((np.count_nonzero(ends <= low) + base) % 2)
        ends, times = np.unique(ends[(ends > low) & (ends <= high)], return_counts=True)
        out.append(Cell(level, int(xs[i]), int(ys[i]), index[reach[i]], odd, ends[times % 2 == 1]))
    return out


def cells_of(edges: np.ndarray, cell: float) -> tuple[np.ndarray, list[Cell]]:
    """The cover of one polygon from its edges (n, 4), and the edges it refers to."""
    edges = edges[edges[:, 1] != edges[:, 3]]
    if not len(edges):
        return edges, []
    low, high = edges.reshape(-1, 2).min(axis=0), edges.reshape(-1, 2).max(axis=0)
    margin = MARGIN * float(np.abs(edges).max())
    level = 0
    while cell * float(FAN) ** level < (high - low).max():
        level += 1
    size = cell * float(FAN) ** level
    (cx0, cy0), (cx1, cy1) = np.floor((low - margin) / size), np.floor((high + margin) / size)
    gx, gy = np.meshgrid(np.arange(cx0, cx1 + 1), np.arange(cy0, cy1 + 1))
    todo, done = split(edges, None, level, gx.ravel(), gy.ravel(), cell, margin), []
    inner = np.arange(FAN)
    while todo:
        c = todo.pop()
        if not len(c.index) and not len(c.jumps):  # jumps alone: a level edge runs through
            if c.base:
                done.append(c)
        elif c.level > 0 or (len(c.index) > CROWDED and c.level > FINEST):
            xs, ys = np.repeat(c.cx * FAN + inner, FAN), np.tile(c.cy * FAN + inner, FAN)
            todo += split(edges, c, c.level - 1, xs.astype(float), ys.astype(float), cell, margin)
        else:
            done.append(c)
    return edges, done


def few(edges: np.ndarray, starts: np.ndarray, cell: float):
    """The covers of all polygons of a batch that are no larger than a cell and have few edges,
    in one go: which polygons these are, and the columns source, cx, cy, base, jumps (with the number
    of each row's), edges (likewise).  The same cells as :func:`cells_of`."""
    of = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    slanted = edges[:, 1] != edges[:, 3]
    edges, of = edges[slanted], of[slanted]
    n = np.bincount(of, minlength=len(starts) - 1)
    begin = np.concatenate([[0], np.cumsum(n)])[:-1]
    some, flat = np.flatnonzero(n), edges.reshape(-1, 2, 2)
    spans = [np.zeros((len(n), 2)), np.zeros((len(n), 2))]
    most = np.zeros(len(n))
    if len(some):
        spans[0][some] = np.minimum.reduceat(flat.min(axis=1), begin[some])
        spans[1][some] = np.maximum.reduceat(flat.max(axis=1), begin[some])
        most[some] = np.maximum.reduceat(np.abs(edges).max(axis=1), begin[some])
    low, high = spans
    simple = (n <= CROWDED) & np.isfinite(most) & (~((high - low).max(axis=1) > cell))
    i = np.flatnonzero(simple & (n > 0))
    margin = MARGIN * most
    first, last = (np.floor(v / cell).astype(np.int64) for v in (low[i] - margin[i, None], high[i] + margin[i, None]))
    count = last - first + 1
    many = count.prod(axis=1)
    at = np.repeat(np.arange(len(i)), many)              # the polygon of each cell
    k = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
    cx, cy, own = first[at, 0] + k % count[at, 0], first[at, 1] + k // count[at, 0], i[at]
    to = np.repeat(np.arange(len(at)), n[own])           # the cell of each (cell, edge)
    e = np.repeat(begin[own] - (np.cumsum(n[own]) - n[own]), n[own]) + np.arange(len(to))
    ax, ay, bx, by = edges[e].T
    half, mx, my = cell / 2 + margin[own], (cx + 0.5) * cell, (cy + 0.5) * cell
    floor, top = my - half, my + half
    half, mx, my = half[to], mx[to], my[to]
    e_low, e_high = np.minimum(ay, by), np.maximum(ay, by)
    rows = (e_low <= my + half) & (e_high >= my - half)
    dx, dy = bx - ax, by - ay
    reach = (rows & (np.minimum(ax, bx) <= mx + half) & (np.maximum(ax, bx) >= mx - half)
             & (np.abs(dx * (my - ay) - dy * (mx - ax)) <= (np.abs(dx) + np.abs(dy)) * half))
    y = (np.maximum(e_low, my - half) + np.minimum(e_high, my + half)) / 2
    right = rows & ~reach & (ax + dx * (y - ay) / dy > mx)
    ends, spot = np.concatenate([ay[right], by[right]]), np.concatenate([to[right], to[right]])
    base = np.bincount(spot[ends <= floor[spot]], minlength=len(at)) % 2 == 1
    inner = (ends > floor[spot]) & (ends <= top[spot])
    pairs, times = np.unique(np.column_stack([spot[inner].astype(float), ends[inner]]), axis=0, return_counts=True)
    pairs = pairs[times % 2 == 1]
    n_jumps = np.bincount(pairs[:, 0].astype(np.int64), minlength=len(at))
    n_edges = np.bincount(to[reach], minlength=len(at))
    kept = base | (n_jumps > 0) | (n_edges > 0)  # what is dropped holds neither jumps nor edges
    return simple, own[kept], cx[kept], cy[kept], base[kept], (pairs[:, 1], n_jumps[kept]), (edges[e[reach]], n_edges[kept])


def flat_edges(edges: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of all rows (ax, ay, bx, by) and where each row's begin; null rows hold none."""
    flat = edges.flatten()
    columns = [flat.field(c).to_numpy(zero_copy_only=False) for c in ("ax", "ay", "bx", "by")]
    sizes = edges.value_lengths().fill_null(0).to_numpy()
    return np.column_stack(columns), np.concatenate([[0], np.cumsum(sizes)])


def list_array(sizes: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), values)


def covered(polygons: DataFrame, cell: float, poly: str = "poly") -> DataFrame:
    """The other columns of ``polygons`` for each cell of the polygon's cover, as a stored
    table; ``cell``: the size border cells are split down to.  The polygons are spread over all
    cores first, and so is the table: a file of them is often a single split."""
    attrs = [c for c in polygons.columns if c != poly]
    rows = spread(polygons).select(*attrs, G.all_edges(poly).alias("__edges"))
    schema = T.StructType([*rows.select(*attrs).schema.fields, *T.StructType.fromDDL(COVER).fields])
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            edges, starts = flat_edges(batch.column(batch.schema.get_field_index("__edges")))
            simple, source, cx, cy, base, (jumps, n_jumps), (held, n_held) = few(edges, starts, cell)
            more, cells, others = [], [], []
            for i in np.flatnonzero(~simple).tolist():
                own, found = cells_of(edges[starts[i]:starts[i + 1]], cell)
                more += [i] * len(found)
                cells += found
                others += [own[c.index] for c in found]
            put = lambda x, y: np.concatenate([x, np.array(y, x.dtype)])
            flat = np.concatenate([held, *others])
            out = [batch.column(i).take(pa.array(put(source, more))) for i in range(len(attrs))] + [
                pa.array(put(np.zeros(len(source), np.int32), [c.level for c in cells])),
                pa.array(put(cx, [c.cx for c in cells])), pa.array(put(cy, [c.cy for c in cells])),
                pa.array(put(base, [c.base for c in cells])),
                list_array(put(n_jumps, [len(c.jumps) for c in cells]),
                           pa.array(np.concatenate([jumps, *[c.jumps for c in cells]]))),
                list_array(put(n_held, [len(c.index) for c in cells]), pa.StructArray.from_arrays(
                    [pa.array(flat[:, k].copy()) for k in range(4)], ["ax", "ay", "bx", "by"]))]
            yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(out, arrow)], schema=arrow)

    return materialize(rows.mapInArrow(run, schema), "cover")


def level_sizes(cover: DataFrame) -> dict[int, int]:
    """Bytes of the rows of each level (there are as many as orders of magnitude)."""
    inner = [c for c in cover.columns if c in ("__base", "__edges", "__jumps", "__level", "__cx", "__cy")]
    others = [c for c in cover.columns if c not in inner]
    width = F.lit(48) + 32 * F.size("__edges") + 8 * F.size("__jumps")
    if others:  # what the caller's columns hold, as text
        width = width + F.octet_length(F.to_json(F.struct(*others)))
    return {r[0]: r[1] for r in cover.groupBy("__level").agg(F.sum(width)).collect()}


def hinted(cover: DataFrame, sizes: dict[int, int]) -> DataFrame:
    """Broadcast what is known to be small; else Spark chooses."""
    return F.broadcast(cover) if sum(sizes.values()) <= BROADCAST_BYTES else cover


def spots(points: DataFrame, cell: float, levels: list[int]) -> DataFrame:
    """``points`` (x, y) once for each level, with the cell they lie in."""
    sizes = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(cell * float(FAN) ** k).alias("size"))
                      for k in levels or [0]])
    at = points.withColumn("__s", F.explode(sizes))
    return at.select(*points.columns, F.col("__s.k").alias("__level"), *[
        F.floor(F.col(c) / F.col("__s.size")).cast("bigint").alias(f"__c{c}") for c in "xy"])


def enclosing(cover: DataFrame, levels: list[int], equal: bool) -> DataFrame:
    """``cover`` once for each of ``levels`` above its rows' own (``equal``: or at it), with the
    cell of that level that holds the row's: __in, __ix, __iy."""
    up = F.filter(F.array(*map(F.lit, levels)) if levels else F.array().cast("array<int>"),
                  lambda k: k >= F.col("__level") + F.lit(0 if equal else 1))
    rows = cover.withColumn("__in", F.explode(up))
    return rows.select("*", *[F.expr(f"shiftright(__c{c}, 2 * (__in - __level))").alias(f"__i{c}") for c in "xy"])


def holds(x: Column, y: Column) -> Column:
    """Is the point inside the polygon of the cell row it was joined with?"""
    right = (F.size(F.filter("__jumps", lambda v: v <= y)) % 2 == 1) != F.col("__base")
    return right != G.edges_contain(F.col("__edges"), x, y)
