"""Field preparation: area filter, inset check, class mapping."""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geometry as G
from ..shared import spread
from .cover import flat_edges

BLOCK = 1 << 20   # numbers held at a time
PAIRS = 1 << 17   # boxes times edges looked at in one step
FEW = 12          # edges of a box that is decided exactly
FAN = 4           # parts of a box
ROUNDING = 1e-9   # of the polygon's size, well above what rounding costs


def min_area(polygons: DataFrame, limit: float) -> DataFrame:
    """Whole polygons (before any inset) of at least ``limit``."""
    return polygons.withColumn("area_m2", G.area("poly")).filter(F.col("area_m2") >= limit)


def _gaps(px: np.ndarray, py: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Distance of each point to the edge beside it."""
    ax, ay, bx, by = e.T
    dx, dy = bx - ax, by - ay
    t = np.clip(((px - ax) * dx + (py - ay) * dy) / (dx * dx + dy * dy), 0, 1)
    return np.hypot(px - (ax + t * dx), py - (ay + t * dy))


def _inside(px: np.ndarray, py: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Even-odd rule for a few points."""
    ax, ay, bx, by = e.T
    out = np.zeros(len(px), bool)
    block = max(1, BLOCK // len(e))
    for i in range(0, len(px), block):
        x, y = px[i:i + block, None], py[i:i + block, None]
        crossed = ((ay > y) != (by > y)) & (x < (bx - ax) * (y - ay) / np.where(ay == by, 1.0, by - ay) + ax)
        out[i:i + block] = crossed.sum(axis=1) % 2 == 1
    return out


def _meetings(i: np.ndarray, j: np.ndarray, e: np.ndarray, d: float):
    """Points at distance ``d`` from both edges of each pair (and some others): where
    the lines moved sideways by ``d`` and the circles around the ends meet."""
    def lines(k):
        dx, dy = e[k, 2] - e[k, 0], e[k, 3] - e[k, 1]
        length = np.hypot(dx, dy)
        for sign in (d, -d):
            nx, ny = -dy / length, dx / length
            yield e[k, 0] + sign * nx, e[k, 1] + sign * ny, dx / length, dy / length

    def circles(k):
        return (e[k, 0], e[k, 1]), (e[k, 2], e[k, 3])

    def line_circle(line, centre):
        x, y, ux, uy = line
        along = (centre[0] - x) * ux + (centre[1] - y) * uy
        fx, fy = x + along * ux, y + along * uy
        half = np.sqrt(np.maximum(0, d * d - (fx - centre[0]) ** 2 - (fy - centre[1]) ** 2))
        yield fx + half * ux, fy + half * uy
        yield fx - half * ux, fy - half * uy

    for a in lines(i):
        for b in lines(j):
            turn = a[2] * b[3] - a[3] * b[2]
            t = ((b[0] - a[0]) * b[3] - (b[1] - a[1]) * b[2]) / turn
            yield a[0] + t * a[2], a[1] + t * a[3]
        for c in circles(j):
            yield from line_circle(a, c)
    for b in lines(j):
        for c in circles(i):
            yield from line_circle(b, c)
    for p in circles(i):
        for q in circles(j):
            gx, gy = q[0] - p[0], q[1] - p[1]
            gap = np.hypot(gx, gy)
            half = np.sqrt(np.maximum(0, d * d - gap * gap / 4)) / gap
            for sign in (half, -half):
                yield (p[0] + q[0]) / 2 - sign * gy, (p[1] + q[1]) / 2 + sign * gx


def _corner_found(boxes: list[tuple], e: np.ndarray, d: float, least: float, slack: float) -> bool:
    """Is there an inner point deeper than ``least`` among the corners of the deep region
    that lie in one of ``boxes``, each with the few edges that can be nearest there?"""
    first, second, box = [], [], []
    for b, (_, _, _, near) in enumerate(boxes):
        i, j = np.triu_indices(len(near), 1)
        first.append(near[i])
        second.append(near[j])
        box.append(np.full(len(i), b))
    i, j, box = (np.concatenate(x) for x in (first, second, box))
    x, y, half = (np.array([b[k] for b in boxes]) for k in (0, 1, 2))
    sizes = np.array([len(b[3]) for b in boxes])
    starts, flat = np.concatenate(([0], np.cumsum(sizes))), np.concatenate([b[3] for b in boxes])
    with np.errstate(all="ignore"):
        for qx, qy in _meetings(i, j, e, d):
            here = np.flatnonzero((np.abs(qx - x[box]) <= half[box] + slack) & (np.abs(qy - y[box]) <= half[box] + slack))
            if not len(here):
                continue
            n = sizes[box[here]]
            at = np.concatenate(([0], np.cumsum(n)))
            edge = flat[np.repeat(starts[box[here]] - at[:-1], n) + np.arange(at[-1])]
            gap = np.minimum.reduceat(_gaps(np.repeat(qx[here], n), np.repeat(qy[here], n), e[edge]), at[:-1])
            deep = here[gap > least]
            if len(deep) and _inside(qx[deep], qy[deep], e).any():
                return True
    return False


def has_core(edges: np.ndarray, inset: float) -> bool:
    """Does some inner point lie deeper than ``inset``?

    Boxes are split best first: none of a box's points lies deeper than its middle's
    distance from the edges and half its diagonal, and only edges within twice that
    half diagonal of the nearest can be nearest in it, so a box passes few edges on.  A box whose
    middle is deep enough decides; one that can't be is dropped.  Where few edges are
    left the answer is exact: the points at least ``d`` deep are bounded by lines beside
    the edges and by arcs around their ends, arcs bulging inwards; so the outermost of
    them are where two of these meet, and it is enough to look there, ``d`` being the
    inset and what rounding may cost."""
    edges = edges[(edges[:, 0] != edges[:, 2]) | (edges[:, 1] != edges[:, 3])]
    if not len(edges):
        return False
    e = edges - np.tile(edges[0, :2], 2)
    slack = ROUNDING * max(inset, float(np.abs(e).max()))
    d, least = inset + slack, inset + slack / 2
    low, high = e.reshape(-1, 2).min(axis=0), e.reshape(-1, 2).max(axis=0)
    (x, y), half = (low + high) / 2, float((high - low).max()) / 2 + slack
    # (bound, turn): box, as a heap
    waiting, turn = [(0.0, 0, (x, y, half, np.arange(len(e))))], 0
    while waiting:
        taken, few, pairs = [], [], 0
        while waiting and pairs < PAIRS:
            box = heapq.heappop(waiting)[2]
            if len(box[3]) <= FEW:
                few.append(box)
                pairs += len(box[3]) ** 2
            else:
                taken.append(box)
                pairs += FAN * len(box[3])
        if few and _corner_found(few, e, d, least, slack):
            return True
        if not taken:
            continue
        x, y, half = (np.repeat([b[k] for b in taken], FAN) for k in (0, 1, 2))
        half = half / 2
        x += half * np.tile([-1, 1, -1, 1], len(taken))
        y += half * np.tile([-1, -1, 1, 1], len(taken))
        n = np.repeat([len(b[3]) for b in taken], FAN)
        edge = np.concatenate([np.tile(b[3], FAN) for b in taken])
        at = np.concatenate(([0], np.cumsum(n)))
        gap = _gaps(np.repeat(x, n), np.repeat(y, n), e[edge])
        near = np.minimum.reduceat(gap, at[:-1])
        reach = half * math.sqrt(2)
        open_ = (near + reach >= d) & (reach > slack)
        deep = np.flatnonzero(near > least)
        if len(deep):
            if _inside(x[deep], y[deep], e).any():
                return True
            open_[deep] &= near[deep] < reach[deep]  # else the whole box lies outside
        keep = gap <= np.repeat(near + 2 * reach, n)
        for k in np.flatnonzero(open_).tolist():
            turn += 1
            mine = slice(at[k], at[k + 1])
            heapq.heappush(waiting, (-(near[k] + reach[k]), turn, (x[k], y[k], half[k], edge[mine][keep[mine]])))
    return False


@F.arrow_udf(T.BooleanType())
def _has_core(edges: pa.Array, inset: pa.Array) -> pa.Array:
    flat, at = flat_edges(edges)
    return pa.array([has_core(flat[at[i]:at[i + 1]], d) if there else None for i, (there, d) in enumerate(
        zip(edges.is_valid().to_pylist(), inset.to_pylist()))], pa.bool_())


def inset_nonempty(polygons: DataFrame, inset: float) -> DataFrame:
    """Polygons of which something is left after shrinking by ``inset``: some point
    lies deeper than that."""
    d = F.lit(float(inset))
    middle = G.let(F.struct(G.bbox("poly").alias("b"), G.all_edges("poly").alias("e")), lambda p: G.let(
        F.struct(((p["b"]["xmin"] + p["b"]["xmax"]) / 2).alias("x"), ((p["b"]["ymin"] + p["b"]["ymax"]) / 2).alias("y")),
        lambda m: F.struct(
            # a box no wider than twice the inset holds no circle of that radius
            (F.least(p["b"]["xmax"] - p["b"]["xmin"], p["b"]["ymax"] - p["b"]["ymin"]) <= 2 * d).alias("narrow"),
            (G.edges_contain(p["e"], m["x"], m["y"]) & (G.edges_distance(p["e"], m["x"], m["y"]) > d)).alias("deep"),
            p["e"].alias("e"))))
    tried = spread(polygons).withColumn("__m", middle)
    open_ = F.when(~F.col("__m.narrow") & ~F.col("__m.deep"), F.col("__m.e"))
    # called nondeterministic, or the filter would move below the spreading
    judged = tried.withColumn("__core", _has_core.asNondeterministic()(open_, d))
    return judged.filter(F.coalesce("__core", F.col("__m.deep") & ~F.col("__m.narrow"))).drop("__m", "__core")


def ordinal_class(df: DataFrame, label: str, classes: dict[str, int],
                  out: str = "gust_class") -> DataFrame:
    """Add the class of a label; an unknown label fails the job."""
    known = F.create_map(*[F.lit(v) for kv in classes.items() for v in kv])
    found = F.try_element_at(known, F.col(label))
    return df.withColumn(out, F.when(found.isNotNull(), found).otherwise(
        F.raise_error(F.concat(F.lit("unexpected label: "), F.col(label))).cast("int")))
