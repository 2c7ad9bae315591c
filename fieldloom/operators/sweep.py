"""Area that two even-odd polygons share inside a box, by a sweep over heights.

Between two heights at which an edge ends, the active edges are straight lines through
the whole slab.  Sorted by x they bound trapezoids, if none of them cross; where some do,
only the neighbours that change places are cut at their crossings.  A slab costs its
active edges, so outlines of thousands of edges cost their length, not its cube.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

CELLS = 1 << 18   # slabs times active edges worked on at once
SMALL = 24        # neighbours whose crossings are listed pair by pair
SLABS = 64        # slabs that share one list of active edges, at most


class Outline(NamedTuple):
    """What a box must know of a polygon: the edges (n, 4) that reach it, and of all
    others to its right whether their number over the box's low end is odd (``base``) and at which
    heights that changes (``jumps``)."""
    edges: np.ndarray
    jumps: np.ndarray
    base: bool

    def odd_right(self, y: np.ndarray) -> np.ndarray:
        """Parity beyond all edges, at heights ``y``."""
        return (np.searchsorted(self.jumps, y, side="right") + int(self.base)) % 2


def _listed(xb: np.ndarray, xt: np.ndarray, bits: np.ndarray, start: int) -> tuple[float, float, float]:
    """As ``_crossed``, from all crossings of a few lines."""
    gap_b, gap_t = xb[:, None] - xb, xt[:, None] - xt
    swap = np.triu(gap_b * gap_t < 0)
    ts = np.unique(np.concatenate(([0.0, 1.0], (gap_b / np.where(swap, gap_b - gap_t, 1.0))[swap])))
    thick, t = np.diff(ts), (ts[1:, None] + ts[:-1, None]) / 2
    x = xb + t * (xt - xb)
    order = np.argsort(x, axis=1, kind="stable")
    x = np.take_along_axis(x, order, 1)
    state = np.bitwise_xor.accumulate(bits[order], axis=1) ^ start
    area = (thick * (np.diff(x, axis=1) * (state[:, :-1] == 7)).sum(axis=1)).sum()
    return float(area), float((thick * x[:, 0]).sum()), float((thick * x[:, -1]).sum())


def _crossed(xb: np.ndarray, xt: np.ndarray, bits: np.ndarray, start: int, depth: int = 0
             ) -> tuple[float, float, float]:
    """Shared area of a slab of height 1 whose lines go from ``xb`` to ``xt``, and the mean
    x of the leftmost and rightmost line.  ``start``: state left of all lines."""
    order = np.lexsort((xt, xb))
    xb, xt, bits = xb[order], xt[order], bits[order]
    state = np.bitwise_xor.accumulate(bits) ^ start
    # lines up to here stay left of the lines after it
    cuts = np.flatnonzero(np.maximum.accumulate(xt)[:-1] <= np.minimum.accumulate(xt[::-1])[::-1][1:]) + 1
    area, edge, first, before = 0.0, None, None, start
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(xb)]):
        if b - a == 1:
            inner, left, right = 0.0, (xb[a] + xt[a]) / 2, (xb[a] + xt[a]) / 2
        elif b - a <= SMALL or depth > 40:
            inner, left, right = _listed(xb[a:b], xt[a:b], bits[a:b], before)
        else:
            middle = (xb[a:b] + xt[a:b]) / 2
            halves = [_crossed(xb[a:b], middle, bits[a:b], before, depth + 1),
                      _crossed(middle, xt[a:b], bits[a:b], before, depth + 1)]
            inner, left, right = (sum(h) / 2 for h in zip(*halves))
        if edge is not None and before == 7:
            area += left - edge
        area, edge, first, before = area + inner, right, left if first is None else first, int(state[b - 1])
    return area, first, edge


MANY = 16         # edges of a side, or jumps, up to which boxes are worked on together


def shared_areas(sides: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]], left: np.ndarray,
                 low: np.ndarray, size: np.ndarray) -> np.ndarray:
    """:func:`shared_area` of many boxes, each with few edges, at once (nan: a box where lines
    cross).  A side: edges of all boxes, where each box's begin, jumps likewise, bases."""
    n = len(left)
    right, high = left + size, low + size
    e, bits, jumps = [], [], []
    for k, (edges, at, heights, to, _) in enumerate(sides):
        for values, begin, out, blank in ((edges, at, e, np.full(4, np.inf)), (heights, to, jumps, np.inf)):
            count = np.diff(begin)
            own, within = np.repeat(np.arange(n), count), np.arange(begin[-1] - begin[0]) - np.repeat(begin[:-1] - begin[0], count)
            grid = np.empty((n, int(count.max(initial=0)), *np.shape(blank)))
            grid[:] = blank
            grid[own, within] = values[begin[0]:begin[-1]]
            out.append(grid)
        bits.append(np.full(e[k].shape[1], k + 1, np.uint8))
    e.append(np.stack([np.stack([x, low, x, high], axis=1) for x in (left, right)], axis=1))
    e, bits = np.concatenate(e, axis=1), np.concatenate([*bits, np.full(2, 4, np.uint8)])
    y0, y1 = np.minimum(e[..., 1], e[..., 3]), np.maximum(e[..., 1], e[..., 3])
    there = (y0 < high[:, None]) & (y1 > low[:, None]) & (y0 != y1)
    up = e[..., 1] <= e[..., 3]
    x0 = np.where(there, np.where(up, e[..., 0], e[..., 2]), 0.0)
    x1 = np.where(there, np.where(up, e[..., 2], e[..., 0]), 0.0)
    y0, y1 = (np.where(there, v, high[:, None] + 1) for v in (y0, y1))  # beyond all heights
    slope = (x1 - x0) / np.where(there, y1 - y0, 1.0)
    ys = np.concatenate([low[:, None], high[:, None], y0, y1, *jumps], axis=1)
    ys = np.sort(np.where((ys >= low[:, None]) & (ys <= high[:, None]), ys, high[:, None]), axis=1)
    bottom, top, middle = ys[:, :-1, None], ys[:, 1:, None], (ys[:, 1:, None] + ys[:, :-1, None]) / 2
    start = sum(((j[:, None] <= middle).sum(axis=2) + s[4][:, None]) % 2 << k
                for k, (j, s) in enumerate(zip(jumps, sides))).astype(np.uint8)
    far = 2 * np.maximum(np.maximum(np.abs(left), np.abs(right)), np.maximum(np.abs(x0), np.abs(x1)).max(axis=1)) + 1
    far, tiny = far[:, None, None], 1e-13
    active = (y0[:, None] <= bottom) & (y1[:, None] >= top)

    def place(y: np.ndarray) -> np.ndarray:
        return np.where(active, x0[:, None] + slope[:, None] * (y - y0[:, None]), far)

    xb, xt, xm = place(bottom), place(top), place(middle)
    order = np.argsort(xm, axis=2, kind="stable")
    own = np.where(active, bits, 0).astype(np.uint8)
    begin = start ^ np.bitwise_xor.reduce(own & 3, axis=2)  # parity left of all edges
    state = np.bitwise_xor.accumulate(np.take_along_axis(own, order, 2), axis=2) ^ begin[..., None]
    widths = (np.diff(np.take_along_axis(xm, order, 2), axis=2) * (state[..., :-1] == 7)).sum(axis=2)
    thick = (top - bottom)[..., 0]
    area = (widths * thick).sum(axis=1)
    for x in (xb, xt):
        bent = (np.diff(np.take_along_axis(x, order, 2), axis=2) < -tiny * far).any(axis=2)
        area[(bent & (thick > 0)).any(axis=1)] = np.nan
    return area


def shared_area(one: Outline, two: Outline, left: float, low: float, right: float, high: float) -> float:
    """Area inside the box, inside ``one`` and inside ``two``."""
    sides = np.array([[left, low, left, high], [right, low, right, high]])
    e = np.concatenate([one.edges, two.edges, sides])
    bits = np.repeat(np.array([1, 2, 4], np.uint8), [len(one.edges), len(two.edges), 2])
    there = (np.minimum(e[:, 1], e[:, 3]) < high) & (np.maximum(e[:, 1], e[:, 3]) > low) & (e[:, 1] != e[:, 3])
    e, bits = e[there], bits[there]
    down = e[:, 1] > e[:, 3]
    e[down] = e[down][:, [2, 3, 0, 1]]
    by_low = np.argsort(e[:, 1], kind="stable")
    (x0, y0, x1, y1), bits = e[by_low].T, bits[by_low]
    slope = (x1 - x0) / (y1 - y0)
    ys = np.concatenate([[low, high], y0, y1, one.jumps, two.jumps])
    ys = np.unique(ys[(ys >= low) & (ys <= high)])
    middle = (ys[1:] + ys[:-1]) / 2
    start = (one.odd_right(middle) + 2 * two.odd_right(middle)).astype(np.uint8)
    total, far, tiny = 0.0, 2 * max(abs(left), abs(right), float(np.abs(e[:, ::2]).max())) + 1, 1e-13
    at, step = 0, SLABS
    while at < len(middle):
        to = min(len(middle), at + step)
        live = np.flatnonzero(y1[:np.searchsorted(y0, ys[to])] > ys[at])
        if (to - at) * len(live) > CELLS and to - at > 1:
            step = max(1, (to - at) // 2)
            continue
        bottom, top = ys[at:to, None], ys[at + 1:to + 1, None]
        active = (y0[live] <= bottom) & (y1[live] >= top)

        def place(y: np.ndarray) -> np.ndarray:
            return np.where(active, x0[live] + slope[live] * (y - y0[live]), far)

        xb, xt, xm = place(bottom), place(top), place(middle[at:to, None])
        order = np.argsort(xm, axis=1, kind="stable")
        own = np.where(active, bits[live], 0).astype(np.uint8)
        begin = start[at:to] ^ np.bitwise_xor.reduce(own & 3, axis=1)  # parity left of all edges
        state = np.bitwise_xor.accumulate(np.take_along_axis(own, order, 1), axis=1) ^ begin[:, None]
        widths = (np.diff(np.take_along_axis(xm, order, 1), axis=1) * (state[:, :-1] == 7)).sum(axis=1)
        bent = np.zeros(to - at, bool)
        for x in (xb, xt):
            bent |= (np.diff(np.take_along_axis(x, order, 1), axis=1) < -tiny * far).any(axis=1)
        for k in np.flatnonzero(bent).tolist():
            on = active[k]
            widths[k] = _crossed(xb[k, on], xt[k, on], own[k, on], int(begin[k]))[0]
        total += float((widths * (ys[at + 1:to + 1] - ys[at:to])).sum())
        at, step = to, min(SLABS, 2 * step)
    return total
