"""The empty-inset test: best-first boxes against depths on a fine lattice."""

import math
import time

import numpy as np
import pytest

from fieldloom.operators import fields

from .test_cover_and_sweep import polygons, ring


def strip(n, width, bend=8.0, length=100.0):
    """A bent strip of ``n`` edges."""
    t = np.linspace(0, length, n // 2)
    y, slope = bend * np.sin(t / 7), bend / 7 * np.cos(t / 7)
    ox, oy = -slope / np.hypot(1, slope) * width / 2, 1 / np.hypot(1, slope) * width / 2
    p = np.concatenate([np.stack([t + ox, y + oy], 1), np.stack([t - ox, y - oy], 1)[::-1]])
    return np.concatenate([p, np.roll(p, -1, 0)], 1)


def deepest(e, steps=160):
    """Largest depth on a lattice, and how much deeper another point can be."""
    low, high = e.reshape(-1, 2).min(axis=0), e.reshape(-1, 2).max(axis=0)
    gx, gy = np.meshgrid(*[np.linspace(a, b, steps) for a, b in zip(low, high)])
    ax, ay, bx, by = e.T
    dx, dy = bx - ax, by - ay
    x, y = gx.reshape(-1, 1), gy.reshape(-1, 1)
    t = np.clip(((x - ax) * dx + (y - ay) * dy) / np.maximum(dx * dx + dy * dy, 1e-300), 0, 1)
    gap = np.hypot(x - ax - t * dx, y - ay - t * dy).min(axis=1)
    with np.errstate(all="ignore"):
        odd = (((ay > y) != (by > y)) & (x < dx * (y - ay) / dy + ax)).sum(axis=1) % 2
    return float(np.where(odd == 1, gap, 0).max()), float(np.hypot(*(high - low)) / (steps - 1))


@pytest.mark.parametrize("seed", range(12))
def test_verdicts_on_either_side_of_the_deepest_point(seed):
    parts = [ring([3, 5, 12, 40][seed % 4], 500, 3, 10, [0, .4, .9][seed % 3], seed)]
    if seed % 2:
        parts += [ring(5, 501, 2, 3, .2, seed + 50), ring(4, 530, 0, 2, 0, seed)]  # a hole, another part
    e = np.concatenate(parts)
    if seed % 5 == 0:
        e = np.round(e)
    depth, more = deepest(e)
    assert depth and fields.has_core(e, depth * 0.999999) and not fields.has_core(e, depth + more)


@pytest.mark.parametrize("turned", [0.0, 0.3, 1.1])
def test_a_core_within_rounding_is_empty(turned):
    def box(w):
        p = np.array([[0, 0], [10, 0], [10, w], [0, w]]) @ np.array(
            [[math.cos(turned), math.sin(turned)], [-math.sin(turned), math.cos(turned)]]) + [1000, 2000]
        return np.concatenate([p, np.roll(p, -1, 0)], 1)
    assert [fields.has_core(box(w), 1.0) for w in (1.9999, 2.0, 2.00000000001, 2.0001)] == [False, False, False, True]
    assert not fields.has_core(np.empty((0, 4)), 1.0) and not fields.has_core(np.ones((3, 4)), 1.0)


@pytest.mark.parametrize("width,core", [(1.7, False), (1.99, False), (2.02, True)])
def test_many_edges_are_decided_fast(width, core):
    start = time.perf_counter()
    assert fields.has_core(strip(10_000, width), 1.0) is core
    assert time.perf_counter() - start < 8  # about one second on a free core


def test_rows(spark):
    kept = polygons(spark, [[ring(40, 0, 0, 10, .1, 1)], [strip(60, 1.5)], [strip(60, 4.5)]])
    nothing = spark.createDataFrame([(9, None)], kept.schema)
    assert sorted(r.id for r in fields.inset_nonempty(kept.unionByName(nothing), 1.0).collect()) == [0, 2]
