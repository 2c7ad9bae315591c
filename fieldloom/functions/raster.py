"""Raster functions: per pixel (inside codegen) and per tile (array columns)."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import NODATA, SCL_MASKED


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pixel_ndvi(red, nir, scl, masked: Sequence[int] = SCL_MASKED) -> Column:
    """Vegetation index of one pixel; null where the pixel is masked or not
    physical (sum not positive, or a negative band)."""
    red, nir, scl = _col(red).cast("double"), _col(nir).cast("double"), _col(scl)
    total = nir + red
    return F.when(~scl.isin(list(masked)) & (total > 0) & (red >= 0) & (nir >= 0),
                  (nir - red) / total)


def stack(red, nir, scl) -> Column:
    """Bands of one tile as array<struct<red,nir,scl>>."""
    return F.arrays_zip(_col(red).alias("red"), _col(nir).alias("nir"), _col(scl).alias("scl"))


def tile_ndvi(red, nir, scl, masked: Sequence[int] = SCL_MASKED) -> Column:
    """Index array of a tile; null unless all bands are there and of one length."""
    n = F.size(_col(red))
    return F.when((n == F.size(_col(nir))) & (n == F.size(_col(scl))), F.transform(
        stack(red, nir, scl), lambda p: pixel_ndvi(p["red"], p["nir"], p["scl"], masked)))


def _flat(tiles: pa.ListArray) -> np.ndarray:
    """Pixels of all tiles of a batch, missing ones as NaN, without a copy
    per tile."""
    return tiles.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def tile_ndvi_arrow(red: pa.Array, nir: pa.Array, scl: pa.Array) -> pa.Array:
    """Second engine for :func:`tile_ndvi`: one vector operation per Arrow
    batch; null, and for NaN inputs too, where the pixel is masked."""
    # a tile counts only if all three bands are there and of one length
    lengths = [b.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False) for b in (red, nir, scl)]
    whole = (lengths[0] >= 0) & (lengths[0] == lengths[1]) & (lengths[0] == lengths[2])
    if not whole.all():
        rows = pa.array(np.arange(len(red)), mask=~whole)
        red, nir, scl = (b.take(rows) for b in (red, nir, scl))
    r, n, s = _flat(red), _flat(nir), _flat(scl)
    total = n + r
    keep = ~np.isin(s, SCL_MASKED) & ~np.isnan(s) & (total > 0) & (r >= 0) & (n >= 0)
    out = np.zeros(r.shape)
    np.divide(n - r, total, out=out, where=keep)
    sizes = red.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    starts = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
    missing = red.is_null() if red.null_count else None
    return pa.ListArray.from_arrays(starts, pa.array(out, mask=~keep), mask=missing)


ENGINES = {"column": tile_ndvi, "arrow": tile_ndvi_arrow}


def nodata_to_null(data) -> Column:
    return F.transform(_col(data), lambda v: F.when(v != NODATA, v))


def resample_nearest(data, width, factor: int) -> Column:
    """Coarse band -> grid ``factor`` times finer; ``width`` is the fine width."""
    data, width = _col(data), _col(width)
    coarse = F.floor(width / factor).cast("int")
    cells = F.size(data) * (factor * factor)
    return F.transform(F.sequence(F.lit(0), cells - 1), lambda i: F.get(
        data, (F.floor(F.floor(i / width) / factor) * coarse
               + F.floor(i % width / factor)).cast("int")))


def masked_fraction(scl, masked: Sequence[int] = SCL_MASKED) -> Column:
    """Share of masked pixels; 0 for a missing or empty tile."""
    scl = _col(scl)
    hits = F.size(F.filter(scl, lambda v: v.isin(list(masked))))
    return F.when(F.size(scl) > 0, hits / F.size(scl)).otherwise(F.lit(0.0))


def reflectance(data, scale, offset, scaled) -> Column:
    """DN * scale + offset, unless the row says that it was done already."""
    data, scale, offset = _col(data), _col(scale), _col(offset)
    return F.when(_col(scaled), F.transform(data, lambda v: v.cast("double"))).otherwise(
        F.transform(data, lambda v: v.cast("double") * scale + offset))


def decimate(data, width, n: int) -> Column:
    """Every n-th pixel of every n-th row."""
    width = _col(width)
    return F.filter(_col(data), lambda v, i: (F.floor(i / width) % n == 0) & (i % width % n == 0))


def envelope(ulx="ulx", uly="uly", scale_x="scale_x", scale_y="scale_y", w="w", h="h") -> Column:
    """Tile extent as struct; ``scale_y`` is negative for north-up tiles."""
    x0, y0 = _col(ulx), _col(uly)
    x1, y1 = x0 + _col(w) * _col(scale_x), y0 + _col(h) * _col(scale_y)
    return F.struct(F.least(x0, x1).alias("xmin"), F.least(y0, y1).alias("ymin"),
                    F.greatest(x0, x1).alias("xmax"), F.greatest(y0, y1).alias("ymax"))
