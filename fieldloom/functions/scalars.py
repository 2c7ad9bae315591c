"""Scalar functions: ten-day periods, quantisation, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..contracts import MONTHS, NDVI_CLAMP, QUANT_MASKED, QUANT_STEPS


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dekad(date, days: int = 10) -> Column:
    """Ten-day period of the year, 0-based."""
    return F.floor((F.dayofyear(_col(date)) - 1) / days).cast("int")


def season(date) -> Column:
    return F.year(_col(date))


def day_of_season(year, doy: int) -> Column:
    return F.date_add(F.make_date(_col(year), F.lit(1), F.lit(1)), doy - 1)


def total_pixels(area_m2, pixel_m2: float = 100.0) -> Column:
    return F.ceil(_col(area_m2) / pixel_m2).cast("int")


def valid_fraction(valid_px, total_px) -> Column:
    return F.least(F.lit(1.0), _col(valid_px) / _col(total_px))


def _codes(value: Column, lo: float, hi: float) -> Column:
    unit = (value - F.lit(lo)) / F.lit(hi - lo)
    # rint rounds halves to even
    return F.rint(F.greatest(F.lit(0.0), F.least(F.lit(1.0), unit)) * QUANT_STEPS).cast("int")


def quantise(value, valid, lo: float = NDVI_CLAMP[0], hi: float = NDVI_CLAMP[1],
             valid_min: float = 0.5) -> Column:
    """0..200 code, 255 where the value is missing or too little was valid."""
    value, valid = _col(value), _col(valid)
    good = value.isNotNull() & (F.coalesce(valid, F.lit(0.0)) >= valid_min)
    return F.when(good, _codes(value, lo, hi)).otherwise(F.lit(QUANT_MASKED))


def quantise_change(before, after, before_valid, after_valid, lo: float = -0.4, hi: float = 0.1,
                    valid_min: float = 0.5) -> Column:
    change = _col(after) - _col(before)
    both = F.least(F.coalesce(_col(before_valid), F.lit(0.0)),
                   F.coalesce(_col(after_valid), F.lit(0.0)))
    return quantise(change, both, lo, hi, valid_min)


def dequantise(code, lo: float = NDVI_CLAMP[0], hi: float = NDVI_CLAMP[1]) -> Column:
    code = _col(code)
    return F.when(code != QUANT_MASKED, F.lit(lo) + code / QUANT_STEPS * F.lit(hi - lo))


def month_day(date) -> Column:
    """'May 03', independent of the locale."""
    date = _col(date)
    return F.concat_ws(" ", F.element_at(F.array(*map(F.lit, MONTHS)), F.month(date)),
                       F.lpad(F.dayofmonth(date).cast("string"), 2, "0"))


def label(code, labels: dict[int, str], default: str | None = None) -> Column:
    pairs = [F.lit(v) for kv in labels.items() for v in kv]
    found = F.try_element_at(F.create_map(*pairs), _col(code))
    return F.coalesce(found, F.lit(default)) if default is not None else found
