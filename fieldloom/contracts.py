"""Data contracts: column layouts and the pre-registered thresholds.

Every operator takes its parameters as arguments; the defaults come from here.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- Fixed values (must equal the published thresholds) ---------------------
SCL_MASKED = (0, 1, 3, 8, 9, 10, 11)
NODATA = -9999.0
NDVI_CLAMP = (-0.2, 1.0)
DROP_CLAMP = (-0.4, 0.1)
QUANT_STEPS = 200
QUANT_MASKED = 255
GUST_CLASSES = {"60-79 mph": 1, "80-99 mph": 2, "100+ mph": 3}
CLASS_LABELS = {0: "control", 1: "60-79 mph", 2: "80-99 mph", 3: "100+ mph"}
CROP_LABELS = {1: "Corn", 5: "Soybeans"}
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun",
          "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
# ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Thresholds:
    cloud_max: float = 20.0
    nodata_max: float = 20.0
    valid_frac_min: float = 0.5
    min_area_m2: float = 10_000.0
    inset_m: float = 15.0
    season_doy: tuple[int, int] = (121, 273)
    dekad_days: int = 10
    trailing_days: int = 30
    band_deg: float = 0.15
    min_controls: int = 5
    min_scenes: int = 1


DEFAULTS = Thresholds()

POINT = T.StructType([
    T.StructField("x", T.DoubleType()),
    T.StructField("y", T.DoubleType()),
])
RING = T.ArrayType(POINT)
POLYGON = T.ArrayType(RING)

FIELDS = T.StructType([
    T.StructField("field_id", T.StringType()),
    T.StructField("area_m2", T.DoubleType()),
    T.StructField("utm_zone", T.IntegerType()),
    T.StructField("poly", POLYGON),
])

SCENES = T.StructType([
    T.StructField("scene_id", T.StringType()),
    T.StructField("mgrs_tile", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("dekad", T.IntegerType()),
    T.StructField("season", T.IntegerType()),
    T.StructField("cloud_cover", T.DoubleType()),
    T.StructField("nodata_pct", T.DoubleType()),
    T.StructField("epsg", T.IntegerType()),
    T.StructField("red_href", T.StringType()),
    T.StructField("nir_href", T.StringType()),
    T.StructField("scl_href", T.StringType()),
    T.StructField("red_scale", T.DoubleType()),
    T.StructField("red_offset", T.DoubleType()),
    T.StructField("nir_scale", T.DoubleType()),
    T.StructField("nir_offset", T.DoubleType()),
    T.StructField("ingested_at", T.TimestampType()),
    T.StructField("usable", T.BooleanType()),
    T.StructField("selected", T.BooleanType()),
])

FIELD_NDVI = T.StructType([
    T.StructField("field_id", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("dekad", T.IntegerType()),
    T.StructField("season", T.IntegerType()),
    T.StructField("mgrs_tile", T.StringType()),
    T.StructField("scene_id", T.StringType()),
    T.StructField("mean_ndvi", T.DoubleType()),
    T.StructField("valid_px", T.IntegerType()),
    T.StructField("utm_zone", T.IntegerType()),
    T.StructField("total_px", T.IntegerType()),
    T.StructField("valid_frac", T.DoubleType()),
])

TILES = T.StructType([
    T.StructField("scene_id", T.StringType()),
    T.StructField("band", T.StringType()),
    T.StructField("x", T.IntegerType()),
    T.StructField("y", T.IntegerType()),
    T.StructField("ulx", T.DoubleType()),
    T.StructField("uly", T.DoubleType()),
    T.StructField("scale_x", T.DoubleType()),
    T.StructField("scale_y", T.DoubleType()),
    T.StructField("w", T.IntegerType()),
    T.StructField("h", T.IntegerType()),
    T.StructField("data", T.ArrayType(T.FloatType())),
])

DQ_RESULTS = T.StructType([
    T.StructField("check_name", T.StringType()),
    T.StructField("scope", T.StringType()),
    T.StructField("expected", T.StringType()),
    T.StructField("observed", T.StringType()),
    T.StructField("passed", T.BooleanType()),
    T.StructField("run_at", T.TimestampType()),
])

# One catalogue item (GeoJSON feature with asset map), read with an explicit
# schema so that malformed or missing members become nulls, not inference.
ITEM = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("collection", T.StringType()),
    T.StructField("properties", T.StructType([
        T.StructField("datetime", T.StringType()),
        T.StructField("grid:code", T.StringType()),
        T.StructField("eo:cloud_cover", T.DoubleType()),
        T.StructField("s2:nodata_pixel_percentage", T.DoubleType()),
        T.StructField("proj:epsg", T.IntegerType()),
    ])),
    T.StructField("assets", T.MapType(T.StringType(), T.StructType([
        T.StructField("href", T.StringType()),
        T.StructField("raster:bands", T.ArrayType(T.StructType([
            T.StructField("scale", T.DoubleType()),
            T.StructField("offset", T.DoubleType()),
        ]))),
    ]))),
])
ITEM_PAGE = T.StructType([T.StructField("features", T.ArrayType(ITEM))])
