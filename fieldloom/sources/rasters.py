"""Raster scans: tile tables, re-tiling, tagged multi-file reads, windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import raster as R
from ..shared import sized_join


def pixels_to_tiles(pixels: DataFrame, keys: list[str], tile_px: int, value: str = "value",
                    spots: tuple[str, str] = ("col", "row")) -> DataFrame:
    """Pixel table (keys, col, row, value) -> square tiles with row-major
    ``data``.  A group is one tile, so it never exceeds ``tile_px ** 2``."""
    col, row = (F.col(c) for c in spots)
    at = (row % tile_px) * tile_px + col % tile_px
    return (pixels.select(*keys, F.floor(col / tile_px).cast("int").alias("x"),
                          F.floor(row / tile_px).cast("int").alias("y"),
                          F.struct(at.cast("int").alias("at"), F.col(value).alias("v")).alias("p"))
            .groupBy(*keys, "x", "y").agg(F.sort_array(F.collect_list("p")).alias("p"))
            .select(*keys, "x", "y", F.col("p.v").alias("data")))


def tiles_to_pixels(tiles: DataFrame, keys: list[str], data: str = "data",
                    out: str = "value") -> DataFrame:
    """Tiles -> one row per pixel with its scene-wide (col, row) position."""
    return (tiles.select(*keys, "x", "y", "w", "h", F.posexplode(data).alias("at", out))
            .select(*keys, (F.col("x") * F.col("w") + F.col("at") % F.col("w")).alias("col"),
                    (F.col("y") * F.col("h") + F.floor(F.col("at") / F.col("w"))).cast("int")
                    .alias("row"), out))


def read_tagged(spark: SparkSession, root: str, manifest: DataFrame, folder: str = "href",
                tag: str = "scene_id") -> DataFrame:
    """One scan of every file under ``root``; each row gets the tag of the
    manifest entry whose folder its file lies in."""
    files = spark.read.option("recursiveFileLookup", "true").parquet(root)
    tagged = files.select("*", F.regexp_extract(
        F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1).alias(folder))
    return sized_join(tagged, manifest.select(folder, tag), [folder]).drop(folder)


def in_window(tiles: DataFrame, xmin: float, ymin: float, xmax: float, ymax: float) -> DataFrame:
    """Tiles whose extent meets the box."""
    box = R.envelope()
    return tiles.filter((box["xmin"] < xmax) & (box["xmax"] > xmin)
                        & (box["ymin"] < ymax) & (box["ymax"] > ymin))


def window_pixels(tiles: DataFrame, bands: list[str], xmin: float, ymin: float, xmax: float,
                  ymax: float) -> DataFrame:
    """Pixels of the tiles whose centre lies in the box, bands side by side."""
    zipped = F.arrays_zip(*[F.col(b) for b in bands])
    px = (in_window(tiles, xmin, ymin, xmax, ymax)
          .select("scene_id", "x", "y", "w", "ulx", "uly", "scale_x", "scale_y",
                  F.posexplode(zipped).alias("at", "p")))
    cx = F.col("ulx") + (F.col("at") % F.col("w") + 0.5) * F.col("scale_x")
    cy = F.col("uly") + (F.floor(F.col("at") / F.col("w")) + 0.5) * F.col("scale_y")
    return (px.withColumn("cx", cx).withColumn("cy", cy)
            .filter(F.col("cx").between(xmin, xmax) & F.col("cy").between(ymin, ymax))
            .select("scene_id", "x", "y", "at", "cx", "cy", "p.*"))
