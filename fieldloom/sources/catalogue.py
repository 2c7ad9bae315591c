"""Scene catalogue: nested items -> flat manifest rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import ITEM, ITEM_PAGE
from ..functions import geometry as G
from ..functions import scalars as S


def rewrite_prefix(href: Column, prefixes: dict[str, str]) -> Column:
    """Replace a known leading prefix; an unknown one fails the job."""
    out = F.raise_error(F.concat(F.lit("no rewrite is known for the link "), href))
    for old, new in reversed(prefixes.items()):
        out = F.when(href.startswith(old),
                     F.concat(F.lit(new), F.substring(href, F.lit(len(old) + 1), F.length(href)))
                     ).otherwise(out)
    return F.when(href.isNotNull(), out)


def read_items(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.schema(ITEM).json(list(paths))


def read_pages(spark: SparkSession, *paths: str) -> DataFrame:
    """Search-result pages (each with a feature list) -> items."""
    return (spark.read.schema(ITEM_PAGE).json(list(paths))
            .select(F.inline("features")))


def search(items: DataFrame, collection: str, tiles: list[str] | None,
           ranges: list[tuple[str, str]]) -> DataFrame:
    """Items of a collection, its tiles and any of the date ranges (inclusive);
    an item found on several pages is kept once."""
    day = F.to_date(F.substring("properties.datetime", 1, 10))
    hit = F.lit(False)
    for start, end in ranges:
        hit = hit | day.between(F.to_date(F.lit(start)), F.to_date(F.lit(end)))
    found = items.filter((F.col("collection") == collection) & hit)
    if tiles is not None:
        found = found.filter(F.col("properties.`grid:code`").isin([f"MGRS-{t}" for t in tiles]))
    return found.dropDuplicates(["id"])


def manifest_rows(items: DataFrame, prefixes: dict[str, str] | None = None) -> DataFrame:
    """One flat row per item, defaults filled in for absent members."""
    p = F.col("properties")
    tile = G.tile_name(p["grid:code"])
    date = F.to_date(F.substring(p["datetime"], 1, 10))

    def href(band: str) -> Column:
        link = F.element_at("assets", F.lit(band))["href"]
        return rewrite_prefix(link, prefixes) if prefixes else link

    def number(band: str, part: str, default: float) -> Column:
        first = F.get(F.element_at("assets", F.lit(band))["raster:bands"], F.lit(0))
        return F.coalesce(first[part], F.lit(default))

    return items.select(
        F.col("id").alias("scene_id"), tile.alias("mgrs_tile"), date.alias("date"),
        S.dekad(date).alias("dekad"), F.year(date).alias("season"),
        F.coalesce(p["eo:cloud_cover"], F.lit(100.0)).alias("cloud_cover"),
        F.coalesce(p["s2:nodata_pixel_percentage"], F.lit(0.0)).alias("nodata_pct"),
        F.coalesce(p["proj:epsg"], G.tile_epsg(tile)).alias("epsg"),
        href("red").alias("red_href"), href("nir").alias("nir_href"), href("scl").alias("scl_href"),
        number("red", "scale", 1.0).alias("red_scale"),
        number("red", "offset", 0.0).alias("red_offset"),
        number("nir", "scale", 1.0).alias("nir_scale"),
        number("nir", "offset", 0.0).alias("nir_offset"), F.current_timestamp().alias("ingested_at"))


def date_ranges(seasons: DataFrame, doy: tuple[int, int], season: str = "season") -> DataFrame:
    """Season years -> first and last day of the growing season."""
    return seasons.select(season, S.day_of_season(season, doy[0]).alias("start"),
                          S.day_of_season(season, doy[1]).alias("end"))
