"""Text outputs: GeoJSON sequences and the season manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import scalars as S


def feature_json(props: list[str], poly: str = "poly") -> Column:
    return G.as_geojson(poly, lambda geometry: F.struct(
        F.lit("Feature").alias("type"), F.struct(*props).alias("properties"), geometry.alias("geometry")))


def feature_lines(df: DataFrame, props: list[str], poly: str = "poly") -> DataFrame:
    return df.select(feature_json(props, poly).alias("value"))


def write_features(df: DataFrame, props: list[str], path: str, poly: str = "poly") -> None:
    """One feature per line."""
    feature_lines(df, props, poly).write.mode("overwrite").text(path)


def season_manifest(obs: DataFrame, season: Column) -> DataFrame:
    """One JSON row: the season's ten-day periods with their earliest date.
    Without any row the payload is explicit: no season, no periods."""
    # at most 37 periods per season
    per_dekad = (obs.withColumn("__season", season).filter(F.col("season") == F.col("__season"))
                 .groupBy("season", "dekad").agg(F.min("date").alias("first")))
    entry = F.struct("dekad", F.concat(F.lit("d"), F.col("dekad")).alias("prop"),
                     F.date_format("first", "yyyy-MM-dd").alias("date"),
                     S.month_day("first").alias("label"))
    listed = per_dekad.agg(F.max("season").alias("season"),
                           F.sort_array(F.collect_list(entry)).alias("d"))
    dekads = F.transform("d", lambda e: F.struct(
        e["prop"].alias("prop"), e["date"].alias("date"), e["label"].alias("label")))
    return listed.select(F.to_json(F.struct("season", dekads.alias("dekads")),
                                   {"ignoreNullFields": "false"}).alias("value"))
