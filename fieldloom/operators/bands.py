"""Band (range) matching by prefix sums: no (treated, control) pair is built.

The mean of the controls inside ``[t - b, t + b]`` is the difference of two
running sums, so the cost is one sort of controls plus band ends, whatever
the number of controls per band.  For two-dimensional bands the longitude
ranks are covered by power-of-two blocks (each control belongs to one block
per level, each band to at most two), and the latitude sums run per block.
Sums are decimals: the difference of two running sums is then exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shared import materialize
from .ordered import running_sums

EXACT = "decimal(30,12)"


def _range_sums(points: DataFrame, ranges: DataFrame, keys: list[str], ids: list[str],
                upper_open: bool) -> DataFrame:
    """Per ``ids`` the sums of the ``points`` (keys, __at, __sum, __cnt) inside
    the ``ranges`` (ids, keys, __lo, __hi), over all keys."""
    # at one position: range starts first, then points, then closed range ends
    end_tie = 0 if upper_open else 2
    marks = ranges.select(*dict.fromkeys([*ids, *keys]), F.inline(F.array(
        F.struct(F.col("__lo").alias("__at"), F.lit(0).alias("__tie"), F.lit(-1).alias("__sign")),
        F.struct(F.col("__hi").alias("__at"), F.lit(end_tie).alias("__tie"),
                 F.lit(1).alias("__sign")))))
    spot = [*keys, "__at", "__tie"]
    # only distinct range ends take part in the sort
    stops = marks.select(*spot).distinct().withColumns(
        {"__sum": F.lit(0).cast(EXACT), "__cnt": F.lit(0).cast("bigint")})
    line = points.select(*keys, "__at", F.lit(1).alias("__tie"), "__sum", "__cnt")
    upto = (running_sums(line.unionByName(stops), keys, "__at",
                         {"__s": "__sum", "__c": "__cnt"}, ["__tie"])
            .filter(F.col("__tie") != 1).select(*spot, "__s", "__c"))
    return marks.join(upto, spot).groupBy(*ids).agg(
        F.sum(F.when(F.col("__sign") > 0, F.col("__s")).otherwise(-F.col("__s")))
        .cast(EXACT).alias("__sum"),
        F.sum(F.col("__sign") * F.col("__c")).alias("__cnt"))


def _weights(controls: DataFrame, by: list[Column]) -> DataFrame:
    return controls.groupBy(*by).agg(
        F.sum(F.col("delta").cast("decimal(20,12)")).cast(EXACT).alias("__sum"),
        F.count(F.lit(1)).alias("__cnt"))


def _finish(treated: DataFrame, sums: DataFrame, on: list[str], min_n: int) -> DataFrame:
    mean = F.col("__sum").cast("double") / F.col("__cnt")
    return (treated.join(sums, on, "left")
            .withColumn("ctrl_n", F.coalesce(F.col("__cnt"), F.lit(0)).cast("bigint"))
            .withColumn("ctrl_delta", F.when(F.col("ctrl_n") >= min_n, mean))
            .drop("__sum", "__cnt"))


def match_lat(treated: DataFrame, controls: DataFrame, band, min_n: int = 5,
              upper_open: bool = False, by: tuple[str, ...] = ()) -> DataFrame:
    """Add ``ctrl_delta`` (null below ``min_n`` controls) and ``ctrl_n``:
    the mean control delta with lat in ``[t - band, t + band]``.

    Rows only meet within equal ``by`` columns; ``band`` may be a Column of them, so many
    variants of a study are matched by one chain of running sums."""
    ids = [*by, "lat"]
    points = _weights(controls, [*map(F.col, by), F.col("lat").alias("__at")])
    bands = treated.select(*ids, F.lit(band).alias("__b")).distinct().select(
        *ids, (F.col("lat") - F.col("__b")).alias("__lo"), (F.col("lat") + F.col("__b")).alias("__hi"))
    return _finish(treated, _range_sums(points, bands, list(by), ids, upper_open), ids, min_n)


def match_lat_lon(treated: DataFrame, controls: DataFrame, lat_band, lon_band, min_n: int = 5,
                  upper_open: bool = True) -> DataFrame:
    """As :func:`match_lat` with lat in ``[t - b, t + b)`` and lon within
    ``lon_band`` at both ends (closed)."""
    lb, ob = F.lit(lat_band), F.lit(lon_band)
    spots = treated.select("lat", "lon").distinct().select(
        "lat", "lon", (F.col("lat") - lb).alias("__lo"), (F.col("lat") + lb).alias("__hi"),
        (F.col("lon") - ob).alias("__w"), (F.col("lon") + ob).alias("__e"))
    weights = _weights(controls, ["lat", "lon"])

    # rank of every distinct control longitude and of both band ends:
    # [__r0, __r1) are the ranks inside the band
    one = F.lit(1).cast("bigint").alias("__one")
    none = F.lit(0).cast("bigint").alias("__one")
    lons = weights.select(F.col("lon").alias("__at"), F.lit(1).alias("__tie"), one).distinct()
    west = spots.select(F.col("__w").alias("__at"), F.lit(0).alias("__tie"), none).distinct()
    east = spots.select(F.col("__e").alias("__at"), F.lit(2).alias("__tie"), none).distinct()
    ranks = materialize(running_sums(lons.unionByName(west).unionByName(east), [], "__at",
                                     {"__upto": "__one"}, ["__tie"]), "ranks")

    def rank_of(tie: int, at: str, out: str, shift: int = 0) -> DataFrame:
        return ranks.filter(F.col("__tie") == tie).select(
            F.col("__at").alias(at), (F.col("__upto") - shift).alias(out))

    spots = materialize(
        spots.join(rank_of(0, "__w", "__r0"), "__w").join(rank_of(2, "__e", "__r1"), "__e")
        .filter(F.col("__r1") > F.col("__r0")), "spots")
    levels = spots.agg(F.floor(F.log2(F.max(F.col("__r1") - F.col("__r0")))).cast("int")).scalar()

    # controls: one block per level; no level is wider than the widest band
    points = (weights.join(rank_of(1, "lon", "__rank", 1), "lon")
              .withColumn("__top", F.coalesce(levels, F.lit(0)))
              .withColumn("__level", F.explode(F.sequence(F.lit(0), F.col("__top"))))
              .withColumn("__block", F.expr("shiftright(__rank, __level)"))
              .groupBy("__level", "__block", F.col("lat").alias("__at"))
              .agg(F.sum("__sum").cast(EXACT).alias("__sum"), F.sum("__cnt").alias("__cnt")))

    # bands: the blocks of each level that lie inside and have no parent inside
    first = F.expr("shiftright(__r0 + shiftleft(1L, __level) - 1, __level)")
    after = F.expr("shiftright(__r1, __level)")
    parts = (spots.withColumn("__level", F.explode(F.sequence(
                F.lit(0), F.floor(F.log2(F.col("__r1") - F.col("__r0"))).cast("int"))))
             .withColumn("__f", first).withColumn("__a", after)
             .filter(F.col("__f") < F.col("__a"))
             .withColumn("__block", F.explode(F.array_compact(F.array(
                 F.when(F.col("__f") % 2 == 1, F.col("__f")),
                 F.when(F.col("__a") % 2 == 1, F.col("__a") - 1)))))
             .select("lat", "lon", "__lo", "__hi", "__level", "__block"))
    sums = _range_sums(points, parts, ["__level", "__block"], ["lat", "lon"], upper_open)
    return _finish(treated, sums, ["lat", "lon"], min_n)
