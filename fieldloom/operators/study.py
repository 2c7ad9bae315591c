"""Matched-control difference-in-differences and its diagnostics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..contracts import CLASS_LABELS, DEFAULTS
from ..functions import scalars as S
from ..shared import materialize
from .bands import match_lat, match_lat_lon
from .ordered import quantiles


def exact_avg(column: str) -> Column:
    """Mean that does not depend on the order of the rows (decimal sum)."""
    return F.avg(F.col(column).cast("decimal(20,12)")).cast("double")


def usable(frame: DataFrame, valid_min: float | Column = DEFAULTS.valid_frac_min) -> DataFrame:
    ok = (F.col("pre").isNotNull() & F.col("post").isNotNull()
          & (F.col("pre_vf") >= valid_min) & (F.col("post_vf") >= valid_min))
    return frame.withColumn("usable", F.coalesce(ok, F.lit(False)))


def event_frame(wide: DataFrame, fields: DataFrame, wind: DataFrame,
                crop: int | None = None,
                valid_min: float = DEFAULTS.valid_frac_min) -> DataFrame:
    """before/after + field position + wind class, one row per field.

    ``fields``: field_id, crop, lat, lon;  ``wind``: field_id, wind.  ``wide``
    was aggregated to one row per field before this join."""
    if crop is not None:
        fields = fields.filter(F.col("crop") == crop)
    return usable(wide.join(fields.select("field_id", "lat", "lon"), "field_id")
                  .join(wind, "field_id")
                  .withColumn("delta", F.col("post") - F.col("pre")), valid_min)


def matched(frame: DataFrame, lat_band, lon_band=None, min_n: int = DEFAULTS.min_controls,
            upper_open: bool | None = None) -> DataFrame:
    """Usable treated fields with their control mean and ``did``; fields with
    too few controls are dropped."""
    # one row per field; treated and controls are both cut from it
    ok = materialize(frame.filter("usable"), "usable")
    treated, controls = ok.filter(F.col("wind") > 0), ok.filter(F.col("wind") == 0)
    if lon_band is None:
        pairs = match_lat(treated, controls, lat_band, min_n, bool(upper_open))
    else:
        pairs = match_lat_lon(treated, controls, lat_band, lon_band, min_n,
                              True if upper_open is None else upper_open)
    return (pairs.filter(F.col("ctrl_delta").isNotNull())
            .withColumn("did", F.col("delta") - F.col("ctrl_delta")))


def did_table(match: DataFrame, *by: str) -> DataFrame:
    """Per class (and ``by``): n, means and the standard error of the mean, to 4 places
    (halves to even)."""
    r = lambda c: F.bround(c, 4)
    return (match.groupBy(*by, "wind").agg(
        F.count(F.lit(1)).alias("fields"), r(exact_avg("delta")).alias("mean_delta"),
        r(exact_avg("ctrl_delta")).alias("mean_ctrl"), r(exact_avg("did")).alias("did"),
        r(F.try_divide(F.stddev_samp("did"), F.sqrt(F.count(F.lit(1))))).alias("did_se"))
        .withColumn("label", S.label("wind", CLASS_LABELS)))


def sensitivity(frame: DataFrame, variants: dict[str, tuple[float, float]],
                min_n: int = DEFAULTS.min_controls) -> DataFrame:
    """Effect per class for each labelled (validity threshold, lat band).  The variant is a
    key of the match: all of them share one pass, whatever their number."""
    plans = F.array(*[F.struct(F.lit(name).alias("variant"), F.lit(float(least)).alias("least"),
                               F.lit(float(band)).alias("band")) for name, (least, band) in variants.items()])
    cases = frame.drop("usable").select("*", F.inline(plans))
    ok = materialize(usable(cases, F.col("least")).filter("usable"), "usable")
    pairs = match_lat(ok.filter(F.col("wind") > 0), ok.filter(F.col("wind") == 0), F.col("band"), min_n,
                      by=("variant",))
    match = (pairs.filter(F.col("ctrl_delta").isNotNull())
             .withColumn("did", F.col("delta") - F.col("ctrl_delta")))
    return did_table(match, "variant").select(F.col("variant").alias("label"), "wind", "fields", "did")


def monotonic(table: DataFrame) -> DataFrame:
    """One row: is the rounded effect strictly lower in every next class?
    (The table has one row per class.)"""
    prev = F.lag("did").over(Window.orderBy("wind"))
    return (table.select("wind", "did", prev.alias("prev"))
            .agg(F.coalesce(F.bool_and(F.col("did") < F.col("prev")), F.lit(True))
                 .alias("monotonic")))


def attrition(frame: DataFrame, match: DataFrame) -> DataFrame:
    counts = match.groupBy("wind").agg(F.count(F.lit(1)).alias("matched"))
    kept = F.col("cloud_ok") / F.col("corn_fields")
    return (frame.groupBy("wind").agg(F.count(F.lit(1)).alias("corn_fields"),
                                      F.count_if("usable").alias("cloud_ok"))
            .join(counts, "wind", "left")
            .withColumn("dropped_pct", F.bround(100 * (1 - kept), 1))
            .withColumn("label", S.label("wind", CLASS_LABELS)))


def class_profile(frame: DataFrame) -> DataFrame:
    """Usable fields per class: means and the exact lon p10/p90."""
    ok = frame.filter("usable")
    means = ok.groupBy("wind").agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"mean_{c}")
                                        for c in ("pre", "post", "delta", "lat", "lon")])
    return means.join(quantiles(ok, ["wind"], "lon", {"lon_p10": 0.1, "lon_p90": 0.9}), "wind")


def tercile_effect(match: DataFrame, by: str = "lon",
                   names: tuple[str, ...] = ("west", "mid", "east")) -> DataFrame:
    """Effect per (class, quantile bin of ``by``).  Bins are right-closed and
    the lowest value belongs to the first."""
    n = len(names)
    cuts = quantiles(match, [], by, {f"q{i}": i / n for i in range(1, n)})
    cut_list = cuts.select(F.array(*[f"q{i}" for i in range(1, n)]).alias("c")).scalar()
    binned = match.withColumn("__cuts", cut_list)
    name = F.lit(names[-1])
    for i in reversed(range(n - 1)):
        name = F.when(F.col(by) <= F.col("__cuts")[i], F.lit(names[i])).otherwise(name)
    return (binned.withColumn("bin", name).groupBy("wind", "bin")
            .agg(F.count(F.lit(1)).alias("n"), F.bround(exact_avg("did"), 4).alias("did")))


def raw_drop(wide: DataFrame, fields: DataFrame, wind: DataFrame, crop: int | None = None) -> DataFrame:
    """Uncontrolled change per class."""
    if crop is not None:
        fields = fields.filter(F.col("crop") == crop)
    zoned = (wide.withColumn("change", F.col("post") - F.col("pre"))
             .join(fields.select("field_id"), "field_id").join(wind, "field_id"))
    return zoned.groupBy(F.col("wind").alias("gust_class")).agg(
        F.count(F.lit(1)).alias("fields"), F.round(exact_avg("pre"), 4).alias("pre"),
        F.round(exact_avg("post"), 4).alias("post"), F.round(exact_avg("change"), 4).alias("drop"))


def crop_series(obs: DataFrame, fields: DataFrame, crop: int,
                valid_min: float = DEFAULTS.valid_frac_min) -> DataFrame:
    """Mean of the crop's fields per date."""
    # summed per field and date first: a field with very many rows joins as few
    exact = lambda c: F.sum(F.col(c).cast("decimal(20,12)")).alias(c)
    daily = obs.filter(F.col("valid_frac") >= valid_min).groupBy("field_id", "date").agg(
        F.count(F.lit(1)).alias("n"), exact("mean_ndvi"), exact("valid_frac"))
    chosen = fields.filter(F.col("crop") == crop).select("field_id")

    def mean(c: str, places: int) -> Column:
        quotient = F.sum(c).cast("decimal(24,12)") / F.sum("n").cast("decimal(10,0)")
        return F.round(quotient.cast("double"), places)

    return daily.join(chosen, "field_id").groupBy("date").agg(
        F.sum("n").alias("fields"), mean("mean_ndvi", 4).alias("corn_mean_ndvi"),
        mean("valid_frac", 3).alias("avg_valid_frac"))


def climatology(obs: DataFrame) -> DataFrame:
    """(field, dekad) median and interquartile range over the seasons."""
    # a group holds the seasons of one field and ten days: the exact percentile's own
    # aggregation (value -> count, combined before the shuffle) is enough
    q = obs.groupBy("field_id", "dekad").agg(
        F.percentile("mean_ndvi", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"))
    return q.select("field_id", "dekad", F.col("q")[1].alias("median"),
                    (F.col("q")[2] - F.col("q")[0]).alias("iqr"))


def anomaly(obs: DataFrame) -> DataFrame:
    """Observations with a robust z-score against the field's own history
    (null where the range is zero)."""
    spread = F.col("iqr") / 1.349  # range of the standard normal's quartiles
    return (obs.join(climatology(obs), ["field_id", "dekad"])
            .withColumn("z", F.when(F.col("iqr") > 0, (F.col("mean_ndvi") - F.col("median")) / spread)))
