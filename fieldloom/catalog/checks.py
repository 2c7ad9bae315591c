"""Queries: data-quality checks."""

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions import geometry as G
from ..operators import grid, quality, scenes, study
from ..plans import stages
from .base import query
from .joins import COVERAGE
from .sources import runs
from .zonal_parts import scene_grid

OBS = fx.observations
SEASONS = [1996, 1997, 1998, 2022]


def row(name, expected, observed, passed, scope="demo"):
    """Oracle columns of one check row."""
    return (f"'{name}' AS check_name, '{scope}' AS scope, {expected} AS expected, "
            f"{observed} AS observed, {passed} AS passed")


def manifest(spark, sf):
    return scenes.season_mode(scenes.quality_gate(fx.scenes(spark, sf)))


COVER_ROW = "SELECT " + row(
    "scenes_per_season_tile_min", "'>= 1 selected scenes per (season, tile)'",
    """CASE WHEN count(*) FILTER (n_selected < 1) = 0 THEN '0 of ' || count(*) || ' rows failed' ELSE
  'missing: ' || string_agg(season || '/' || mgrs_tile, ', ' ORDER BY season || '/' || mgrs_tile)
  FILTER (n_selected < 1) END""", "count(*) FILTER (n_selected < 1) = 0") + f" FROM ({COVERAGE})"


@query("q1_coverage", "sel", COVER_ROW)
def _(spark, sf):
    return quality.coverage_check(scenes.coverage(manifest(spark, sf), SEASONS), "demo", named=True)


@query("q1_short_pairs", "sel", f"SELECT * FROM ({COVERAGE}) WHERE n_selected < 1")
def _(spark, sf):
    return quality.short_pairs(scenes.coverage(manifest(spark, sf), SEASONS))


def range_row(c, lo, hi):
    bad = f"count(*) FILTER (NOT {c} BETWEEN {lo} AND {hi})"
    return "SELECT " + row(f"field_ndvi_{c}_range", f"'in [{lo}, {hi}]'",
                           f"{bad} || ' of ' || count(*) || ' rows failed'", f"{bad} = 0") + " FROM ob"


COUNT_ROW = "SELECT " + row("field_ndvi_row_count_gt_zero", "'>= 1 row'", "CAST(count(*) AS VARCHAR)",
                            "count(*) >= 1") + " FROM ob"


@query("q2_ranges", "ob", " UNION ALL ".join([range_row("mean_ndvi", -1.0, 0.75),
                                              range_row("valid_frac", 0.0, 1.0), COUNT_ROW]))
def _(spark, sf):
    return quality.table_checks(OBS(spark, sf), "demo", {"mean_ndvi": (-1.0, 0.75),
                                                         "valid_frac": (0.0, 1.0)})


@query("q3_row_count", "ob", "SELECT " + row("enough", "'>= 1000000000 rows'", "CAST(count(*) AS VARCHAR)",
                                             "count(*) >= 1000000000") + " FROM ob")
def _(spark, sf):
    return quality.row_count_check(OBS(spark, sf), "demo", 1_000_000_000, "enough")


def unique_row(name, keys, source):
    bad = "coalesce(sum(k) FILTER (k > 1), 0)"
    return "SELECT " + row(name, f"'unique ({keys})'", f"{bad} || ' of ' || sum(k) || ' rows failed'",
                           f"{bad} = 0") + f" FROM (SELECT count(*) AS k FROM {source} GROUP BY {keys})"


@query("q4_unique_key", "", unique_row("line_key", "l_orderkey, l_linenumber", "lineitem"))
def _(spark, sf):
    return quality.unique_check(fx.table(spark, sf, "lineitem"), "demo",
                                ["l_orderkey", "l_linenumber"], "line_key")


@query("q5_row_delta", "ob", "SELECT " + row(
    "field_ndvi_row_count_vs_previous_snapshot", "'>= previous (' || was || ')'",
    "now || ' (delta +' || (now - was) || ')'", "now >= was") + """ FROM (SELECT count(*) AS now,
  count(*) FILTER (season < (SELECT max(season) FROM ob)) AS was FROM ob)""")
def _(spark, sf):
    table = OBS(spark, sf).withColumn("run_seq", F.col("season"))
    return quality.delta_check(table, runs(spark, sf), "demo")


AUDIT = " UNION ALL ".join([
    "SELECT " + row("scene_coverage_nonempty", "'>= 1 (season, tile) pair in scope'",
                    "count(*) || ' pairs'", "count(*) > 0") + f" FROM ({COVERAGE})",
    COVER_ROW, range_row("mean_ndvi", -1.0, 1.0), range_row("valid_frac", 0.0, 1.0), COUNT_ROW,
    unique_row("field_ndvi_no_duplicate_field_date", "field_id, date, mgrs_tile", "ob"),
    "SELECT " + row("field_ndvi_row_count_vs_previous_snapshot", "'>= previous (' || was || ')'",
                    "now || ' (delta +' || (now - was) || ')'", "now >= was")
    + """ FROM (SELECT count(*) AS now, count(*) FILTER (season < (SELECT max(season) FROM ob)) AS was FROM ob)"""])
# the scope's rows only
AUDIT = AUDIT.replace("FROM ob", f"FROM (SELECT * FROM ob WHERE season IN {tuple(SEASONS)})")


@query("q6_audit", "sel ob", AUDIT)
def _(spark, sf):
    obs = OBS(spark, sf).withColumn("run_seq", F.col("season"))
    return stages.quality_stage(manifest(spark, sf), obs, "demo", SEASONS,
                                runs=runs(spark, sf).filter(F.col("run_seq").isin(SEASONS)))


@query("q7_unexpected_values", "", """SELECT event_type AS value, count(*) AS rows FROM events
  WHERE event_type NOT IN ('click', 'view') GROUP BY event_type""")
def _(spark, sf):
    return quality.unexpected_values(fx.events(spark, sf), "event_type", ["click", "view"])


@query("q7_domain", "", "SELECT " + row("event_type_domain", "'click, view'",
       "format('{} unexpected values in {} rows', count(DISTINCT event_type), count(*))", "count(*) = 0")
       + " FROM events WHERE event_type NOT IN ('click', 'view')")
def _(spark, sf):
    return quality.domain_check(fx.events(spark, sf), "event_type", ["click", "view"], "demo")


@query("q8_plausible_mean", "ob fl", "SELECT " + row(
    "crop_mean_plausible", "'in [0.1, 0.9]'", "coalesce(printf('%.4f', max(v)), 'no rows')",
    "coalesce(max(v) BETWEEN 0.1 AND 0.9, false)") + """ FROM (SELECT round(avg(mean_ndvi::DECIMAL(20, 12)), 4) AS v FROM ob
  JOIN fl USING (field_id) WHERE crop = 1 AND valid_frac >= 0.5 AND date = DATE '1995-07-07' GROUP BY date)""")
def _(spark, sf):
    series = study.crop_series(OBS(spark, sf), fx.fields(spark, sf), 1)
    return quality.plausible_check(series, "1995-07-07", 0.1, 0.9, "demo")


@query("q9_gate", "sel ob", f"""SELECT count(*) FILTER (NOT passed) AS failures, 0::BIGINT AS warnings,
  count(*) FILTER (NOT passed) = 0 AS ok FROM ({AUDIT})""")
def _(spark, sf):
    return quality.gate(stages.quality_stage(manifest(spark, sf), OBS(spark, sf), "demo", SEASONS))


@query("q10_output_coverage", "sel ob", "SELECT " + row(
    "output_partition_coverage", "'an output partition per selected scene'",
    "count(*) FILTER (NOT hit) || ' of ' || count(*) || ' partitions missing'",
    "count(*) FILTER (NOT hit) = 0") + """ FROM (SELECT DISTINCT date, mgrs_tile, EXISTS (SELECT 1 FROM ob
  WHERE ob.date = sel.date AND ob.mgrs_tile = sel.mgrs_tile) AS hit FROM sel WHERE selected)""")
def _(spark, sf):
    return quality.output_coverage_check(manifest(spark, sf).filter("selected"), OBS(spark, sf), "demo")


@query("q11_uniform_scale", "sc", "SELECT " + row(
    "scale_offset_uniform", "'1 combination'", "count(*) || ' combinations'", "count(*) = 1")
    + " FROM (SELECT DISTINCT scene_id % 3 AS scale, scene_id % 2 AS off FROM sc)")
def _(spark, sf):
    df = fx.scenes(spark, sf).select((F.col("scene_id") % 3).alias("scale"),
                                     (F.col("scene_id") % 2).alias("off"))
    return quality.uniform_check(df, ["scale", "off"], "demo")


@query("q12_band_alignment", "rt", "SELECT " + row(
    "band_alignment", "'3 bands per tile'", "count(*) FILTER (vec_id % 9 = 4) || ' of ' || count(*) || "
    "' tiles misaligned'", "count(*) FILTER (vec_id % 9 = 4) = 0") + " FROM rt")
def _(spark, sf):
    # every ninth tile lacks its nir band
    k = F.col("scene_id") * 100 + F.col("y") * 10 + F.col("x")
    b = fx.bands(spark, sf).filter(~((k % 9 == 4) & (F.col("band") == "nir")))
    return quality.band_alignment_check(b, "demo")


@query("q13_centroid_in_envelope", "fl", "SELECT " + row(
    "centroid_in_envelope", "'centroid inside the scene'",
    "count(*) FILTER (bad) || ' of ' || count(*) || ' rows failed'", "count(*) FILTER (bad) = 0")
    + " FROM (SELECT NOT (mx >= 0 AND mx < 400 AND my >= 0 AND my < 400) AS bad FROM fl)")
def _(spark, sf):
    span = F.col("stride")
    outline = grid.shared_grids(scene_grid(spark, sf)).select(G.rectangle(
        "x0", F.col("y0") - span * (F.col("y_hi") + 1), F.col("x0") + span * (F.col("x_hi") + 1),
        "y0").alias("poly"))
    points = fx.fields(spark, sf).select("field_id", G.centroid("poly").alias("c")).select(
        "field_id", "c.x", "c.y")
    return quality.envelope_check(points, outline, "field_id", "demo", fx.CELL)


@query("q14_run_metrics", "ob", """SELECT 'publish' AS stage, 'demo' AS scope, count(*) AS rows_in,
  (SELECT count(*) FROM (SELECT DISTINCT field_id, dekad FROM ob)) AS rows_out,
  count(DISTINCT season) AS partitions FROM ob""")
def _(spark, sf):
    from ..operators import publish
    from ..operators.metrics import run_with_metrics
    from ..shared import shared_folder
    metrics = run_with_metrics(
        OBS(spark, sf), lambda df: publish.best_row(df), shared_folder(spark, "q14"),
        "publish", "demo", "season")
    return metrics.select("stage", "scope", "rows_in", "rows_out", "partitions")
