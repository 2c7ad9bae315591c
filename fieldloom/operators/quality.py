"""Data-quality checks.  Every check is one row: check_name, scope, expected,
observed, passed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import DEFAULTS
from .spatial import locate

CHECK = ["check_name", "scope", "expected", "observed", "passed"]


def _row(name: str, scope: str, expected, observed: Column, passed: Column) -> list[Column]:
    expected = F.lit(expected) if isinstance(expected, str) else expected
    return [F.lit(name).alias("check_name"), F.lit(scope).alias("scope"),
            expected.cast("string").alias("expected"), observed.cast("string").alias("observed"),
            F.coalesce(passed, F.lit(False)).alias("passed")]


def failed_of(bad: Column, total: Column) -> Column:
    return F.format_string("%d of %d rows failed", bad, total)


def coverage_check(coverage: DataFrame, scope: str, minimum: int = DEFAULTS.min_scenes,
                   named: bool = False) -> DataFrame:
    """Every expected (season, tile) has enough selected scenes; the row counts the short
    ones, or, if ``named``, names them all (their number is bounded by the scope);
    :func:`short_pairs` lists them as rows."""
    short = F.col("n_selected") < minimum
    pair = F.concat(F.col("season"), F.lit("/"), F.col("mgrs_tile"))
    names = [F.sort_array(F.collect_list(F.when(short, pair))).alias("names")] if named else []
    got = coverage.agg(F.count(F.lit(1)).alias("n"), F.count_if(short).alias("bad"), *names)
    observed = failed_of(F.col("bad"), F.col("n"))
    if named:  # a tile without a number has no name
        listed = F.when(F.size("names") > 0, F.concat(F.lit("missing: "), F.array_join("names", ", ")))
        observed = F.when(F.col("bad") == 0, observed).otherwise(listed)
    return got.select(*_row("scenes_per_season_tile_min", scope,
                            f">= {minimum} selected scenes per (season, tile)", observed,
                            F.col("bad") == 0))


def short_pairs(coverage: DataFrame, minimum: int = DEFAULTS.min_scenes) -> DataFrame:
    """The (season, tile) pairs with too few selected scenes, a row each."""
    return coverage.filter(F.col("n_selected") < minimum)


def nonempty_scope_check(coverage: DataFrame, scope: str) -> DataFrame:
    got = coverage.agg(F.count(F.lit(1)).alias("n"))
    return got.select(*_row("scene_coverage_nonempty", scope,
                            ">= 1 (season, tile) pair in scope",
                            F.format_string("%d pairs", F.col("n")), F.col("n") > 0))


def table_checks(obs: DataFrame, scope: str, ranges: dict[str, tuple[float, float]],
                 min_rows: int = 1, table: str = "field_ndvi") -> DataFrame:
    """Range of each column (nulls pass) and row count, in one pass."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for c, (lo, hi) in ranges.items():
        aggs.append(F.count_if(~F.col(c).between(lo, hi)).alias(f"bad_{c}"))
    rows = [F.struct(*_row(f"{table}_{c}_range", scope, f"in [{lo}, {hi}]",
                           failed_of(F.col(f"bad_{c}"), F.col("n")), F.col(f"bad_{c}") == 0))
            for c, (lo, hi) in ranges.items()]
    rows.append(F.struct(*_row(f"{table}_row_count_gt_zero", scope, f">= {min_rows} row",
                               F.col("n"), F.col("n") >= min_rows)))
    return obs.agg(*aggs).select(F.inline(F.array(*rows)))


def row_count_check(df: DataFrame, scope: str, minimum: int, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n")).select(
        *_row(name, scope, f">= {minimum} rows", F.col("n"), F.col("n") >= minimum))


def unique_check(df: DataFrame, scope: str, keys: list[str], name: str) -> DataFrame:
    """Rows whose compound key occurs more than once."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("k"))
    got = per_key.agg(F.coalesce(F.sum(F.when(F.col("k") > 1, F.col("k"))), F.lit(0)).alias("bad"),
                      F.coalesce(F.sum("k"), F.lit(0)).alias("n"))
    return got.select(*_row(name, scope, f"unique ({', '.join(keys)})",
                            failed_of(F.col("bad"), F.col("n")), F.col("bad") == 0))


def delta_check(table: DataFrame, runs: DataFrame, scope: str) -> DataFrame:
    """Row count now against the count as of the previous run, both in the
    same scope.  Warn-only; the first run passes."""
    ranked = runs.orderBy(F.desc("run_seq")).limit(2)
    ends = ranked.agg(F.max("run_seq").alias("cur"), F.min("run_seq").alias("prev"),
                      F.count(F.lit(1)).alias("n_runs"))
    got = table.withColumn("__prev", ends.select("prev").scalar()).agg(
        F.count(F.lit(1)).alias("now"), F.count_if(F.col("run_seq") <= F.col("__prev")).alias("was"))
    got = got.withColumn("n_runs", ends.select("n_runs").scalar())
    first = F.col("n_runs") < 2
    return got.select(*_row(
        "field_ndvi_row_count_vs_previous_snapshot", scope,
        F.when(first, F.lit("previous snapshot")).otherwise(
            F.format_string(">= previous (%d)", F.col("was"))),
        F.when(first, F.lit("none (first snapshot)")).otherwise(
            F.format_string("%d (delta %+d)", F.col("now"), F.col("now") - F.col("was"))),
        first | (F.col("now") >= F.col("was"))))


def unexpected_values(df: DataFrame, column: str, domain: list) -> DataFrame:
    """Every value outside the domain with its number of rows, one row each."""
    return (df.filter(~F.col(column).isin(domain)).groupBy(F.col(column).cast("string").alias("value"))
            .agg(F.count(F.lit(1)).alias("rows")))


def domain_check(df: DataFrame, column: str, domain: list, scope: str) -> DataFrame:
    """Values outside the domain: the check row holds their number, the rows
    themselves are :func:`unexpected_values`."""
    got = unexpected_values(df, column, domain).agg(F.count(F.lit(1)).alias("n"),
                                                    F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
    return got.select(*_row(f"{column}_domain", scope, ", ".join(map(str, domain)),
                            F.format_string("%d unexpected values in %d rows", F.col("n"), F.col("rows")),
                            F.col("n") == 0))


def plausible_check(series: DataFrame, day, lo: float, hi: float, scope: str,
                    value: str = "corn_mean_ndvi") -> DataFrame:
    """Class mean on one date within physical bounds; no such date fails."""
    got = series.filter(F.col("date") == F.to_date(F.lit(day))).agg(F.max(value).alias("v"))
    return got.select(*_row("crop_mean_plausible", scope, f"in [{lo}, {hi}]",
                            F.when(F.col("v").isNull(), "no rows").otherwise(F.format_string("%.4f", F.col("v"))),
                            F.col("v").between(lo, hi)))


def output_coverage_check(selected: DataFrame, written: DataFrame, scope: str,
                          keys: list[str] | None = None) -> DataFrame:
    """Selected scenes without any output partition."""
    keys = keys or ["date", "mgrs_tile"]
    want = selected.select(*keys).distinct()
    gone = want.join(written.select(*keys).distinct().withColumn("__w", F.lit(1)), keys, "left")
    got = gone.agg(F.count(F.lit(1)).alias("n"),
                   F.count_if(F.col("__w").isNull()).alias("bad"))
    return got.select(*_row("output_partition_coverage", scope, "an output partition per selected scene",
                            F.format_string("%d of %d partitions missing", F.col("bad"), F.col("n")),
                            F.col("bad") == 0))


def uniform_check(scenes: DataFrame, columns: list[str], scope: str) -> DataFrame:
    combos = scenes.select(*columns).distinct().agg(F.count(F.lit(1)).alias("n"))
    return combos.select(*_row("scale_offset_uniform", scope, "1 combination",
                               F.format_string("%d combinations", F.col("n")), F.col("n") == 1))


def band_alignment_check(bands: DataFrame, scope: str, n_bands: int = 3) -> DataFrame:
    """Every (scene, x, y) occurs exactly once in every band."""
    per_tile = bands.groupBy("scene_id", "x", "y").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("band").alias("b"))
    bad = (F.col("n") != n_bands) | (F.col("b") != n_bands)
    got = per_tile.agg(F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("bad"))
    return got.select(*_row("band_alignment", scope, f"{n_bands} bands per tile",
                            F.format_string("%d of %d tiles misaligned", F.col("bad"), F.col("n")),
                            F.col("bad") == 0))


def envelope_check(points: DataFrame, envelopes: DataFrame, key: str, scope: str,
                   cell: float) -> DataFrame:
    """Points (key, x, y) that lie in none of the scene envelopes (``poly``).
    They are located by grid cell, not compared with every envelope."""
    found = locate(points.select(key, "x", "y"), envelopes.select("poly"), cell)
    n_in = found.agg(F.count_distinct(key)).scalar()
    got = points.agg(F.count(F.lit(1)).alias("n")).withColumn("bad", F.col("n") - n_in)
    return got.select(*_row("centroid_in_envelope", scope, "centroid inside the scene",
                            failed_of(F.col("bad"), F.col("n")), F.col("bad") == 0))


def line_bytes(text: str | Column = "value") -> Column:
    """Bytes of a line in a file: UTF-8, with its end."""
    return F.octet_length(text) + 1


def tile_budget_check(tiles: DataFrame, budget_bytes: int, scope: str) -> DataFrame:
    """No map tile (z, tx, ty) holds features of more than ``budget_bytes``."""
    got = (tiles.groupBy("z", "tx", "ty").agg(F.sum("bytes").alias("b"))
           .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("b") > budget_bytes).alias("bad"),
                F.coalesce(F.max("b"), F.lit(0)).alias("most")))
    observed = F.format_string("%d of %d tiles above, largest %d bytes", F.col("bad"), F.col("n"), F.col("most"))
    return got.select(*_row("tile_size_budget", scope, f"<= {budget_bytes} bytes a tile", observed,
                            F.col("bad") == 0))


def size_budget_check(lines: DataFrame, budget_bytes: int, scope: str,
                      text: str = "value") -> DataFrame:
    got = lines.agg(F.coalesce(F.sum(line_bytes(text)), F.lit(0)).alias("b"))
    return got.select(*_row("output_size_budget", scope, f"< {budget_bytes} bytes",
                            F.format_string("%d bytes", F.col("b")), F.col("b") < budget_bytes))


def audit(checks: list[DataFrame]) -> DataFrame:
    """All checks as one table, pass or fail."""
    return reduce(DataFrame.unionByName, [c.select(*CHECK) for c in checks])


def gate(results: DataFrame, warn_only: tuple[str, ...] = (
        "field_ndvi_row_count_vs_previous_snapshot",)) -> DataFrame:
    """One row: number of hard failures, warnings and the overall verdict."""
    hard = ~F.col("check_name").isin(list(warn_only)) & ~F.col("passed")
    soft = F.col("check_name").isin(list(warn_only)) & ~F.col("passed")
    return results.agg(F.count_if(hard).alias("failures"), F.count_if(soft).alias("warnings")
                       ).select("failures", "warnings", (F.col("failures") == 0).alias("ok"))


class QualityFailure(RuntimeError):
    """At least one hard check failed (its audit row is already written)."""


def enforce(results: DataFrame) -> None:
    """Raise when a hard check failed.  Call after the audit rows are written."""
    row = gate(results).first()
    if not row["ok"]:
        raise QualityFailure(f"{row['failures']} hard checks failed")
