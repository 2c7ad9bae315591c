"""Tile budgets in bytes, study variants in one match, checks without long lists."""

import pytest
from pyspark.sql import functions as F

from fieldloom.operators import ordered, publish, quality, study


def features(spark, n, spread):
    """``n`` crowded features and a few on their own, all in one tile at low zooms."""
    rows = [(i, -93.0 + (i % 50) * 1e-4, 42.0, 100.0 + i, 40) for i in range(n)]
    rows += [(n + k, -111.0 + 2 * k, 41.0 + k / 3, 5.0, 40) for k in range(spread)]
    return spark.createDataFrame(rows, "field_id long, lon double, lat double, area_m2 double, bytes long")


def test_tiles_stay_below_the_budget_and_dense_places_lose_first(spark):
    df = features(spark, 400, 6)
    got = publish.budget_tiles(df, 4, 12, 1000).collect()
    sums = {}
    for r in got:
        sums[r.z, r.tx, r.ty] = sums.get((r.z, r.tx, r.ty), 0) + r.bytes
    assert max(sums.values()) <= 1000 and max(sums.values()) > 900
    low = {r.field_id for r in got if r.z == 4}
    assert {400 + k for k in range(6)} <= low  # the lonely ones are small and stay
    assert max(i for i in low if i < 400) == 399  # of the crowd the largest stay
    everything = publish.budget_tiles(df, 4, 4, 10 ** 9).count()
    assert everything == 406
    assert publish.budget_tiles(df.limit(0), 4, 6, 1000).count() == 0


def test_budget_checks_count_bytes(spark):
    lines = spark.createDataFrame([("é漢",), ("ab",), ("",)], "value string")
    row = quality.size_budget_check(lines, 11, "s").first()
    assert row.observed == "10 bytes" and row.passed
    assert not quality.size_budget_check(lines, 10, "s").first().passed
    tiles = spark.createDataFrame([(1, 0, 0, 30), (1, 0, 0, 31), (1, 0, 1, 60)], "z int, tx int, ty int, bytes long")
    row = quality.tile_budget_check(tiles, 60, "s").first()
    assert (row.observed, row.passed) == ("1 of 2 tiles above, largest 61 bytes", False)
    assert quality.tile_budget_check(tiles.limit(0), 60, "s").first().passed


def test_variants_share_one_match(spark, monkeypatch):
    """Equal to one match per variant, by one chain of running sums."""
    from fieldloom.operators import bands
    rows = [(i, i * 7 % 90, i % 4 if i % 3 else 0, (i * 37 % 100) / 100, 0.1 * (i % 7), .5, (i * 13 % 10) / 10, (i * 17 % 10) / 10)
            for i in range(400)]
    frame = spark.createDataFrame(rows, "field_id int, lat int, wind int, delta double, pre double, post double, "
                                        "pre_vf double, post_vf double")
    variants = {"a": (0.2, 10), "b": (0.4, 10), "c": (0.2, 3), "d": (0.95, 10)}
    calls = []
    monkeypatch.setattr(bands, "running_sums", lambda *a, **k: calls.append(1) or ordered.running_sums(*a, **k))
    got = sorted((r.label, r.wind, r.fields, r.did) for r in study.sensitivity(frame, variants).collect())
    assert len(calls) == 1
    want = [(name, r.wind, r.fields, r.did) for name, (least, band) in variants.items()
            for r in study.did_table(study.matched(study.usable(frame, least), band)).collect()]
    assert got == sorted(want) and {g[0] for g in got} == {"a", "b", "c"}


def test_short_pairs_and_wide_ids(spark):
    cover = spark.createDataFrame([(1996, 1, 0), (1996, 2, 3), (1997, 1, 0)], "season int, mgrs_tile int, n_selected long")
    assert quality.coverage_check(cover, "s").first().observed == "2 of 3 rows failed"
    assert [(r.season, r.mgrs_tile) for r in quality.short_pairs(cover).orderBy("season").collect()] == [(1996, 1), (1997, 1)]
    assert dict(ordered.dense_ids(cover.select("mgrs_tile").distinct(), "mgrs_tile").dtypes)["fid"] == "bigint"


@pytest.mark.parametrize("rows", [0, 5])
def test_metrics_count_partitions(spark, rows):
    from fieldloom.operators.metrics import run_with_metrics
    from fieldloom.shared import shared_folder
    df = spark.range(5).limit(rows).withColumn("p", F.when(F.col("id") < 3, F.col("id") % 2))
    row = run_with_metrics(df, lambda d: d.filter("id > 0"), shared_folder(spark, "m"), "x", "s", "p").first()
    assert (row.rows_in, row.rows_out, row.partitions) == ((5, 4, 2) if rows else (0, 0, 0))


def test_the_audit_names_every_short_pair(spark):
    cover = spark.createDataFrame([(1996, 1, 0), (1996, 2, 5), (1997, 10, 0), (1997, 9, 0), (1997, None, 0)],
                                  "season int, mgrs_tile int, n_selected long")
    row = quality.coverage_check(cover, "s", named=True).first()
    assert row.observed == "missing: 1996/1, 1997/10, 1997/9" and not row.passed
    assert quality.coverage_check(cover.filter("n_selected > 0"), "s", named=True).first().observed == "0 of 1 rows failed"
    assert quality.coverage_check(cover.filter("mgrs_tile is null"), "s", named=True).first().observed is None


def test_coverage_queries_name_the_short_pairs(spark, sf):
    from fieldloom.catalog import QUERIES
    short = sorted(f"{r.season}/{r.mgrs_tile}" for r in QUERIES["q1_short_pairs"](spark, sf).collect())
    want = "missing: " + ", ".join(short)
    assert short and QUERIES["q1_coverage"](spark, sf).first().observed == want
    audit = QUERIES["q6_audit"](spark, sf).filter("check_name = 'scenes_per_season_tile_min'")
    assert audit.first().observed == want
