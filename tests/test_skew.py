"""Joins by size, and the shared folder."""

import pytest
from pyspark.sql import functions as F

from fieldloom.shared import materialize

from fieldloom import shared


def sides(spark):
    left = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 700 + 1).alias("k"),
        F.col("id").alias("v"))
    right = spark.range(500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    return left, right.unionByName(right.withColumn("w", F.col("w") + 1))


def test_top_k_is_cut_before_the_shuffle(spark):
    from fieldloom.sources.tables import newest_per_key
    left, _ = sides(spark)
    plan = newest_per_key(left, ["k"], ["v"], 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # partial and final


@pytest.mark.parametrize("limit", [10, 100_000])
def test_sized_join_both_ways(spark, limit):
    left, right = sides(spark)
    assert shared.fits(right, limit) == (limit > 10)
    got = shared.sized_join(left, right, ["k"], max_rows=limit)
    hinted = "strategy=broadcast" in got._jdf.queryExecution().analyzed().toString()
    assert hinted == (limit > 10)  # beyond the bound the choice is Spark's
    assert got.exceptAll(left.join(right, "k")).count() == 0


def test_shared_folder_follows_the_session(spark):
    root = (spark.conf.get("spark.checkpoint.dir", None)
            or spark.sparkContext.getCheckpointDir() or "")
    a, b = (shared.shared_folder(spark, "t") for _ in range(2))
    assert a != b and a.startswith(root.rstrip("/"))
    assert shared.materialize(spark.range(3).toDF("a"), "t").count() == 3


def test_one_spot_of_many_fields_and_scenes_takes_many_tasks(spark, monkeypatch):
    from fieldloom.operators import zonal
    for name, n in (("FIELDS_EACH", 8), ("TILES_EACH", 4)):
        monkeypatch.setattr(zonal, name, n)
    spot = [F.lit(0).alias("grid_id"), F.lit(1).alias("x"), F.lit(2).alias("y")]
    run = F.struct((F.col("id") % 2).cast("int").alias("row"), F.lit(0).alias("first"), F.lit(1).alias("last"))
    masks = materialize(spark.range(0, 60, 1, 1).select(*spot, F.col("id").alias("field_id"), F.array(run).alias("runs")), "m")
    tiles = materialize(spark.range(0, 30, 1, 1).select(*spot, F.col("id").alias("scene_id"), F.lit(2).alias("w"), F.array(
        *[F.col("id").cast("double") + k for k in range(4)]).alias("ndvi")), "t")
    got = zonal.pair_stats(masks, tiles).withColumn("task", F.spark_partition_id()).collect()
    assert len({r.task for r in got}) > 4
    want = sorted((s, f, 2.0 * s + (5 if f % 2 else 1), 2) for s in range(30) for f in range(60))
    assert sorted((r.scene_id, r.field_id, r["sum"], r["count"]) for r in got) == want
