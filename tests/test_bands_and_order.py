"""Prefix-sum matching and order statistics against brute force."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fieldloom.operators import bands, ordered


def people(spark, n, seed, hot=False):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        # a third of the rows sits on one single spot when hot
        lat = 5.0 if hot and i % 3 == 0 else round(r.uniform(0, 20), 1)
        lon = 7.0 if hot and i % 3 == 0 else round(r.uniform(0, 20), 1)
        rows.append((i, lat, lon, r.uniform(-1, 1)))
    return pd.DataFrame(rows, columns=["field_id", "lat", "lon", "delta"])


def brute(t, c, lat_band, lon_band, upper_open, min_n):
    out = {}
    for row in t.itertuples():
        hi = c.lat < row.lat + lat_band if upper_open else c.lat <= row.lat + lat_band
        m = (c.lat >= row.lat - lat_band) & hi
        if lon_band is not None:
            m &= (c.lon >= row.lon - lon_band) & (c.lon <= row.lon + lon_band)
        sel = c.delta[m]
        out[row.field_id] = (len(sel), sel.mean() if len(sel) >= min_n else None)
    return out


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("lon_band,upper_open", [(None, False), (None, True), (1.5, True), (0.2, False)])
def test_band_match_is_exact(spark, lon_band, upper_open, hot):
    t, c = people(spark, 150, 1, hot), people(spark, 400, 2, hot)
    st, sc = spark.createDataFrame(t), spark.createDataFrame(c)
    if lon_band is None:
        got = bands.match_lat(st, sc, 0.5, 5, upper_open)
    else:
        got = bands.match_lat_lon(st, sc, 0.5, lon_band, 5, upper_open)
    want = brute(t, c, 0.5, lon_band, upper_open, 5)
    rows = got.collect()
    assert len(rows) == len(t)
    for r in rows:
        n, mean = want[r.field_id]
        assert r.ctrl_n == n
        assert (r.ctrl_delta is None) == (mean is None)
        if mean is not None:
            assert abs(r.ctrl_delta - mean) < 1e-9


def test_no_controls(spark):
    t = spark.createDataFrame(people(spark, 5, 1))
    empty = t.limit(0)
    for got in (bands.match_lat(t, empty, 1.0), bands.match_lat_lon(t, empty, 1.0, 1.0)):
        rows = got.collect()
        assert len(rows) == 5 and all(r.ctrl_delta is None and r.ctrl_n == 0 for r in rows)


def test_band_match_never_pairs_rows(spark):
    t, c = (spark.createDataFrame(people(spark, 50, s)) for s in (1, 2))
    for got in (bands.match_lat(t, c, 0.5), bands.match_lat_lon(t, c, 0.5, 0.5)):
        plan = got._jdf.queryExecution().toString()
        assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_running_sums_over_hot_and_cold_groups(spark):
    r = random.Random(3)
    rows = [("hot" if i % 3 else f"g{i % 50}", i, r.randint(1, 9)) for i in range(900)]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, at int, v int")
    got = ordered.running_sums(df, ["k"], "at", {"total": "v"}).toPandas()
    pdf = got.sort_values(["k", "at"])
    assert (pdf.groupby("k").v.cumsum() == pdf.total).all() and len(pdf) == 900
    none = ordered.running_sums(df.withColumn("k", F.when(F.col("k") != "hot", F.col("k"))), ["k"], "at", {"total": "v"})
    assert none.agg(F.sum("total")).first()[0] == got.total.sum()  # a missing key is a group too
    every = ordered.running_sums(df, [], "at", {"total": "v"}).toPandas().sort_values("at")
    assert (every.v.cumsum() == every.total).all()


def test_quantiles_match_linear_interpolation(spark):
    r = random.Random(4)
    rows = [("a" if i % 3 else f"g{i % 7}", r.choice([r.random(), 0.25, 0.5])) for i in range(800)]
    df = spark.createDataFrame(rows, "k string, v double")
    probs = {"p10": 0.1, "p50": 0.5, "p90": 0.9}
    got = {x.k: x for x in ordered.quantiles(df, ["k"], "v", probs).collect()}
    for k, g in pd.DataFrame(rows, columns=["k", "v"]).groupby("k"):
        for name, p in probs.items():
            assert abs(got[k][name] - np.quantile(g.v, p)) < 1e-12
    one = ordered.quantiles(df, [], "v", probs).first()
    assert abs(one.p50 - np.quantile([v for _, v in rows], 0.5)) < 1e-12


def test_dense_ids_are_dense_and_ordered(spark):
    df = spark.range(0, 3000, 3).withColumnRenamed("id", "key").orderBy(F.rand(1))
    rows = ordered.dense_ids(df, "key").orderBy("key").collect()
    assert [x.fid for x in rows] == list(range(1000))


def test_dense_ids_of_text_keys(spark):
    names = [f"IA-{i}" for i in range(400)] + [str(i) for i in range(400)]
    rows = ordered.dense_ids(spark.createDataFrame([(n,) for n in names], "key string"), "key").collect()
    assert {r.key: r.fid for r in rows} == {n: i for i, n in enumerate(sorted(names))}


def test_a_hot_group_in_a_narrow_range_spreads(spark):
    # all rows of the largest group lie close together; more than 1,000 other groups tie in size
    df = spark.range(60_000).select(
        F.when(F.col("id") < 20_000, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 2_000)).alias("k"),
        F.when(F.col("id") < 20_000, 500 + F.col("id") / 1e9).otherwise(F.col("id").cast("double")).alias("at"),
        F.lit(1).alias("one"))
    got = ordered.running_sums(df, ["k"], "at", {"n": "one"})
    tops = got.groupBy("k").agg(F.max("n").alias("top"), F.count("*").alias("rows"), F.countDistinct("n").alias("d"))
    assert tops.filter("top <> rows OR d <> rows").count() == 0 and tops.count() == 2_001
    cuts = df.repartitionByRange(8, "k", "at").withColumn("p", F.spark_partition_id())
    assert cuts.filter("k = 'hot'").select("p").distinct().count() >= 2
