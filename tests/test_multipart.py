"""Polygons of several parts: grouped by nesting, written so that others read them right."""

import json
import struct

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldloom.functions import geometry as G
from fieldloom.sinks import features
from fieldloom.sources import polygons

POLY = "array<array<struct<x: double, y: double>>>"


def box(x, y, s):
    return [(x, y), (x + s, y), (x + s, y + s), (x, y + s), (x, y)]


def frame(spark, shapes):
    rows = [(i, None if s is None else [[{"x": float(x), "y": float(y)} for x, y in ring] for ring in s])
            for i, s in enumerate(shapes)]
    return spark.createDataFrame(rows, f"id int, poly {POLY}").coalesce(1)


OUTER, HOLE, ISLAND, POND, APART, APART_HOLE = (box(0, 0, 10), box(1, 1, 6), box(2, 2, 4), box(3, 3, 1), box(20, 0, 4), box(21, 1, 1))
SHAPES = [[OUTER], [OUTER, HOLE], [OUTER, APART], [POND, APART_HOLE, APART, HOLE, ISLAND, OUTER], None]
PARTS = [[[OUTER]], [[OUTER, HOLE]], [[OUTER], [APART]], [[APART, APART_HOLE], [ISLAND, POND], [OUTER, HOLE]], None]


def plain(parts):
    return None if parts is None else [[[(p.x, p.y) for p in ring] for ring in part] for part in parts]


def test_rings_are_grouped_by_nesting(spark):
    got = frame(spark, SHAPES).select("id", G.parts("poly").alias("p")).orderBy("id").collect()
    assert [plain(r.p) for r in got] == PARTS


def test_geojson_and_text(spark, tmp_path):
    df = frame(spark, SHAPES)
    features.write_features(df.filter("poly IS NOT NULL"), ["id"], str(tmp_path / "f"))
    lines = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "f")).collect()]
    for f in lines:
        parts = PARTS[f["properties"]["id"]]
        kind, coordinates = f["geometry"]["type"], f["geometry"]["coordinates"]
        assert kind == ("Polygon" if len(parts) == 1 else "MultiPolygon")
        want = [[[list(map(float, p)) for p in ring] for ring in part] for part in parts]
        assert coordinates == (want[0] if len(parts) == 1 else want)
    assert len(lines) == 4
    back = polygons.read_geojson_lines(spark, str(tmp_path / "f"), T.StructType([T.StructField("id", T.IntegerType())]))
    area = {r.id: r.a for r in df.select("id", G.area("poly").alias("a")).collect() if r.a is not None}
    assert {r.id: r.a for r in back.select("id", G.area("poly").alias("a")).collect()} == area
    assert area[3] == 100 - 36 + 16 - 1 + 16 - 1
    text = df.filter("id IN (0, 2)").orderBy("id").select(G.as_text("poly").alias("t")).collect()
    assert text[0].t == "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0))"
    assert text[1].t == "MULTIPOLYGON (((0 0, 10 0, 10 10, 0 10, 0 0)), ((20 0, 24 0, 24 4, 20 4, 20 0)))"
    assert df.filter("id = 4").select(G.as_text("poly").alias("t")).first().t is None


def test_wkb(spark):
    df = frame(spark, SHAPES)
    coded = polygons.encode_wkb(df, "poly", "g")
    for r in coded.collect():
        if r.g is None:
            assert r.id == 4
            continue
        kind, n = struct.unpack_from("<II", bytes(r.g), 1)
        assert (kind, n) == ((3, len(PARTS[r.id][0])) if len(PARTS[r.id]) == 1 else (6, len(PARTS[r.id])))
    back = {r.id: r.poly for r in polygons.decode_wkb(coded, "g").collect()}
    for i, parts in enumerate(PARTS):
        assert (None if back[i] is None else [[(p.x, p.y) for p in ring] for ring in back[i]]) == (
            None if parts is None else [ring for part in parts for ring in part])
    again = polygons.decode_wkb(polygons.encode_wkb(polygons.decode_wkb(coded, "g"), "poly", "g"), "g")
    assert {r.id: r.poly for r in again.collect()} == back
    assert again.select(F.sum(G.area("poly")).alias("a")).first().a == df.select(F.sum(G.area("poly")).alias("a")).first().a
