"""Polygon layers: WKB parquet, GeoJSON lines, prefix-filtered extracts."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import POLYGON
from ..functions import geometry as G


def _rings_from_wkb(blob: bytes) -> list[np.ndarray]:
    """Rings of one polygon or of all parts of a multipolygon, either byte order."""
    def polygon(at: int) -> tuple[list[np.ndarray], int]:
        end = "<" if blob[at] == 1 else ">"
        kind, n_rings = struct.unpack_from(end + "II", blob, at + 1)
        if kind != 3:
            raise ValueError(f"not a plane polygon: WKB type {kind}")
        rings, at = [], at + 9
        for _ in range(n_rings):
            (n,) = struct.unpack_from(end + "I", blob, at)
            rings.append(np.frombuffer(blob, end + "f8", 2 * n, at + 4).reshape(n, 2))
            at += 4 + 16 * n
        return rings, at

    end = "<" if blob[0] == 1 else ">"
    kind, n_parts = struct.unpack_from(end + "II", blob, 1)
    if kind != 6:
        return polygon(0)[0]
    rings, at = [], 9
    for _ in range(n_parts):
        more, at = polygon(at)
        rings += more
    return rings


def _plain_rings(blobs: pa.Array) -> list[tuple[np.ndarray, np.ndarray]] | None:
    """Rings of a batch of little-endian polygons: for each ring number the rows
    that have it and (start, points) of each, in the batch's bytes.  None if a
    row is something else.  One step per ring number, not per polygon."""
    data = np.frombuffer(blobs.buffers()[2] or b"", np.uint8)
    ends = np.frombuffer(blobs.buffers()[1], np.int32)[blobs.offset:blobs.offset + len(blobs) + 1]
    rows = np.flatnonzero(blobs.is_valid().to_numpy(zero_copy_only=False))
    at = ends[:-1][rows].astype(np.int64)

    def number(where: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(data[where[:, None] + np.arange(4)]).view("<u4")[:, 0].astype(np.int64)

    if len(rows) and ((data[at] != 1).any() or (number(at + 1) != 3).any()):
        return None
    left, at, found = number(at + 5) if len(rows) else np.empty(0, np.int64), at + 9, []
    while (left > 0).any():
        rows, at, left = rows[left > 0], at[left > 0], left[left > 0]
        n = number(at)
        found.append((rows, np.column_stack([at + 4, n])))
        at, left = at + 4 + 16 * n, left - 1
    return found


def _swap_column(df: DataFrame, column: str, out: str, kind: T.DataType, convert) -> DataFrame:
    """Replace a column, one Arrow batch at a time."""
    schema = T.StructType([f for f in df.schema.fields if f.name != column]
                          + [T.StructField(out, kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [n for n in batch.schema.names if n != column]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in keep), convert(batch.column(column))],
                names=[*keep, out])

    return df.mapInArrow(run, schema)


def _decode(blobs: pa.Array) -> pa.Array:
    missing = blobs.is_null().to_numpy(zero_copy_only=False)
    found = _plain_rings(blobs)
    if found is None:  # parts or another byte order: one by one
        polys = [None if b is None else _rings_from_wkb(b) for b in blobs.to_pylist()]
        rings = [ring for p in polys if p is not None for ring in p]
        points = np.concatenate(rings) if rings else np.empty((0, 2))
        sizes = np.array([len(r) for r in rings], np.int64)
        counts = np.array([0 if p is None else len(p) for p in polys], np.int64)
    else:
        rows = np.concatenate([r for r, _ in found]) if found else np.empty(0, np.int64)
        spans = np.concatenate([s for _, s in found]) if found else np.empty((0, 2), np.int64)
        spans = spans[np.argsort(rows, kind="stable")]  # ring numbers come in order
        counts, sizes = np.bincount(rows, minlength=len(blobs)), spans[:, 1]
        # byte positions of all points, then all coordinates in one gather
        first = np.repeat(spans[:, 0] - 16 * (np.cumsum(sizes) - sizes), sizes)
        data = np.frombuffer(blobs.buffers()[2] or b"", np.uint8)
        where = first + 16 * np.arange(len(first))
        points = np.ascontiguousarray(data[where[:, None] + np.arange(16)]).view("<f8").reshape(-1, 2)
    xy = pa.StructArray.from_arrays([pa.array(points[:, k], pa.float64()) for k in (0, 1)], names=["x", "y"])
    return pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()),
        pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), xy),
        mask=pa.array(missing) if missing.any() else None)


def _encode(polys: pa.Array) -> pa.Array:
    """Polygons given as parts of rings: one part a polygon, more a multipolygon."""
    parts = polys.values
    rings = parts.values
    points = rings.values
    xy = np.column_stack([points.field(k).to_numpy(zero_copy_only=False) for k in (0, 1)]
                         ).astype("<f8")
    first, ring, at = polys.offsets.to_numpy(), parts.offsets.to_numpy(), rings.offsets.to_numpy()

    def part(p: int) -> bytes:
        out = [struct.pack("<BII", 1, 3, ring[p + 1] - ring[p])]
        for r in range(ring[p], ring[p + 1]):
            out += [struct.pack("<I", at[r + 1] - at[r]), xy[at[r]:at[r + 1]].tobytes()]
        return b"".join(out)

    def one(k: int) -> bytes:
        found = [part(p) for p in range(first[k], first[k + 1])]
        return found[0] if len(found) == 1 else struct.pack("<BII", 1, 6, len(found)) + b"".join(found)

    return pa.array([one(k) if ok else None for k, ok in enumerate(polys.is_valid().to_pylist())],
                    pa.binary())


def decode_wkb(df: DataFrame, wkb: str, out: str = "poly") -> DataFrame:
    """Replace a WKB polygon column by rings."""
    return _swap_column(df, wkb, out, POLYGON, _decode)


def encode_wkb(df: DataFrame, poly: str, out: str = "geometry") -> DataFrame:
    """Replace rings by little-endian WKB polygons, or multipolygons where there are
    several parts."""
    return _swap_column(df.withColumn(poly, G.parts(poly)), poly, out, T.BinaryType(), _encode)


def read_wkb_polygons(spark: SparkSession, path: str, wkb: str = "geometry") -> DataFrame:
    return decode_wkb(spark.read.parquet(path), wkb)


def read_geojson_lines(spark: SparkSession, path: str, properties: T.StructType) -> DataFrame:
    """One feature per line -> its properties and ``poly`` (all parts of a
    multipolygon).  A feature without geometry has none; any other kind of
    geometry fails the job."""
    ring = T.ArrayType(T.ArrayType(T.DoubleType()))

    def feature(coordinates: T.DataType) -> T.StructType:
        return T.StructType([
            T.StructField("properties", properties),
            T.StructField("geometry", T.StructType([
                T.StructField("type", T.StringType()), T.StructField("coordinates", coordinates)]))])

    single, multi = T.ArrayType(ring), T.ArrayType(T.ArrayType(ring))
    raw = spark.read.text(path).select(
        F.from_json("value", feature(single)).alias("f"),
        F.get_json_object("value", "$.geometry.type").alias("kind"), "value")
    parts = F.from_json("value", feature(multi))["geometry"]["coordinates"]
    rings = (F.when(F.col("kind") == "Polygon", F.col("f.geometry.coordinates"))
             .when(F.col("kind") == "MultiPolygon", F.flatten(parts))
             .when(F.col("kind").isNotNull(), F.raise_error(
                 F.concat(F.lit("not a polygon: "), F.col("kind"))).cast(single)))
    points = F.transform(rings, lambda r: F.transform(r, lambda p: G.point(p[0], p[1])))
    return raw.select("f.properties.*", points.alias("poly"))


def prefix_extract(df: DataFrame, column: str, prefix: str) -> DataFrame:
    """Rows whose key starts with ``prefix`` (reaches the parquet scan)."""
    return df.filter(F.col(column).startswith(prefix))


def with_prefix_columns(df: DataFrame, prefix: str) -> list[str]:
    """Names of the columns that start with ``prefix``, in any case."""
    return [c for c in df.columns if c.upper().startswith(prefix.upper())]
