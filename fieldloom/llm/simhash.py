"""Near-duplicate groups by SimHash and pivot distance tables.

A fingerprint bit is set when more than half of the text's shingle hashes have
it.  Fingerprints link at four or fewer differing bits; groups are the connected
components.  Equal fingerprints are one row from the start.

Finding the links: 64 bits are cut into blocks so that two fingerprints within
four bits agree on some key of whole blocks (pigeonhole; more blocks to a key the
more fingerprints there are, so that buckets stay small).  Inside a bucket the
Hamming distances to fixed reference fingerprints form a table; by the triangle
inequality a pair whose distances to any reference differ by more than four
cannot link, so rows are swept in order of the first distance and pairs are
discarded by their largest difference.  What survives is verified by its bits.
No pair leaves a bucket: a bucket gives each of its rows one edge to the smallest
fingerprint it is connected with there.  Buckets above ``TILE`` rows are cut into
tiles that meet pairwise in cells of their own, so that no task holds a bucket.

Defined results: null and empty texts have fingerprint zero and link like any
other; repeated rows fall into one group; rows without doc_id take part in the
links but name no group (component_id is null where a group has no id at all).
Other columns of the input are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.shared import materialize

from .common import WORD, document_key, keyed_rows, map_rows
from .components import components

SHINGLE = 4
DISTANCE = 4
SEED = 42
PIVOTS = 16
TILE = 16_384
LOWER = {i: i + 32 for i in range(65, 91)}
REFERENCES = np.array([xxhash.xxh64_intdigest(f"reference {i}".encode(), SEED)
                       for i in range(PIVOTS)], np.uint64)


def fingerprint(text: str | None) -> int:
    """Signed 64-bit SimHash of a whole text."""
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    joined = " ".join(words).encode("utf-8", "replace")
    ends = np.cumsum([len(w.encode("utf-8", "replace")) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(1, len(words) - SHINGLE + 1)
    to = ends[SHINGLE - 1:].tolist() if len(words) >= SHINGLE else [len(joined)]
    digest = xxhash.xxh64_intdigest
    counts, step = np.zeros(64, np.int64), 1 << 16
    starts = starts[:last].tolist()
    for at in range(0, last, step):  # bounded memory on very long texts
        hashes = np.array([digest(joined[a:b], SEED) for a, b in
                           zip(starts[at:at + step], to[at:at + step])], np.uint64)
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > last).view(">i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, fp (signed long)."""
    def run(cols: dict) -> dict:
        return {"doc_id": cols["doc_id"], "text_key": cols["text_key"],
                "fp": [fingerprint(t) for t in cols["text"].to_pylist()]}

    rows = document_key(docs)
    schema = rows.select("doc_id", "text_key").schema.add("fp", "long")
    return map_rows(rows, run, schema)


def bucket_plan(n: int) -> list[tuple[int, ...]]:
    """Keys as tuples of (shift, bits) blocks: any two fingerprints within
    ``DISTANCE`` bits agree on one key whole.  About 13, 21, 27 or 32 bits."""
    blocks, chosen = next((b, k) for b, k, most in (
        (5, 1, 4 << 20), (6, 2, 1 << 30), (7, 3, 1 << 36), (8, 4, 1 << 62)) if n <= most)
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    spans = [(cuts[i], cuts[i + 1] - cuts[i]) for i in range(blocks)]
    return list(combinations(spans, chosen))


def bucket_rows(prints: DataFrame, n: int) -> DataFrame:
    """Every fingerprint under each of its keys: fp, bucket, tile, tile2."""
    keys = []
    for i, key in enumerate(bucket_plan(n)):
        value = F.lit(0).cast("long")
        for shift, bits in key:
            part = F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << bits) - 1))
            value = F.shiftleft(value, bits).bitwiseOR(part)
        keys.append(F.struct(F.lit(i).alias("k"), value.alias("v")))
    rows = prints.select("fp", F.explode(F.array(*keys)).alias("bucket"))
    large = materialize(rows.groupBy("bucket").count().filter(F.col("count") > TILE)
                        .select("bucket", F.ceil(F.col("count") / TILE).cast("int").alias("tiles")),
                        "large-buckets")
    if large.isEmpty():
        return rows.withColumn("tile", F.lit(0)).withColumn("tile2", F.lit(0))
    rows = rows.join(large, "bucket", "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    return (rows.withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
            .select("fp", "bucket", F.least("own", "other").alias("tile"),
                    F.greatest("own", "other").alias("tile2")))


def linked_roots(fp: np.ndarray, group: np.ndarray) -> np.ndarray:
    """For each row the smallest fingerprint (as unsigned) it is connected with
    among the rows of its group.  Rows of a group stand together."""
    table = np.bitwise_count(fp[:, None] ^ REFERENCES[None, :]).astype(np.int16)
    order = np.lexsort((fp, table[:, 0], group))
    fp, group, table = fp[order], group[order], table[order]
    parent = np.arange(len(fp))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    alive, lag = np.arange(len(fp)), 0
    while len(alive):
        lag += 1
        alive = alive[:np.searchsorted(alive, len(fp) - lag)]
        near = ((group[alive] == group[alive + lag])
                & (table[alive + lag, 0] - table[alive, 0] <= DISTANCE))
        alive = alive[near]  # in this order nothing further right comes nearer
        pairs = alive[parent[alive] != parent[alive + lag]]
        for p in range(1, PIVOTS):
            pairs = pairs[np.abs(table[pairs, p] - table[pairs + lag, p]) <= DISTANCE]
        pairs = pairs[np.bitwise_count(fp[pairs] ^ fp[pairs + lag]) <= DISTANCE]
        if len(pairs):
            for i in pairs.tolist():
                a, b = root(i), root(i + lag)
                if a != b:
                    if fp[b] < fp[a]:
                        a, b = b, a
                    parent[b] = a
            while not np.array_equal(up := parent[parent], parent):
                parent = up
    roots = np.empty_like(fp)
    roots[order] = fp[parent]
    return roots


def bucket_edges(rows: DataFrame) -> DataFrame:
    """Edges (a, b) from rows to the smallest fingerprint they reach in a bucket."""
    cell = [F.col("bucket.k"), F.col("bucket.v"), F.col("tile"), F.col("tile2")]
    sorted_rows = (rows.select(F.xxhash64(*cell).alias("cell"), "fp")
                   .repartition("cell").sortWithinPartitions("cell"))

    def run(batches):
        held_c, held_f = np.empty(0, np.int64), np.empty(0, np.int64)

        def edges(cells, fps):
            roots = linked_roots(fps.view(np.uint64), cells).view(np.int64)
            out = roots != fps
            return pa.RecordBatch.from_pydict({"a": fps[out], "b": roots[out]})

        for batch in batches:  # the last cell may go on in the next batch
            cells = np.concatenate((held_c, batch.column("cell").to_numpy()))
            fps = np.concatenate((held_f, batch.column("fp").to_numpy()))
            cut = int(np.searchsorted(cells, cells[-1])) if len(cells) else 0
            if cut:
                yield edges(cells[:cut], fps[:cut])
            held_c, held_f = cells[cut:], fps[cut:]
        if len(held_c):
            yield edges(held_c, held_f)

    return sorted_rows.mapInArrow(run, "a long, b long")


def similar_groups(prints: DataFrame) -> DataFrame:
    """fp, component (a fingerprint), component_id (smallest doc_id) for every
    distinct fingerprint of ``prints`` (doc_id, fp)."""
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "prints")
    edges = bucket_edges(bucket_rows(distinct, distinct.count()))
    groups = components(edges, "a", "b")
    placed = (distinct.join(groups, distinct["fp"] == groups["node"], "left")
              .select("fp", "first_id", F.coalesce("component", "fp").alias("component")))
    firsts = placed.groupBy("component").agg(F.min("first_id").alias("component_id"))
    return placed.join(firsts, "component").select("fp", "component", "component_id")


def grouped(prints: DataFrame) -> DataFrame:
    """``prints`` (doc_id, text_key, fp) with component and component_id."""
    return prints.join(similar_groups(prints), "fp")


def simhash_groups(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: one row per document row."""
    prints = materialize(fingerprints(docs), "simhash")
    return grouped(prints).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                                  "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near copies: of each group the row with the
    smallest doc_id (null last, then by text) stays, once if it is repeated."""
    prints = materialize(fingerprints(docs), "simhash")
    chosen = grouped(prints).groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("k"))
    chosen = materialize(chosen.select(F.col("k.doc_id").alias("__id"), "k.text_key"), "kept")
    rows = keyed_rows(docs)  # the caller's columns in one, so no name can clash
    kept = rows.join(chosen, F.col("__id").eqNullSafe(rows["doc_id"])
                     & (chosen["text_key"] == rows["row_key"]), "left_semi")
    # repeated rows of a kept document: only where there are any, for they cost a shuffle
    again = (prints.groupBy("doc_id", "text_key").count().filter("count > 1")
             .withColumnRenamed("doc_id", "__id"))
    if again.isEmpty():
        return kept.select("row.*")
    hit = F.col("__id").eqNullSafe(kept["doc_id"]) & (again["text_key"] == kept["row_key"])
    return (kept.join(again, hit, "left_anti")
            .unionByName(kept.join(again, hit, "left_semi").dropDuplicates(["doc_id", "row_key"]))
            .select("row.*"))
