"""Merkle manifest of a dataset with kept hash states (SHA midstate tree).

Leaves are digests of rows.  Per source they ascend by doc_id and every three
consecutive nodes hash to their parent, until one is left; the sources' tops form a
tree of the same kind.  A child takes one whole block of its parent's hash, so a
parent keeps the running state in front of each of its child slots.  A leaf that
changed is folded up to the root by resuming, level by level, the state in front of its
slot with the new digest and the siblings to its right: what lies left is in the state.

Trees are built in blocks of 3^6 neighbours (``DEPTH`` levels at once, one task
holds one block), the tops of the blocks are the entries of the next layer; a source of
any size is cut into blocks.  A path is packed: ``shape`` one byte a level (4 *
children + slot), ``states`` 32 bytes a level, ``siblings`` 32 bytes each, level by
level, left to right.

Defined results: a null field counts as ``-`` and an empty text as ``0:``; null doc_id
comes first in its source, equal doc_ids follow their leaf digests, repeated rows are
leaves each; null is a source of its own and comes first; an empty table gives no rows; a
lone source's top is the root.  Columns that are no fields are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldloom.operators.ordered import running_sums
from fieldloom.shared import fits, materialize

from . import sha_states as S

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN = 3
DEPTH = 6
BROADCAST_PATHS = 10_000  # rows of some 2 kB at most; more are joined by a shuffle
PATH = "shape binary, states binary, siblings binary"


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_digest(values: list[Column]) -> Column:
    """32 bytes: SHA-256 of the fields, each with its length in front."""
    return F.unhex(F.sha2(F.concat(*map(field, values)).cast("binary"), 256))


def leaves(docs: DataFrame, changed_text: Column | None = None) -> DataFrame:
    """doc_id, source, leaf and, with ``changed_text``, the leaf that it would give."""
    cols = ["doc_id", "source", row_digest([F.col(c) for c in FIELDS]).alias("leaf")]
    if changed_text is not None:
        other = [changed_text if c == "text" else F.col(c) for c in FIELDS]
        cols.append(row_digest(other).alias("changed"))
    return docs.select(*cols)


def grown(nodes: np.ndarray, depth: int) -> tuple[np.ndarray, list[tuple]]:
    """``depth`` levels above ``nodes`` (n, 32): the last level, and of every level
    below it the nodes, the states in front of the slots and the children's counts."""
    levels = []
    for _ in range(depth):
        m = -(-len(nodes) // FAN)
        state, kept, blocks = S.fresh(m), [], S.hex_block(nodes)
        for slot in range(FAN):
            kept.append(state)
            child = np.arange(m) * FAN + slot
            there = child < len(nodes)
            state = state.copy()
            state[there] = S.absorbed(state[there], blocks[child[there]])
        counts = np.minimum(FAN, len(nodes) - FAN * np.arange(m))
        levels.append((nodes, np.stack(kept, axis=1), counts))
        nodes = S.finished(state, counts)
    return nodes, levels


def packed(rows: np.ndarray, keep: np.ndarray | None = None) -> pa.Array:
    """A binary array of rows (n, k, width) of bytes, of which ``keep`` (n, k) stay."""
    n, k, width = rows.shape
    sizes = np.full(n, k * width) if keep is None else keep.sum(axis=1) * width
    data = rows if keep is None else rows[keep]
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets),
                                                 pa.py_buffer(np.ascontiguousarray(data).tobytes())])


def paths(levels: list[tuple], n: int) -> dict[str, pa.Array]:
    """The packed path of each of the ``n`` entries below ``levels``."""
    depth, at = len(levels), np.arange(n)
    shape = np.zeros((n, depth, 1), np.uint8)
    states = np.zeros((n, depth, 32), np.uint8)
    siblings = np.zeros((n, depth * FAN, 32), np.uint8)
    keep = np.zeros((n, depth * FAN), bool)
    for level, (nodes, kept, counts) in enumerate(levels):
        parent, slot = at // FAN, at % FAN
        shape[:, level, 0] = 4 * counts[parent] + slot
        states[:, level] = S.as_bytes(kept[parent, slot])
        for other in range(FAN):
            node = np.minimum(parent * FAN + other, len(nodes) - 1)
            siblings[:, level * FAN + other] = nodes[node]
            keep[:, level * FAN + other] = (other < counts[parent]) & (other != slot)
        at = parent
    return {"shape": packed(shape), "states": packed(states), "siblings": packed(siblings, keep)}


def digests_of(column: pa.Array) -> np.ndarray:
    """A column of 32-byte values as an array (n, 32)."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 32)


def layer(entries: DataFrame, depth: int) -> DataFrame:
    """Adds the path inside its block and the block's top to each of ``entries``
    (key, pos, total, digest, ...)."""
    names = [f.name for f in entries.schema]
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in entries.schema)}, {PATH}, top binary"

    def block(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("pos")
        nodes = digests_of(table["digest"])
        n, total = len(nodes), table["total"][0].as_py()
        high = depth
        if total <= FAN ** depth:  # the whole tree: up to its single node
            high, left = 0, total
            while left > 1:
                high, left = high + 1, -(-left // FAN)
        top, levels = grown(nodes, high)
        cols = {c: table[c] for c in names} | paths(levels, n)
        return pa.table(cols | {"top": pa.array([top[0].tobytes()] * n, pa.binary())})

    return (entries.groupBy("key", F.floor(F.col("pos") / FAN ** depth).alias("block"))
            .applyInArrow(block, schema))


def numbered(rows: DataFrame, keys: list[str], order: str, ties: list[str] | None = None) -> DataFrame:
    """``rows`` with pos from 0 within ``keys``; no task holds a whole key."""
    counted = rows.withColumn("one", F.lit(1).cast("bigint"))
    return (running_sums(counted, keys, order, {"pos": "one"}, ties)
            .withColumn("pos", F.col("pos") - 1).drop("one"))


def joined(rows: DataFrame, small: DataFrame, on: list[str]) -> DataFrame:
    return rows.join(F.broadcast(small) if fits(small, BROADCAST_PATHS) else small, on)


def tree(entries: DataFrame, depth: int = DEPTH) -> DataFrame:
    """The whole path and the top of the tree for each of ``entries`` (key, pos,
    digest, ...), whose ``pos`` counts from 0 within ``key``."""
    size = FAN ** depth
    totals = materialize(entries.groupBy("key").agg(F.count(F.lit(1)).alias("total")), "totals")
    most = totals.agg(F.max("total")).first()[0] or 0
    layers = [materialize(layer(joined(entries, totals, ["key"]), depth), "layer")]
    while most > size:
        most = -(-most // size)
        tops = layers[-1].filter(F.col("pos") % size == 0).select(
            "key", F.floor(F.col("pos") / size).alias("pos"),
            F.ceil(F.col("total") / size).alias("total"), F.col("top").alias("digest"))
        layers.append(materialize(layer(tops, depth), "layer"))
    parts = ("shape", "states", "siblings")
    whole = layers[-1]
    for own in layers[-2::-1]:
        up = whole.select("key", F.col("pos").alias("block"), F.col("top").alias("up_top"),
                          *[F.col(c).alias(f"up_{c}") for c in parts])
        own = joined(own.withColumn("block", F.floor(F.col("pos") / size)), up, ["key", "block"])
        whole = own.select(*[c for c in own.columns if not c.startswith("up_") and c not in (*parts, "top")],
                           *[F.concat(c, f"up_{c}").alias(c) for c in parts], F.col("up_top").alias("top"))
    return whole


def manifest(found: DataFrame, depth: int = DEPTH) -> DataFrame:
    """From ``leaves``: its columns, subroot, root (32 bytes each) and the packed path
    from the leaf to the root."""
    kept = materialize(found, "leaves")
    key = F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("key")  # null first
    extra = [c for c in kept.columns if c not in ("doc_id", "source", "leaf")]
    rows = numbered(kept.select(key, "doc_id", F.col("leaf").alias("digest"), *extra),
                    ["key"], "doc_id", ["digest"])
    inner = tree(rows, depth)
    tops = materialize(inner.filter("pos = 0").select(F.col("key").alias("name"), F.col("top").alias("digest")),
                       "subroots")
    outer = tree(numbered(tops, [], "name").withColumn("key", F.lit("")), depth)
    up = outer.select(F.col("name").alias("key"), F.col("top").alias("root"),
                      *[F.col(c).alias(f"up_{c}") for c in ("shape", "states", "siblings")])
    return joined(inner, up, ["key"]).select(
        "doc_id", F.expr("CASE WHEN key <> '' THEN substr(key, 2) END").alias("source"),
        F.col("digest").alias("leaf"), *extra, F.col("top").alias("subroot"), "root",
        *[F.concat(c, f"up_{c}").alias(c) for c in ("shape", "states", "siblings")])


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a binary column and where each row starts."""
    whole = column.to_pylist()
    starts = np.concatenate(([0], np.cumsum([len(x) for x in whole]))).astype(np.int64)
    return np.frombuffer(b"".join(whole), np.uint8), starts


def folded_batch(digests: np.ndarray, shape: pa.Array, states: pa.Array, siblings: pa.Array) -> np.ndarray:
    """Roots (n, 32) that ``digests`` lead to along their paths."""
    (form, at_form), (kept, at_state), (nodes, at_node) = map(_flat, (shape, states, siblings))
    kept, nodes = kept.reshape(-1, 32), nodes.reshape(-1, 32)
    depth, now = np.diff(at_form), digests.copy()
    at_state, at_node = at_state[:-1] // 32, at_node[:-1] // 32
    for level in range(int(depth.max(initial=0))):
        rows = np.flatnonzero(depth > level)
        count, slot = np.divmod(form[at_form[rows] + level].astype(np.int64), 4)
        state = S.as_state(kept[at_state[rows] + level])
        state = S.absorbed(state, S.hex_block(now[rows]))
        right = at_node[rows] + slot  # the siblings left of the slot are in the state
        for step in range(1, FAN):
            more = np.flatnonzero(slot + step < count)
            state[more] = S.absorbed(state[more], S.hex_block(nodes[right[more] + step - 1]))
        now[rows] = S.finished(state, count)
        at_node[rows] += count - 1
    return now


def folded(found: DataFrame, replacement: str) -> DataFrame:
    """``manifest`` with ``folded_root``: the root with ``replacement`` (a column of
    32-byte digests) in each row's leaf's place."""
    names = found.columns
    schema = T.StructType([*found.schema.fields, T.StructField("folded_root", T.BinaryType())])

    def run(batches):
        for batch in batches:
            cols = {c: batch.column(c) for c in names}
            roots = folded_batch(digests_of(cols[replacement]), cols["shape"], cols["states"],
                                 cols["siblings"])
            cols["folded_root"] = pa.array([r.tobytes() for r in roots], pa.binary())
            yield pa.RecordBatch.from_pydict(cols)

    return found.mapInArrow(run, schema)


def audit(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """doc_id, source, leaf, subroot, root, siblings, changed, folded_root: every row's
    proof, tried on a text without its line ends where 2 divides crc32(doc_id)."""
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0,
                      F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return folded(manifest(leaves(docs, tampered), depth), "changed")


def proof_digest(found: DataFrame) -> DataFrame:
    """The digest columns of the query, as hex."""
    def text(c: str) -> Column:
        return F.lower(F.hex(c))

    return found.select("doc_id", *[text(c).alias(c) for c in ("leaf", "subroot", "root")],
                        F.sha2(text("siblings").cast("binary"), 256).alias("proof_sha256"),
                        text("folded_root").alias("folded_root"),
                        (F.col("folded_root") == F.col("root")).alias("verified"))
