"""Benchmark decontamination by greedy string tiling.

Benchmark items and documents are cut into lower-case words; five-word windows
get a Karp-Rabin hash (one rolling polynomial over the words' hashes).  Windows of
documents are joined with those of the items, in the tasks: every hit is a seed (position in the
document, position in the item).  Per document and item the seeds on one diagonal
make maximal matches; the longest match that overlaps no marked word is marked
again and again, until none of five words is left.  The share of the item's words
under marked tiles decides, so a passage whose sentences were reordered still counts.

Defined results: items below five words, null or empty texts give no seeds and are
never reported; repeated document rows are judged together; repeated item ids
with different texts are judged each on its own, the best counts; rows without
doc_id are told apart by their text.  Other columns are ignored.
"""

from __future__ import annotations

import heapq
import re
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from fieldloom.operators.ordered import running_sums
from fieldloom.shared import materialize

from .common import broadcast_tables, document_key, keyed_rows, map_rows, revived

WINDOW = 5
COVERAGE = 0.5
BROADCAST_SEEDS = 1_000_000  # windows of some 40 bytes; more items take another pass
PAIRS = 1 << 18              # seeds of a document and item that are laid out at once
TOKEN = re.compile(r"\w+")
BASE = np.uint64(0x9E3779B97F4A7C15)


def window_hashes(text: str | None, seen: dict[str, int]) -> np.ndarray:
    """Karp-Rabin hashes (signed) of the five-word windows of a text."""
    tokens = TOKEN.findall((text or "").lower())
    n = len(tokens) - WINDOW + 1
    if n < 1:
        return np.empty(0, np.int64)
    if len(seen) > 200_000:
        seen.clear()
    codes = []
    for t in tokens:
        code = seen.get(t)
        if code is None:
            code = seen[t] = xxhash.xxh64_intdigest(t.encode("utf-8", "replace"))
        codes.append(code)
    word = np.array(codes, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(WINDOW):  # Horner's rule modulo 2^64
        total = total * BASE + word[i:i + n]
    return total.view(np.int64)


def windows(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, pos, h: every window of ``text``."""
    def run(cols: dict) -> dict:
        seen: dict[str, int] = {}
        found = [window_hashes(t, seen) for t in cols["text"].to_pylist()]
        return {k: cols[k] for k in keys} | {"hashes": found}

    schema = rows.select(*keys).schema.add("hashes", T.ArrayType(T.LongType()))
    return map_rows(rows, run, schema).select(*keys, F.posexplode("hashes").alias("pos", "h"))


def pair_runs(doc: np.ndarray, item: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal matches (document position, item position, words) from seeds."""
    order = np.lexsort((doc, doc - item))
    doc, item = doc[order], item[order]
    breaks = np.flatnonzero((np.diff(doc - item) != 0) | (np.diff(doc) != 1)) + 1
    starts = np.concatenate(([0], breaks))
    ends = np.concatenate((breaks, [len(doc)]))
    return doc[starts], item[starts], ends - starts + WINDOW - 1


def diagonal_runs(places: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same from the sorted document positions of each of the item's windows, one window at a
    time: only the diagonals of the matches still open are held, never all seeds."""
    found, line, start = [], np.empty(0, np.int64), np.empty(0, np.int64)
    for at, place in enumerate([*places, np.empty(0, np.int64)]):
        here = place - at
        goes_on = np.isin(line, here, assume_unique=True)
        over, since = line[~goes_on], start[~goes_on]
        found.append((over + since, since, at - since + WINDOW - 1))
        new = here[~np.isin(here, line, assume_unique=True)]
        line, start = np.concatenate((line[goes_on], new)), np.concatenate((start[goes_on], np.full(len(new), at)))
    return tuple(np.concatenate(x) for x in zip(*found))


def marked(doc: np.ndarray, item: np.ndarray, size: np.ndarray) -> list[tuple[int, int, int]]:
    """Greedy tiles of maximal matches: the longest that overlaps no marked word, again and
    again.  Matches wait in sorted arrays; what is left of one whose ends or middle were taken
    waits in a heap.  Matches whose part of the item has no five free words left are dropped at once,
    so a passage that repeats very often is not gone through match by match."""
    order = np.lexsort((doc, item, -size))
    doc, item, size = doc[order], item[order], size[order]
    words = int((item + size).max(initial=0))
    free = np.ones(words + 1, bool)
    free[words] = False
    used_doc: set[int] = set()
    parts: list[tuple[int, int, int]] = []
    found, at = [], 0
    while at < len(doc) or parts:
        if at < len(doc) and (not parts or (-size[at], item[at], doc[at]) <= parts[0]):
            length, at_item, at_doc = int(size[at]), int(item[at]), int(doc[at])
            at += 1
        else:
            length, at_item, at_doc = heapq.heappop(parts)
            length = -length
        ok = [free[at_item + i] and at_doc + i not in used_doc for i in range(length)]
        if all(ok):
            found.append((at_doc, at_item, length))
            used_doc.update(range(at_doc, at_doc + length))
            free[at_item:at_item + length] = False
            # windows of the item that are still free, counted up to each position
            whole = np.convolve(free, np.ones(WINDOW, int))[WINDOW - 1:] == WINDOW
            upto = np.concatenate(([0], np.cumsum(whole)))
            doc, item, size, at = doc[at:], item[at:], size[at:], 0
            alive = upto[item + size - WINDOW + 1] > upto[item]
            doc, item, size = doc[alive], item[alive], size[alive]
            continue
        start = None
        for i, good in enumerate([*ok, False]):
            if good and start is None:
                start = i
            elif not good and start is not None:
                if i - start >= WINDOW:
                    heapq.heappush(parts, (start - i, at_item + start, at_doc + start))
                start = None
    return found


def tiles(doc: np.ndarray, item: np.ndarray) -> list[tuple[int, int, int]]:
    """Greedy tiles (document position, item position, words) from seeds."""
    return marked(*pair_runs(doc, item))


class Items:
    """The windows of a block of benchmark items, to be met by those of documents."""

    def __init__(self, item: np.ndarray, pos: np.ndarray, h: np.ndarray):
        order = np.lexsort((pos, item))
        item, h = item[order], h[order]
        self.hashes, self.window = np.unique(h, return_inverse=True)   # of each window its hash's number
        self.names, first = np.unique(item, return_index=True)
        self.first = np.append(first, len(item))                       # windows of each item
        by_hash = np.argsort(self.window, kind="stable")
        self.holders = np.repeat(np.arange(len(self.names)), np.diff(self.first))[by_hash]
        self.lists = np.searchsorted(self.window[by_hash], np.arange(len(self.hashes) + 1))

    def covered(self, hashes: np.ndarray, coverage: float) -> list[tuple[int, int, int, int]]:
        """(item, its words, words under tiles, tiles) of the items that a text with these windows
        covers by ``coverage`` or more."""
        place = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        spots = np.flatnonzero(self.hashes[place] == hashes)
        if not len(spots):
            return []
        which = place[spots]
        order = np.argsort(which, kind="stable")
        spots, (seen, cuts) = spots[order], np.unique(which[order], return_index=True)
        ends = np.append(cuts[1:], len(spots))
        out = []
        for i in np.unique(np.concatenate([self.holders[self.lists[k]:self.lists[k + 1]] for k in seen])).tolist():
            window = self.window[self.first[i]:self.first[i + 1]]
            words = len(window) + WINDOW - 1
            at = np.minimum(np.searchsorted(seen, window), len(seen) - 1)
            hit = seen[at] == window
            # no tile reaches beyond the windows that are met
            if np.count_nonzero(np.convolve(hit, np.ones(WINDOW, int))) < coverage * words:
                continue
            places = [spots[cuts[a]:ends[a]] if ok else spots[:0] for a, ok in zip(at.tolist(), hit.tolist())]
            sizes = [len(p) for p in places]
            if sum(sizes) <= PAIRS:
                runs = pair_runs(np.concatenate(places), np.repeat(np.arange(len(places)), sizes))
            else:
                runs = diagonal_runs(places)
            found = marked(*runs)
            total = sum(t[2] for t in found)
            if total >= coverage * words:
                out.append((int(self.names[i]), words, total, len(found)))
        return out


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """doc_id, text_key, item_id, item_words, covered, tiles, coverage of every
    document and item at or above ``coverage``.

    The items' windows are broadcast in blocks of whole items, ``BROADCAST_SEEDS`` windows
    or one item; each block is met by the windows of all documents, in one pass over the texts.
    Only what is covered leaves the pass."""
    spark = docs.sparkSession
    items = benchmark.select("item_id", "text", F.xxhash64("text").alias("item_key")).distinct()
    seeds = materialize(windows(items, ["item_id", "item_key"]), "seeds")
    order = [F.col("item_id").isNull().alias("none"), F.col("item_id"), F.col("item_key")]
    counts = seeds.groupBy(*order).agg(F.count(F.lit(1)).alias("n"))
    numbered = running_sums(counts.withColumn("one", F.lit(1).cast("bigint")), [], "none",
                            {"upto": "n", "number": "one"}, ["item_id", "item_key"])
    numbered = materialize(numbered.select(
        F.col("item_id").alias("__i"), F.col("item_key").alias("__k"), F.col("number"),
        F.floor((F.col("upto") - F.col("n")) / F.lit(BROADCAST_SEEDS)).alias("block")), "items")
    blocks = sorted(r.block for r in numbered.select("block").distinct().collect())  # as many as passes
    rows = document_key(docs)
    schema = T.StructType([*rows.select("doc_id", "text_key").schema.fields,
                           *T.StructType.fromDDL("number long, item_words long, covered long, tiles long").fields])
    arrow = to_arrow_schema(schema)
    same = F.col("__i").eqNullSafe(F.col("item_id")) & (F.col("__k") == F.col("item_key"))
    parts = []
    for block in blocks:
        held = (seeds.join(numbered.filter(F.col("block") == block), same)
                .select("number", F.col("pos").cast("long"), "h").toArrow())
        shared = broadcast_tables(spark, Items(*(held[c].to_numpy() for c in ("number", "pos", "h"))))

        def run(batches, shared=shared):
            seen: dict[str, int] = {}
            met = revived(Items, shared)
            for batch in batches:
                ids, keys = batch.column("doc_id"), batch.column("text_key")
                row, found = [], []
                for i, text in enumerate(batch.column("text").to_pylist()):
                    hits = met.covered(window_hashes(text, seen), coverage)
                    row += [i] * len(hits)
                    found += hits
                at = pa.array(row, pa.int64())
                columns = [ids.take(at), keys.take(at), *(pa.array([f[k] for f in found], pa.int64()) for k in range(4))]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

        parts.append(rows.mapInArrow(run, schema))
    if not parts:
        parts.append(spark.createDataFrame([], schema))
    named = numbered.select(F.col("__i").alias("item_id"), "number")
    hits = reduce(DataFrame.unionByName, parts).distinct()  # repeated rows are judged together
    return hits.join(named, "number").select(
        "doc_id", "text_key", "item_id", "item_words", "covered", "tiles",
        (F.col("covered") / F.col("item_words")).alias("coverage"))


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """One row per document and item it leaks, whatever the number of text versions."""
    return (benchmark_hits(docs, benchmark, coverage).groupBy("doc_id", "item_id")
            .agg(F.max(F.struct("coverage", "covered", "item_words", "tiles")).alias("best"))
            .select("doc_id", "item_id", "best.*"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The rows of ``docs`` that leak no item."""
    leaks = materialize(benchmark_hits(docs, benchmark, coverage)
                        .select(F.col("doc_id").alias("__id"), "text_key").distinct(), "leaks")
    rows = keyed_rows(docs)
    return rows.join(leaks, F.col("__id").eqNullSafe(rows["doc_id"])
                     & (leaks["text_key"] == rows["row_key"]), "left_anti").select("row.*")
