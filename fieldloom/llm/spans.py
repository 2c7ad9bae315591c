"""Spans of a pattern as Columns: no Python in the tasks.

Positions are code points, ends exclusive.  ``split`` and ``regexp_extract_all`` see
the same matches, so a match starts after the lengths of all pieces and matches
before it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 256
NEAR = 40  # code points of context kept before and after a match
SPAN = "struct<start:int,stop:int,rank:int,kind:string,found:string,before:string,after:string>"


def running_sums(values: Column) -> Column:
    """Sums of all elements before each one.  In blocks: arrays are copied when
    they grow, and a text may hold very many matches."""
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor(F.greatest(F.size(values) - 1, F.lit(0)) / BLOCK).cast("int")),
        lambda b: F.slice(values, b * BLOCK + 1, BLOCK))
    zero = F.array(F.lit(0))
    inner = F.transform(blocks, lambda block: F.aggregate(
        block, zero, lambda sums, x: F.concat(sums, F.array(F.element_at(sums, -1) + x))))
    return F.element_at(F.transform(F.array(inner), lambda sums: F.flatten(F.zip_with(
        sums, F.aggregate(sums, zero, lambda done, s: F.concat(
            done, F.array(F.element_at(done, -1) + F.element_at(s, -1)))),
        lambda s, base: F.transform(F.slice(F.coalesce(s, zero), 1, F.size(F.coalesce(s, zero)) - 1),
                                    lambda x: x + base)))), 1)


def with_matches(df: DataFrame, text: str, patterns: dict[str, str],
                 quick: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """Adds ``p_<kind>`` (pieces between matches) and ``m_<kind>`` (matches), both
    null where a cheap test (``quick``, else the pattern itself) finds nothing."""
    column = F.col(text)
    tests = {k: F.when(quick[k](column) if k in quick else F.lit(True), column.rlike(p))
             for k, p in patterns.items()}
    tested = df.select("*", *[c.alias(f"has_{k}") for k, c in tests.items()])
    return tested.select(
        *df.columns,
        *[F.when(F.col(f"has_{k}"), F.split(column, p, -1)).alias(f"p_{k}") for k, p in patterns.items()],
        *[F.when(F.col(f"has_{k}"), F.regexp_extract_all(column, F.lit(p), F.lit(0))).alias(f"m_{k}")
          for k, p in patterns.items()])


def with_spans(df: DataFrame, kinds: dict[str, int]) -> DataFrame:
    """Replaces ``p_`` and ``m_`` of each kind by ``s_<kind>``, an array of SPAN
    (empty where nothing was found)."""
    others = [c for c in df.columns if c[:2] not in ("p_", "m_") or c[2:] not in kinds]

    def lengths(k: str) -> Column:
        return F.zip_with(f"p_{k}", f"m_{k}", lambda p, m: F.char_length(p) + F.coalesce(
            F.char_length(m), F.lit(0)))

    summed = df.select(*others, *[c for k in kinds for c in (
        F.col(f"p_{k}"), F.col(f"m_{k}"),
        F.when(F.col(f"m_{k}").isNotNull(), running_sums(lengths(k))).alias(f"b_{k}"))])

    def spans(k: str, rank: int) -> Column:
        def one(m: Column, i: Column) -> Column:
            piece = F.get(f"p_{k}", i)
            start = F.get(f"b_{k}", i) + F.char_length(piece)
            return F.struct(start.alias("start"), (start + F.char_length(m)).alias("stop"),
                            F.lit(rank).alias("rank"), F.lit(k).alias("kind"), m.alias("found"),
                            F.right(piece, F.lit(NEAR)).alias("before"),
                            F.left(F.get(f"p_{k}", i + 1), F.lit(NEAR)).alias("after"))
        return F.coalesce(F.transform(f"m_{k}", one), F.array().cast(f"array<{SPAN}>"))

    return summed.select(*others, *[spans(k, rank).alias(f"s_{k}") for k, rank in kinds.items()])


def digest_text(spans: Column) -> Column:
    """``kind:start:stop`` of sorted spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
