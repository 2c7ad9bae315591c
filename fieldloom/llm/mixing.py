"""Mixing sources to target weights by repetition rates.

Sizes are words.  Sources are ranked by code point (null last) and weigh 5, 2, 1,
repeating; they share ``budget`` times all words by weight.  A target stops at
``max_rate`` times its source's size; the excess is shared again by weight among the
others until no target is above its stop.  The rate of a source is target / size: every
document is taken floor(rate) times, and once more with a probability equal to the
fraction.  The draw is a hash of the document and a seed.  Several seeds are tried
for every source in the same pass and the one whose sum comes nearest to the target is
taken; all is a function of the rows, so reruns agree.

Defined results: null and empty texts have size 0 and follow their source's rate;
a source without words has target 0 and rate 0; null is a source of its own; repeated
rows draw alike.  Other columns are ignored, or kept by ``emitted``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldloom.shared import fits, materialize

from .common import JAVA_WORD

WEIGHTS = (5, 2, 1)
SEEDS = 16           # four draws of 28 bits come from one digest
BROADCAST_SOURCES = 100_000  # rows of some 100 bytes; more are joined by a shuffle
DRAW = 1 << 28


def size_of(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(JAVA_WORD)), F.lit(0)).cast("long")


def draws(doc_id: Column) -> Column:
    """``SEEDS`` numbers from 0 to DRAW - 1 for each document."""
    digests = [F.md5(F.concat(F.lit(f"mix {i}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))))
               for i in range(SEEDS // 4)]
    return F.array(*[F.conv(F.substring(d, 1 + 7 * j, 7), 16, 10).cast("long")
                     for d in digests for j in range(4)])


def ranked(sizes: DataFrame) -> DataFrame:
    """``sizes`` with the weight of each source's rank: ranks inside the ranges of
    a range partitioning, moved by the counts of the ranges before."""
    parts = materialize(sizes.repartitionByRange(F.col("source").asc_nulls_last())
                        .withColumn("part", F.spark_partition_id()), "source-parts")
    counts = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # a row per partition
    before = counts.select("part", F.coalesce(F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    place = (rank + F.col("before") - 1) % len(WEIGHTS)
    return parts.join(before, "part").withColumn(
        "weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), place.cast("int") + 1).cast("long"))


def source_targets(sizes: DataFrame, budget_num: int = 3, budget_den: int = 2,
                   max_rate: int = 2) -> DataFrame:
    """source, source_size, target from rows of source, source_size.

    The rounds of resharing work on sums alone: what is left for a unit of weight
    is a fraction of whole numbers, so engines agree to the last bit."""
    table = materialize(ranked(sizes).select(
        "source", "source_size", "weight", (max_rate * F.col("source_size")).alias("stop")), "sources")
    total, weights = table.agg(F.sum("source_size"), F.sum("weight")).first()
    total = total or 0
    num, den = budget_num * total, budget_den * (weights or 1)  # words for a unit of weight
    while True:
        over = F.col("stop") * F.lit(den) < F.col("weight") * F.lit(num)
        stopped, free = table.agg(F.sum(F.when(over, F.col("stop"))),
                                  F.sum(F.when(~over, F.col("weight")))).first()
        after = (budget_num * total - budget_den * (stopped or 0), budget_den * (free or 0))
        if not free or after[0] * den == num * after[1]:
            break
        num, den = after
    share = F.col("weight") * F.lit(num).cast("double") / F.lit(den).cast("double")
    return table.select("source", "source_size",
                        F.when(over, F.col("stop").cast("double")).otherwise(share).alias("target"))


def with_copies(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` (doc_id, source, ...) with the columns of their source's plan and
    ``copies``.  ``plan`` is broadcast when it is small, else joined by source."""
    plan = F.broadcast(plan) if fits(plan, BROADCAST_SOURCES) else plan
    joined = rows.join(plan, F.col("source").eqNullSafe(F.col("__source")))
    draw = F.element_at(draws(F.col("doc_id")), F.col("seed") + 1)
    extra = (draw < F.col("fraction") * DRAW).cast("int")
    return joined.withColumn("copies", F.col("whole").cast("int") + extra)


def mixing_plan(sized: DataFrame, **budget) -> DataFrame:
    """__source, source_size, target, whole, fraction, seed for every source of
    ``sized`` (doc_id, source, size)."""
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rate = F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    rates = materialize(source_targets(per_source, **budget).select(
        F.col("source").alias("__source"), "source_size", "target", F.floor(rate).alias("whole"),
        (rate - F.floor(rate)).alias("fraction")), "rates")
    hits = F.transform(draws(F.col("doc_id")), lambda d: (d < F.col("fraction") * DRAW).cast("long"))
    table = F.broadcast(rates) if fits(rates, BROADCAST_SOURCES) else rates
    tried = (sized.join(table, F.col("source").eqNullSafe(F.col("__source")))
             .select("source", "size", "whole", hits.alias("hits")))
    sums = tried.groupBy("source").agg(*[
        F.sum(F.col("size") * (F.col("whole") + F.col("hits")[i])).alias(f"s{i}") for i in range(SEEDS)])
    best = F.array_min(F.array(*[F.struct(F.abs(F.col(f"s{i}") - F.col("target")).alias("off"),
                                          F.lit(i).alias("seed")) for i in range(SEEDS)]))
    return materialize(rates.join(sums, F.col("source").eqNullSafe(F.col("__source")))
                       .select(*rates.columns, best["seed"].alias("seed")), "plan")


def sizes(docs: DataFrame) -> DataFrame:
    return materialize(docs.select("doc_id", "source", size_of("text").alias("size")), "sizes")


def mixture(docs: DataFrame, **budget) -> DataFrame:
    """doc_id, source, size, source_size, target, taken: one row per document row."""
    sized = sizes(docs)
    return (with_copies(sized, mixing_plan(sized, **budget))
            .select("doc_id", "source", "size", "source_size", "target",
                    (F.col("size") * F.col("copies")).cast("long").alias("taken")))


def emitted(docs: DataFrame, **budget) -> DataFrame:
    """The rows of ``docs``, each as often as the mixture takes it, with ``copy``
    (from 1).  Texts are not moved.  Where ``docs`` has a column of that name, the number is
    called ``copy_`` (with more underscores until the name is free)."""
    name = "copy"
    while name in map(str.lower, docs.columns):
        name += "_"
    rows = docs.select(F.struct("*").alias("__row"), "doc_id", "source")
    taken = with_copies(rows, mixing_plan(sizes(docs), **budget)).filter("copies > 0")
    return taken.select("__row.*", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias(name))
