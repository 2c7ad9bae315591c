"""Order statistics without one task ever holding a whole group.

The building block is a running sum over a sort order.  Rows are range
partitioned by (keys, order, ties), so a group of any size, or the whole table,
is cut by the partitions' own bounds.  The running sum is taken inside each
(partition, group), and what the partitions before hold of the same group is added:
a group reaches into the next partition at most once per bound, so there are
fewer such starts than partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import materialize


def running_sums(df: DataFrame, keys: list[str], order: str, sums: dict[str, str],
                 ties: list[str] | None = None) -> DataFrame:
    """Add ``sums[out] = running sum of column`` in ``order`` (any type that
    sorts, then ``ties``) within ``keys``.  Pre-aggregate ``df`` to one row per
    (keys, order, ties).  The rows are stored once, as the bounds must not move."""
    line = [order, *(ties or [])]
    types = dict(df.dtypes)

    def like(total: Column, column: str) -> Column:
        # decimal sums keep their type: a wider one would lose decimal places
        return total.cast(types[column]) if types[column].startswith("decimal") else total

    parts = materialize(df.repartitionByRange(*keys, *line)
                        .withColumn("__part", F.spark_partition_id()), "ordered")
    inside = (Window.partitionBy("__part", *keys).orderBy(*line)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    totals = parts.groupBy("__part", *keys).agg(
        *[like(F.sum(c), c).alias(f"__t_{o}") for o, c in sums.items()])
    before = (Window.partitionBy(*(keys or [F.lit(0)])).orderBy("__part")
              .rowsBetween(Window.unboundedPreceding, -1))
    starts = totals.select(
        F.col("__part").alias("__in"), *[F.col(k).alias(f"__k_{k}") for k in keys],
        F.count(F.lit(1)).over(before).alias("__ahead"),
        *[like(F.sum(f"__t_{o}").over(before), c).alias(f"__b_{o}") for o, c in sums.items()])
    on = F.col("__part") == F.col("__in")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    summed = parts.select("*", *[like(F.sum(c).over(inside), c).alias(f"__r_{o}")
                                 for o, c in sums.items()])
    # one start per partition bound at most
    return (summed.join(F.broadcast(starts.filter("__ahead > 0")), on, "left").select(
        *df.columns, *[like(F.col(f"__r_{o}") + F.coalesce(F.col(f"__b_{o}"), F.lit(0)), c).alias(o)
                       for o, c in sums.items()]))


def dense_ids(df: DataFrame, key: str, out: str = "fid") -> DataFrame:
    """0-based dense id in the order of ``key`` (unique, any type that sorts)."""
    numbered = running_sums(df.select(key).withColumn("__one", F.lit(1).cast("bigint")),
                            [], key, {"__rank": "__one"})
    return df.join(numbered.select(key, (F.col("__rank") - 1).alias(out)), key)


def quantiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per group.

    Values are first counted, so repeated values cost one row; the two order
    statistics around each quantile are then picked by their running count."""
    counted = materialize(df.filter(F.col(value).isNotNull()).groupBy(*keys, value)
                          .agg(F.count(F.lit(1)).alias("__n")), "counted")
    ranked = running_sums(counted, keys, value, {"__upto": "__n"})
    sizes = counted.groupBy(*keys).agg(F.sum("__n").alias("__size"))
    if keys:
        cells = ranked.join(sizes, keys)
    else:
        cells = ranked.withColumn("__size", counted.agg(F.sum("__n")).scalar())
    first, last = F.col("__upto") - F.col("__n"), F.col("__upto") - 1

    def at(index: Column) -> Column:
        return F.max(F.when((index >= first) & (index <= last), F.col(value)))

    picks, finals = [], []
    for name, p in probs.items():
        pos = (F.col("__size") - 1) * F.lit(float(p))
        picks += [at(F.floor(pos)).alias(f"__lo_{name}"), at(F.ceil(pos)).alias(f"__hi_{name}"),
                  F.max(pos - F.floor(pos)).alias(f"__w_{name}")]
        lo, hi, w = (F.col(f"__{k}_{name}") for k in ("lo", "hi", "w"))
        finals.append((lo + (hi - lo) * w).alias(name))
    return cells.groupBy(*keys).agg(*picks).select(*keys, *finals)
