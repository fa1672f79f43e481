"""Ranking operators.

Picking the first rows of a key is a row_number filter, which Spark cuts down on the map
side (WindowGroupLimit) before it shuffles; first and last values are plain aggregates.
A rank for every row would pull a whole key into one task, so ``rank_rows`` ranks inside
range partitions of the whole order and adds the rows of the key in the partitions before.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadlens.sources.sinks import staged


def newest(col: str) -> Column:
    """Latest first, NULL last."""
    return F.col(col).desc_nulls_last()


def oldest(col: str) -> Column:
    """Earliest first, NULL first."""
    return F.col(col).asc_nulls_first()


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key in a total order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def latest_per_key(df: DataFrame, keys: Sequence[str], by: str, ties: Sequence[str]) -> DataFrame:
    """The row with the newest ``by`` per key; ``ties`` make the choice unique."""
    return top_per_key(df, keys, [newest(by), *[oldest(t) for t in ties]])


def earliest_per_key(df: DataFrame, keys: Sequence[str], by: str, ties: Sequence[str]) -> DataFrame:
    """The row with the oldest ``by`` per key, a NULL counting as oldest."""
    return top_per_key(df, keys, [oldest(by), *[oldest(t) for t in ties]])


def latest_two_stage(
    df: DataFrame, fine: Sequence[str], coarse: Sequence[str], by: str, ties: Sequence[str]
) -> DataFrame:
    """Newest row per fine key, then the newest of those per coarse key. ``ties`` must make the order
    total.

    With one total order and the coarse key inside the fine key, the winner of the second
    step always wins the first one too, so one step gives the same rows.
    """
    if not set(coarse) <= set(fine):
        raise ValueError("the coarse key must be part of the fine key")
    return latest_per_key(df, coarse, by, ties)


def first_value(col: Column | str) -> Column:
    """Aggregate: the value of the row that sorts first, NULL sorting before all."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(F.count(F.when(c.isNull(), 1)) == 0, F.min(c))


def last_value(col: Column | str) -> Column:
    """Aggregate: the value of the row that sorts last, NULL only if there is no other."""
    return F.max(F.col(col) if isinstance(col, str) else col)


def arg_extreme(
    df: DataFrame,
    keys: Sequence[str],
    by: Sequence[str],
    cols: Sequence[str],
    *,
    highest: bool = True,
) -> DataFrame:
    """The values of ``cols`` in the row with the highest (or lowest) ``by`` per key."""
    pick = F.max if highest else F.min
    row = F.struct(*[F.col(c) for c in [*by, *cols]])
    return df.groupBy(*keys).agg(pick(row).alias("_best")).select(*keys, *[f"_best.{c}" for c in [*by, *cols]])


def rank_rows(
    df: DataFrame,
    keys: Sequence[str],
    by: str,
    out: str,
    *,
    descending: bool = False,
    ties: Sequence[str],
    partitions: int | None = None,
    keep: Callable[[DataFrame], DataFrame] = staged,
) -> DataFrame:
    """Row number of every row within its key, in a total order by ``by`` then ``ties``.

    The rows are dealt into ranges of (keys, by, ties) and stored by ``keep``; the range is the bucket.
    Since the ties belong to the order, a range is never larger than the others, whatever a key, a
    time or a missing time holds. Ranks are taken per key and range and moved up by the key's rows in
    the ranges before.
    """
    direction = newest if descending else oldest
    order = [*[oldest(k) for k in keys], direction(by), *[oldest(t) for t in ties]]
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    cut = keep(ranged.withColumn("_bucket", F.spark_partition_id()))
    sizes = cut.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *[F.col(k).alias(f"_o_{k}") for k in keys],
        F.col("_bucket").alias("_o_bucket"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
    )
    same = F.col("_bucket") == F.col("_o_bucket")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_o_{k}"))
    inside = Window.partitionBy(*keys, "_bucket").orderBy(direction(by), *[oldest(t) for t in ties])
    return (
        cut.join(offsets, same, "left")
        .withColumn(out, (F.col("_before") + F.row_number().over(inside)).cast("int"))
        .select(*df.columns, out)
    )


def conditional_rank(
    df: DataFrame,
    flag: str,
    keys: Sequence[str],
    by: str,
    out: str,
    *,
    ties: Sequence[str],
    partitions: int | None = None,
    keep: Callable[[DataFrame], DataFrame] = staged,
) -> DataFrame:
    """Rank, newest first, among the rows with flag = 1; NULL for all other rows, which are not ranked."""
    flagged = F.coalesce(F.col(flag) == 1, F.lit(False))
    ranked = rank_rows(df.where(flagged), keys, by, out, descending=True, ties=ties, partitions=partitions, keep=keep)
    return ranked.unionByName(df.where(~flagged).withColumn(out, F.lit(None).cast("int")))


def stop_count(df: DataFrame, keys: Sequence[str], stop: str, out: str = "multi_stop_num") -> DataFrame:
    """How many different stops a key has, a missing stop counting as one."""
    return df.groupBy(*keys).agg(distinct_with_null(stop).alias(out))


def distinct_with_null(col: str) -> Column:
    """Aggregate: the highest dense rank of ``col``, NULL being a value of its own."""
    return (F.count_distinct(F.col(col)) + F.max(F.when(F.col(col).isNull(), 1).otherwise(0))).cast("int")


def newest_groups(df: DataFrame, group: str, n: int, out: str) -> DataFrame:
    """Rows of the ``n`` newest groups, with the group's place (1 = newest) in ``out``.

    Only the distinct groups are ranked. The ``n`` kept ones, a list whose size is ``n``, come back as
    values, so that Spark can drop the other groups as early as the rows of ``df`` are read.
    """
    top = staged(df.select(F.col(group).alias("_g")).distinct().orderBy(newest("_g")).limit(n))
    ranked = top.withColumn(out, F.row_number().over(Window.orderBy(newest("_g"))))
    kept = [r[0] for r in top.collect()]
    among = F.col(group).isin([g for g in kept if g is not None])
    among = among | F.col(group).isNull() if None in kept else among
    return (
        df.where(among)
        .join(F.broadcast(ranked), F.col(group).eqNullSafe(F.col("_g")), "inner")
        .select(*df.columns, out)
    )
