"""Comparison of two copies of a table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.functions.keys import text_or_empty
from loadlens.functions.rules import null_safe_diff
from loadlens.operators.columns import affix_columns
from loadlens.operators.joins import anti_join
from loadlens.operators.reshape import unpivot_pairs

# Buckets a level of the digest tree, from the root down.
LEVELS = (256, 256)


# Text that decimal(38,18) holds without rounding.
PLAIN_NUMBER = r"^[+-]?[0-9]{1,20}([.][0-9]{1,18})?$"


def comparable(col: str, *, numeric: bool = False) -> Column:
    """Text to compare: trimmed, NULL as ''; with ``numeric``, '1.50' equals '1.5'. Only plain decimal
    numbers that fit exactly are compared by value; all else ('1d', 40 digits) is compared as text."""
    text = text_or_empty(col)
    if not numeric:
        return text
    trimmed = F.trim(F.col(col))
    value = trimmed.try_cast("decimal(38,18)").cast("string")
    return F.when(trimmed.rlike(PLAIN_NUMBER), value).otherwise(text)


def discrepancies(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    *,
    carry: Sequence[str] = (),
    numeric: bool = False,
) -> DataFrame:
    """One row per key and column whose values differ in the two tables.

    ``carry`` columns come from the left table.
    """
    l = affix_columns(left.select(*keys, *cols, *carry), "l", except_=[*keys, *carry])
    r = affix_columns(right.select(*keys, *cols), "r", except_=list(keys))
    both = l.join(r, list(keys), "inner")
    rows = unpivot_pairs(both, cols, "l", "r", keep=[*keys, *carry])
    differ = null_safe_diff(comparable("left_val", numeric=numeric), comparable("right_val", numeric=numeric))
    return rows.where(differ).withColumns(
        {"left_val": text_or_empty("left_val"), "right_val": text_or_empty("right_val")}
    )


def missing_rows(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    *,
    carry: Sequence[str] = (),
    label: str = "missing_row",
) -> DataFrame:
    """Keys of the left table that the right one lacks, in the layout of ``discrepancies``."""
    nothing = F.lit(None).cast("string")
    return (
        anti_join(left, right, keys)
        .select(*keys, *carry)
        .withColumns({"column_name": F.lit(label), "left_val": nothing, "right_val": nothing})
    )


def reconcile_tables(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    *,
    carry: Sequence[str] = (),
    label: str = "missing_row",
    numeric: bool = False,
) -> DataFrame:
    """Value discrepancies and missing keys in one report."""
    return discrepancies(left, right, keys, cols, carry=carry, numeric=numeric).unionByName(
        missing_rows(left, right, keys, carry=carry, label=label)
    )


def _bucket(keys: Sequence[str], levels: Sequence[int]) -> Column:
    """Number of the bucket on the last of the levels, a part of the one above."""
    place, number = F.lit(0).cast("bigint"), F.xxhash64(*keys)
    for n in levels:
        place = place * n + F.pmod(number, F.lit(n))
        number = F.shiftright(number, n.bit_length() - 1)
    return place


def _digests(df: DataFrame, keys: Sequence[str], cols: Sequence[str], bucket: Column, numeric: bool) -> DataFrame:
    """Of each bucket its rows and sums of two 64-bit hashes of them, in halves that cannot overflow."""
    values = [*[F.col(k) for k in keys], *[comparable(c, numeric=numeric) for c in cols]]
    one, two = F.xxhash64(F.lit(1), *values), F.xxhash64(F.lit(2), *values)
    halves = [h for x in (one, two) for h in (x.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(x, 32))]
    sums = [F.sum(h).alias(f"_{i}") for i, h in enumerate(halves)]
    return df.groupBy(bucket.alias("_bucket")).agg(F.count("*").alias("_n"), *sums)


def unequal_buckets(
    left: DataFrame, right: DataFrame, keys: Sequence[str], cols: Sequence[str], *, numeric: bool = False, levels: Sequence[int] = LEVELS
) -> DataFrame:
    """Buckets of keys (``_bucket``, on the last level) in which the two tables differ.

    The tables are read once a level and only sums are shuffled, at most as many rows as there
    are buckets; below the root, only the rows of buckets that were unequal one level above
    are summed. ``levels`` are powers of two. Buckets with different rows are taken for equal
    with a probability of about 2^-128.
    """
    found = None
    for depth in range(1, len(levels) + 1):
        bucket = _bucket(keys, levels[:depth])
        sides = [left, right]
        if found is not None:
            sides = [_rows_in(side, keys, levels[: depth - 1], found) for side in sides]
        a, b = (_digests(side, keys, cols, bucket, numeric) for side in sides)
        names = ["_n", *[f"_{i}" for i in range(4)]]
        b = b.withColumnsRenamed({c: f"r{c}" for c in ["_bucket", *names]})
        same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"r{c}")) for c in names])
        both = a.join(b, F.col("_bucket") == F.col("r_bucket"), "full")
        found = both.where(~same).select(F.coalesce("_bucket", "r_bucket").alias("_bucket"))
    return found


def _rows_in(df: DataFrame, keys: Sequence[str], levels: Sequence[int], buckets: DataFrame) -> DataFrame:
    """Rows of some buckets. Their list is bounded by the levels (half a megabyte by default), so
    every task has it and no row is shuffled."""
    return df.join(F.broadcast(buckets), _bucket(keys, levels) == F.col("_bucket"), "left_semi")


def reconcile_by_digest(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    *,
    carry: Sequence[str] = (),
    label: str = "missing_row",
    numeric: bool = False,
    levels: Sequence[int] = LEVELS,
) -> DataFrame:
    """``reconcile_tables`` for copies that differ in few places: only the rows of unequal buckets are
    shuffled. ``left`` and ``right`` are read once a level and once more and should be stored tables."""
    found = unequal_buckets(left, right, keys, cols, numeric=numeric, levels=levels)
    parts = [_rows_in(side, keys, levels, found) for side in (left, right)]
    return reconcile_tables(*parts, keys, cols, carry=carry, label=label, numeric=numeric)
