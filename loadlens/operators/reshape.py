"""Columns to rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unpivot_measures(
    df: DataFrame, ids: Sequence[str], cols: Sequence[str] | None = None, key: str = "key", val: str = "val"
) -> DataFrame:
    """One row per (ids, column); all unpivoted columns must have one type."""
    cols = [c for c in df.columns if c not in ids] if cols is None else list(cols)
    types = {df.schema[c].dataType.simpleString() for c in cols}
    if len(types) != 1:
        raise ValueError(f"columns of one type expected, got {sorted(types)}")
    return df.unpivot(list(ids), cols, key, val)


def unpivot_pairs(
    df: DataFrame,
    cols: Sequence[str],
    left_prefix: str,
    right_prefix: str,
    *,
    keep: Sequence[str],
    name: str = "column_name",
    left_out: str = "left_val",
    right_out: str = "right_val",
) -> DataFrame:
    """One row per compared column with its left and right value as text.

    A narrow pass over the rows: every input row gives ``len(cols)`` output rows.
    """
    pairs = F.array(
        *[
            F.struct(
                F.lit(c).alias(name),
                F.col(f"{left_prefix}_{c}").cast("string").alias(left_out),
                F.col(f"{right_prefix}_{c}").cast("string").alias(right_out),
            )
            for c in cols
        ]
    )
    return df.select(*keep, F.inline(pairs))
