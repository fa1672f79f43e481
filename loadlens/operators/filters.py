"""Filter operators that need more than one Column expression."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.functions.rules import has_value


def where_has_value(df: DataFrame, *cols: str, min_len: int = 2) -> DataFrame:
    """Rows in which every named column holds text of at least ``min_len`` characters."""
    for c in cols:
        df = df.where(has_value(c, min_len))
    return df


def where_by_param(
    df: DataFrame, value: str, columns: Mapping[str, str], default: str, condition
) -> DataFrame:
    """Filter on a column that a run parameter chooses.

    ``columns`` maps parameter values to column names, ``condition`` turns the chosen
    Column into a boolean Column.
    """
    chosen: Column = F.col(columns.get(value, default))
    return df.where(condition(chosen))
