"""Projection operators: drop, rename, affix, cast, conform, clean."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlens.functions.keys import clean_text


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop by name; names the frame does not have are ignored."""
    return df.drop(*names)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename old -> new; names the frame does not have are ignored."""
    return df.withColumnsRenamed(dict(mapping))


def affix_columns(
    df: DataFrame, prefix: str = "", postfix: str = "", except_: Sequence[str] = ()
) -> DataFrame:
    """Lower-cased ``prefix_`` / ``_postfix`` on every column but the excepted ones."""
    pre = f"{prefix}_".lower() if prefix else ""
    post = f"_{postfix}".lower() if postfix else ""
    return df.select([F.col(c).alias(c if c in except_ else f"{pre}{c}{post}") for c in df.columns])


def apply_exprs(df: DataFrame, exprs: Mapping[str, str | Column]) -> DataFrame:
    """Add or replace columns from SQL text or Columns.

    Every expression sees the input columns, not the ones replaced beside it.
    """
    have = set(df.columns)
    new = {k: v for k, v in exprs.items() if isinstance(v, str) and k not in have}
    if new:
        df = df.selectExpr("*", *[f"{v} AS `{k}`" for k, v in new.items()])
    rest = {k: F.expr(v) if isinstance(v, str) else v for k, v in exprs.items() if k not in new}
    return df.withColumns(rest) if rest else df


def cast_columns(df: DataFrame, types: Mapping[str, str | T.DataType]) -> DataFrame:
    """Cast by name; text that does not fit the type becomes NULL."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def conform(df: DataFrame, schema: T.StructType, *, fill_missing: bool = False) -> DataFrame:
    """Exactly the columns of ``schema``, in its order and types, matched by name."""
    have = set(df.columns)
    missing = [f.name for f in schema if f.name not in have]
    if missing and not fill_missing:
        raise ValueError(f"columns missing for the target schema: {missing}")
    return df.select(
        [
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def clean_strings(df: DataFrame) -> DataFrame:
    """Trim every string column; blank text and any spelling of 'NULL' become NULL."""
    return df.select(
        [
            clean_text(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
            for f in df.schema
        ]
    )


def coalesce_pairs(df: DataFrame, pairs: Iterable[tuple[str, str]]) -> DataFrame:
    """Fill the first column of each pair from the second one."""
    return df.withColumns({a: F.coalesce(F.col(a), F.col(b)) for a, b in pairs})
