"""Key and text helpers. Every function takes and returns a Column (or a column name)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_one_zero(col: Column | str) -> Column:
    """'0012' -> '012'."""
    return F.regexp_replace(_c(col), "^0", "")


def strip_zeros(col: Column | str) -> Column:
    """'0012' -> '12', '0000' -> ''."""
    return F.regexp_replace(_c(col), "^0+", "")


def last_chars(col: Column | str, n: int) -> Column:
    """The last ``n`` characters; shorter text is returned whole."""
    return F.substring(_c(col), -n, n)


def key_of(*cols: Column | str, sep: str = "") -> Column:
    """Composite text key; NULL as soon as one part is NULL."""
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i and sep:
            parts.append(F.lit(sep))
        parts.append(_c(c).cast("string"))
    return F.concat(*parts)


def exact_key(*cols: Column | str) -> Column:
    """One non-NULL text for several values, different for different values.

    Each value is written with its length, a missing one as '-'. A join on it compares one
    column and lets NULLs match each other.
    """
    texts = [_c(c).cast("string") for c in cols]
    return F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def lane_text(origin: Column | str, city: Column | str, state: Column | str, postal: Column | str) -> Column:
    """'ORIGIN to CITY,STATE,POSTAL'."""
    return F.concat(_c(origin), F.lit(" to "), _c(city), F.lit(","), _c(state), F.lit(","), _c(postal))


def strip_parens(col: Column | str) -> Column:
    """Drop everything from the first '(' to the last ')'."""
    return F.regexp_replace(_c(col), r"\(.*\)", "")


def left_pad(col: Column | str, width: int, fill: str = "0") -> Column:
    return F.lpad(_c(col).cast("string"), width, fill)


def cut(col: Column | str, pos: int, length: int) -> Column:
    """Characters by position, counted from 1."""
    return F.substring(_c(col), pos, length)


def int_of(col: Column | str) -> Column:
    """Integer value of a text number, NULL for anything else."""
    return _c(col).try_cast("int")


def fixed_width_id(col: Column | str, width: int = 10) -> Column:
    return left_pad(col, width, "0")


def clean_text(col: Column | str) -> Column:
    """Trim; blank text and any spelling of 'NULL' become NULL."""
    t = F.trim(_c(col))
    return F.when((t == "") | (F.upper(t) == "NULL"), None).otherwise(t)


def text_or_empty(col: Column | str) -> Column:
    """Trim; NULL becomes ''."""
    return F.coalesce(F.trim(_c(col)), F.lit(""))
