"""Business rules as Column expressions: promise pick, on-time flag, ratios, guards."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from loadlens.functions.keys import _c

# Profile method code -> which promise counts.
FIRST_APPOINTMENT_CODES = ("APFD", "RDDAPF", "APF")
LAST_APPOINTMENT_CODES = ("APLD", "RDDAPL", "APL")
REQUESTED_CODES = ("RDD",)
ORIGINAL_REQUEST_CODES = ("ORDD", "OTIF")

# Fixed value: event time of an event that has not happened.
OPEN_EVENT_TIME = "99991231235959"


def pick_by_code(code: Column | str, choices: Mapping[tuple[str, ...], Column | str]) -> Column:
    """The column named by the first family of codes that holds ``code``, else NULL."""
    out: Column | None = None
    for codes, col in choices.items():
        hit = _c(code).isin(*codes)
        out = F.when(hit, _c(col)) if out is None else out.when(hit, _c(col))
    if out is None:
        raise ValueError("no choices given")
    return out


def on_time_flag(promise: Column | str, actual: Column | str) -> Column:
    """1 if the promise is not before the actual time, 0 if it is, NULL if one is missing."""
    p, a = _c(promise), _c(actual)
    return F.when(p.isNull() | a.isNull(), None).when(p >= a, 1).otherwise(0)


def override_for(by: Column | str, values: Iterable[str], special: Column | str, usual: Column | str) -> Column:
    """``special`` where ``by`` is one of ``values``, else ``usual``."""
    return F.when(_c(by).isin(*values), _c(special)).otherwise(_c(usual))


def ratio(num: Column | str, den: Column | str) -> Column:
    """num / den as double, NULL on a zero denominator."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def percent(num: Column | str, den: Column | str) -> Column:
    return ratio(num, den) * F.lit(100.0)


def fill_nan(col: Column | str, value: float) -> Column:
    """NaN and NULL of a numeric column replaced by ``value``."""
    return F.coalesce(F.nanvl(_c(col), F.lit(value)), F.lit(value))


def has_value(col: Column | str, min_len: int = 2) -> Column:
    """Text of at least ``min_len`` characters."""
    return F.length(F.coalesce(_c(col), F.lit(""))) >= min_len


def not_sentinel(col: Column | str, *values: str) -> Column:
    return ~_c(col).isin(*(values or (OPEN_EVENT_TIME,)))


def not_null_text(col: Column | str) -> Column:
    """Neither the text 'NULL' nor a real NULL (inside a filter)."""
    return _c(col) != "NULL"


def non_empty(col: Column | str) -> Column:
    return _c(col) != ""


def null_safe_diff(a: Column | str, b: Column | str) -> Column:
    """True unless both are equal or both are NULL."""
    return ~_c(a).eqNullSafe(_c(b))


def any_of(*conds: Column) -> Column:
    return reduce(lambda x, y: x | y, conds)


def all_of(*conds: Column) -> Column:
    return reduce(lambda x, y: x & y, conds)
