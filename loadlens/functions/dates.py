"""Date and time helpers over text, date and timestamp columns.

Text is parsed with the ``try_`` forms so that a malformed value turns into NULL
instead of failing the job under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loadlens.functions.keys import _c

# Text layouts of the source tables.
DATE_TEXT = "dd/MM/yyyy"
DATE_TIME_TEXT = "dd/MM/yyyy HH:mm:ss"
COMPACT_TIME_TEXT = "yyyyMMddHHmmss"


def iso_week(col: Column | str) -> Column:
    return F.weekofyear(_c(col).try_cast("date"))


def calendar_year(col: Column | str) -> Column:
    return F.year(_c(col).try_cast("date"))


def week_key(col: Column | str, layout: str = "yyyyww", *, pad: bool = True, iso_year: bool = False) -> Column:
    """Week key as text: 'yyyyww' (sortable) or 'ww/yyyy'.

    The default pairs the ISO week with the calendar year, which is how the report
    tables are keyed; ``iso_year=True`` pairs it with the year the week belongs to.
    """
    day = _c(col).try_cast("date")
    year = F.extract(F.lit("YEAROFWEEK"), day) if iso_year else F.year(day)
    week = F.weekofyear(day).cast("string")
    week = F.lpad(week, 2, "0") if pad else week
    year = year.cast("string")
    if layout == "yyyyww":
        return F.concat(year, week)
    if layout == "ww/yyyy":
        return F.concat(week, F.lit("/"), year)
    raise ValueError(f"unknown week key layout: {layout}")


def dashed_date(col: Column | str, layout: str = "yyyyMMdd") -> Column:
    """Compact or slashed date text -> 'yyyy-MM-dd' by position."""
    starts = {"yyyyMMdd": (1, 5, 7), "dd/MM/yyyy": (7, 4, 1)}
    if layout not in starts:
        raise ValueError(f"unknown date layout: {layout}")
    y, m, d = starts[layout]
    c = _c(col)
    return F.concat(
        F.substring(c, y, 4), F.lit("-"), F.substring(c, m, 2), F.lit("-"), F.substring(c, d, 2)
    )


def join_date_time(date: Column | str, time: Column | str, default_time: str | None = None) -> Column:
    """'date time' text; NULL if a part is missing, unless a default time is given."""
    t = _c(time)
    if default_time is not None:
        t = F.coalesce(t, F.lit(default_time))
    return F.concat(_c(date), F.lit(" "), t)


def epoch_of(date: Column | str, time: Column | str, layout: str = DATE_TIME_TEXT) -> Column:
    """Epoch seconds of date text plus time text; NULL if missing or malformed."""
    return F.unix_timestamp(F.try_to_timestamp(join_date_time(date, time), F.lit(layout)))


def month_num(col: Column | str) -> Column:
    return F.month(_c(col).try_cast("date"))


def month_name(col: Column | str) -> Column:
    return F.date_format(_c(col).try_cast("date"), "MMM")


def month_label(col: Column | str) -> Column:
    """'Jan 2024'."""
    return F.concat(month_name(col), F.lit(" "), calendar_year(col).cast("string"))


def audit_ts(zone: Column | str | None = None) -> Column:
    """Load time in UTC, read from the session zone or from a given one."""
    return F.to_utc_timestamp(F.current_timestamp(), F.current_timezone() if zone is None else zone)
