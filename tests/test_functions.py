"""Column helpers on literal edge cases."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from loadlens.functions import dates as D
from loadlens.functions import expressions as X
from loadlens.functions import keys as K
from loadlens.functions import rules as R


def column(spark, rows, schema, expr):
    df = spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema)
    return [r[0] for r in df.select(expr).collect()]


def test_strip_zeros(spark):
    rows = ["0012", "0000", "", None, "12"]
    assert column(spark, rows, "k string", K.strip_one_zero("k")) == ["012", "000", "", None, "12"]
    assert column(spark, rows, "k string", K.strip_zeros("k")) == ["12", "", "", None, "12"]


def test_texts(spark):
    rows = [("a(b)c(d)", "0012345678901"), (None, "12")]
    assert column(spark, rows, "a string, b string", K.strip_parens("a")) == ["a", None]
    assert column(spark, rows, "a string, b string", K.last_chars("b", 9)) == ["345678901", "12"]
    assert column(spark, rows, "a string, b string", K.key_of("a", "b", sep="-")) == ["a(b)c(d)-0012345678901", None]
    assert column(spark, ["7", "x", None], "k string", K.int_of("k")) == [7, None, None]
    assert column(spark, ["7", None], "k string", K.fixed_width_id("k")) == ["0000000007", None]
    assert column(spark, [" x ", "", " ", "null", "NULL ", None], "k string", K.clean_text("k")) == ["x"] + [None] * 5
    assert column(spark, [" x ", None], "k string", K.text_or_empty("k")) == ["x", ""]


def test_exact_key_tells_values_and_nulls_apart(spark):
    rows = [("a", "b"), ("ab", ""), ("", "ab"), (None, "ab"), ("ab", None), ("-", None), (None, "-"), ("1:a", "b")]
    keys = column(spark, rows, "a string, b string", K.exact_key("a", "b"))
    assert len(set(keys)) == len(rows) and None not in keys


def test_week_keys_at_year_ends(spark):
    days = [dt.date(2027, 1, 1), dt.date(2026, 12, 31), dt.date(2026, 2, 1), None]
    assert column(spark, days, "d date", D.week_key("d")) == ["202753", "202653", "202605", None]
    assert column(spark, days, "d date", D.week_key("d", iso_year=True)) == ["202653", "202653", "202605", None]
    assert column(spark, days, "d date", D.week_key("d", "ww/yyyy")) == ["53/2027", "53/2026", "05/2026", None]
    assert column(spark, days, "d date", D.week_key("d", "ww/yyyy", pad=False))[2] == "5/2026"
    assert column(spark, ["2026-02-01", "soon"], "d string", D.iso_week("d")) == [5, None]
    with pytest.raises(ValueError):
        D.week_key("d", "yy")


def test_date_texts(spark):
    assert column(spark, ["20240131", None], "d string", D.dashed_date("d")) == ["2024-01-31", None]
    assert column(spark, ["31/01/2024"], "d string", D.dashed_date("d", "dd/MM/yyyy")) == ["2024-01-31"]
    rows = [("01/01/1970", "00:01:00"), ("99/99/9999", "00:00:00"), ("01/01/1970", None)]
    assert column(spark, rows, "d string, t string", D.epoch_of("d", "t")) == [60, None, None]
    assert column(spark, rows, "d string, t string", D.join_date_time("d", "t", "00:00:00"))[2] == "01/01/1970 00:00:00"
    assert column(spark, ["2024-01-31"], "d string", D.month_label("d")) == ["Jan 2024"]


def test_audit_time_is_utc(spark):
    row = spark.range(1).select(D.audit_ts().alias("a"), F.to_utc_timestamp(F.current_timestamp(), "UTC").alias("b")).first()
    assert row["a"] == row["b"]


def test_on_time_flag(spark):
    t = [dt.datetime(2024, 1, d) for d in (1, 2)]
    rows = [(t[0], t[0]), (t[1], t[0]), (t[0], t[1]), (None, t[0]), (t[0], None)]
    assert column(spark, rows, "p timestamp, a timestamp", R.on_time_flag("p", "a")) == [1, 1, 0, None, None]


def test_pick_by_code_knows_every_code(spark):
    families = [
        R.FIRST_APPOINTMENT_CODES,
        R.LAST_APPOINTMENT_CODES,
        R.REQUESTED_CODES,
        R.ORIGINAL_REQUEST_CODES,
    ]
    choices = {codes: F.lit(i) for i, codes in enumerate(families)}
    rows = [c for codes in families for c in codes] + ["other", None]
    want = [i for i, codes in enumerate(families) for _ in codes] + [None, None]
    assert column(spark, rows, "c string", R.pick_by_code("c", choices)) == want


def test_ratios_and_guards(spark):
    rows = [(1, 2), (1, 0), (None, 2)]
    assert column(spark, rows, "n int, d int", R.percent("n", "d")) == [50.0, None, None]
    assert column(spark, [1.0, float("nan"), None], "x double", R.fill_nan("x", 9.0)) == [1.0, 9.0, 9.0]
    assert column(spark, ["ab", "a", "", None], "s string", R.has_value("s")) == [True, False, False, False]
    df = spark.createDataFrame([("NULL",), (None,), ("x",)], "s string")
    assert [r[0] for r in df.where(R.not_null_text("s")).collect()] == ["x"]
    pairs = [("a", "a"), ("a", "b"), ("a", None), (None, None)]
    assert column(spark, pairs, "a string, b string", R.null_safe_diff("a", "b")) == [False, True, True, False]


def test_expression_overrides():
    assert X.chosen({"a": "1", "b": "2"}, {"b": "3", "c": "4"}) == {"a": "1", "b": "3"}
