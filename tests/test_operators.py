"""Operators on small literal frames, against hand-written or brute-force results."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlens.operators import aggregates as A
from loadlens.operators import columns as C
from loadlens.operators import joins as J
from loadlens.operators import reconcile as Q
from loadlens.operators import reshape as S
from loadlens.operators import windows as W
from loadlens.operators.filters import where_by_param
from loadlens.sources.sinks import staged


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- columns -------------------------------------------------------------------------------------
def test_column_operators(spark):
    df = spark.createDataFrame([(1, " a "), (2, "null")], "id int, s string")
    assert C.affix_columns(df, "REG", "X", ["id"]).columns == ["id", "reg_s_x"]
    assert C.drop_columns(df, ["s", "nothing"]).columns == ["id"]
    assert C.rename_columns(df, {"s": "t", "nothing": "u"}).columns == ["id", "t"]
    assert rows_of(C.clean_strings(df)) == [(1, "a"), (2, None)]
    swapped = C.apply_exprs(df, {"id": "id + 1", "old": "id"})
    assert rows_of(swapped.select("id", "old")) == [(2, 1), (3, 2)]
    assert rows_of(C.cast_columns(df, {"s": "int"})) == [(1, None), (2, None)]
    schema = T.StructType([T.StructField("s", T.StringType()), T.StructField("id", T.LongType())])
    assert C.conform(df, schema).dtypes == [("s", "string"), ("id", "bigint")]
    with pytest.raises(ValueError, match="missing"):
        C.conform(df.drop("s"), schema)


def test_filter_column_by_parameter(spark):
    df = spark.createDataFrame([("D", "U"), ("U", "D"), (None, "U")], "a string, b string")
    keep = lambda c: c != "D"
    assert rows_of(where_by_param(df, "one", {"one": "a"}, "b", keep)) == [("U", "D")]
    assert len(rows_of(where_by_param(df, "two", {"one": "a"}, "b", keep))) == 2


# --- joins ------------------------------------------------------------------------------------------
@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_lookup_join_with_a_hot_key_equals_a_plain_join(spark, how, null_safe):
    rng = random.Random(3)
    # A third of the rows has one key, many are exact copies, some have no key.
    left = [("hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None]), i % 7) for i in range(600)]
    right = [("hot", 1), ("a", 2), ("c", 3), (None, 4), ("unused", 5)]
    l = spark.createDataFrame(left, "k string, v int")
    r = spark.createDataFrame(right, "key string, w int")
    out = J.lookup_join(
        l, r, {"k": "key"}, how, counts=J.key_counts(l, ["k"]), rows_per_slot=20, null_safe=null_safe
    )
    look = {k: w for k, w in right if null_safe or k is not None}
    if how == "left":
        want = [(k, v, look.get(k)) for k, v in left]
    elif how == "inner":
        want = [(k, v, look[k]) for k, v in left if k in look]
    else:
        want = [(k, v) for k, v in left if (k in look) == (how == "left_semi")]
    assert rows_of(out) == sorted(want, key=str)
    assert rows_of(J.lookup_join(l, r, {"k": "key"}, how, null_safe=null_safe)) == sorted(want, key=str)


def test_hot_key_is_cut_into_slots(spark):
    l = spark.range(1000).select(F.lit("hot").alias("k"), "id")
    r = spark.createDataFrame([("hot", 1)], "k string, w int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = J.lookup_join(l, r, "k", counts=J.key_counts(l, ["k"]), rows_per_slot=100)
        used = out.groupBy(F.spark_partition_id()).count().count()
        assert out.count() == 1000
        assert used > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_join_rejects_columns_of_both_sides(spark):
    df = spark.createDataFrame([(1, 2)], "k int, v int")
    with pytest.raises(ValueError, match="both sides"):
        J.enrich(df, df, "k")


def test_anti_and_missing(spark):
    l = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    r = spark.createDataFrame([(2,), (2,), (None,)], "k int")
    assert rows_of(J.anti_join(l, r, "k")) == [(1,), (None,)]
    assert rows_of(J.missing_keys(l, r, ["k"])) == [(1,), (None,)]


def test_right_join_keeps_the_right_side(spark):
    l = spark.createDataFrame([(1, "x")], "k int, a string")
    r = spark.createDataFrame([(1, "p"), (2, "q")], "k int, b string")
    assert rows_of(J.right_join(l, r, "k").select("k", "a", "b")) == [(1, "x", "p"), (2, None, "q")]


def test_fallback_lookup_takes_the_first_key_with_a_value(spark):
    df = spark.createDataFrame([("both", "order", "load"), ("none", "order", "load"), ("none", "none", None)], "a string, b string, c string")
    lookup = spark.createDataFrame([("both", "1", None), ("order", "2", "y"), ("load", "3", "z")], "key string, x string, y string")
    out = J.fallback_lookup(df, lookup, "key", ["a", "b", "c"], ["x", "y"])
    assert sorted(map(str, (tuple(r)[3:] for r in out.collect()))) == sorted(map(str, [("1", "y"), ("2", "y"), (None, None)]))


def test_fallback_lookup_against_a_join_for_each_key(spark):
    """Repeated rows, NULL and hot keys, and hits without a value; the lookup is read once."""
    df = spark.range(0, 3000, 1, 5).selectExpr(
        "id div 2 AS id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 7 > 2 THEN cast(id % 50 as string) END AS a",
        "CASE WHEN id % 5 > 0 THEN cast(id % 40 + 20 as string) END AS b", "map('k', id) AS extra",
    )
    lookup = spark.range(0, 80, 2).selectExpr("cast(id as string) AS key", "CASE WHEN id % 3 > 0 THEN id END AS x", "concat('y', id) AS y")
    lookup = staged(lookup.union(spark.sql("SELECT 'hot', cast(NULL as bigint), 'h' UNION ALL SELECT NULL, 5, 'n'")))
    df = staged(df)
    out = J.fallback_lookup(df, lookup, "key", ["a", "b"], ["x", "y"])
    sides = [lookup.where("key IS NOT NULL").selectExpr(f"key AS {k}", f"x AS x{k}", f"y AS y{k}") for k in "ab"]
    plain = df.join(sides[0], "a", "left").join(sides[1], "b", "left").selectExpr("id", "a", "b", "extra", "coalesce(xa, xb) AS x", "coalesce(ya, yb) AS y")
    assert out.columns == ["id", "a", "b", "extra", "x", "y"]
    assert plan_text(out).count("FileScan") == 2
    assert sorted(map(str, out.collect())) == sorted(map(str, plain.collect()))
    assert J.fallback_lookup(df.limit(0), lookup, "key", ["a"], ["x"]).count() == 0


def test_two_pass_match(spark):
    left = spark.createDataFrame(
        [("w", "o1", "z", 5), ("w", "o2", "z", 7), ("w", "o3", "z", 1), ("w", "o4", "y", 2), (None, "o5", "z", 3)],
        "week string, origin string, zone string, n int",
    )
    right = spark.createDataFrame([("w", "o1", "z", 100)], "week string, origin string, zone string, cost int")
    out = J.two_pass_match(
        left,
        right.drop("zone"),
        ["week", "origin"],
        ["week", "zone"],
        regroup={"n": F.sum("n")},
        right_coarse=right.drop("origin"),
    )
    assert "LeftAnti" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = rows_of(out.select("match_pass", "week", "origin", "zone", "n", "cost", "matched"))
    assert got == sorted(
        [
            (1, "w", "o1", "z", 5, 100, True),
            (1, "w", "o2", "z", 7, None, False),
            (1, "w", "o3", "z", 1, None, False),
            (1, "w", "o4", "y", 2, None, False),
            (1, None, "o5", "z", 3, None, False),
            (2, "w", None, "z", 8, 100, True),
            (2, "w", None, "y", 2, None, False),
        ],
        key=str,
    )


# --- aggregates ---------------------------------------------------------------------------------------
def test_aggregates(spark):
    df = spark.createDataFrame(
        [("a", "i1", "d", 2.0), ("a", "i1", "d", 2.0), ("a", "i2", "d", 2.0), ("b", "i1", "d", None)],
        "load string, item string, doc string, q double",
    )
    two = A.two_level(df, ["load", "item", "doc"], ["load"], {"q": "q"})
    assert rows_of(two) == [("a", 4.0), ("b", None)]
    assert rows_of(A.distinct_sum(df, ["load"], ["q"])) == [("a", 2.0), ("b", None)]
    fine = A.fine_coarse(df, two.withColumnRenamed("q", "total"), ["load"], ["load", "item"], ["q"])
    assert rows_of(fine) == [("a", "i1", 4.0, 4.0), ("a", "i2", 2.0, 4.0), ("b", "i1", None, None)]
    pct = A.pct_of(df, ["load"], "item", "q")
    assert rows_of(pct) == [("a", 2, 1, 200.0), ("b", 1, 0, None)]
    with pytest.raises(ValueError):
        A.collapse(df, ["load"], {"x": ("median", "q")})
    assert rows_of(A.dedupe(df, ["load"], [W.oldest("item")]).select("load", "item")) == [("a", "i1"), ("b", "i1")]


# --- rankings ----------------------------------------------------------------------------------------------
EVENTS = [("a", "2", "x1"), ("a", "3", "x3"), ("a", "3", "x2"), ("a", None, "x4"), ("b", "1", "y1"), (None, "5", "z1")]


def test_keep_latest_and_earliest(spark):
    df = spark.createDataFrame(EVENTS, "k string, ts string, id string")
    assert rows_of(W.latest_per_key(df, ["k"], "ts", ["id"]).select("k", "id")) == [("a", "x2"), ("b", "y1"), (None, "z1")]
    assert rows_of(W.earliest_per_key(df, ["k"], "ts", ["id"]).select("k", "id")) == [("a", "x4"), ("b", "y1"), (None, "z1")]
    ends = df.groupBy("k").agg(W.first_value("ts").alias("f"), W.last_value("ts").alias("l"))
    assert rows_of(ends) == [("a", None, "3"), ("b", "1", "1"), (None, "5", "5")]
    with pytest.raises(TypeError):
        W.latest_per_key(df, ["k"], "ts")
    assert W.latest_per_key(df.limit(0), ["k"], "ts", ["id"]).count() == 0


@pytest.mark.parametrize("descending", [True, False])
def test_rank_rows_over_buckets(spark, descending):
    rng = random.Random(1)
    data = [(rng.choice(["a", "b", None]), rng.choice([None] + [f"{d:02d}{h:02d}" for d in range(5) for h in range(3)]), f"{i:04d}") for i in range(300)]
    df = spark.createDataFrame(data, "k string, ts string, id string")
    out = W.rank_rows(df, ["k"], "ts", "r", descending=descending, ties=["id"])
    want = []
    for k in ("a", "b", None):
        rows = sorted((r for r in data if r[0] == k), key=lambda r: r[2])
        rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or ""), reverse=descending)
        want += [(*r, i + 1) for i, r in enumerate(rows)]
    assert rows_of(out) == sorted(want, key=str)


def test_conditional_rank_does_not_multiply_rows(spark):
    df = spark.createDataFrame([("a", "1", 1, 1), ("a", "1", 1, 2), ("a", "2", 0, 3), ("a", "2", None, 4)], "k string, ts string, f int, i int")
    out = W.conditional_rank(df, "f", ["k"], "ts", "r", ties=["i"])
    assert sorted(str(r["r"]) for r in out.collect()) == ["1", "2", "None", "None"]


def test_newest_groups_and_stops(spark):
    df = spark.createDataFrame([(w, i) for w in (None, "202401", "202402", "202403") for i in range(2)], "w string, i int")
    assert rows_of(W.newest_groups(df, "w", 2, "r").select("w", "r").distinct()) == [("202402", 2), ("202403", 1)]
    assert (None, 4) in rows_of(W.newest_groups(df, "w", 9, "r").select("w", "r").distinct())
    stops = spark.createDataFrame([("a", "p"), ("a", None), ("a", "p"), ("b", "q")], "k string, s string")
    assert rows_of(W.stop_count(stops, ["k"], "s")) == [("a", 2), ("b", 1)]


def test_two_stage_needs_nested_keys(spark):
    df = spark.createDataFrame([("a", "b", "1")], "x string, y string, t string")
    with pytest.raises(ValueError):
        W.latest_two_stage(df, ["x"], ["y"], "t", ["t"])


# --- columns to rows, comparison ----------------------------------------------------------------------------------
def test_unpivot_measures(spark):
    df = spark.createDataFrame([("x", 7.5, None), ("y", None, 3.0)], "lane string, pallets double, tons double")
    long = rows_of(S.unpivot_measures(df, ["lane"]))
    assert long == sorted([("x", "pallets", 7.5), ("x", "tons", None), ("y", "pallets", None), ("y", "tons", 3.0)], key=str)
    with pytest.raises(ValueError, match="one type"):
        S.unpivot_measures(df.withColumn("s", F.lit("x")), ["id"])


def test_reconcile(spark):
    schema = "k int, a string, u string"
    left = spark.createDataFrame([(1, "1.50", "EA"), (2, None, "EA"), (3, " x", "EA"), (4, "1", "EA")], schema)
    right = spark.createDataFrame([(1, "1.5", "EA"), (2, "", "CS"), (3, "x ", "EA"), (9, "1", "EA")], schema)
    text = rows_of(Q.reconcile_tables(left, right, ["k"], ["a", "u"]))
    assert text == [(1, "a", "1.50", "1.5"), (2, "u", "EA", "CS"), (4, "missing_row", None, None)]
    numeric = rows_of(Q.reconcile_tables(left, right, ["k"], ["a", "u"], numeric=True))
    assert numeric == text[1:]
    assert rows_of(Q.reconcile_tables(left, left, ["k"], ["a", "u"])) == []


def test_numeric_comparison_is_exact(spark):
    pairs = [("9007199254740993", "9007199254740992"), ("1d", "1"), ("1e2", "100"), ("+1.0", "1"), ("-0", "0"), ("1" * 30, "1" * 30 + ".0")]
    left = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(pairs)], "k int, a string")
    right = spark.createDataFrame([(i, b) for i, (_, b) in enumerate(pairs)], "k int, a string")
    found = Q.discrepancies(left, right, ["k"], ["a"], numeric=True)
    assert sorted(r["k"] for r in found.collect()) == [0, 1, 2, 5]


def test_small_lookups_are_counted_before_they_are_sent(spark):
    rows, side = spark.range(100), spark.range(10).withColumn("v", F.lit("x"))
    out = J.small_lookup_join(rows, side, "id", most_rows=10)
    assert out.where("v = 'x'").count() == 10 and out.count() == 100
    with pytest.raises(ValueError, match="more than 9 rows"):
        J.small_lookup_join(rows, side, "id", most_rows=9)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
def test_lookups_are_sent_or_shuffled_by_their_bytes(spark, how):
    rows = staged(spark.range(0, 4000, 1, 4).selectExpr("id AS n", "CASE WHEN id % 9 > 0 THEN id % 700 END AS a", "cast(id % 5 as string) AS b"))
    side = spark.range(0, 300).selectExpr("id AS c", "cast(id % 5 as string) AS b", "repeat('x', 100) AS text", "array(id, null) AS list")
    on = {"a": "c", "b": "b"}
    small = J.small_lookup_join(rows, side, on, how)
    large = J.small_lookup_join(rows, side, on, how, most_bytes=20_000)
    assert "BroadcastHashJoin" in plan_text(small) and "SortMergeJoin" not in plan_text(small)
    filtered = J.key_filter(rows, side, on)
    partners = rows.where("a < 300 AND a % 5 = cast(b as int)").count()
    assert partners <= filtered.count() <= partners + 2
    assert sorted(map(str, small.collect())) == sorted(map(str, large.select(small.columns).collect()))
    full = J.key_filter(rows, side, on, bits=64)
    assert partners <= full.count() and J.key_filter(rows, side.limit(0), on).count() == 0


def copies(spark, changed=()):
    """A stored master table, and a copy of it with some rows changed, some gone and some new."""
    rows = spark.range(0, 40_000, 1, 4).selectExpr("cast(id as string) AS k", "'EA' AS u", "cast(id % 97 as string) AS a", "cast(id / 4 as string) AS b", "'box' AS box")
    other = rows.withColumn("a", F.when(F.col("k").isin(*changed), F.lit("other")).otherwise(F.concat(F.lit(" "), F.col("a"))))
    other = other.withColumn("b", F.concat("b", F.lit("0")))  # the same numbers
    other = other.where("k NOT IN ('31', '32')") if changed else other
    return staged(rows), staged(other.union(spark.sql("SELECT 'new', 'EA', '1', '1', 'box'")) if changed else other)


def test_reconcile_by_digest_shuffles_what_differs(spark):
    keys, cols = ["k", "u"], ["a", "b"]
    few, many = ("5", "77", "1234"), tuple(str(k) for k in range(0, 4000, 2))
    sizes = []
    for changed in ((), few, many):
        left, right = copies(spark, changed)
        want = Q.reconcile_tables(left, right, keys, cols, carry=["box"], numeric=True)
        got = Q.reconcile_by_digest(left, right, keys, cols, carry=["box"], numeric=True)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        buckets = Q.unequal_buckets(left, right, keys, cols, numeric=True)
        sizes.append((buckets.count(), Q._rows_in(left, keys, Q.LEVELS, buckets).count()))
    assert sizes[0] == (0, 0)
    assert 5 <= sizes[1][0] <= 6 and sizes[1][1] <= 30  # three changed, two gone, one new
    assert 1900 <= sizes[2][0] <= 2004 and sizes[2][1] <= 4_000
    # the rows themselves are filtered before their exchange
    plan = plan_text(Q.reconcile_by_digest(*copies(spark, few), keys, cols))
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan


def test_digests_of_odd_rows(spark):
    rows = [(None, "1", "x"), ("a", None, "x"), ("a", None, "x"), ("b", "1.50", None), ("c", "7", "")]
    other = [(None, "2", "x"), ("a", None, "x"), ("b", "1.5", ""), ("c", "8", None), ("d", "1", "1")]
    left, right = (spark.createDataFrame(x, "k string, a string, b string") for x in (rows, other))
    for levels in ((2,), (2, 2), (256, 256)):
        want = Q.reconcile_tables(left, right, ["k"], ["a", "b"], numeric=True)
        got = Q.reconcile_by_digest(left, right, ["k"], ["a", "b"], numeric=True, levels=levels)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert Q.reconcile_by_digest(left.limit(0), right.limit(0), ["k"], ["a"]).count() == 0
