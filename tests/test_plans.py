"""Shapes of physical plans that matter at scale."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  (fills the registry)
from catalog import plans, registry
from loadlens.demo.views import Views
from loadlens.operators import joins as J
from loadlens.operators import windows as W
from loadlens.plans import by_load, schemas
from loadlens.plans.loading import load_out_rows
from loadlens.sources import sinks


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, sf_dir):
    v = Views(spark, sf_dir, stored=True)
    v.hub = sinks.staged(plans.hub_of(v))
    yield v
    sinks.clean_staged(spark)


@pytest.mark.parametrize("name", sorted(registry.OVER_VIEWS))
def test_no_query_pairs_all_rows(name, stored):
    plan = plan_of(registry.OVER_VIEWS[name](stored))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name, most", [("weekly_scorecard", 7), ("fill_rate_load_agg", 8), ("fallback_lookup", 4)])
def test_sources_are_read_once_or_from_a_stored_table(name, most, stored):
    assert plan_of(registry.OVER_VIEWS[name](stored)).count("FileScan") <= most


@pytest.mark.parametrize(
    "name, schema",
    [
        ("on_time_hub", schemas.ON_TIME_HUB),
        ("loading_on_time", schemas.LOADING_ON_TIME),
        ("customer_on_time", schemas.CUSTOMER_ON_TIME),
        ("interplant", schemas.CUSTOMER_ON_TIME),
        ("carrier_lane_detail", schemas.CARRIER_LANE_DETAIL),
        ("carrier_shipment_detail", schemas.CARRIER_SHIPMENT_DETAIL),
        ("weekly_scorecard", schemas.WEEKLY_SCORECARD),
        ("fill_rate_hub", schemas.FILL_RATE_HUB),
        ("fill_rate_load_agg", schemas.FILL_RATE_LOAD_AGG),
    ],
)
def test_the_checked_columns_are_those_of_the_target(name, schema, stored):
    """The query that is held against DuckDB has every column of the product."""
    assert registry.OVER_VIEWS[name](stored).columns == schema.names


def test_a_hot_key_is_ranked_in_several_tasks(spark):
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.lit("999912").alias("ts"),
        "id",
    )
    out = W.rank_rows(rows, ["k"], "ts", "r", ties=["id"], partitions=8).cache()
    hot = out.where("k = 'hot'")
    assert hot.agg(F.max("r"), F.countDistinct("r")).first() == (20_000, 20_000)
    kept = []
    W.rank_rows(rows, ["k"], "ts", "r", ties=["id"], partitions=8, keep=lambda df: kept.append(sinks.staged(df)) or kept[0])
    assert kept[0].where("k = 'hot'").select("_bucket").distinct().count() >= 2
    out.unpersist()


def test_a_load_with_a_third_of_the_rows(spark):
    """One hot left key gives the rows of a plain join, cut into slots or left to the planner."""
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("load_id"), "id")
    side = spark.range(20_000).select(F.col("id").alias("load_id"), (F.col("id") * 2).alias("v"))
    plain = rows.join(side, "load_id", "left").agg(F.count("v"), F.sum("v"), F.count("*")).first()
    counts = J.key_counts(rows, ["load_id"])
    cut = J.lookup_join(rows, side, "load_id", counts=counts, rows_per_slot=1_000)
    assert cut.agg(F.count("v"), F.sum("v"), F.count("*")).first() == plain


def test_newest_row_is_cut_before_the_shuffle(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_shipdate", "l_partkey")
    plan = plan_of(W.latest_per_key(rows, ["l_orderkey"], "l_shipdate", ["l_partkey"]))
    assert plan.index("WindowGroupLimit") < plan.index("Exchange hashpartitioning") < plan.rindex("WindowGroupLimit")
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_shipdate:timestamp_ntz>" in plan


def test_newest_weeks_do_not_gather_all_rows(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.year("l_shipdate").alias("y"), "l_partkey")
    plan = plan_of(W.newest_groups(rows, "y", 3, "r"))
    assert "TakeOrderedAndProject" in plan
    assert "BroadcastHashJoin" in plan


def test_load_out_filter_reaches_the_scan(spark, sf_dir, tmp_path, capsys):
    v = Views(spark, sf_dir)
    path = str(tmp_path / "events")
    v.events.withColumn("load_id", F.substring("shpmt_id", -9, 9)).write.parquet(path)
    load_out_rows(spark.read.parquet(path)).select("load_id", "event_datetm").explain("formatted")
    plan = capsys.readouterr().out
    assert "In(change_type_code, [PICKCI,PICKCO])" in plan
    assert "EqualTo(trnsp_stage_num,1)" in plan
    assert "ship_to_party_desc" not in plan


def test_multi_key_lookups_with_more_customers_than_a_broadcast_takes(spark, sf_dir):
    from catalog.registry import OVER_VIEWS
    from loadlens.demo.views import Views

    class Many(Views):
        @property
        def party_flags(self):
            return spark.range(2_000_001).selectExpr("cast(id AS string) AS ship_to_num", "'Y' AS party_flag")

    out = OVER_VIEWS["multi_key_lookups"](Many(spark, sf_dir))
    assert out.where("party_flag = 'Y'").count() > 0


WHOLE_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


def test_the_hub_by_load_moves_no_row(spark, stored):
    stored.layout = plans.layout_of(stored)
    spark.conf.set(WHOLE_KEYS, "false")
    try:
        plan = plan_of(registry.OVER_VIEWS["on_time_hub_by_load"](stored))
    finally:
        spark.conf.unset(WHOLE_KEYS)
        layout, stored.layout = stored.layout, None
    assert "Exchange" not in plan
    assert "SelectedBucketsCount" in plan or "Bucketed: true" in plan
    # one file a bucket at most, so that a bucket is read in the order it was sorted in
    assert len(layout.events.inputFiles()) <= layout.buckets


def test_hub_by_load_with_hot_loads_and_without_a_load(spark, sf_dir):
    """Loads kept apart, rows without a load, stage, order or ship point: the rows of the plain hub."""

    v = Views(spark, sf_dir, stored=True)
    nth = lambda n: F.pmod(F.xxhash64("line_key"), F.lit(n))
    hot = F.when(nth(3) == 0, F.lit("0000000007")).otherwise(F.col("shpmt_id"))
    missing = {"shpmt_id": 7, "trnsp_stage_num": 5, "order_num": 11, "ship_point_code": 13}
    rows = v.events.where(nth(4) == 0).withColumn("shpmt_id", hot)
    v.events = sinks.staged(rows.withColumns({c: F.when(nth(n) != 0, F.col(c)) for c, n in missing.items()}))
    layout = plans.layout_of(v, rows_per_bucket=300, buckets=3)
    assert layout.apart.where("shpmt_id IS NOT NULL").select("shpmt_id").distinct().count() == 1
    assert layout.events.where("load_id IS NULL").isEmpty()
    want = sinks.staged(plans.hub_of(v))
    got = sinks.staged(by_load.hub_by_load(layout, schema=schemas.ON_TIME_HUB, audit=False))
    assert got.count() == want.count() == v.events.count()
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    sinks.clean_staged(spark)


def test_hub_by_load_of_no_events(spark, sf_dir):
    v = Views(spark, sf_dir, stored=True)
    v.events = v.events.limit(0)
    assert by_load.hub_by_load(plans.layout_of(v), schema=schemas.ON_TIME_HUB, audit=False).isEmpty()
    sinks.clean_staged(spark)
