"""What the queries leave on disk while they run: shuffles that are not needed, and files of shuffles that are over."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  (fills the registry)
from catalog import registry
from loadlens.demo.views import WEEKLY_COLUMNS, Views
from loadlens.operators import windows as W
from loadlens.plans import schemas
from loadlens.sources import sinks


@pytest.fixture(autouse=True)
def clean(spark):
    yield
    sinks.clean_staged(spark)


def shuffles(spark) -> int:
    """Shuffles whose files are there."""
    return spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def exchanges(df) -> int:
    return len(re.findall(r"Exchange hashpartitioning", df._jdf.queryExecution().executedPlan().toString()))


def test_staged_leaves_no_shuffle_files_and_the_settings_as_they_were(spark):
    before = {k: spark.conf.get(k, None) for k in {**sinks.WHILE_STAGING, **sinks.BY_SOME_KEYS}}
    had = shuffles(spark)
    df = sinks.staged(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count(), by_some_keys=True)
    assert shuffles(spark) <= had
    assert {k: spark.conf.get(k, None) for k in before} == before
    assert df.count() == 7


def test_two_pass_match_deals_line_items_once_for_each_side(spark, sf_dir):
    v = Views(spark, sf_dir).as_stored(WEEKLY_COLUMNS)
    assert v.lines.columns == WEEKLY_COLUMNS
    keys = ["ship_week_num", "carr_num", "service_tms_code", "origin_code", "dest_ship_from_code"]
    assert exchanges(v.weekly.groupBy(*keys).agg(F.sum("shpmt_cnt"))) == 1
    assert exchanges(v.tender_counts.groupBy("forward_agent_id", "service_tms_code", "dest_ship_from_code", "region_code").count()) == 1


def test_right_join_forms_runs_within_the_partitions(spark, sf_dir):
    assert exchanges(registry.QUERIES["right_join_forms"](spark, sf_dir)) == 0


def test_newest_groups_drops_the_others_before_the_sums(spark):
    df = spark.range(40).select((F.col("id") % 8).alias("g"), F.col("id").alias("n")).groupBy("g").agg(F.sum("n").alias("n"))
    out = W.newest_groups(df, "g", 2, "place")
    assert re.search(r"Aggregate(.|\n)*Filter.*(IN|=)", plan(out))
    assert sorted(map(tuple, out.select("g", "place").collect())) == [(6, 2), (7, 1)]


def test_newest_groups_counts_a_missing_group(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 'a'), (CAST(NULL AS INT), 'b'), (CAST(NULL AS INT), 'c') t(g, n)")
    assert sorted(map(tuple, W.newest_groups(df, "g", 2, "place").select("n", "place").collect())) == [("a", 1), ("b", 2), ("c", 2)]


def test_shipments_of_other_weeks_are_dropped_before_duplicates(spark, sf_dir):
    text = plan(registry.QUERIES["carrier_shipment_detail"](spark, sf_dir))
    assert re.search(r"Filter .*concat\(.*IN \(|Filter .*INSET", text)


def test_fill_rate_load_agg_deals_rows_once(spark, sf_dir):
    assert exchanges(registry.QUERIES["fill_rate_load_agg"](spark, sf_dir)) == 0


def test_loading_on_time_does_not_store_the_hub(spark, sf_dir):
    before = len(sinks._staged)
    registry.QUERIES["loading_on_time"](spark, sf_dir)
    wide = [p for p in sinks._staged[before:] if set(schemas.ON_TIME_HUB.names) <= set(spark.read.parquet(p).columns)]
    assert wide == []


def test_hub_by_load_needs_no_shuffle_in_any_session(spark, sf_dir):
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
    assert exchanges(registry.QUERIES["on_time_hub_by_load"](spark, sf_dir)) == 0
