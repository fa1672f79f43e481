"""Carrier tables: lane detail of the newest weeks, shipment detail with its lane."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlens.functions.dates import audit_ts, calendar_year, iso_week, week_key
from loadlens.functions.keys import left_pad, strip_one_zero
from loadlens.operators.columns import conform
from loadlens.operators.joins import lookup_join
from loadlens.operators.windows import newest_groups
from loadlens.sources.sinks import staged

# Fixed values of the reports.
WEEKS = 13
WEEK_KEY = "concat_week_year"


def carrier_lane_detail(
    tenders: DataFrame,
    *,
    columns: Sequence[str],
    weeks: int = WEEKS,
    iso_year: bool = True,
    schema: T.StructType | None = None,
    audit: bool = True,
) -> DataFrame:
    """Distinct lane rows of the newest weeks, with the week's parts and place (1 = newest).

    ``columns`` are the tender columns to keep, ``week_begin_date`` among them. The weeks
    are cut before the duplicates are removed, so that only the kept weeks are shuffled. The
    week key has the ISO year, so that days around New Year rank with their week;
    ``iso_year=False`` takes the calendar year.
    """
    keyed = tenders.withColumn(WEEK_KEY, week_key("week_begin_date", iso_year=iso_year))
    recent = newest_groups(keyed, WEEK_KEY, weeks, "drank_week_year")
    lanes = (
        recent.select(*columns, WEEK_KEY, "drank_week_year")
        .distinct()
        .withColumnsRenamed({"region_code": "state_province_code"})
        .withColumns(
            {
                "calendar_week_num": iso_week("week_begin_date"),
                "calendar_year_num": calendar_year("week_begin_date"),
                "str_calendar_week_num": left_pad(iso_week("week_begin_date"), 2),
            }
        )
    )
    lanes = conform(lanes, schema) if schema else lanes
    return lanes.withColumn("last_update_utc_tmstp", audit_ts()) if audit else lanes


def carrier_shipment_detail(
    tenders: DataFrame,
    lanes: DataFrame,
    locations: DataFrame,
    *,
    columns: Sequence[str],
    lane_keys: Sequence[str],
    lane_sums: Sequence[str] = (),
    iso_year: bool = True,
    schema: T.StructType | None = None,
    audit: bool = True,
) -> DataFrame:
    """Distinct tender rows of the reported weeks with their lane's week and location.

    The lane rows are collapsed to one per week and lane (``lane_keys``): a join on the
    week alone would pair every shipment of a week with every lane of it. They are stored, and
    shipments of weeks without a lane are dropped before their duplicates are looked for.
    """
    if not lane_keys:
        raise ValueError("lane_keys must name what a shipment and its lane share besides the week")
    lane_weeks = staged(
        lanes.withColumn(WEEK_KEY, week_key("week_begin_date", iso_year=iso_year))
        .groupBy(WEEK_KEY, *lane_keys)
        .agg(
            F.max("week_begin_date").alias("week_begin_date"),
            F.count(F.lit(1)).alias("lane_row_cnt"),
            *[F.sum(c).alias(f"lane_{c}") for c in lane_sums],
        )
    )
    weeks = [r[0] for r in lane_weeks.select(WEEK_KEY).dropna().distinct().collect()]
    week = week_key("actual_goods_issue_date", iso_year=iso_year)
    rows = (
        tenders.where(week.isin(weeks))
        .withColumn("load_id", strip_one_zero("load_id"))
        .select(*columns)
        .distinct()
        .withColumn(WEEK_KEY, week)
    )
    states = locations.groupBy(F.col("postal_code").alias("final_stop_postal_code")).agg(
        F.max("state_province_code").alias("state_province_code")
    )
    joined = lookup_join(rows, lane_weeks, [WEEK_KEY, *lane_keys], "inner")
    joined = lookup_join(joined, states, "final_stop_postal_code")
    joined = conform(joined, schema) if schema else joined
    return joined.withColumn("last_update_utc_tmstp", audit_ts()) if audit else joined
