"""The plans' input tables, derived by Spark from the given tables, whole and unsampled.

One line item stands for one shipment event: its order is the load, its part the order
number, its line number the transport stage, its supplier the carrier and ship point.
Missing values, late and early times and unmatched keys follow from the line's own
discount, tax and quantity, so that both engines derive the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.functions.rules import OPEN_EVENT_TIME
from loadlens.operators.joins import row_bytes
from loadlens.sources.sinks import staged

# date column, time column, days after the event, condition under which it is missing
EVENT_TIMES = [
    ("plan_shpmt_start_date", "plan_shpmt_start_datetm", "l_linenumber - 4", "false"),
    ("plan_shpmt_end_date", "plan_shpmt_end_aot_datetm", "l_linenumber - 2", "disc = 10"),
    ("tender_date", "tender_datetm", "-3", "false"),
    ("final_lrdt_date", "final_lrdt_datetm", "tax - 4", "qty = 2"),
    ("actual_load_end_date", "actual_load_end_datetm", "disc - 5", "qty = 3"),
    ("orig_request_dlvry_from_date", "orig_request_dlvry_from_datetm", "tax - 5", "false"),
    ("orig_request_dlvry_to_date", "orig_request_dlvry_to_datetm", "tax - 3", "qty = 4"),
    ("request_dlvry_from_date", "request_dlvry_from_datetm", "disc - 6", "false"),
    ("request_dlvry_to_date", "request_dlvry_to_datetm", "disc - 4", "qty = 5"),
    ("first_dlvry_appt_date", "first_dlvry_appt_datetm", "l_linenumber - 3", "disc = 9"),
    ("last_dlvry_appt_date", "last_dlvry_appt_datetm", "l_linenumber - 1", "false"),
    ("actual_shpmt_end_date", "actual_arrival_datetm", "disc - tax", "tax = 0"),
]


def _day_text(day: str, layout: str = "dd/MM/yyyy") -> str:
    """SQL for a date as text, put together from its parts: much cheaper than date_format."""
    y = f"lpad(cast(year({day}) as string), 4, '0')"
    m = f"lpad(cast(month({day}) as string), 2, '0')"
    d = f"lpad(cast(day({day}) as string), 2, '0')"
    if layout == "dd/MM/yyyy":
        return f"{d} || '/' || {m} || '/' || {y}"
    return f"{y} || {m} || {d}"


def unmatched(key: str, matched: str) -> str:
    """SQL for a key that finds its partner only where ``matched`` holds. Every row stays; the keys of
    the others get a suffix that no partner has. Both engines read it."""
    return f"CASE WHEN {matched} THEN {key} ELSE {key} || 'U' END"


#: Bytes of a table up to which it is sent to every task.
SENT_BYTES = 64 << 20


def sent(table: DataFrame, most_bytes: int = SENT_BYTES) -> DataFrame:
    """The table, marked to be sent to every task if the bytes of its rows, summed up, are few enough."""
    return F.broadcast(table) if (table.agg(F.sum(row_bytes(table))).first()[0] or 0) <= most_bytes else table


def _dec(col: str) -> Column:
    return F.col(col).cast("decimal(18,2)")


# Tender columns that are carried along: name and SQL that both engines read, over the line items.
TENDER_TEXTS = {
    "campus_lane_name": "origin_zone || ' - ' || dest_zone",
    "customer_specific_lane_name": "origin_zone || ' - ' || c_name",
    "sold_to_party_id": "'S' || c_name",
    "ship_cond_val": "p_brand",
    "country_from_code": "substring(origin_zone, 1, 2)",
    "country_to_code": "substring(dest_zone, 1, 2)",
    "freight_auction_flag": "CASE WHEN p_size > 25 THEN 'Y' ELSE 'N' END",
    "primary_carr_flag": "CASE WHEN p_size > 10 THEN 'Y' ELSE 'N' END",
    "month_type_val": "CASE WHEN l_linenumber > 3 THEN 'P' ELSE 'C' END",
    "dest_postal_code": "'D' || dest_zone",
    "customer_desc": "c_name",
    "customer_code": "'C' || c_name",
    "customer_lvl3_desc": "c_mktsegment",
    "customer_lvl5_desc": "'Level 5 ' || c_mktsegment",
    "customer_lvl6_desc": "'Level 6 ' || c_mktsegment",
    "customer_lvl12_desc": "'Level 12 ' || c_mktsegment",
}
# Tender amounts in whole units, summed; and figures that the scorecard averages.
TENDER_SUMS = {
    "total_cnt": "1",
    "actual_carr_trans_cost_amt": "qty * 11",
    "incrmtl_freight_auction_cost_amt": "qty * 2",
    "cnc_carr_mix_cost_amt": "qty * 3",
    "unsource_cost_amt": "tax",
    "fuel_cost_amt": "qty * 4",
    "acsrl_cost_amt": "disc",
}
TENDER_MEANS = {
    "accept_pct": "CASE WHEN l_linestatus = 'F' THEN 100 ELSE 0 END",
    "reject_pct": "CASE WHEN l_linestatus = 'F' THEN 0 ELSE 100 END",
    "expct_vol_val": "qty",
    "reject_below_award_val": "tax",
    "weekly_carr_rate": "p_size",
    "avg_award_weekly_vol_qty": "CASE WHEN p_size > 10 THEN qty ELSE 0 END",
}
# The highest of each of these texts follows from the highest values of a tender's line items, the others
# (``_TENDER_OWN``) are compared themselves; the sums follow from a few sums.
_TENDER_PARTS = ["c_name", "origin_zone", "dest_zone", "p_brand", "p_size", "l_linenumber", "c_mktsegment", "qty", "tax", "disc"]
_TENDER_AMOUNT = "cast(l_extendedprice as decimal(18,2))"
_TENDER_OWN = ["campus_lane_name", "customer_specific_lane_name"]
_TENDER_TOTALS = {
    "total_cnt": "_rows",
    "actual_carr_trans_cost_amt": "_qty * 11",
    "incrmtl_freight_auction_cost_amt": "_qty * 2",
    "cnc_carr_mix_cost_amt": "_qty * 3",
    "unsource_cost_amt": "_tax",
    "fuel_cost_amt": "_qty * 4",
    "acsrl_cost_amt": "_disc",
    "accept_pct": "accept_cnt * 100",
    "reject_pct": "(_rows - accept_cnt) * 100",
    "expct_vol_val": "_qty",
    "reject_below_award_val": "_tax",
    "weekly_carr_rate": "_p_size",
    "avg_award_weekly_vol_qty": "_award",
}
# Quantities of the fill-rate rows that the scorecard sums.
FILL_SUMS = {
    "plan_gross_weight_qty": "l_quantity",
    "plan_net_weight_qty": "l_quantity - 1",
    "shipped_gross_weight_qty": "l_quantity - tax",
    "shipped_net_weight_qty": "l_quantity - disc",
    "plan_gross_vol_qty": "l_quantity * 2",
    "plan_net_vol_qty": "l_quantity * 3",
    "shipped_gross_vol_qty": "l_quantity * 4",
    "shipped_net_vol_qty": "l_quantity * 5",
    "su_per_load_cnt": "l_quantity * 6",
}
# Material amounts of the fill-rate load aggregate.
MATERIAL_AMOUNTS = {
    "drf_last_truck_amt": "cast(tax * 3 as double)",
    "glb_segment_impact_cat_ld_amt": "cast(disc * 5 as double)",
    "hopade_amt": "cast(tax + disc as double)",
    "max_orders_non_drp_amt": "cast(p_size + tax as double)",
    "max_orders_incrmtl_amt": "cast(p_size + disc as double)",
}


#: The line item columns that ``weekly`` and ``tender_counts`` are made of.
WEEKLY_COLUMNS = """l_shipdate l_suppkey l_linenumber l_linestatus p_type p_size s_acctbal s_nationkey s_name c_nationkey c_name
c_mktsegment o_custkey tax""".split()


def customer_levels(text: str) -> dict[str, str]:
    """SQL for the twelve levels of a customer's hierarchy, for an engine whose text type is ``text``.
    The seventh line of an order tells another hierarchy than the others."""
    levels = {}
    for i in range(1, 13):
        levels[f"customer_lvl{i}_code"] = f"'L{i}-' || cast(c_nationkey as {text})"
        levels[f"customer_lvl{i}_desc"] = f"'Level {i} ' || c_mktsegment"
    levels["customer_lvl3_desc"] = "CASE WHEN l_linenumber = 7 THEN 'Z ' || c_mktsegment ELSE c_mktsegment END"
    key = f"cast(o_custkey as {text})"
    levels["customer_lvl12_code"] = f"CASE WHEN l_linenumber = 7 THEN '0' || {key} ELSE {key} END"
    levels["customer_lvl12_desc"] = (
        "CASE WHEN c_acctbal < 0 THEN NULL ELSE CASE WHEN c_acctbal > 9000 THEN 'CVS' ELSE c_name END || '(' || c_mktsegment || ')' END"
    )
    return levels


#: Key of a line item; the numbers alone are not unique in the test data.
LINE_KEY = (
    "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, "
    "cast(l_quantity as decimal(18,2)), cast(l_extendedprice as decimal(18,2)))"
)


class Views:
    """Lazy frames over one data folder.

    With ``stored``, the joined line items are written once and read by all views, as the
    source tables of the plans would be; else each view joins them itself.
    """

    def __init__(
        self,
        spark: SparkSession,
        sf_dir: str,
        *,
        stored: bool = False,
        hub: DataFrame | None = None,
        columns: Sequence[str] | None = None,
    ):
        self.spark = spark
        self.sf_dir = sf_dir
        self.stored = stored
        self.columns = columns  # of the line items that are stored; None: all that a view reads
        self.hub = hub  # a stored on-time hub, for the plans that read one
        self.layout = None  # the events stored by load, for the hub that reads them so
        self._tables: dict[str, DataFrame] = {}

    def as_stored(self, columns: Sequence[str] | None = None) -> Views:
        """These views if they are stored, else stored ones over the same folder, with the line item
        ``columns`` that the caller's views read."""
        return self if self.stored else Views(self.spark, self.sf_dir, stored=True, hub=self.hub, columns=columns)

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            self._tables[name] = df
        return self._tables[name]

    # --- events ------------------------------------------------------------------------
    @cached_property
    def lines(self) -> DataFrame:
        """Line items with order, customer, supplier and part.

        Orders get their customer first, and line items what is small enough to be sent to every task, so
        that the line items, the largest table, move as rarely as they can and while they are narrow.
        """
        nation = self.table("nation")
        dest = nation.select(
            F.col("n_nationkey").alias("c_nationkey"),
            F.col("n_name").alias("dest_zone"),
            F.col("n_regionkey").alias("dest_region"),
        )
        orig = nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("origin_zone"))
        customer = self.table("customer").join(dest, "c_nationkey")
        supplier = self.table("supplier").join(orig, "s_nationkey")
        orders = self.table("orders")
        part = self.table("part")
        line = self.table("lineitem")
        placed = orders.join(sent(customer), orders.o_custkey == customer.c_custkey)
        joined = (
            line.join(sent(supplier), line.l_suppkey == supplier.s_suppkey)
            .join(sent(part), line.l_partkey == part.p_partkey)
            .join(placed, line.l_orderkey == orders.o_orderkey)
            .withColumns(
                {
                    "qty": F.col("l_quantity").cast("int"),
                    "disc": F.round(F.col("l_discount") * 100).cast("int"),
                    "tax": F.round(F.col("l_tax") * 100).cast("int"),
                }
            )
            .withColumn("event_ts", F.expr("timestampadd(HOUR, qty, l_shipdate)"))
            .withColumns(
                {
                    "event_day": F.expr("cast(event_ts as date)"),
                    "event_hour": F.expr("lpad(cast(hour(event_ts) as string), 2, '0')"),
                }
            )
            .withColumn("event_stamp", F.expr(f"{_day_text('event_day', 'yyyyMMdd')} || event_hour || '0000'"))
        )
        if not self.stored:
            return joined
        return staged(joined.select(*self.columns) if self.columns else joined.drop("p_name", "p_retailprice", "o_totalprice"))

    @cached_property
    def events(self) -> DataFrame:
        """One row per shipment-stage-event, with dates and times as text."""
        return self.some_events()

    def some_events(self, *names: str) -> DataFrame:
        """Columns of the events, all without ``names``."""
        cols: dict[str, str] = {
            "line_key": LINE_KEY,
            "shpmt_id": "lpad(cast(l_orderkey + 100000000 as string), 10, '0')",
            "order_num": "'PO' || cast(l_partkey as string)",
            "cust_po_num": "'C' || cast(l_partkey as string)",
            "trnsp_stage_num": "cast(l_linenumber as string)",
            "event_datetm": f"CASE WHEN disc = 0 THEN '{OPEN_EVENT_TIME}' ELSE event_stamp END",
            "carr_num": "lpad(cast(l_suppkey as string), 10, '0')",
            "carr_desc": "' ' || s_name || ' '",
            "service_tms_code": "p_type",
            "ship_point_code": "'P' || cast(l_suppkey as string)",
            "ship_to_party_id": "cast(o_custkey as string)",
            "ship_to_party_code": "cast(o_custkey as string)",
            "ship_to_party_desc": "c_name",
            "sold_to_party_desc": "CASE WHEN c_acctbal >= 0 THEN c_name END",
            "origin_zone_code": "CASE WHEN s_acctbal < 0 THEN '' ELSE origin_zone END",
            "dest_zone_code": "CASE WHEN c_acctbal >= 0 THEN dest_zone END",
            "dest_loc_code": "lpad(cast(o_custkey as string), 8, '0')",
            "dest_city_name": "c_mktsegment",
            "dest_state_code": "'S' || cast(c_nationkey as string)",
            "dest_postal_code": "lpad(cast(c_nationkey as string), 5, '0')",
            "country_to_code": "CASE dest_region WHEN 0 THEN 'US' WHEN 1 THEN 'CA' WHEN 2 THEN 'MX' ELSE 'XX' END",
            "freight_type_code": "CASE c_mktsegment WHEN 'MACHINERY' THEN 'I' WHEN 'FURNITURE' THEN 'E' ELSE 'C' END",
            "frt_auction_code": "CASE WHEN p_size > 25 THEN 'YES' ELSE 'NO' END",
            "distance_qty": "p_size * 30",
            "child_shpmt_num": "CASE WHEN qty = 50 THEN lpad(cast(l_orderkey + 100000001 as string), 10, '0') END",
            "change_type_code": "CASE l_returnflag WHEN 'R' THEN 'PICKCI' WHEN 'A' THEN 'PICKCO' ELSE 'OTHER' END",
            "lot_delay_reason_code": "CASE WHEN tax > 0 THEN 'R' || cast(tax as string) END",
            "lot_delay_reason_code_desc": "CASE WHEN tax > 0 THEN 'Delay ' || cast(tax as string) END",
            "lot_exception_categ_val": "CASE WHEN tax > 6 THEN 'E' || cast(tax as string) END",
            "profl_method_code": (
                "CASE o_orderpriority WHEN '1-URGENT' THEN 'APF' WHEN '2-HIGH' THEN 'APL' "
                "WHEN '3-MEDIUM' THEN 'RDD' WHEN '4-NOT SPECIFIED' THEN 'ORDD' END"
            ),
            "csot_failure_reason_bucket_name": (
                "CASE WHEN tax <= 3 THEN 'On Time' WHEN tax <= 6 THEN 'Carrier' WHEN tax = 7 THEN 'Customer' END"
            ),
            "on_time_src_code": "l_returnflag",
            "on_time_src_desc": "'Source ' || l_returnflag",
            "sd_doc_item_overall_process_status_val": "CASE WHEN l_linestatus = 'F' THEN '7' ELSE '5' END",
            "drop_live_ind_desc": "CASE o_orderstatus WHEN 'F' THEN 'Drop' WHEN 'O' THEN 'Live' ELSE 'Yard' END",
            "otd_cnt": "CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END",
            "tat_late_counter_val": "CASE WHEN l_linestatus = 'F' THEN 0 ELSE 1 END",
            "load_builder_prty_val": "cast(qty - 25 as string)",
            "gbu_code": "p_brand",
            "order_create_date": _day_text("o_orderdate"),
            "order_create_datetm": "lpad(cast(hour(o_orderdate) as string), 2, '0') || ':00:00'",
            "origin_zone_ship_from_code": "CASE WHEN qty > 45 THEN 'OWN' END",
            "dest_ship_from_code": "CASE WHEN qty < 5 THEN 'OWN' END",
            "load_method_num": "cast(p_size % 3 as string)",
            "ship_cond_desc": "'Cond ' || o_orderstatus",
            "schedule_datetm": "event_hour || ':00:00'",
            "measrbl_flag": "CASE WHEN tax > 0 THEN 'Y' ELSE 'N' END",
            "actual_ship_month_num": "lpad(cast(month(event_day) as string), 2, '0')",
            "cause_code": "CASE WHEN tax > 4 THEN 'K' || cast(tax as string) END",
            "sales_org_code": "'SO' || cast(dest_region as string)",
            "lot_cust_failure_cnt": "CASE WHEN tax = 1 THEN 1 ELSE 0 END",
            "site_failure_cnt": "CASE WHEN tax = 2 THEN 1 ELSE 0 END",
            "carr_failure_cnt": "CASE WHEN tax = 3 THEN 1 ELSE 0 END",
            "others_failure_cnt": "CASE WHEN tax > 3 THEN 1 ELSE 0 END",
            "tolrnc_sot_val": "disc",
            "first_tendered_rdd_from_datetm": "event_stamp",
            "first_tendered_rdd_to_datetm": "CASE WHEN qty > 2 THEN event_stamp END",
            "schedule_date": f"CASE WHEN qty = 1 THEN 'NULL' ELSE {_day_text('event_day')} END",
            "actual_ship_date": _day_text("event_day"),
            "ship_week_num": (
                "lpad(cast(weekofyear(event_ts) as string), 2, '0') || '/' || cast(year(event_ts) as string)"
            ),
        }
        for date, time, days, missing in EVENT_TIMES:
            cols[date] = f"CASE WHEN NOT ({missing}) THEN {_day_text(f'date_add(event_day, {days})')} END"
            cols[time] = f"CASE WHEN NOT ({missing}) THEN event_hour || ':00:00' END"
        cols["actual_shpmt_end_aot_datetm"] = cols["actual_arrival_datetm"]
        return self.lines.selectExpr(*[f"{e} AS {n}" for n, e in cols.items() if not names or n in names])

    # --- dimensions and lookups of the on-time hub -------------------------------------------
    @cached_property
    def customer_dim(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").cast("string").alias("cust_id"),
            F.expr("'T' || cast(c_nationkey as string)").alias("trade_chanl_curr_id"),
            F.expr("CASE WHEN c_acctbal >= 0 THEN 'Y' ELSE 'N' END").alias("curr_ind"),
        )

    @cached_property
    def channel_dim(self) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            F.col("r_name").alias("trade_chanl_2_long_name"),
            F.expr("'T' || cast(n_nationkey as string)").alias("trade_chanl_7_id"),
            F.expr("CASE WHEN n_regionkey = 3 THEN '600' ELSE '658' END").alias("trade_chanl_hier_id"),
            F.lit("Y").alias("curr_ind"),
        )

    @cached_property
    def locations(self) -> DataFrame:
        return self.table("supplier").select(
            F.expr("'P' || cast(s_suppkey as string)").alias("loc_id"),
            F.col("s_name").alias("loc_name"),
            F.expr("'S' || cast(s_nationkey as string)").alias("state_province_code"),
            F.expr("lpad(cast(s_nationkey as string), 5, '0')").alias("postal_code"),
            F.expr("'Z' || cast(s_nationkey as string)").alias("origin_zone_ship_from_code"),
        )

    @cached_property
    def accounts(self) -> DataFrame:
        return (
            self.table("customer")
            .select(F.col("c_mktsegment").alias("customer_lvl3_desc"))
            .distinct()
            .withColumn("account_flag", F.expr("CASE WHEN length(customer_lvl3_desc) > 9 THEN 'Y' ELSE 'N' END"))
        )

    @cached_property
    def reasons(self) -> DataFrame:
        """Reason codes keyed by load id, by order number, or by both."""
        e = self.lines.select(
            F.expr("substring(lpad(cast(l_orderkey + 100000000 as string), 10, '0'), -9, 9)").alias("load_id"),
            F.expr("'PO' || cast(l_partkey as string)").alias("order_num"),
            "o_orderpriority",
            "l_returnflag",
            "p_size",
            "p_brand",
            "tax",
        )
        by_load = e.groupBy(F.expr(unmatched("load_id", "o_orderpriority = '1-URGENT'")).alias("poload_id")).agg(
            F.max(F.lit(None).cast("string")).alias("csot_update_reason_code"),
            F.max("o_orderpriority").alias("reason_code"),
            F.max(F.lit("by load")).alias("aot_reason_code"),
        )
        by_both = (
            e.groupBy(F.expr(unmatched("(order_num || load_id)", "l_returnflag = 'R'")).alias("poload_id"))
            .agg(
                F.max(F.expr("CASE WHEN tax > 4 THEN 'Weather' END")).alias("csot_update_reason_code"),
                F.max(F.expr("'B' || cast(tax as string)")).alias("reason_code"),
                F.max(F.lit("by both")).alias("aot_reason_code"),
            )
        )
        by_order = e.groupBy(F.expr(unmatched("order_num", "p_size >= 40")).alias("poload_id")).agg(
            F.max(F.expr("CASE WHEN p_size > 45 THEN 'On Time' END")).alias("csot_update_reason_code"),
            F.max("p_brand").alias("reason_code"),
            F.max(F.lit(None).cast("string")).alias("aot_reason_code"),
        )
        return by_load.unionByName(by_both).unionByName(by_order)

    @cached_property
    def reason_changes(self) -> DataFrame:
        """A second row for the reasons by load, with other codes."""
        load = unmatched("substring(lpad(cast(l_orderkey + 100000000 as string), 10, '0'), -9, 9)", "o_orderpriority = '1-URGENT'")
        return self.lines.groupBy(F.expr(load).alias("poload_id")).agg(
            F.lit("Later").alias("csot_update_reason_code"),
            F.min(F.expr("'0 ' || l_returnflag")).alias("reason_code"),
            F.lit(None).cast("string").alias("aot_reason_code"),
        )

    @cached_property
    def ship_times(self) -> DataFrame:
        return self.table("orders").select(
            F.expr("lpad(cast(o_orderkey + 100000000 as string), 10, '0')").alias("shpmt_id"),
            F.expr("CASE WHEN o_orderstatus = 'P' THEN 'open' ELSE '0' || substring(o_orderpriority, 1, 1) || ':30:00' END").alias(
                "actual_ship_datetm"
            ),
        )

    @cached_property
    def unload_methods(self) -> DataFrame:
        return self.table("orders").select(
            F.expr("substring(lpad(cast(o_orderkey + 100000000 as string), 10, '0'), -9, 9)").alias("load_id"),
            F.expr("substring(o_orderpriority, 3)").alias("unload_method_val"),
        )

    @cached_property
    def freight(self) -> DataFrame:
        return self.table("orders").select(
            F.expr("lpad(cast(o_orderkey + 100000000 as string), 10, '0')").alias("shpmt_id"),
            F.expr("CASE WHEN o_totalprice > 250000 THEN 'YES' ELSE 'NO' END").alias("freight_auction_val"),
            F.expr("CASE WHEN o_totalprice > 300000 THEN 'AUCTION' END").alias("auction_frt_type_desc"),
            F.expr("cast(o_totalprice as decimal(18,2))").alias("distance_per_load_qty"),
        )

    @cached_property
    def tenders(self) -> DataFrame:
        """Tender rows, one per line item; those of suppliers without a positive balance have a load id
        that no event has. The seventh line of an order has a second hierarchy of its party."""
        return self.lines.select(
            F.expr(unmatched("lpad(cast(l_orderkey + 100000000 as string), 10, '0')", "s_acctbal > 0")).alias("load_id"),
            F.col("l_suppkey").cast("int").alias("forward_agent_id"),
            F.col("p_type").alias("service_tms_code"),
            F.expr("CASE WHEN p_size > 10 THEN l_quantity ELSE 0D END").alias("avg_award_weekly_vol_qty"),
            _dec("l_extendedprice").alias("linehaul_cost_amt"),
            F.expr("cast(l_extendedprice as decimal(18,2)) * cast(l_tax as decimal(18,2))").alias("fuel_cost_amt"),
            F.expr("'Z' || cast(c_nationkey as string)").alias("dest_ship_from_code"),
            F.col("dest_zone").alias("dest_zone_code"),
            F.expr("event_stamp").alias("tender_event_datetm"),
            F.expr("cast(o_custkey as string)").alias("ship_to_party_id"),
            F.expr("CASE WHEN c_acctbal > 9000 THEN 'CVS' ELSE c_name END || '(' || c_mktsegment || ')'").alias(
                "customer_desc"
            ),
            *[F.expr(sql).alias(name) for name, sql in customer_levels("string").items()],
            F.expr("cast(l_shipdate as date)").alias("actual_goods_issue_date"),
            F.expr("lpad(cast(s_nationkey as string), 5, '0')").alias("final_stop_postal_code"),
            F.expr("'Z' || cast(s_nationkey as string)").alias("origin_zone_ship_from_code"),
            F.expr(
                "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, "
                "cast(l_quantity as decimal(18,2)), cast(l_extendedprice as decimal(18,2)))"
            ).alias("tender_key"),
        )

    @cached_property
    def acceptances(self) -> DataFrame:
        return self.table("orders").select(
            F.expr("lpad(cast(o_orderkey + 100000000 as string), 10, '0')").alias("load_id"),
            F.expr("cast(o_custkey as string)").alias("ship_to_party_id"),
        )

    # --- lookups of the customer plan ---------------------------------------------------------
    @cached_property
    def origin_gbu(self) -> DataFrame:
        return self.lines.select(
            F.expr(unmatched("'P' || cast(l_suppkey as string)", "l_quantity > 25")).alias("origin_id"),
            F.col("origin_zone").alias("parent_loc_code"),
            F.col("p_brand").alias("gbu_code"),
        )

    @cached_property
    def channels(self) -> DataFrame:
        return self.table("customer").select(
            F.expr(unmatched("c_name", "c_acctbal > 1000")).alias("dest_sold_to_name"),
            F.col("c_mktsegment").alias("channel_name"),
            F.expr("CASE WHEN c_acctbal > 9000 THEN 'CVS' ELSE 'Key ' || c_mktsegment END").alias("customer_name"),
        )

    @cached_property
    def party_flags(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").cast("string").alias("ship_to_num"),
            F.expr("CASE WHEN c_acctbal > 5000 THEN 'Y' ELSE 'N' END").alias("party_flag"),
        )

    @cached_property
    def source_reasons(self) -> DataFrame:
        return (
            self.table("lineitem")
            .select(F.expr(unmatched("'Source ' || l_returnflag", "l_returnflag <> 'N'")).alias("definition_name"), "l_returnflag")
            .distinct()
            .select("definition_name", F.expr("'Cause ' || l_returnflag").alias("cause_desc"))
        )

    # --- weekly tables -----------------------------------------------------------------------
    def lane_keys(self) -> list[Column]:
        """Carrier, service and destination as the keys of the weekly tables have them. The rows are dealt by
        these, so that sums by them and more columns run where the rows are."""
        carrier, dest = F.expr("cast(l_suppkey as string)"), F.expr("'Z' || cast(c_nationkey as string)")
        return [carrier.alias("carrier"), F.col("p_type"), dest.alias("dest")]

    @cached_property
    def tender_summary(self) -> DataFrame:
        """Tenders per week, carrier, service, origin and destination; suppliers without a positive balance
        ship from points and zones that no weekly row knows."""
        return self._tenders(_TENDER_PARTS, _TENDER_OWN)

    @cached_property
    def tender_counts(self) -> DataFrame:
        """The rows of ``tender_summary`` without its texts and amounts."""
        return self._tenders((), ())

    def _tenders(self, parts: Sequence[str], own: Sequence[str]) -> DataFrame:
        rows = self.lines.select(
            *self.lane_keys(),
            F.expr("cast(date_trunc('week', l_shipdate) as date)").alias("week_begin_date"),
            F.expr("coalesce(s_acctbal > 0, false)").alias("known"),
            "s_nationkey",
            "l_linestatus",
            *parts,
            *[F.expr(TENDER_TEXTS[c]).alias(f"_{c}") for c in own],
            *([F.expr(_TENDER_AMOUNT).alias("_amount"), F.expr(TENDER_MEANS["avg_award_weekly_vol_qty"]).alias("_award")] if parts else []),
        )
        # Grouped by the narrow values that the other keys follow from one to one, and each value summed up
        # once, however many columns are made of it.
        dealt = rows.repartition("carrier", "p_type", "dest")
        grouped = dealt.groupBy("week_begin_date", "carrier", "p_type", "known", "s_nationkey", "dest").agg(
            F.expr("count(CASE WHEN l_linestatus = 'F' THEN 1 END)").alias("accept_cnt"),
            F.expr("count(CASE WHEN l_linestatus = 'O' THEN 1 END)").alias("reject_cnt"),
            F.count(F.lit(1)).alias("_rows"),
            *[F.max(c).alias(c) for c in parts if c not in ("qty", "tax", "disc")],
            *[F.max(f"_{c}").alias(f"_{c}") for c in own],
            *[F.sum(c).alias(f"_{c}") for c in parts if c in ("qty", "tax", "disc", "p_size")],
            *([F.sum(c).alias(c) for c in ("_amount", "_award")] if parts else []),
        )
        texts = {c: f"_{c}" if c in _TENDER_OWN else sql for c, sql in TENDER_TEXTS.items()}
        return grouped.selectExpr(
            "week_begin_date",
            "carrier AS forward_agent_id",
            "p_type AS service_tms_code",
            f"{unmatched("'P' || carrier", 'known')} AS origin_code",
            f"{unmatched("'Z' || cast(s_nationkey as string)", 'known')} AS origin_zone_ship_from_code",
            "dest AS dest_ship_from_code",
            "'S' || cast(s_nationkey as string) AS region_code",
            "accept_cnt",
            "reject_cnt",
            *(["cast(_amount as decimal(28,2)) AS linehaul_cost_amt"] if parts else []),
            *[f"{sql} AS {c}" for c, sql in {**texts, **_TENDER_TOTALS}.items() if parts],
        )

    @cached_property
    def weekly(self) -> DataFrame:
        """Weekly on-time rows per carrier, service, lane and party. Stage 7 ships from another
        point of the zone, whose origin code the tenders do not know."""
        rows = self.lines.select(
            *self.lane_keys(),
            F.expr("cast(l_shipdate as date)").alias("day"),
            F.expr("CASE WHEN l_linenumber = 7 THEN 'X' WHEN p_size = 50 THEN 'NULL' ELSE 'P' END").alias("point"),
            "s_nationkey",
            "o_custkey",
            "c_name",
            "s_name",
            "c_mktsegment",
            "l_linestatus",
            "tax",
        )
        # Grouped by the narrow values that the other keys follow from one to one.
        keys = [c for c in rows.columns if c not in ("l_linestatus", "tax")]
        point = "CASE WHEN point = 'NULL' THEN point ELSE point || carrier END"
        return rows.repartition("carrier", "p_type", "dest").groupBy(*keys).agg(
            F.count(F.lit(1)).alias("shpmt_cnt"),
            F.expr("count(CASE WHEN l_linestatus = 'F' THEN 1 END)").alias("shpmt_on_time_cnt"),
            F.expr("count(CASE WHEN tax > 0 THEN 1 END)").alias("measrbl_shpmt_cnt"),
            F.max("tax").alias("cdot_ontime_cnt"),
        ).selectExpr(
            "lpad(cast(weekofyear(day) as string), 2, '0') || '/' || cast(year(day) as string) AS ship_week_num",
            "carrier AS carr_num",
            "p_type AS service_tms_code",
            f"{point} AS origin_code",
            "'Z' || cast(s_nationkey as string) AS parent_loc_code",
            "'Z' || cast(s_nationkey as string) AS origin_zone_ship_from_code",
            "dest AS dest_ship_from_code",
            "cast(o_custkey as string) AS ship_to_party_code",
            "c_name AS ship_to_party_desc",
            "c_name AS dest_sold_to_name",
            "s_name AS carr_desc",
            "cast(day as string) AS actual_ship_date",
            "c_mktsegment AS freight_type_val",
            "split_part(s_name, '#', 1) AS parent_carr_name",
            "shpmt_cnt",
            "shpmt_on_time_cnt",
            "measrbl_shpmt_cnt",
            "cdot_ontime_cnt",
        )

    @cached_property
    def load_out(self) -> DataFrame:
        """Load-out rows as the scorecard reads them."""
        return self.lines.select(
            F.expr("cast(l_suppkey as string)").alias("carr_num"),
            F.expr("'Z' || cast(c_nationkey as string)").alias("dest_ship_from_code"),
            F.expr(unmatched("'P' || cast(l_suppkey as string)", "l_returnflag <> 'N'")).alias("ship_point_code"),
            F.col("p_type").alias("actual_service_tms_code"),
            F.expr(
                "lpad(cast(weekofyear(l_shipdate) as string), 2, '0') || '/' || cast(year(l_shipdate) as string)"
            ).alias("ship_week_num"),
            F.expr("CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END").alias("lot_otd_cnt"),
            F.expr("CASE WHEN l_linestatus = 'F' THEN 0 ELSE 1 END").alias("lot_tat_late_counter_val"),
            F.expr("CASE WHEN tax = 1 THEN 1 ELSE 0 END").alias("lot_cust_failure_cnt"),
            F.expr("CASE WHEN tax = 2 THEN 1 ELSE 0 END").alias("site_failure_cnt"),
            F.expr("CASE WHEN tax = 3 THEN 1 ELSE 0 END").alias("carr_failure_cnt"),
            F.expr("CASE WHEN tax > 3 THEN 1 ELSE 0 END").alias("others_failure_cnt"),
            F.col("disc").alias("tolrnc_sot_val"),
        )

    @cached_property
    def fill_loads(self) -> DataFrame:
        """Fill-rate rows per load as the scorecard reads them."""
        return self.lines.select(
            F.expr("lpad(cast(l_suppkey as string), 10, '0')").alias("carr_id"),
            F.expr(_day_text("l_shipdate")).alias("shpmt_start_date"),
            F.col("p_type").alias("tms_service_code"),
            F.expr(unmatched("'P' || cast(l_suppkey as string)", "l_returnflag <> 'A'")).alias("ship_point_code"),
            F.expr("'Z' || cast(c_nationkey as string)").alias("dest_ship_from_code"),
            *[F.expr(sql).alias(c) for c, sql in FILL_SUMS.items()],
            F.expr("cast(p_size as double)").alias("floor_position_qty"),
            F.expr("cast(disc as double)").alias("net_vol_fill_rate"),
        )

    # --- fill rate ------------------------------------------------------------------------------
    @cached_property
    def truck_reports(self) -> DataFrame:
        return self.lines.select(
            F.expr("'PO' || cast(l_partkey as string)").alias("follow_on_doc_num"),
            F.expr("cast(l_orderkey as string)").alias("tour_id"),
            F.expr(_day_text("l_shipdate", "yyyyMMdd")).alias("release_date"),
            F.expr("event_hour || '0000'").alias("release_datetm"),
            F.expr("cast(qty as string)").alias("pallet_num_qty"),
            F.expr("CASE WHEN disc = 0 THEN 'n/a' ELSE cast(disc as string) END").alias("pallet_spot_qty"),
            F.expr("cast(cast(l_quantity as decimal(18,2)) as string)").alias("total_gross_weight_qty"),
            F.expr("cast(p_size * qty as string)").alias("total_gross_vol_qty"),
            F.col("p_type").alias("truck_type_code"),
            F.expr("cast(o_custkey as string)").alias("truck_ship_to_num"),
        )

    @cached_property
    def vehicles(self) -> DataFrame:
        return (
            self.table("part")
            .groupBy(F.expr(unmatched("p_type", "p_type <> 'PROMO'")).alias("vehicle_trans_medium_code"))
            .agg(
                F.max("p_type").alias("vehicle_type_code"),
                F.max(F.expr("cast(p_size * 20 as double)")).alias("total_weight_qty"),
                F.max(F.expr("cast(p_size as double)")).alias("length_qty"),
                F.min(F.expr("cast(p_size + 1 as double)")).alias("width_qty"),
                F.max(F.expr("cast(length(p_type) as double)")).alias("height_qty"),
            )
        )

    @cached_property
    def order_links(self) -> DataFrame:
        return self.lines.select(
            F.expr("'PO' || cast(l_partkey as string)").alias("order_num"),
            F.expr("lpad(cast(l_orderkey + 100000000 as string), 10, '0')").alias("transport_num"),
            F.expr("event_stamp").alias("load_tmstp"),
            F.col("l_linenumber").alias("link_line_num"),
        )

    @cached_property
    def deliveries(self) -> DataFrame:
        return self.lines.select(
            F.expr("lpad(cast(l_orderkey + 100000000 as string), 10, '0')").alias("shpmt_id"),
            F.expr("cast(l_linenumber as string)").alias("dlvry_item_num"),
            F.expr("lpad(cast(l_partkey as string), 10, '0')").alias("material_doc_num"),
            F.expr("cast(l_shipdate as date)").alias("actual_goods_issue_date"),
            F.col("p_brand").alias("gbu_code"),
            F.expr("l_quantity * p_size").alias("gross_vol_qty"),
            F.expr("l_quantity * (p_size - 1)").alias("net_vol_qty"),
            F.expr("l_quantity * 2").alias("gross_weight_qty"),
            F.col("l_quantity").alias("net_weight_qty"),
        )

    @cached_property
    def fill_rows(self) -> DataFrame:
        """Material rows of loads with plan and shipped quantities, vehicle limits and unit."""
        return self.lines.select(
            F.expr("substring(lpad(cast(l_orderkey + 100000000 as string), 10, '0'), -9, 9)").alias("load_id"),
            F.col("p_brand").alias("gbu_code"),
            F.expr("CASE WHEN p_size < 48 THEN upper(p_brand) END").alias("gbu_desc"),
            F.expr("substring(lpad(cast(l_orderkey + 100000000 as string), 10, '0'), -9, 9) || p_brand").alias("load_gbu_id"),
            F.expr("cast(l_partkey as string)").alias("material_doc_num"),
            F.expr("cast(l_linenumber as string)").alias("dlvry_item_num"),
            F.expr("CASE WHEN l_linenumber <= 5 THEN 'Y' ELSE 'N' END").alias("min_trans_stage_flag"),
            F.expr("cast(year(l_shipdate) as string)").alias("fiscal_year_num"),
            F.expr("CASE WHEN disc = 0 THEN 'none' ELSE cast(month(l_shipdate) as string) END").alias(
                "fiscal_year_perd_num"
            ),
            F.expr("'P' || cast(l_suppkey as string)").alias("ship_point_code"),
            F.expr("l_quantity * 2").alias("gross_weight_qty"),
            F.expr("l_quantity * p_size").alias("gross_vol_qty"),
            F.col("l_quantity").alias("net_weight_qty"),
            F.expr("l_quantity * (p_size - 1)").alias("net_vol_qty"),
            F.expr("l_quantity * 3").alias("load_material_weight_qty"),
            F.expr("l_quantity * 4").alias("load_material_vol_qty"),
            F.expr("CASE WHEN tax > 1 THEN l_quantity * 5 END").alias("plan_net_weight_qty"),
            F.expr("CASE WHEN tax > 2 THEN l_quantity * 6 END").alias("plan_net_vol_qty"),
            F.expr("l_quantity * 7").alias("plan_gross_weight_qty"),
            F.expr("l_quantity * 8").alias("plan_gross_vol_qty"),
            F.expr("l_quantity * 9").alias("shipped_gross_weight_qty"),
            F.expr("l_quantity * 10").alias("shipped_gross_vol_qty"),
            F.expr("cast(p_size * 5 as double)").alias("max_weight_qty"),
            F.expr("cast(p_size * 6 as double)").alias("max_vol_qty"),
            F.expr("CASE WHEN tax > 3 THEN l_quantity END").alias("total_gross_weight_qty"),
            F.expr("CASE WHEN tax > 4 THEN l_quantity + 1 END").alias("total_gross_vol_qty"),
            F.expr("cast(tax as double)").alias("pallet_spot_qty"),
            F.expr("cast(disc as double)").alias("cut_impact_rate"),
            F.expr("cast(p_size as double)").alias("floor_position_qty"),
            F.expr("cast(qty as double)").alias("pallet_qty"),
            F.expr("cast(l_linenumber as double)").alias("theortc_pallet_qty"),
            F.expr("cast(disc * 2 as double)").alias("vehicle_fill_opportunity_qty"),
            F.expr("'T' || cast(disc % 3 as string)").alias("tdcval_code"),
            *[F.expr(sql).alias(c) for c, sql in MATERIAL_AMOUNTS.items()],
        )

    @cached_property
    def unit_costs(self) -> DataFrame:
        return self.lines.select(
            F.expr(unmatched("lpad(cast(l_orderkey + 100000000 as string), 10, '0')", "l_returnflag <> 'N'")).alias("load_id"),
            F.expr("CASE WHEN p_size < 48 THEN p_brand END").alias("subsector_name"),
            F.col("p_brand").alias("gbu_code"),
            F.col("l_quantity").alias("su_per_load_qty"),
            _dec("l_extendedprice").alias("total_cost_amt"),
            F.expr("cast(tax as double)").alias("step_factor"),
        )

    # --- two copies of a master table -------------------------------------------------------------
    @cached_property
    def master_left(self) -> DataFrame:
        return self.table("part").select(
            F.expr("cast(p_partkey as string)").alias("item_id"),
            F.lit("EA").alias("unit"),
            F.expr("'BOX-' || p_type").alias("box_name"),
            F.expr("CASE WHEN p_size = 1 THEN 'D' WHEN p_size = 2 THEN NULL ELSE 'U' END").alias("north_chng_code"),
            F.expr("CASE WHEN p_size = 3 THEN 'D' ELSE 'U' END").alias("other_chng_code"),
            F.expr("cast(p_size as string)").alias("length_val"),
            F.expr("cast(cast(p_retailprice as decimal(18,2)) as string)").alias("width_val"),
            F.expr(
                "CASE WHEN p_size = 7 THEN NULL WHEN p_size = 11 THEN '9007199254740993' WHEN p_size = 12 THEN '1d' "
                "WHEN p_size = 13 THEN '1.50' ELSE p_brand END"
            ).alias("vol_qty"),
            F.lit("KG").alias("weight_uom"),
        )

    @cached_property
    def master_right(self) -> DataFrame:
        """The other copy: large items have other ids, some brands, numbers and sizes differ."""
        return self.table("part").select(
            F.expr(unmatched("cast(p_partkey as string)", "p_size <= 46")).alias("item_id"),
            F.lit("EA").alias("unit"),
            F.expr("'BOX-' || p_type").alias("box_name"),
            F.expr("CASE WHEN p_size = 5 THEN cast(p_size + 1 as string) ELSE cast(p_size as string) END").alias(
                "length_val"
            ),
            F.expr("' ' || cast(cast(p_retailprice as decimal(18,1)) as string)").alias("width_val"),
            F.expr(
                "CASE WHEN p_size IN (7, 8) THEN NULL WHEN p_size = 9 THEN '' WHEN p_size = 11 THEN '9007199254740992' "
                "WHEN p_size = 12 THEN '1' WHEN p_size = 13 THEN '1.5' "
                "WHEN p_brand = 'Brand#1' THEN 'Brand#2' ELSE p_brand END"
            ).alias("vol_qty"),
            F.expr("CASE WHEN p_type = 'SMALL' THEN 'LB' ELSE 'KG' END").alias("weight_uom"),
        )

    # --- text to clean -------------------------------------------------------------------------
    @cached_property
    def dirty(self) -> DataFrame:
        return self.table("customer").select(
            "c_custkey",
            F.expr(
                "CASE c_mktsegment WHEN 'MACHINERY' THEN '  ' WHEN 'FURNITURE' THEN ' null ' "
                "WHEN 'HOUSEHOLD' THEN NULL ELSE '  ' || c_name || ' ' END"
            ).alias("name_raw"),
            F.expr("CASE WHEN c_acctbal < 0 THEN 'NULL' ELSE c_mktsegment || ' ' END").alias("name_alt"),
            F.col("c_nationkey"),
        )
