"""Joins, aggregates, rankings, reshaping and reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query
from loadlens.demo.views import LINE_KEY, WEEKLY_COLUMNS, Views
from loadlens.functions import rules as R
from loadlens.functions.dates import week_key
from loadlens.functions.keys import key_of, last_chars, strip_one_zero
from loadlens.operators import aggregates as A
from loadlens.operators import joins as J
from loadlens.operators import reconcile as Q
from loadlens.operators import reshape as S
from loadlens.operators import windows as W
from loadlens.plans.customer import load_level_on_time
from loadlens.plans.on_time import base_events, key_table, load_rollup
from loadlens.sources.sinks import staged

LOADED = {"e": "SELECT *, substring(shpmt_id, -9, 9) AS load_id FROM v_events"}


def loaded(v):
    return v.events.withColumn("load_id", last_chars("shpmt_id", 9))


# --- rankings ---------------------------------------------------------------------------------
@query(
    "newest_weeks",
    """SELECT w AS week_key, count(*) AS line_cnt, max(r) AS place FROM (
  SELECT w, cast(dense_rank() OVER (ORDER BY w DESC) as integer) AS r FROM (
    SELECT cast(year(l_shipdate) as varchar) || lpad(cast(weekofyear(l_shipdate) as varchar), 2, '0') AS w FROM lineitem))
WHERE r < 14 GROUP BY 1""",
)
def _(v):
    keyed = v.table("lineitem").select(week_key("l_shipdate").alias("week_key"))
    recent = W.newest_groups(keyed, "week_key", 13, "place")
    return recent.groupBy("week_key").agg(F.count(F.lit(1)).alias("line_cnt"), F.max("place").alias("place"))


@query(
    "first_last_event",
    """SELECT load_id, trnsp_stage_num, max(CASE WHEN rn_min = 1 THEN event_datetm END) AS first_dttm,
  max(CASE WHEN rn_max = 1 THEN event_datetm END) AS last_dttm FROM (
  SELECT *, row_number() OVER (PARTITION BY load_id, trnsp_stage_num ORDER BY event_datetm ASC NULLS FIRST, line_key) AS rn_min,
    row_number() OVER (PARTITION BY load_id, trnsp_stage_num ORDER BY event_datetm DESC NULLS LAST, line_key) AS rn_max FROM e)
GROUP BY 1, 2""",
    {"e": "SELECT line_key, substring(shpmt_id, -9, 9) AS load_id, trnsp_stage_num, "
          "nullif(event_datetm, '99991231235959') AS event_datetm FROM v_events"},
)
def _(v):
    rows = loaded(v).withColumn("event_datetm", F.nullif("event_datetm", F.lit(R.OPEN_EVENT_TIME)))
    return rows.groupBy("load_id", "trnsp_stage_num").agg(
        W.first_value("event_datetm").alias("first_dttm"), W.last_value("event_datetm").alias("last_dttm")
    )


@query(
    "rank_events",
    """SELECT line_key, load_id,
  cast(row_number() OVER (PARTITION BY load_id ORDER BY event_datetm DESC NULLS LAST, line_key) as integer) AS max_event_datetm_rn
FROM e""",
    LOADED,
)
def _(v):
    rows = loaded(v).select("line_key", "load_id", "event_datetm")
    ranked = W.rank_rows(
        rows,
        ["load_id"],
        "event_datetm",
        "max_event_datetm_rn",
        descending=True,
        ties=["line_key"],
    )
    return ranked.drop("event_datetm")


@query(
    "load_rollup",
    """SELECT load_id, max(CASE WHEN rn = 1 THEN service_tms_code END) AS actual_service_tms_code,
  max(plan_end) AS plan_shpmt_end_tmstp, max(tat_late_counter_val) AS max_tat_late_counter_val,
  max(otd_cnt) AS max_otd_cnt, max(frt_auction_code) AS max_frt_auction_code,
  max(otd_cnt) / max(CASE WHEN load_id IS NOT NULL THEN 1 ELSE 0 END) * 100.0 AS load_on_time_pct,
  CASE WHEN max(frt_auction_code) = 'YES' THEN 'Y' ELSE 'N' END AS freight_auction_flag
FROM (SELECT *, plan_shpmt_end_date || ' ' || plan_shpmt_end_aot_datetm_x AS plan_end,
  row_number() OVER (PARTITION BY load_id ORDER BY event_datetm DESC NULLS LAST, line_key DESC) AS rn FROM ee)
GROUP BY 1""",
    {"ee": "SELECT *, plan_shpmt_end_aot_datetm AS plan_shpmt_end_aot_datetm_x, substring(shpmt_id, -9, 9) AS load_id FROM v_events"},
)
def _(v):
    rolled = load_rollup(key_table(base_events(v.events), "line_key"))
    return rolled.drop("iot_newest", "max_shpmt_cnt", "multi_stop_num")


@query(
    "stop_count",
    """SELECT load_id, max(d) AS multi_stop_num FROM (
  SELECT load_id, cast(dense_rank() OVER (PARTITION BY load_id ORDER BY ship_point_code NULLS FIRST) as integer) AS d FROM (
    SELECT load_id, CASE WHEN dest_zone_code IS NOT NULL THEN ship_point_code END AS ship_point_code FROM e)) GROUP BY 1""",
    LOADED,
)
def _(v):
    rows = loaded(v).withColumn("stop", F.when(F.col("dest_zone_code").isNotNull(), F.col("ship_point_code")))
    return W.stop_count(rows, ["load_id"], "stop")


@query(
    "latest_per_key",
    """SELECT load_id, line_key, event_datetm, service_tms_code FROM (
  SELECT *, row_number() OVER (PARTITION BY load_id ORDER BY event_datetm DESC NULLS LAST, line_key) AS rn FROM e) WHERE rn = 1""",
    LOADED,
)
def _(v):
    rows = loaded(v).select("load_id", "line_key", "event_datetm", "service_tms_code")
    return W.latest_per_key(rows, ["load_id"], "event_datetm", ["line_key"])


@query(
    "earliest_per_key",
    """SELECT load_id, tender_key, tender_event_datetm, dest_zone_code FROM (
  SELECT *, row_number() OVER (PARTITION BY load_id ORDER BY tender_event_datetm ASC NULLS FIRST, tender_key) AS rn
  FROM v_tenders) WHERE rn = 1""",
)
def _(v):
    rows = v.tenders.select("load_id", "tender_key", "tender_event_datetm", "dest_zone_code")
    return W.earliest_per_key(rows, ["load_id"], "tender_event_datetm", ["tender_key"])


@query(
    "latest_two_stage",
    """SELECT load_id, change_type_code, lot_delay_reason_code, line_key, event_datetm FROM (
  SELECT *, row_number() OVER (PARTITION BY load_id, change_type_code ORDER BY event_datetm DESC NULLS LAST, line_key) AS rn2
  FROM (SELECT *, row_number() OVER (PARTITION BY load_id, lot_delay_reason_code, change_type_code
    ORDER BY event_datetm DESC NULLS LAST, line_key) AS rn FROM e) WHERE rn = 1) WHERE rn2 = 1""",
    LOADED,
)
def _(v):
    rows = loaded(v).select("load_id", "change_type_code", "lot_delay_reason_code", "line_key", "event_datetm")
    return W.latest_two_stage(
        rows,
        ["load_id", "lot_delay_reason_code", "change_type_code"],
        ["load_id", "change_type_code"],
        "event_datetm",
        ["line_key"],
    )


@query(
    "conditional_rank",
    """SELECT line_key, load_id, otd_cnt, CASE WHEN otd_cnt = 1 THEN
  cast(row_number() OVER (PARTITION BY load_id, otd_cnt = 1 ORDER BY event_datetm DESC NULLS LAST, line_key) as integer) END AS rn_on_time
FROM e""",
    LOADED,
)
def _(v):
    rows = loaded(v).select("line_key", "load_id", "otd_cnt", "event_datetm")
    ranked = W.conditional_rank(
        rows,
        "otd_cnt",
        ["load_id"],
        "event_datetm",
        "rn_on_time",
        ties=["line_key"],
    )
    return ranked.drop("event_datetm")


@query(
    "argmax_back",
    """SELECT load_id, max(stage) AS max_stage, max(event_datetm) AS max_event, max(ship_point_code) AS ship_point_code FROM (
  SELECT *, row_number() OVER (PARTITION BY load_id ORDER BY stage DESC, event_datetm DESC, ship_point_code DESC) AS rn
  FROM (SELECT *, cast(trnsp_stage_num as integer) AS stage FROM e)) WHERE rn = 1 GROUP BY 1""",
    LOADED,
)
def _(v):
    rows = loaded(v).withColumn("stage", F.col("trnsp_stage_num").cast("int"))
    best = W.arg_extreme(rows, ["load_id"], ["stage", "event_datetm"], ["ship_point_code"])
    return best.withColumnsRenamed({"stage": "max_stage", "event_datetm": "max_event"})


# --- joins -----------------------------------------------------------------------------------------
@query(
    "anti_child_loads",
    """SELECT load_id, line_key FROM e LEFT JOIN (SELECT DISTINCT regexp_replace(child_shpmt_num, '^0', '') AS child FROM v_events) c
  ON load_id = child WHERE child IS NULL""",
    LOADED,
)
def _(v):
    rows = staged(loaded(v).select("load_id", "line_key", "child_shpmt_num"))
    children = rows.select(strip_one_zero("child_shpmt_num").alias("child"))
    rows = rows.select("load_id", "line_key")
    counts = J.key_counts(rows, ["load_id"])
    return J.lookup_join(rows, children, {"load_id": "child"}, "left_anti", counts=counts)


@query(
    "missing_keys",
    """SELECT item_id, unit FROM v_master_left l
WHERE NOT EXISTS (SELECT 1 FROM v_master_right r WHERE r.item_id = l.item_id AND r.unit = l.unit)""",
)
def _(v):
    return J.missing_keys(v.master_left, v.master_right, ["item_id", "unit"])


_LOOKUPS = {
    "pts": "SELECT loc_id, state_province_code, origin_zone_ship_from_code AS zone FROM v_locations",
    "gbus": "SELECT origin_id, parent_loc_code, max(gbu_code) AS gbu FROM v_origin_gbu GROUP BY 1, 2",
    "flags": "SELECT ship_to_num, party_flag FROM v_party_flags",
}


@query(
    "multi_key_lookups",
    """SELECT line_key, state_province_code, zone, gbu, party_flag FROM v_events
JOIN pts ON ship_point_code = loc_id
LEFT JOIN gbus ON ship_point_code = origin_id AND origin_zone_code = parent_loc_code
LEFT JOIN flags ON ship_to_party_code = ship_to_num""",
    _LOOKUPS,
)
def _(v):
    rows = v.events.select("line_key", "ship_point_code", "origin_zone_code", "ship_to_party_code")
    points = v.locations.select("loc_id", "state_province_code", F.col("origin_zone_ship_from_code").alias("zone"))
    gbu = v.origin_gbu.groupBy("origin_id", "parent_loc_code").agg(F.max("gbu_code").alias("gbu"))
    rows = J.inner_join(rows, points, {"ship_point_code": "loc_id"})
    rows = J.lookup_join(rows, gbu, {"ship_point_code": "origin_id", "origin_zone_code": "parent_loc_code"})
    rows = J.lookup_join(rows, v.party_flags, {"ship_to_party_code": "ship_to_num"})
    return rows.select("line_key", "state_province_code", "zone", "gbu", "party_flag")


@query(
    "spread_lookup_join",
    """SELECT line_key, dest_zone_code, trade_chanl_id, channel_name FROM v_events LEFT JOIN (
  SELECT n_name, 'T' || n_nationkey AS trade_chanl_id, r_name AS channel_name
  FROM nation JOIN region ON n_regionkey = r_regionkey) ON dest_zone_code = n_name""",
)
def _(v):
    n, r = v.table("nation"), v.table("region")
    zones = n.join(r, n.n_regionkey == r.r_regionkey).select(
        "n_name",
        F.concat(F.lit("T"), F.col("n_nationkey").cast("string")).alias("trade_chanl_id"),
        F.col("r_name").alias("channel_name"),
    )
    # A low limit, so that every zone is hot and cut into slots.
    rows = staged(v.events.select("line_key", "dest_zone_code"))
    counts = J.key_counts(rows, ["dest_zone_code"])
    return J.lookup_join(rows, zones, {"dest_zone_code": "n_name"}, counts=counts, rows_per_slot=100)


@query(
    "right_join_forms",
    """SELECT w.week_year_val, w.forward_agent_id, w.service_tms_code, w.origin_code, w.dest_ship_from_code,
  accept_cnt, reject_cnt, shpmt_cnt
FROM (SELECT * FROM v_tender_summary) t
RIGHT JOIN wk w ON t.week_year_val = w.week_year_val AND t.forward_agent_id = w.forward_agent_id
  AND t.service_tms_code = w.service_tms_code AND t.origin_code = w.origin_code AND t.dest_ship_from_code = w.dest_ship_from_code""".replace(
        "(SELECT * FROM v_tender_summary)", "tw"
    ),
    {
        "tw": "SELECT *, lpad(cast(weekofyear(week_begin_date) as varchar), 2, '0') || '/' || "
              "cast(year(week_begin_date) as varchar) AS week_year_val FROM v_tender_summary",
        "wk": "SELECT ship_week_num AS week_year_val, carr_num AS forward_agent_id, service_tms_code, origin_code, "
              "dest_ship_from_code, cast(sum(shpmt_cnt) as bigint) AS shpmt_cnt FROM v_weekly GROUP BY ALL",
    },
)
def _(v):
    v = v.as_stored(WEEKLY_COLUMNS)
    keys = ["week_year_val", "forward_agent_id", "service_tms_code", "origin_code", "dest_ship_from_code"]
    tenders = v.tender_counts.withColumn("week_year_val", week_key("week_begin_date", "ww/yyyy")).select(
        *keys, "accept_cnt", "reject_cnt"
    )
    weekly = (
        v.weekly.withColumnsRenamed({"ship_week_num": "week_year_val", "carr_num": "forward_agent_id"})
        .groupBy(*keys)
        .agg(F.sum("shpmt_cnt").alias("shpmt_cnt"))
    )
    return staged(J.right_join(tenders, weekly, keys), by_some_keys=True)


_LOAD = "substring(lpad(cast(l_orderkey + 100000000 as varchar), 10, '0'), 2, 9)"


@query(
    "fallback_lookup",
    """SELECT line_key, coalesce(a.csot_update_reason_code, b.csot_update_reason_code, c.csot_update_reason_code) AS csot_update_reason_code,
  coalesce(a.reason_code, b.reason_code, c.reason_code) AS reason_code,
  coalesce(a.aot_reason_code, b.aot_reason_code, c.aot_reason_code) AS aot_reason_code
FROM fkeys LEFT JOIN by_key a ON order_num || load_id = a.poload_id
LEFT JOIN by_key b ON order_num = b.poload_id LEFT JOIN by_key c ON load_id = c.poload_id""",
    {
        # the few columns of the three tables that the keys and the reasons are made of
        "fkeys": f"""SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(l_quantity as decimal(18,2)),
    cast(l_extendedprice as decimal(18,2))) AS line_key, 'PO' || l_partkey AS order_num, {_LOAD} AS load_id, l_returnflag,
  cast(round(l_tax * 100) as integer) AS tax, o_orderpriority, p_size, p_brand
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
        "by_key": """SELECT load_id || CASE WHEN o_orderpriority = '1-URGENT' THEN '' ELSE 'U' END AS poload_id,
  cast(NULL as varchar) AS csot_update_reason_code, max(o_orderpriority) AS reason_code, 'by load' AS aot_reason_code FROM fkeys GROUP BY 1
UNION ALL SELECT order_num || load_id || CASE WHEN l_returnflag = 'R' THEN '' ELSE 'U' END,
  max(CASE WHEN tax > 4 THEN 'Weather' END), max('B' || tax), 'by both' FROM fkeys GROUP BY 1
UNION ALL SELECT order_num || CASE WHEN p_size >= 40 THEN '' ELSE 'U' END, max(CASE WHEN p_size > 45 THEN 'On Time' END), max(p_brand), NULL
FROM fkeys GROUP BY 1""",
    },
)
def _(v):
    """Reason codes of each event by order and load, else by order, else by load. Keys and reasons are
    made of a few columns, which are stored once."""
    narrow = Views(v.spark, v.sf_dir)
    lines = v.lines if v.stored else v.table("lineitem").join(
        v.table("orders"), F.col("l_orderkey") == F.col("o_orderkey")
    ).join(v.table("part"), F.col("l_partkey") == F.col("p_partkey")).withColumn("tax", F.round(F.col("l_tax") * 100).cast("int"))
    narrow.lines = staged(
        lines.select(
            F.expr(LINE_KEY).alias("line_key"), "l_orderkey", "l_partkey", "l_returnflag", "tax", "o_orderpriority", "p_size", "p_brand"
        )
    )
    rows = narrow.lines.select(
        "line_key",
        F.expr("'PO' || cast(l_partkey as string)").alias("order_num"),
        last_chars(F.expr("lpad(cast(l_orderkey + 100000000 as string), 10, '0')"), 9).alias("load_id"),
    ).withColumn("both", key_of("order_num", "load_id"))
    cols = ["csot_update_reason_code", "reason_code", "aot_reason_code"]
    out = J.fallback_lookup(rows, narrow.reasons, "poload_id", ["both", "order_num", "load_id"], cols)
    return out.select("line_key", *cols)


FINE = ["week", "carrier", "service", "origin", "dest"]
COARSE = ["week", "carrier", "service", "zone", "dest"]
_TWO = {
    "wk2": """SELECT ship_week_num AS week, carr_num AS carrier, service_tms_code AS service, origin_code AS origin,
  dest_ship_from_code AS dest, max(parent_loc_code) AS zone, cast(sum(shpmt_cnt) as bigint) AS shpmt_cnt FROM v_weekly GROUP BY ALL""",
    "tn2": """SELECT lpad(cast(weekofyear(week_begin_date) as varchar), 2, '0') || '/' || cast(year(week_begin_date) as varchar) AS week,
  forward_agent_id AS carrier, service_tms_code AS service, origin_code AS origin, dest_ship_from_code AS dest,
  max(origin_zone_ship_from_code) AS tzone, cast(sum(accept_cnt) as bigint) AS accept_cnt FROM v_tender_summary GROUP BY ALL""",
    "tc2": """SELECT week, carrier, service, tzone AS zone, dest, cast(sum(accept_cnt) as bigint) AS accept_cnt FROM tn2 GROUP BY ALL""",
    "un2": """SELECT week, carrier, service, zone, dest, cast(sum(shpmt_cnt) as bigint) AS shpmt_cnt, max(origin) AS origin
  FROM wk2 WHERE NOT EXISTS (SELECT 1 FROM tn2 WHERE tn2.week = wk2.week AND tn2.carrier = wk2.carrier
    AND tn2.service = wk2.service AND tn2.origin = wk2.origin AND tn2.dest = wk2.dest) GROUP BY 1, 2, 3, 4, 5""",
}


@query(
    "two_pass_match",
    """SELECT week, carrier, service, origin, dest, wk2.zone, shpmt_cnt, accept_cnt, accept_cnt IS NOT NULL AS matched,
  1 AS match_pass FROM wk2 LEFT JOIN tn2 USING (week, carrier, service, origin, dest)
UNION ALL
SELECT week, carrier, service, origin, dest, zone, shpmt_cnt, accept_cnt, accept_cnt IS NOT NULL, 2
FROM un2 LEFT JOIN tc2 USING (week, carrier, service, zone, dest)""",
    _TWO,
)
def _(v):
    v = v.as_stored(WEEKLY_COLUMNS)
    weekly = (
        v.weekly.groupBy(
            F.col("ship_week_num").alias("week"),
            F.col("carr_num").alias("carrier"),
            F.col("service_tms_code").alias("service"),
            F.col("origin_code").alias("origin"),
            F.col("dest_ship_from_code").alias("dest"),
        )
        .agg(F.max("parent_loc_code").alias("zone"), F.sum("shpmt_cnt").alias("shpmt_cnt"))
    )
    tenders = v.tender_counts.select(
        week_key("week_begin_date", "ww/yyyy").alias("week"),
        F.col("forward_agent_id").alias("carrier"),
        F.col("service_tms_code").alias("service"),
        F.col("origin_code").alias("origin"),
        F.col("dest_ship_from_code").alias("dest"),
        F.col("origin_zone_ship_from_code").alias("zone"),
        "accept_cnt",
    )
    return J.two_pass_match(
        weekly,
        tenders.groupBy(*FINE).agg(F.sum("accept_cnt").alias("accept_cnt")),
        FINE,
        COARSE,
        right_coarse=tenders.groupBy(*COARSE).agg(F.sum("accept_cnt").alias("accept_cnt")),
        regroup={"shpmt_cnt": F.sum("shpmt_cnt"), "origin": F.max("origin")},
        keep=lambda df: staged(df, by_some_keys=True),
    )


# --- aggregates -----------------------------------------------------------------------------------
@query(
    "collapse_mixed",
    """SELECT o_orderpriority, l_returnflag, l_linestatus, max(l_shipdate) AS last_ship, min(l_quantity) AS min_qty,
  cast(sum(cast(l_extendedprice as decimal(18,2))) as double) AS price_sum, avg(l_quantity) AS avg_qty,
  count(CASE WHEN l_tax > 0 THEN 1 END) AS taxed_cnt, count(DISTINCT l_suppkey) AS supp_cnt,
  max(l_quantity * l_linenumber) AS max_expr
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3""",
)
def _(v):
    line, orders = v.table("lineitem"), v.table("orders")
    rows = line.join(orders, line.l_orderkey == orders.o_orderkey)
    return A.collapse(
        rows,
        ["o_orderpriority", "l_returnflag", "l_linestatus"],
        {
            "last_ship": ("max", "l_shipdate"),
            "min_qty": ("min", "l_quantity"),
            "price_sum": ("sum", "cast(l_extendedprice as decimal(18,2))"),
            "avg_qty": ("avg", "l_quantity"),
            "taxed_cnt": ("count", "CASE WHEN l_tax > 0 THEN 1 END"),
            "supp_cnt": ("count_distinct", "l_suppkey"),
            "max_expr": ("max", "l_quantity * l_linenumber"),
        },
    ).withColumn("price_sum", F.col("price_sum").cast("double"))


@query(
    "dedupe_keys",
    """SELECT load_id, trnsp_stage_num, line_key, carr_num FROM (
  SELECT *, row_number() OVER (PARTITION BY load_id, trnsp_stage_num ORDER BY line_key) AS rn FROM e) WHERE rn = 1""",
    LOADED,
)
def _(v):
    rows = loaded(v).select("load_id", "trnsp_stage_num", "line_key", "carr_num").distinct()
    return A.dedupe(rows, ["load_id", "trnsp_stage_num"], [W.oldest("line_key")])


@query(
    "percent_ratio",
    """SELECT load_id, count(DISTINCT late) AS num_cnt, count(DISTINCT done) AS den_cnt,
  count(DISTINCT late) / nullif(count(DISTINCT done), 0) * 100 AS pct FROM (
  SELECT load_id, CASE WHEN tat_late_counter_val = 1 THEN carr_num END AS late,
    CASE WHEN sd_doc_item_overall_process_status_val = '7' THEN carr_num END AS done FROM e) GROUP BY 1""",
    LOADED,
)
def _(v):
    rows = loaded(v).select(
        "load_id",
        F.when(F.col("tat_late_counter_val") == 1, F.col("carr_num")).alias("late"),
        F.when(F.col("sd_doc_item_overall_process_status_val") == "7", F.col("carr_num")).alias("done"),
    )
    return A.pct_of(rows, ["load_id"], "late", "done")


@query(
    "ratio_of_max",
    """SELECT load_id, cast(max(otd_cnt) as double) / nullif(max(cast(trnsp_stage_num as integer) - 1), 0) AS ratio FROM e GROUP BY 1""",
    LOADED,
)
def _(v):
    rows = loaded(v).withColumn("stage", F.col("trnsp_stage_num").cast("int") - 1)
    return A.ratio_of_max(rows, ["load_id"], "otd_cnt", "stage")


@query(
    "two_level_sum",
    """SELECT load_id, sum(q) AS qty_sum, sum(w) AS weight_sum FROM (
  SELECT load_id, dlvry_item_num, material_doc_num, max(net_weight_qty) AS q, max(gross_weight_qty) AS w
  FROM (SELECT *, substring(shpmt_id, -9, 9) AS load_id FROM v_deliveries) GROUP BY 1, 2, 3) GROUP BY 1""",
)
def _(v):
    rows = v.deliveries.withColumn("load_id", last_chars("shpmt_id", 9))
    return A.two_level(
        rows,
        ["load_id", "dlvry_item_num", "material_doc_num"],
        ["load_id"],
        {"qty_sum": "net_weight_qty", "weight_sum": "gross_weight_qty"},
    )


@query(
    "distinct_then_sum",
    """SELECT load_id, sum(floor_position_qty) AS floor_position_qty, sum(pallet_qty) AS pallet_qty
FROM (SELECT DISTINCT load_id, floor_position_qty, pallet_qty FROM v_fill_rows) GROUP BY 1""",
)
def _(v):
    return A.distinct_sum(v.fill_rows, ["load_id"], ["floor_position_qty", "pallet_qty"])


@query(
    "fine_coarse_agg",
    """SELECT load_id, load_gbu_id, sum(gross_weight_qty) AS gross_weight_qty, max(plan_net_weight_qty) AS plan_net_weight_qty,
  max(p) AS pallet_spot_qty
FROM v_fill_rows LEFT JOIN (SELECT load_id, sum(pallet_spot_qty) AS p FROM (SELECT DISTINCT load_id, pallet_spot_qty FROM v_fill_rows)
  GROUP BY 1) USING (load_id) GROUP BY 1, 2""",
)
def _(v):
    coarse = A.distinct_sum(v.fill_rows, ["load_id"], ["pallet_spot_qty"])
    return A.fine_coarse(
        v.fill_rows,
        coarse,
        ["load_id"],
        ["load_id", "load_gbu_id"],
        ["gross_weight_qty"],
        ["plan_net_weight_qty"],
    )


# --- rules ------------------------------------------------------------------------------------------
V3 = {
    "v3a": "SELECT *, substring(shpmt_id, -9, 9) AS load_id FROM v_events",
    "v3b": """SELECT load_id, profl_method_code,
  max(cast(epoch(try_strptime(first_dlvry_appt_date || ' ' || first_dlvry_appt_datetm, '%d/%m/%Y %H:%M:%S')) as bigint)) AS first_max,
  max(cast(epoch(try_strptime(last_dlvry_appt_date || ' ' || last_dlvry_appt_datetm, '%d/%m/%Y %H:%M:%S')) as bigint)) AS last_max,
  max(cast(epoch(try_strptime(request_dlvry_to_date || ' ' || request_dlvry_to_datetm, '%d/%m/%Y %H:%M:%S')) as bigint)) AS request_max,
  max(cast(epoch(try_strptime(orig_request_dlvry_to_date || ' ' || orig_request_dlvry_to_datetm, '%d/%m/%Y %H:%M:%S')) as bigint)) AS orig_max,
  max(cast(epoch(try_strptime(actual_shpmt_end_date || ' ' || actual_arrival_datetm, '%d/%m/%Y %H:%M:%S')) as bigint)) AS actual_arrival_max,
  max(order_num) AS order_num FROM v3a GROUP BY 1, 2""",
    "v3c": """SELECT *, CASE WHEN profl_method_code IN ('APFD', 'RDDAPF', 'APF') THEN first_max
  WHEN profl_method_code IN ('APLD', 'RDDAPL', 'APL') THEN last_max WHEN profl_method_code = 'RDD' THEN request_max
  WHEN profl_method_code IN ('ORDD', 'OTIF') THEN orig_max END AS profl_dlvry_max FROM v3b""",
    "v3": """SELECT load_id, profl_method_code, order_num, profl_dlvry_max, actual_arrival_max,
  CASE WHEN profl_dlvry_max IS NULL OR actual_arrival_max IS NULL THEN NULL
    WHEN profl_dlvry_max >= actual_arrival_max THEN 1 ELSE 0 END AS load_lvl_on_time_pct FROM v3c""",
}


@query("load_level_on_time", "SELECT * FROM v3", V3)
def _(v):
    return load_level_on_time(loaded(v)).select(
        "load_id", "profl_method_code", "order_num", "profl_dlvry_max", "actual_arrival_max", "load_lvl_on_time_pct"
    )


@query(
    "promise_pick_flag",
    """SELECT line_key, profl_method_code, CASE WHEN profl_method_code = 'APF' THEN first_dlvry_appt_date
  WHEN profl_method_code = 'APL' THEN last_dlvry_appt_date WHEN profl_method_code = 'RDD' THEN request_dlvry_to_date
  WHEN profl_method_code = 'ORDD' THEN orig_request_dlvry_to_date END AS promise_date,
  CASE WHEN first_dlvry_appt_datetm IS NULL OR actual_arrival_datetm IS NULL THEN NULL
    WHEN first_dlvry_appt_datetm >= actual_arrival_datetm THEN 1 ELSE 0 END AS met,
  CASE WHEN dest_city_name IN ('MACHINERY', 'HOUSEHOLD') THEN otd_cnt ELSE tat_late_counter_val END AS pct
FROM v_events""",
)
def _(v):
    return v.events.select(
        "line_key",
        "profl_method_code",
        R.pick_by_code(
            "profl_method_code",
            {
                R.FIRST_APPOINTMENT_CODES: "first_dlvry_appt_date",
                R.LAST_APPOINTMENT_CODES: "last_dlvry_appt_date",
                R.REQUESTED_CODES: "request_dlvry_to_date",
                R.ORIGINAL_REQUEST_CODES: "orig_request_dlvry_to_date",
            },
        ).alias("promise_date"),
        R.on_time_flag("first_dlvry_appt_datetm", "actual_arrival_datetm").alias("met"),
        R.override_for("dest_city_name", ["MACHINERY", "HOUSEHOLD"], "otd_cnt", "tat_late_counter_val").alias("pct"),
    )


# --- columns to rows, table comparison ------------------------------------------------------------------
@query(
    "unpivot_measures",
    """SELECT l_returnflag, key, cast(sum(val) as double) AS val, count(*) AS n FROM (
  SELECT l_returnflag, 'l_quantity' AS key, cast(l_quantity as decimal(18,2)) AS val FROM lineitem
  UNION ALL SELECT l_returnflag, 'l_extendedprice', cast(l_extendedprice as decimal(18,2)) FROM lineitem
  UNION ALL SELECT l_returnflag, 'l_discount', cast(l_discount as decimal(18,2)) FROM lineitem) GROUP BY 1, 2""",
)
def _(v):
    long = S.unpivot_measures(
        v.table("lineitem").select("l_returnflag", "l_quantity", "l_extendedprice", "l_discount"), ["l_returnflag"]
    )
    return long.groupBy("l_returnflag", "key").agg(
        F.sum(F.col("val").cast("decimal(18,2)")).cast("double").alias("val"), F.count(F.lit(1)).alias("n")
    )


COMPARED = ["length_val", "width_val", "vol_qty", "weight_uom"]
_PAIRS = {
    "pairs": "\nUNION ALL\n".join(
        f"SELECT l.item_id, l.unit, l.box_name, l.north_chng_code, '{c}' AS column_name, l.{c} AS left_val, r.{c} AS right_val "
        "FROM v_master_left l JOIN v_master_right r ON l.item_id = r.item_id AND l.unit = r.unit"
        for c in COMPARED
    )
}


@query("unpivot_pairs", "SELECT item_id, unit, column_name, left_val, right_val FROM pairs", _PAIRS)
def _(v):
    keys = ["item_id", "unit"]
    l = v.master_left.select(*keys, *[F.col(c).alias(f"reg_{c}") for c in COMPARED])
    r = v.master_right.select(*keys, *[F.col(c).alias(f"glb_{c}") for c in COMPARED])
    return S.unpivot_pairs(J.inner_join(l, r, keys), COMPARED, "reg", "glb", keep=keys)


@query(
    "null_safe_diff",
    """SELECT item_id, unit, column_name, coalesce(trim(left_val), '') AS left_val, coalesce(trim(right_val), '') AS right_val
FROM pairs WHERE coalesce(trim(left_val), '') <> coalesce(trim(right_val), '')""",
    _PAIRS,
)
def _(v):
    return Q.discrepancies(v.master_left, v.master_right, ["item_id", "unit"], COMPARED)


@query(
    "reconcile_report",
    """SELECT item_id, unit, column_name, coalesce(trim(left_val), '') AS left_val, coalesce(trim(right_val), '') AS right_val,
  substring(box_name, 5, 3) AS box_name
FROM pairs WHERE north_chng_code <> 'D' AND (CASE WHEN regexp_full_match(trim(left_val), '[+-]?[0-9]{1,20}([.][0-9]{1,18})?')
    THEN cast(cast(trim(left_val) as decimal(38,18)) as varchar) ELSE coalesce(trim(left_val), '') END)
  <> (CASE WHEN regexp_full_match(trim(right_val), '[+-]?[0-9]{1,20}([.][0-9]{1,18})?')
    THEN cast(cast(trim(right_val) as decimal(38,18)) as varchar) ELSE coalesce(trim(right_val), '') END)
UNION ALL
SELECT item_id, unit, 'missing_row', NULL, NULL, substring(box_name, 5, 3) FROM v_master_left l WHERE north_chng_code <> 'D'
  AND NOT EXISTS (SELECT 1 FROM v_master_right r WHERE r.item_id = l.item_id AND r.unit = l.unit)""",
    _PAIRS,
)
def _(v):
    from loadlens.operators.filters import where_by_param

    left = where_by_param(v.master_left, "north", {"north": "north_chng_code"}, "other_chng_code", lambda c: c != "D")
    report = Q.reconcile_tables(
        left, v.master_right, ["item_id", "unit"], COMPARED, carry=["box_name"], numeric=True
    )
    return report.withColumn("box_name", F.substring("box_name", 5, 3))


@query(
    "reconcile_copies",
    """SELECT item_id, unit, column_name, left_val, right_val, box_name FROM (
  SELECT l.item_id, l.unit, 'vol_qty' AS column_name, coalesce(trim(l.vol_qty), '') AS left_val, 'changed' AS right_val, l.box_name, r.p_size
  FROM v_master_left l JOIN part r ON l.item_id = cast(r.p_partkey as varchar)) WHERE p_size = 17
UNION ALL SELECT l.item_id, l.unit, 'missing_row', NULL, NULL, l.box_name
FROM v_master_left l JOIN part r ON l.item_id = cast(r.p_partkey as varchar) WHERE p_size = 31""",
)
def _(v):
    """Two stored copies of a master table that differ in few rows."""
    size = F.col("p_size")
    other = v.master_left.join(v.table("part").select(F.col("p_partkey").cast("string").alias("item_id"), size), "item_id")
    other = other.where(size != 31).withColumn("vol_qty", F.when(size == 17, F.lit("changed")).otherwise(F.col("vol_qty")))
    left, right = staged(v.master_left), staged(other.drop("p_size"))
    report = Q.reconcile_by_digest(left, right, ["item_id", "unit"], COMPARED, carry=["box_name"], numeric=True)
    return report.select("item_id", "unit", "column_name", "left_val", "right_val", "box_name")


@query(
    "sized_lookups",
    """SELECT o_orderkey, n_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE c_acctbal < 0 AND n_regionkey < 3""",
)
def _(v):
    """Orders of some customers: the customers count as too large to be sent, so their keys sift the orders
    before the shuffle; the nations are sent."""
    owing = v.table("customer").where("c_acctbal < 0").select("c_custkey", "c_nationkey", "c_mktsegment")
    orders = v.table("orders").select("o_orderkey", "o_custkey")
    rows = J.small_lookup_join(orders, owing, {"o_custkey": "c_custkey"}, "inner", most_bytes=1000)
    nations = v.table("nation").where("n_regionkey < 3").select("n_nationkey", "n_name")
    named = J.small_lookup_join(rows, nations, {"c_nationkey": "n_nationkey"}, "inner")
    return named.select("o_orderkey", "n_name", "c_mktsegment")
