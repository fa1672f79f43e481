"""DuckDB text of the views in ``loadlens.demo.views``, and WITH clauses made of them."""

from __future__ import annotations

import re

from loadlens.demo.views import (
    EVENT_TIMES,
    FILL_SUMS,
    MATERIAL_AMOUNTS,
    TENDER_MEANS,
    TENDER_SUMS,
    TENDER_TEXTS,
    customer_levels,
    unmatched,
)

SHPMT = "lpad(cast(l_orderkey + 100000000 as varchar), 10, '0')"
LOAD = f"substring({SHPMT}, -9, 9)"
O_SHPMT = "lpad(cast(o_orderkey + 100000000 as varchar), 10, '0')"
LINE_KEY = (
    "concat_ws('-', cast(l_orderkey as varchar), cast(l_linenumber as varchar), cast(l_partkey as varchar), "
    "cast(l_suppkey as varchar), cast(cast(l_quantity as decimal(18,2)) as varchar), "
    "cast(cast(l_extendedprice as decimal(18,2)) as varchar))"
)


def week(col: str) -> str:
    return f"lpad(cast(weekofyear({col}) as varchar), 2, '0') || '/' || cast(year({col}) as varchar)"


def _event_times() -> str:
    out = []
    for date, time, days, missing in EVENT_TIMES:
        at = f"(event_ts + to_days(cast({days} as integer)))"
        out.append(f"CASE WHEN NOT ({missing}) THEN strftime({at}, '%d/%m/%Y') END AS {date}")
        out.append(f"CASE WHEN NOT ({missing}) THEN strftime({at}, '%H:%M:%S') END AS {time}")
        if time == "actual_arrival_datetm":
            out.append(f"CASE WHEN NOT ({missing}) THEN strftime({at}, '%H:%M:%S') END AS actual_shpmt_end_aot_datetm")
    return ",\n  ".join(out)


VIEWS: dict[str, str] = {
    "v_lines": """
SELECT li.*, o.*, c.*, s.*, p.*, dn.n_name AS dest_zone, dn.n_regionkey AS dest_region, sn.n_name AS origin_zone,
  cast(l_quantity as integer) AS qty, cast(round(l_discount * 100) as integer) AS disc,
  cast(round(l_tax * 100) as integer) AS tax,
  l_shipdate + to_hours(cast(l_quantity as integer)) AS event_ts
FROM lineitem li JOIN orders o ON l_orderkey = o_orderkey
JOIN customer c ON o_custkey = c_custkey JOIN nation dn ON c_nationkey = dn.n_nationkey
JOIN supplier s ON l_suppkey = s_suppkey JOIN nation sn ON s_nationkey = sn.n_nationkey
JOIN part p ON l_partkey = p_partkey""",
    "v_events": f"""
SELECT {LINE_KEY} AS line_key, {SHPMT} AS shpmt_id, 'PO' || l_partkey AS order_num, 'C' || l_partkey AS cust_po_num,
  cast(l_linenumber as varchar) AS trnsp_stage_num,
  CASE WHEN disc = 0 THEN '99991231235959' ELSE strftime(event_ts, '%Y%m%d%H%M%S') END AS event_datetm,
  lpad(cast(l_suppkey as varchar), 10, '0') AS carr_num, ' ' || s_name || ' ' AS carr_desc,
  p_type AS service_tms_code, 'P' || l_suppkey AS ship_point_code,
  cast(o_custkey as varchar) AS ship_to_party_id, cast(o_custkey as varchar) AS ship_to_party_code,
  c_name AS ship_to_party_desc, CASE WHEN c_acctbal >= 0 THEN c_name END AS sold_to_party_desc,
  CASE WHEN s_acctbal < 0 THEN '' ELSE origin_zone END AS origin_zone_code,
  CASE WHEN c_acctbal >= 0 THEN dest_zone END AS dest_zone_code,
  lpad(cast(o_custkey as varchar), 8, '0') AS dest_loc_code,
  c_mktsegment AS dest_city_name, 'S' || c_nationkey AS dest_state_code,
  lpad(cast(c_nationkey as varchar), 5, '0') AS dest_postal_code,
  CASE dest_region WHEN 0 THEN 'US' WHEN 1 THEN 'CA' WHEN 2 THEN 'MX' ELSE 'XX' END AS country_to_code,
  CASE c_mktsegment WHEN 'MACHINERY' THEN 'I' WHEN 'FURNITURE' THEN 'E' ELSE 'C' END AS freight_type_code,
  CASE WHEN p_size > 25 THEN 'YES' ELSE 'NO' END AS frt_auction_code, p_size * 30 AS distance_qty,
  CASE WHEN qty = 50 THEN lpad(cast(l_orderkey + 100000001 as varchar), 10, '0') END AS child_shpmt_num,
  CASE l_returnflag WHEN 'R' THEN 'PICKCI' WHEN 'A' THEN 'PICKCO' ELSE 'OTHER' END AS change_type_code,
  CASE WHEN tax > 0 THEN 'R' || tax END AS lot_delay_reason_code,
  CASE WHEN tax > 0 THEN 'Delay ' || tax END AS lot_delay_reason_code_desc,
  CASE WHEN tax > 6 THEN 'E' || tax END AS lot_exception_categ_val,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'APF' WHEN '2-HIGH' THEN 'APL' WHEN '3-MEDIUM' THEN 'RDD'
    WHEN '4-NOT SPECIFIED' THEN 'ORDD' END AS profl_method_code,
  CASE WHEN tax <= 3 THEN 'On Time' WHEN tax <= 6 THEN 'Carrier' WHEN tax = 7 THEN 'Customer' END
    AS csot_failure_reason_bucket_name,
  l_returnflag AS on_time_src_code, 'Source ' || l_returnflag AS on_time_src_desc,
  CASE WHEN l_linestatus = 'F' THEN '7' ELSE '5' END AS sd_doc_item_overall_process_status_val,
  CASE o_orderstatus WHEN 'F' THEN 'Drop' WHEN 'O' THEN 'Live' ELSE 'Yard' END AS drop_live_ind_desc,
  CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS otd_cnt,
  CASE WHEN l_linestatus = 'F' THEN 0 ELSE 1 END AS tat_late_counter_val,
  cast(qty - 25 as varchar) AS load_builder_prty_val, p_brand AS gbu_code,
  strftime(o_orderdate, '%d/%m/%Y') AS order_create_date, strftime(o_orderdate, '%H:%M:%S') AS order_create_datetm,
  CASE WHEN qty > 45 THEN 'OWN' END AS origin_zone_ship_from_code, CASE WHEN qty < 5 THEN 'OWN' END AS dest_ship_from_code,
  cast(p_size % 3 as varchar) AS load_method_num, 'Cond ' || o_orderstatus AS ship_cond_desc,
  strftime(event_ts, '%H:%M:%S') AS schedule_datetm, CASE WHEN tax > 0 THEN 'Y' ELSE 'N' END AS measrbl_flag,
  strftime(event_ts, '%m') AS actual_ship_month_num, CASE WHEN tax > 4 THEN 'K' || tax END AS cause_code,
  'SO' || dest_region AS sales_org_code, CASE WHEN tax = 1 THEN 1 ELSE 0 END AS lot_cust_failure_cnt,
  CASE WHEN tax = 2 THEN 1 ELSE 0 END AS site_failure_cnt, CASE WHEN tax = 3 THEN 1 ELSE 0 END AS carr_failure_cnt,
  CASE WHEN tax > 3 THEN 1 ELSE 0 END AS others_failure_cnt, disc AS tolrnc_sot_val,
  strftime(event_ts, '%Y%m%d%H%M%S') AS first_tendered_rdd_from_datetm,
  CASE WHEN qty > 2 THEN strftime(event_ts, '%Y%m%d%H%M%S') END AS first_tendered_rdd_to_datetm,
  CASE WHEN qty = 1 THEN 'NULL' ELSE strftime(event_ts, '%d/%m/%Y') END AS schedule_date,
  strftime(event_ts, '%d/%m/%Y') AS actual_ship_date, {week("event_ts")} AS ship_week_num,
  {_event_times()}
FROM v_lines""",
    "v_customer_dim": """
SELECT cast(c_custkey as varchar) AS cust_id, 'T' || c_nationkey AS trade_chanl_curr_id,
  CASE WHEN c_acctbal >= 0 THEN 'Y' ELSE 'N' END AS curr_ind FROM customer""",
    "v_channel_dim": """
SELECT r_name AS trade_chanl_2_long_name, 'T' || n_nationkey AS trade_chanl_7_id,
  CASE WHEN n_regionkey = 3 THEN '600' ELSE '658' END AS trade_chanl_hier_id, 'Y' AS curr_ind
FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "v_locations": """
SELECT 'P' || s_suppkey AS loc_id, s_name AS loc_name, 'S' || s_nationkey AS state_province_code,
  lpad(cast(s_nationkey as varchar), 5, '0') AS postal_code, 'Z' || s_nationkey AS origin_zone_ship_from_code
FROM supplier""",
    "v_accounts": """
SELECT DISTINCT c_mktsegment AS customer_lvl3_desc,
  CASE WHEN length(c_mktsegment) > 9 THEN 'Y' ELSE 'N' END AS account_flag FROM customer""",
    "v_reasons": f"""
SELECT {unmatched(LOAD, "o_orderpriority = '1-URGENT'")} AS poload_id, cast(NULL as varchar) AS csot_update_reason_code,
  max(o_orderpriority) AS reason_code, 'by load' AS aot_reason_code FROM v_lines GROUP BY 1
UNION ALL
SELECT {unmatched(f"('PO' || l_partkey || {LOAD})", "l_returnflag = 'R'")}, max(CASE WHEN tax > 4 THEN 'Weather' END), max('B' || tax), 'by both'
FROM v_lines GROUP BY 1
UNION ALL
SELECT {unmatched("('PO' || l_partkey)", "p_size >= 40")}, max(CASE WHEN p_size > 45 THEN 'On Time' END), max(p_brand), cast(NULL as varchar)
FROM v_lines GROUP BY 1""",
    "v_reason_changes": f"""
SELECT {unmatched(LOAD, "o_orderpriority = '1-URGENT'")} AS poload_id, 'Later' AS csot_update_reason_code,
  min('0 ' || l_returnflag) AS reason_code, cast(NULL as varchar) AS aot_reason_code FROM v_lines GROUP BY 1""",
    "v_ship_times": f"""
SELECT {O_SHPMT} AS shpmt_id, CASE WHEN o_orderstatus = 'P' THEN 'open'
  ELSE '0' || substring(o_orderpriority, 1, 1) || ':30:00' END AS actual_ship_datetm FROM orders""",
    "v_unload": f"""
SELECT substring({O_SHPMT}, -9, 9) AS load_id, substring(o_orderpriority, 3) AS unload_method_val FROM orders""",
    "v_freight": f"""
SELECT {O_SHPMT} AS shpmt_id, CASE WHEN o_totalprice > 250000 THEN 'YES' ELSE 'NO' END AS freight_auction_val,
  CASE WHEN o_totalprice > 300000 THEN 'AUCTION' END AS auction_frt_type_desc, cast(o_totalprice as decimal(18,2)) AS distance_per_load_qty FROM orders""",
    "v_tenders": f"""
SELECT {unmatched(SHPMT, "s_acctbal > 0")} AS load_id, cast(l_suppkey as integer) AS forward_agent_id, p_type AS service_tms_code,
  CASE WHEN p_size > 10 THEN l_quantity ELSE 0.0 END AS avg_award_weekly_vol_qty,
  cast(l_extendedprice as decimal(18,2)) AS linehaul_cost_amt,
  cast(l_extendedprice as decimal(18,2)) * cast(l_tax as decimal(18,2)) AS fuel_cost_amt,
  'Z' || c_nationkey AS dest_ship_from_code, dest_zone AS dest_zone_code,
  strftime(event_ts, '%Y%m%d%H%M%S') AS tender_event_datetm, cast(o_custkey as varchar) AS ship_to_party_id,
  CASE WHEN c_acctbal > 9000 THEN 'CVS' ELSE c_name END || '(' || c_mktsegment || ')' AS customer_desc,
  {", ".join(f"{sql} AS {name}" for name, sql in customer_levels("varchar").items())},
  cast(l_shipdate as date) AS actual_goods_issue_date,
  lpad(cast(s_nationkey as varchar), 5, '0') AS final_stop_postal_code,
  'Z' || s_nationkey AS origin_zone_ship_from_code, {LINE_KEY} AS tender_key
FROM v_lines""",
    "v_acceptances": f"""
SELECT {O_SHPMT} AS load_id, cast(o_custkey as varchar) AS ship_to_party_id FROM orders""",
    "v_origin_gbu": f"""
SELECT {unmatched("'P' || l_suppkey", "l_quantity > 25")} AS origin_id, origin_zone AS parent_loc_code, p_brand AS gbu_code
FROM v_lines""",
    "v_channels": f"""
SELECT {unmatched("c_name", "c_acctbal > 1000")} AS dest_sold_to_name, c_mktsegment AS channel_name,
  CASE WHEN c_acctbal > 9000 THEN 'CVS' ELSE 'Key ' || c_mktsegment END AS customer_name
FROM customer""",
    "v_party_flags": """
SELECT cast(c_custkey as varchar) AS ship_to_num, CASE WHEN c_acctbal > 5000 THEN 'Y' ELSE 'N' END AS party_flag
FROM customer""",
    "v_source_reasons": f"""
SELECT DISTINCT {unmatched("'Source ' || l_returnflag", "l_returnflag <> 'N'")} AS definition_name, 'Cause ' || l_returnflag AS cause_desc
FROM lineitem""",
    "v_tender_summary": f"""
SELECT cast(date_trunc('week', l_shipdate) as date) AS week_begin_date, cast(l_suppkey as varchar) AS forward_agent_id,
  p_type AS service_tms_code, {unmatched("'P' || l_suppkey", "s_acctbal > 0")} AS origin_code,
  {unmatched("'Z' || s_nationkey", "s_acctbal > 0")} AS origin_zone_ship_from_code,
  'Z' || c_nationkey AS dest_ship_from_code, 'S' || s_nationkey AS region_code,
  count(CASE WHEN l_linestatus = 'F' THEN 1 END) AS accept_cnt,
  count(CASE WHEN l_linestatus = 'O' THEN 1 END) AS reject_cnt,
  cast(sum(cast(l_extendedprice as decimal(18,2))) as decimal(28,2)) AS linehaul_cost_amt,
  {", ".join(f"max({sql}) AS {c}" for c, sql in TENDER_TEXTS.items())},
  {", ".join(f"cast(sum({sql}) as bigint) AS {c}" for c, sql in {**TENDER_SUMS, **TENDER_MEANS}.items())}
FROM v_lines GROUP BY ALL""",
    "v_weekly": f"""
SELECT {week("l_shipdate")} AS ship_week_num, cast(l_suppkey as varchar) AS carr_num, p_type AS service_tms_code,
  CASE WHEN l_linenumber = 7 THEN 'X' || l_suppkey WHEN p_size = 50 THEN 'NULL' ELSE 'P' || l_suppkey END AS origin_code,
  'Z' || s_nationkey AS parent_loc_code, 'Z' || s_nationkey AS origin_zone_ship_from_code,
  'Z' || c_nationkey AS dest_ship_from_code, cast(o_custkey as varchar) AS ship_to_party_code,
  c_name AS ship_to_party_desc, c_name AS dest_sold_to_name, s_name AS carr_desc,
  strftime(l_shipdate, '%Y-%m-%d') AS actual_ship_date, c_mktsegment AS freight_type_val,
  split_part(s_name, '#', 1) AS parent_carr_name,
  count(*) AS shpmt_cnt, count(CASE WHEN l_linestatus = 'F' THEN 1 END) AS shpmt_on_time_cnt,
  count(CASE WHEN tax > 0 THEN 1 END) AS measrbl_shpmt_cnt, max(tax) AS cdot_ontime_cnt
FROM v_lines GROUP BY ALL""",
    "v_load_out": f"""
SELECT cast(l_suppkey as varchar) AS carr_num, 'Z' || c_nationkey AS dest_ship_from_code,
  {unmatched("'P' || l_suppkey", "l_returnflag <> 'N'")} AS ship_point_code, p_type AS actual_service_tms_code, {week("l_shipdate")} AS ship_week_num,
  CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS lot_otd_cnt,
  CASE WHEN l_linestatus = 'F' THEN 0 ELSE 1 END AS lot_tat_late_counter_val,
  CASE WHEN tax = 1 THEN 1 ELSE 0 END AS lot_cust_failure_cnt, CASE WHEN tax = 2 THEN 1 ELSE 0 END AS site_failure_cnt,
  CASE WHEN tax = 3 THEN 1 ELSE 0 END AS carr_failure_cnt, CASE WHEN tax > 3 THEN 1 ELSE 0 END AS others_failure_cnt,
  disc AS tolrnc_sot_val FROM v_lines""",
    "v_fill_loads": f"""
SELECT lpad(cast(l_suppkey as varchar), 10, '0') AS carr_id, strftime(l_shipdate, '%d/%m/%Y') AS shpmt_start_date,
  p_type AS tms_service_code, {unmatched("'P' || l_suppkey", "l_returnflag <> 'A'")} AS ship_point_code, 'Z' || c_nationkey AS dest_ship_from_code,
  {", ".join(f"{sql} AS {c}" for c, sql in FILL_SUMS.items())},
  cast(p_size as double) AS floor_position_qty, cast(disc as double) AS net_vol_fill_rate
FROM v_lines""",
    "v_truck_reports": """
SELECT 'PO' || l_partkey AS follow_on_doc_num, cast(l_orderkey as varchar) AS tour_id,
  strftime(l_shipdate, '%Y%m%d') AS release_date, strftime(event_ts, '%H%M%S') AS release_datetm,
  cast(qty as varchar) AS pallet_num_qty, CASE WHEN disc = 0 THEN 'n/a' ELSE cast(disc as varchar) END AS pallet_spot_qty,
  cast(cast(l_quantity as decimal(18,2)) as varchar) AS total_gross_weight_qty,
  cast(p_size * qty as varchar) AS total_gross_vol_qty, p_type AS truck_type_code,
  cast(o_custkey as varchar) AS truck_ship_to_num FROM v_lines""",
    "v_vehicles": f"""
SELECT {unmatched("p_type", "p_type <> 'PROMO'")} AS vehicle_trans_medium_code, max(p_type) AS vehicle_type_code,
  max(cast(p_size * 20 as double)) AS total_weight_qty, max(cast(p_size as double)) AS length_qty,
  min(cast(p_size + 1 as double)) AS width_qty, max(cast(length(p_type) as double)) AS height_qty
FROM part GROUP BY 1""",
    "v_order_links": f"""
SELECT 'PO' || l_partkey AS order_num, {SHPMT} AS transport_num, strftime(event_ts, '%Y%m%d%H%M%S') AS load_tmstp,
  l_linenumber AS link_line_num FROM v_lines""",
    "v_deliveries": f"""
SELECT {SHPMT} AS shpmt_id, cast(l_linenumber as varchar) AS dlvry_item_num,
  lpad(cast(l_partkey as varchar), 10, '0') AS material_doc_num, cast(l_shipdate as date) AS actual_goods_issue_date,
  p_brand AS gbu_code, l_quantity * p_size AS gross_vol_qty, l_quantity * (p_size - 1) AS net_vol_qty,
  l_quantity * 2 AS gross_weight_qty, l_quantity AS net_weight_qty FROM v_lines""",
    "v_fill_rows": f"""
SELECT {LOAD} AS load_id, p_brand AS gbu_code, CASE WHEN p_size < 48 THEN upper(p_brand) END AS gbu_desc,
  {LOAD} || p_brand AS load_gbu_id, cast(l_partkey as varchar) AS material_doc_num,
  cast(l_linenumber as varchar) AS dlvry_item_num, CASE WHEN l_linenumber <= 5 THEN 'Y' ELSE 'N' END AS min_trans_stage_flag,
  cast(year(l_shipdate) as varchar) AS fiscal_year_num,
  CASE WHEN disc = 0 THEN 'none' ELSE cast(month(l_shipdate) as varchar) END AS fiscal_year_perd_num,
  'P' || l_suppkey AS ship_point_code, l_quantity * 2 AS gross_weight_qty, l_quantity * p_size AS gross_vol_qty,
  l_quantity AS net_weight_qty, l_quantity * (p_size - 1) AS net_vol_qty,
  l_quantity * 3 AS load_material_weight_qty, l_quantity * 4 AS load_material_vol_qty,
  CASE WHEN tax > 1 THEN l_quantity * 5 END AS plan_net_weight_qty,
  CASE WHEN tax > 2 THEN l_quantity * 6 END AS plan_net_vol_qty,
  l_quantity * 7 AS plan_gross_weight_qty, l_quantity * 8 AS plan_gross_vol_qty,
  l_quantity * 9 AS shipped_gross_weight_qty, l_quantity * 10 AS shipped_gross_vol_qty,
  cast(p_size * 5 as double) AS max_weight_qty, cast(p_size * 6 as double) AS max_vol_qty,
  CASE WHEN tax > 3 THEN l_quantity END AS total_gross_weight_qty,
  CASE WHEN tax > 4 THEN l_quantity + 1 END AS total_gross_vol_qty, cast(tax as double) AS pallet_spot_qty,
  cast(disc as double) AS cut_impact_rate, cast(p_size as double) AS floor_position_qty,
  cast(qty as double) AS pallet_qty, cast(l_linenumber as double) AS theortc_pallet_qty,
  cast(disc * 2 as double) AS vehicle_fill_opportunity_qty, 'T' || cast(disc % 3 as varchar) AS tdcval_code,
  {", ".join(f"{sql} AS {c}" for c, sql in MATERIAL_AMOUNTS.items())} FROM v_lines""",
    "v_unit_costs": f"""
SELECT {unmatched(SHPMT, "l_returnflag <> 'N'")} AS load_id, CASE WHEN p_size < 48 THEN p_brand END AS subsector_name, p_brand AS gbu_code,
  l_quantity AS su_per_load_qty, cast(l_extendedprice as decimal(18,2)) AS total_cost_amt,
  cast(tax as double) AS step_factor FROM v_lines""",
    "v_master_left": """
SELECT cast(p_partkey as varchar) AS item_id, 'EA' AS unit, 'BOX-' || p_type AS box_name,
  CASE WHEN p_size = 1 THEN 'D' WHEN p_size = 2 THEN NULL ELSE 'U' END AS north_chng_code,
  CASE WHEN p_size = 3 THEN 'D' ELSE 'U' END AS other_chng_code, cast(p_size as varchar) AS length_val,
  cast(cast(p_retailprice as decimal(18,2)) as varchar) AS width_val,
  CASE WHEN p_size = 7 THEN NULL WHEN p_size = 11 THEN '9007199254740993' WHEN p_size = 12 THEN '1d'
    WHEN p_size = 13 THEN '1.50' ELSE p_brand END AS vol_qty, 'KG' AS weight_uom FROM part""",
    "v_master_right": f"""
SELECT {unmatched("cast(p_partkey as varchar)", "p_size <= 46")} AS item_id, 'EA' AS unit, 'BOX-' || p_type AS box_name,
  CASE WHEN p_size = 5 THEN cast(p_size + 1 as varchar) ELSE cast(p_size as varchar) END AS length_val,
  ' ' || cast(cast(p_retailprice as decimal(18,1)) as varchar) AS width_val,
  CASE WHEN p_size IN (7, 8) THEN NULL WHEN p_size = 9 THEN '' WHEN p_size = 11 THEN '9007199254740992'
    WHEN p_size = 12 THEN '1' WHEN p_size = 13 THEN '1.5' WHEN p_brand = 'Brand#1' THEN 'Brand#2'
    ELSE p_brand END AS vol_qty,
  CASE WHEN p_type = 'SMALL' THEN 'LB' ELSE 'KG' END AS weight_uom FROM part""",
    "v_dirty": """
SELECT c_custkey, CASE c_mktsegment WHEN 'MACHINERY' THEN '  ' WHEN 'FURNITURE' THEN ' null ' WHEN 'HOUSEHOLD' THEN NULL
  ELSE '  ' || c_name || ' ' END AS name_raw,
  CASE WHEN c_acctbal < 0 THEN 'NULL' ELSE c_mktsegment || ' ' END AS name_alt, c_nationkey FROM customer""",
}


def with_views(sql: str, ctes: dict[str, str] | None = None) -> str:
    """``sql`` with a WITH clause of the views and steps it names, directly or through others."""
    known = {**VIEWS, **(ctes or {})}
    ordered: list[str] = []

    def need(text: str) -> None:
        for name in known:
            if name not in ordered and re.search(rf"\b{name}\b", text):
                need_one(name)

    def need_one(name: str) -> None:
        for other in known:
            if other != name and other not in ordered and re.search(rf"\b{other}\b", known[name]):
                need_one(other)
        if name not in ordered:
            ordered.append(name)

    need(sql)
    if not ordered:
        return sql.strip()
    # A step that is read more than once is computed once, and its size is known to the joins.
    text = "\n".join([sql, *(known[n] for n in ordered)])
    often = {n: " MATERIALIZED" if len(re.findall(rf"\b{n}\b", text)) > 1 else "" for n in ordered}
    clause = ",\n".join(f"{n} AS{often[n]} ({known[n].strip()})" for n in ordered)
    return f"WITH {clause}\n{sql.strip()}"
