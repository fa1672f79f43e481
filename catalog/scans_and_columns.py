"""Scans, projections, filters, keys, texts and dates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.registry import query
from loadlens.functions import dates as D
from loadlens.functions import keys as K
from loadlens.functions import rules as R
from loadlens.operators import columns as C
from loadlens.operators.filters import where_by_param, where_has_value
from loadlens.operators.joins import enrich
from loadlens.plans.on_time import channel_of_customer
from loadlens.sources import sinks, tables
from loadlens.sources.slices import Conflict, SliceTable


def current_customers(v) -> DataFrame:
    return tables.current_rows(v.customer_dim, {"cust_id": "cust_id", "trade_chanl_curr_id": "trade_chanl_id"})


def channel_names(v) -> DataFrame:
    return tables.hierarchy_level(
        v.channel_dim, "trade_chanl_7_id", "trade_chanl_2_long_name", hier_col="trade_chanl_hier_id"
    )


@query(
    "current_rows_hierarchy",
    """SELECT cust_id AS customer_lvl12_code, max(trade_chanl_2_long_name) AS channel_name
FROM v_customer_dim c JOIN v_channel_dim h ON trade_chanl_curr_id = trade_chanl_7_id
WHERE c.curr_ind = 'Y' AND h.curr_ind = 'Y' AND trade_chanl_hier_id = '658' GROUP BY 1""",
)
def _(v):
    return channel_of_customer(current_customers(v), channel_names(v))


@query(
    "params_lookup",
    """SELECT n_name AS param_name, cast(n_nationkey as varchar) AS param_val
FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'""",
)
def _(v):
    n, r = v.table("nation"), v.table("region")
    params = n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("r_name").alias("param_group_name"),
        F.col("n_name").alias("param_name"),
        F.col("n_nationkey").cast("string").alias("param_val"),
    )
    return tables.read_params(params, "ASIA")


@query(
    "date_spine_coverage",
    """SELECT strftime(d, '%d/%m/%Y') AS day_text, coalesce(n, 0) AS order_cnt
FROM (SELECT unnest(generate_series(min(cast(o_orderdate as date)), max(cast(o_orderdate as date)), INTERVAL 1 DAY)) AS d FROM orders) s
LEFT JOIN (SELECT cast(o_orderdate as date) AS od, count(*) AS n FROM orders GROUP BY 1) o ON d = od""",
)
def _(v):
    first, last = v.table("orders").select(F.min("o_orderdate").cast("date"), F.max("o_orderdate").cast("date")).first()
    spine = tables.date_spine(v.spark, first, last, "dd/MM/yyyy")
    per_day = v.table("orders").groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return enrich(spine, per_day, "day").select("day_text", F.coalesce("n", F.lit(0)).alias("order_cnt"))


@query(
    "affix_and_conform",
    """SELECT cast(c_custkey as varchar) AS c_custkey, c_name AS dim_c_name_v1, c_name AS label,
  cast(floor(c_acctbal) as integer) AS balance, 'ACTIVE' AS state, try_cast(c_name as integer) AS not_a_number,
  cast(NULL as double) AS unknown_qty
FROM customer""",
)
def _(v):
    df = C.affix_columns(
        v.table("customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment"), "DIM", "V1", ["c_custkey"]
    )
    df = C.drop_columns(df, ["dim_c_mktsegment_v1", "no_such_column"])
    df = C.rename_columns(df, {"dim_c_acctbal_v1": "balance", "no_such_column": "x"})
    df = C.apply_exprs(
        df,
        {
            "label": F.col("dim_c_name_v1"),
            "state": F.lit("ACTIVE"),
            "not_a_number": F.col("dim_c_name_v1"),
            "balance": "floor(balance)",
        },
    )
    df = C.cast_columns(df, {"not_a_number": "int", "balance": "int"})
    schema = T.StructType(
        [
            T.StructField("c_custkey", T.StringType()),
            T.StructField("dim_c_name_v1", T.StringType()),
            T.StructField("label", T.StringType()),
            T.StructField("balance", T.IntegerType()),
            T.StructField("state", T.StringType()),
            T.StructField("not_a_number", T.IntegerType()),
            T.StructField("unknown_qty", T.DoubleType()),
        ]
    )
    return C.conform(df, schema, fill_missing=True)


@query(
    "filters_mix",
    """SELECT line_key, change_type_code, schedule_date, drop_live_ind_desc, distance_qty FROM v_events
WHERE sd_doc_item_overall_process_status_val = '7' AND change_type_code IN ('PICKCI', 'PICKCO')
  AND length(coalesce(lot_delay_reason_code_desc, '')) > 1 AND length(coalesce(final_lrdt_date, '')) > 1
  AND event_datetm <> '99991231235959' AND schedule_date <> 'NULL' AND origin_zone_code <> ''
  AND drop_live_ind_desc IN ('Drop', 'Live', '') AND distance_qty < 1200 AND frt_auction_code <> 'YES'""",
)
def _(v):
    rows = where_has_value(v.events, "lot_delay_reason_code_desc", "final_lrdt_date").where(
        R.all_of(
            F.col("sd_doc_item_overall_process_status_val") == "7",
            F.col("change_type_code").isin("PICKCI", "PICKCO"),
            R.not_sentinel("event_datetm"),
            R.not_null_text("schedule_date"),
            R.non_empty("origin_zone_code"),
            F.col("drop_live_ind_desc").isin("Drop", "Live", ""),
            F.col("distance_qty") < 1200,
        )
    )
    rows = where_by_param(
        rows, "auction", {"auction": "frt_auction_code"}, "drop_live_ind_desc", lambda c: c != "YES"
    )
    return rows.select("line_key", "change_type_code", "schedule_date", "drop_live_ind_desc", "distance_qty")


_CLEAN = "CASE WHEN trim({0}) = '' OR upper(trim({0})) = 'NULL' THEN NULL ELSE trim({0}) END"


@query(
    "clean_strings",
    f"""SELECT c_custkey, {_CLEAN.format("name_raw")} AS name_raw, {_CLEAN.format("name_alt")} AS name_alt, c_nationkey,
  cast(length({_CLEAN.format("name_raw")}) as integer) AS name_len
FROM v_dirty""",
)
def _(v):
    return C.clean_strings(v.dirty).withColumn("name_len", F.length("name_raw"))


@query(
    "coalesce_pairs",
    f"""SELECT c_custkey, coalesce({_CLEAN.format("name_raw")}, {_CLEAN.format("name_alt")}) AS name_raw,
  {_CLEAN.format("name_alt")} AS name_alt, c_nationkey FROM v_dirty""",
)
def _(v):
    return C.coalesce_pairs(C.clean_strings(v.dirty), [("name_raw", "name_alt")])


@query(
    "strip_zeros_variants",
    """SELECT line_key, regexp_replace(carr_num, '^0', '') AS one_off, regexp_replace(carr_num, '^0+', '') AS all_off,
  regexp_replace(dest_postal_code, '^0+', '') AS postal_off, try_cast(carr_num as integer) AS carr_int,
  try_cast(order_num as integer) AS order_int,
  lpad(regexp_replace(carr_num, '^0+', ''), 10, '0') AS ten_digits, lpad(trnsp_stage_num, 4, '0') AS stage_pad
FROM v_events""",
)
def _(v):
    return v.events.select(
        "line_key",
        K.strip_one_zero("carr_num").alias("one_off"),
        K.strip_zeros("carr_num").alias("all_off"),
        K.strip_zeros("dest_postal_code").alias("postal_off"),
        K.int_of("carr_num").alias("carr_int"),
        K.int_of("order_num").alias("order_int"),
        K.fixed_width_id(K.strip_zeros("carr_num")).alias("ten_digits"),
        K.left_pad("trnsp_stage_num", 4).alias("stage_pad"),
    )


@query(
    "key_building",
    """SELECT line_key, substring(shpmt_id, -9, 9) AS load_id, substring(trnsp_stage_num, -9, 9) AS short_text,
  order_num || substring(shpmt_id, -9, 9) AS poload_id, origin_zone_code || '-' || dest_zone_code AS lane_key,
  origin_zone_code || ' to ' || dest_city_name || ',' || dest_state_code || ',' || dest_postal_code AS lane_name,
  regexp_replace(ship_to_party_desc || '(' || dest_city_name || ')', '\\(.*\\)', '', 'g') AS party_name,
  substring(order_num, 3, 3) AS order_part, trim(carr_desc) AS carr_desc, upper(dest_city_name) AS city
FROM v_events""",
)
def _(v):
    load = K.last_chars("shpmt_id", 9)
    return v.events.select(
        "line_key",
        load.alias("load_id"),
        K.last_chars("trnsp_stage_num", 9).alias("short_text"),
        K.key_of("order_num", load).alias("poload_id"),
        K.key_of("origin_zone_code", "dest_zone_code", sep="-").alias("lane_key"),
        K.lane_text("origin_zone_code", "dest_city_name", "dest_state_code", "dest_postal_code").alias("lane_name"),
        K.strip_parens(F.concat("ship_to_party_desc", F.lit("("), "dest_city_name", F.lit(")"))).alias("party_name"),
        K.cut("order_num", 3, 3).alias("order_part"),
        F.trim("carr_desc").alias("carr_desc"),
        F.upper("dest_city_name").alias("city"),
    )


@query(
    "date_text_formats",
    """SELECT line_key,
  substring(event_datetm, 1, 4) || '-' || substring(event_datetm, 5, 2) || '-' || substring(event_datetm, 7, 2) AS event_day,
  substring(actual_ship_date, 7, 4) || '-' || substring(actual_ship_date, 4, 2) || '-' || substring(actual_ship_date, 1, 2) AS ship_day,
  cast(epoch(try_strptime(actual_shpmt_end_date || ' ' || actual_arrival_datetm, '%d/%m/%Y %H:%M:%S')) as bigint) AS arrival_epoch,
  cast(epoch(try_strptime(schedule_date || ' ' || tender_datetm, '%d/%m/%Y %H:%M:%S')) as bigint) AS schedule_epoch,
  actual_shpmt_end_date || ' ' || actual_arrival_datetm AS arrival_text,
  actual_ship_date || ' ' || coalesce(actual_arrival_datetm, '00:00:00') AS ship_text,
  cast(month(sd) as integer) AS ship_month, strftime(sd, '%b') AS ship_mon,
  strftime(sd, '%b') || ' ' || cast(year(sd) as varchar) AS ship_label
FROM (SELECT *, strptime(actual_ship_date, '%d/%m/%Y') AS sd FROM v_events)""",
)
def _(v):
    ship_day = D.dashed_date("actual_ship_date", "dd/MM/yyyy")
    return v.events.select(
        "line_key",
        D.dashed_date("event_datetm").alias("event_day"),
        ship_day.alias("ship_day"),
        D.epoch_of("actual_shpmt_end_date", "actual_arrival_datetm").alias("arrival_epoch"),
        D.epoch_of("schedule_date", "tender_datetm").alias("schedule_epoch"),
        D.join_date_time("actual_shpmt_end_date", "actual_arrival_datetm").alias("arrival_text"),
        D.join_date_time("actual_ship_date", "actual_arrival_datetm", "00:00:00").alias("ship_text"),
        D.month_num(ship_day).alias("ship_month"),
        D.month_name(ship_day).alias("ship_mon"),
        D.month_label(ship_day).alias("ship_label"),
    )


@query(
    "week_keys",
    """SELECT l_shipdate AS ship_day, count(*) AS line_cnt, cast(max(weekofyear(l_shipdate)) as integer) AS week_num,
  cast(max(year(l_shipdate)) as integer) AS year_num,
  max(cast(year(l_shipdate) as varchar) || lpad(cast(weekofyear(l_shipdate) as varchar), 2, '0')) AS yyyyww,
  max(cast(isoyear(l_shipdate) as varchar) || lpad(cast(weekofyear(l_shipdate) as varchar), 2, '0')) AS iso_yyyyww,
  max(lpad(cast(weekofyear(l_shipdate) as varchar), 2, '0') || '/' || cast(year(l_shipdate) as varchar)) AS ww_yyyy,
  max(cast(weekofyear(l_shipdate) as varchar) || '/' || cast(year(l_shipdate) as varchar)) AS w_yyyy
FROM (SELECT cast(l_shipdate as date) AS l_shipdate FROM lineitem) GROUP BY 1""",
)
def _(v):
    per_day = v.table("lineitem").groupBy(F.col("l_shipdate").cast("date").alias("ship_day")).agg(
        F.count(F.lit(1)).alias("line_cnt")
    )
    return per_day.select(
        "ship_day",
        "line_cnt",
        D.iso_week("ship_day").alias("week_num"),
        D.calendar_year("ship_day").alias("year_num"),
        D.week_key("ship_day").alias("yyyyww"),
        D.week_key("ship_day", iso_year=True).alias("iso_yyyyww"),
        D.week_key("ship_day", "ww/yyyy").alias("ww_yyyy"),
        D.week_key("ship_day", "ww/yyyy", pad=False).alias("w_yyyy"),
    )


@query(
    "fill_nan",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN -1.0 ELSE value END AS value_filled FROM events""",
)
def _(v):
    broken = F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value"))
    return v.table("events").select("event_id", R.fill_nan(broken, -1.0).alias("value_filled"))


@query(
    "slice_overwrite",
    """SELECT l_returnflag, count(*) AS line_cnt,
  cast(sum(CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_quantity END) as bigint) AS qty_sum
FROM lineitem GROUP BY 1""",
)
def _(v):
    folder = sinks.staging_folder(v.spark)
    line = v.table("lineitem").select("l_orderkey", "l_quantity", "l_returnflag")
    line.write.partitionBy("l_returnflag").parquet(folder)
    returned = line.where("l_returnflag = 'R'").withColumn("l_quantity", F.lit(0.0))
    sinks.overwrite_slice(returned, folder, {"l_returnflag": "R"})
    return (
        v.spark.read.parquet(folder)
        .groupBy("l_returnflag")
        .agg(F.count(F.lit(1)).alias("line_cnt"), F.sum("l_quantity").cast("bigint").alias("qty_sum"))
    )


@query(
    "sink_roundtrip",
    """SELECT step, l_returnflag, count(*) AS line_cnt, cast(sum(l_linenumber * f) as bigint) AS number_sum FROM (
  SELECT l_returnflag, l_linenumber, 'target' AS step, 2 AS f FROM lineitem
  UNION ALL SELECT l_returnflag, l_linenumber, 'side', 3 FROM lineitem) GROUP BY 1, 2""",
)
def _(v):
    """A target that is overwritten by column name, and a side table that is made of itself."""
    line = v.table("lineitem").select("l_returnflag", "l_linenumber")
    folder = sinks.staging_folder(v.spark)
    target, side = (f"{kind}_{folder.rsplit('-', 1)[-1]}" for kind in ("target", "side"))
    v.spark.sql(f"CREATE TABLE {target} (l_linenumber INT, l_returnflag STRING) USING parquet LOCATION '{folder}/target'")
    sinks.overwrite_table(line, target)
    sinks.overwrite_table(line.withColumn("l_linenumber", F.col("l_linenumber") * 2), target)
    sinks.checkpoint_table(line, side, folder)
    tripled = v.spark.table(side).withColumn("l_linenumber", F.col("l_linenumber") * 3)
    kept = sinks.checkpoint_table(tripled, side, folder)
    both = tables.read_table(v.spark, target).withColumn("step", F.lit("target")).unionByName(
        kept.withColumn("step", F.lit("side"))
    )
    return both.groupBy("step", "l_returnflag").agg(
        F.count(F.lit(1)).alias("line_cnt"), F.sum("l_linenumber").cast("bigint").alias("number_sum")
    )


@query(
    "drop_partition",
    "SELECT l_returnflag, count(*) AS line_cnt FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1",
)
def _(v):
    """A partition of an external table dropped, with its files."""
    folder = sinks.staging_folder(v.spark)
    table = f"parts_{folder.rsplit('-', 1)[-1]}"
    v.spark.sql(
        f"CREATE TABLE {table} (l_orderkey BIGINT, l_returnflag STRING) USING parquet "
        f"PARTITIONED BY (l_returnflag) LOCATION '{folder}'"
    )
    v.table("lineitem").select("l_orderkey", "l_returnflag").write.insertInto(table, overwrite=True)
    sinks.drop_partition(v.spark, table, {"l_returnflag": "R"}, purge_path=folder)
    # read by path: neither the metastore nor the folder has the partition any more
    return v.spark.read.parquet(folder).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("line_cnt"))


@query(
    "serial_slices",
    """SELECT l_returnflag, count(*) AS line_cnt, cast(sum(CASE l_returnflag WHEN 'R' THEN 2 WHEN 'A' THEN 3 ELSE 1 END * l_linenumber) as bigint) AS number_sum
FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1""",
)
def _(v):
    """Slices written from one version: disjoint ones are put on top of each other, a second write of the
    same slice is refused and changes nothing, and a slice is taken out."""
    line = v.table("lineitem").select("l_returnflag", "l_linenumber")
    table = SliceTable(v.spark, sinks.staging_folder(v.spark), ["l_returnflag"])
    for flag in ("A", "N", "R"):
        table.replace(line.where(F.col("l_returnflag") == flag), {"l_returnflag": flag})
    base = table.version()

    def scaled(flag: str, factor: int) -> DataFrame:
        own = table.read(base, [{"l_returnflag": flag}])
        return own.withColumn("l_linenumber", F.col("l_linenumber") * factor)

    for flag, factor in (("R", 2), ("A", 3)):
        table.replace(scaled(flag, factor), {"l_returnflag": flag}, based_on=base, reads=())
    try:
        table.replace(scaled("R", 7), {"l_returnflag": "R"}, based_on=base)
    except Conflict:
        table.drop({"l_returnflag": "N"})
    return table.read().groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("line_cnt"), F.sum("l_linenumber").cast("bigint").alias("number_sum")
    )


@query(
    "refresh_and_keep",
    """SELECT step, l_returnflag, count(*) AS line_cnt FROM lineitem, (VALUES ('refreshed'), ('view'), ('cached view'), ('cache'), ('disk')) t(step)
WHERE step <> 'refreshed' OR l_linenumber > 2 GROUP BY 1, 2""",
)
def _(v):
    """A table whose files another job has replaced, read anew after a refresh, and the ways to keep an
    intermediate."""
    line = v.table("lineitem").select("l_returnflag", "l_linenumber")
    folder = sinks.staging_folder(v.spark)
    name = f"kept_{folder.rsplit('-', 1)[-1]}"
    line.write.parquet(f"{folder}/t")
    v.spark.sql(f"CREATE TABLE {name} (l_returnflag STRING, l_linenumber INT) USING parquet LOCATION '{folder}/t'")
    v.spark.table(name).count()
    line.where("l_linenumber > 2").write.mode("overwrite").parquet(f"{folder}/t")
    tables.refresh(v.spark, name)
    parts = [tables.read_table(v.spark, name).withColumn("step", F.lit("refreshed"))]
    for mode, step in enumerate(("view", "cached view", "cache", "disk")):
        parts.append(sinks.manage_output(line, f"{name}_{mode}", mode).withColumn("step", F.lit(step)))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.groupBy("step", "l_returnflag").agg(F.count(F.lit(1)).alias("line_cnt"))


@query(
    "suffix_drop",
    "SELECT 'side_' || lower(r_name) AS table_name, r_regionkey, CASE WHEN r_name = 'ASIA' THEN 'kept' ELSE 'dropped' END AS state, true AS loaded_today FROM region",
)
def _(v):
    """Side tables of a database, one a region, of which those with a suffix are dropped; their names as a
    frame, and the time of the load."""
    folder = sinks.staging_folder(v.spark)
    db = f"side_{folder.rsplit('-', 1)[-1]}"
    v.spark.sql(f"CREATE DATABASE {db}")
    regions = v.table("region").select("r_name", "r_regionkey")
    names = sorted(r["r_name"] for r in regions.collect())  # a handful of regions, one table each
    for n in names:
        own = regions.where(F.col("r_name") == n)
        sinks.checkpoint_table(own, f"{db}.side_{n.lower().replace(' ', '_')}{'' if n == 'ASIA' else '_DEBUG'}", folder)
    gone = sinks.drop_tables_with_suffix(v.spark, db, "_debug")
    left = tables.names_frame(v.spark, [t.name for t in v.spark.catalog.listTables(db) if not t.isTemporary], "table_name")
    states = left.withColumn("state", F.lit("kept")).unionByName(
        tables.names_frame(v.spark, [n[: -len("_debug")] for n in gone], "table_name").withColumn("state", F.lit("dropped"))
    )
    keyed = regions.select(
        F.concat(F.lit("side_"), F.lower("r_name")).alias("table_name"), F.translate(F.concat(F.lit("side_"), F.lower("r_name")), " ", "_").alias("k"), "r_regionkey"
    )
    today = F.abs(F.unix_timestamp(D.audit_ts()) - F.unix_timestamp(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()))) < 86400
    return keyed.join(states.withColumnRenamed("table_name", "k"), "k").select("table_name", "r_regionkey", "state", today.alias("loaded_today"))
