"""Vehicle fill rate: the truck and shipped-quantity hub, and its load aggregate."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlens.functions import expressions as X
from loadlens.functions.keys import last_chars, strip_zeros
from loadlens.operators.aggregates import distinct_sum, fine_coarse, two_level
from loadlens.operators.columns import apply_exprs, cast_columns, conform
from loadlens.operators.joins import enrich, lookup_join
from loadlens.operators.windows import latest_per_key
from loadlens.sources.sinks import staged, staged_by

TRUCK_SUMS = ["pallet_num_qty", "pallet_spot_qty", "total_gross_weight_qty", "total_gross_vol_qty"]
SHIPPED = {
    "shipped_net_vol_qty": "net_vol_qty",
    "shipped_net_weight_qty": "net_weight_qty",
    "shipped_gross_vol_qty": "gross_vol_qty",
    "shipped_gross_weight_qty": "gross_weight_qty",
}


def newest_truck_reports(reports: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """Truck quantities summed per document, tour and release; the newest release per document."""
    typed = cast_columns(reports, {c: "double" for c in TRUCK_SUMS}).withColumn(
        "release_dttm", F.concat("release_date", "release_datetm")
    )
    summed = typed.groupBy("follow_on_doc_num", "tour_id", "release_dttm").agg(
        *[F.sum(c).alias(c) for c in TRUCK_SUMS],
        *[F.max(c).alias(c) for c in ("release_date", "release_datetm", "truck_type_code", *carried)],
    )
    return latest_per_key(summed, ["follow_on_doc_num"], "release_dttm", ["tour_id"])


def newest_links(links: DataFrame, ties: Sequence[str]) -> DataFrame:
    """Newest link per order and transport, with the load id of the transport."""
    newest = latest_per_key(links, ["order_num", "transport_num"], "load_tmstp", ties)
    return newest.select("order_num", "transport_num", last_chars("transport_num", 9).alias("load_id"))


def prepared_deliveries(deliveries: DataFrame, exprs: Mapping[str, str] | None = None) -> DataFrame:
    """Distinct delivery rows with load id, month and load-and-unit id."""
    keyed = deliveries.withColumns(
        {"load_id": last_chars("shpmt_id", 9), "material_doc_num": strip_zeros("material_doc_num")}
    )
    return apply_exprs(keyed, X.chosen(X.FILL_DELIVERY, exprs)).distinct()


def shipped_per_load(deliveries: DataFrame) -> DataFrame:
    """Shipped weights and volumes per load; a delivery item that is listed twice counts once."""
    return two_level(deliveries, ["load_id", "dlvry_item_num", "material_doc_num"], ["load_id"], SHIPPED)


def builder_priority(hub: DataFrame, exprs: Mapping[str, str] | None = None) -> DataFrame:
    """Positive load-builder priority per load."""
    typed = apply_exprs(hub.select("load_id", "load_builder_prty_val"), X.chosen(X.FILL_PRIORITY, exprs))
    return (
        typed.where(F.col("load_builder_prty_val") > 0)
        .groupBy("load_id")
        .agg(F.max("load_builder_prty_val").alias("load_builder_prty_val"))
    )


def fill_rate_hub(
    truck_reports: DataFrame,
    vehicles: DataFrame,
    links: DataFrame,
    deliveries: DataFrame,
    hub: DataFrame,
    *,
    link_ties: Sequence[str],
    truck_cols: Sequence[str] = (),
    schema: T.StructType | None = None,
    exprs: Mapping[str, str] | None = None,
    keep: Callable[[DataFrame], DataFrame] = staged,
) -> DataFrame:
    """One row per order and transport that has a truck report and a known vehicle, with the
    shipped quantities and the builder priority of its load. ``keep`` stores the planned rows and the rows
    by load, so that the shuffle files of the one are gone before those of the other are written."""
    trucks = newest_truck_reports(truck_reports, truck_cols)
    specs = apply_exprs(
        vehicles.withColumn("vehicle_true_max_weight_qty", F.col("total_weight_qty")),
        X.chosen(X.FILL_VEHICLE, exprs),
    ).drop("total_weight_qty", "length_qty", "width_qty", "height_qty")
    planned = lookup_join(newest_links(links, link_ties), trucks, {"order_num": "follow_on_doc_num"}, "inner")
    planned = keep(lookup_join(planned, specs, {"truck_type_code": "vehicle_trans_medium_code"}, "inner"))
    shipped = prepared_deliveries(deliveries, exprs)
    per_load = shipped_per_load(shipped).join(
        shipped.groupBy("load_id").agg(F.max("gi_month_num").alias("gi_month_num")), "load_id"
    )
    per_load = keep(enrich(per_load, builder_priority(hub, exprs), "load_id"))
    out = lookup_join(planned, per_load, "load_id")
    return conform(out, schema) if schema else out


GROSS = ["total_gross_weight_qty", "oblb_gross_weight_plan_qty", "total_gross_vol_qty", "oblb_gross_vol_plan_qty", "pallet_spot_qty"]
MATERIAL_SUMS = [
    "load_material_weight_qty", "load_material_vol_qty", "gross_weight_qty", "gross_vol_qty", "cut_impact_rate",
    "drf_last_truck_amt", "glb_segment_impact_cat_ld_amt", "hopade_amt", "max_orders_non_drp_amt", "max_orders_incrmtl_amt",
]
MATERIAL_COLS = ["tdcval_code"]
MATERIAL_MAXES = ["plan_net_weight_qty", "plan_net_vol_qty"]
MATERIAL_KEYS = ["load_id", "load_gbu_id", "material_doc_num", "dlvry_item_num"]
LOAD_SUMS = ["floor_position_qty", "pallet_qty", "theortc_pallet_qty"]


def fill_rate_load_agg(
    rows: DataFrame,
    costs: DataFrame,
    *,
    maxes: Mapping[str, str],
    sums: Sequence[str] = ("net_weight_qty", "net_vol_qty"),
    gross: Sequence[str] = GROSS,
    material_sums: Sequence[str] = MATERIAL_SUMS,
    material_maxes: Sequence[str] = MATERIAL_MAXES,
    load_sums: Sequence[str] = LOAD_SUMS,
    material_cols: Sequence[str] = MATERIAL_COLS,
    schema: T.StructType | None = None,
    exprs: Mapping[str, str] | None = None,
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """One row per load and business unit.

    ``maxes`` (``{out: column}``) and ``sums`` are the columns of the main grouping; the
    rest comes from sub-aggregates: gross sums per load over distinct rows, material sums,
    distinct floor positions and pallets per load, and costs per load and unit. Rows
    without a business unit have no ``load_gbu_id`` and are left out by the inner joins.
    ``material_cols`` are further columns that make a material row distinct. ``keep`` stores the
    first-stage rows, which four aggregates read; the default deals them by load once, and no aggregate or
    join moves them again. The result is stored as well, since only then is that so in any session.
    """
    by_load = keep or (lambda df: staged_by(df, ["load_id"], int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    capped = apply_exprs(rows, X.chosen(X.FILL_CAPPED, exprs)).withColumns(
        {
            "fiscal_year_num": F.col("fiscal_year_num").try_cast("int"),
            "fiscal_year_perd_num": F.col("fiscal_year_perd_num").try_cast("int"),
        }
    )
    # Rows without a load find no partner in the inner joins below.
    first_stage = by_load(capped.where((F.col("min_trans_stage_flag") == "Y") & F.col("load_id").isNotNull()))

    gross_sums = distinct_sum(first_stage, ["load_id"], gross)
    materials = first_stage.select(*MATERIAL_KEYS, *material_cols, *material_sums, *material_maxes).distinct()
    per_unit = fine_coarse(
        materials, gross_sums, ["load_id"], ["load_id", "load_gbu_id"], material_sums, material_maxes
    )
    per_unit = apply_exprs(per_unit, X.chosen(X.FILL_AGG, exprs)).drop(*material_maxes)

    cost = (
        apply_exprs(costs.withColumn("load_id", strip_zeros("load_id")), X.chosen(X.FILL_GBU, exprs))
        .withColumn("load_gbu_id", F.expr(X.chosen(X.FILL_DELIVERY, exprs)["load_gbu_id"]))
        .groupBy("load_id", "load_gbu_id")
        .agg(
            F.sum("su_per_load_qty").alias("cost_su_per_load_qty"),
            F.sum("total_cost_amt").alias("cost_total_amt"),
            F.sum("step_factor").alias("cost_step_factor"),
        )
    )
    main = first_stage.groupBy("load_id", "gbu_desc", "gbu_code", "load_gbu_id").agg(
        *[F.max(c).alias(out) for out, c in maxes.items()], *[F.sum(c).alias(c) for c in sums]
    )
    per_load = first_stage.groupBy("load_id").agg(*[F.sum_distinct(F.col(c)).alias(c) for c in load_sums])
    main = main.join(per_load, "load_id")
    main = main.join(per_unit, ["load_id", "load_gbu_id"])
    out = main.join(cost, ["load_id", "load_gbu_id"], "left")
    out = conform(out, schema) if schema else out
    return out if keep else staged(out, by_some_keys=True)
