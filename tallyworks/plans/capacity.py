"""Storage capacity against projected stock: plants, outside warehouses, packaging."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions import digits_between, div0, pad_key, parse_yyyymmdd, quantity, remap
from tallyworks.operators.membership import impute_mean, latest, mark_sides
from tallyworks.operators.reshape import category_columns, stack_by_alt_key
from tallyworks.operators.spine import densify, running_balance, running_balance_in_blocks, spread_over
from tallyworks.sources import Sources, inline
from tallyworks.sources import constants as const
from tallyworks.sources.layout import in_months

TYPES = {"cans": "Cans", "ends": "Ends"}


def _pallets(src: Sources, rows: Sequence[tuple]) -> DataFrame:
    return inline(src.spark, ["mat_group", "pnum", "types"], rows)


def _locations(src: Sources) -> DataFrame:
    """Storage places that are no plant, under the key that stock rows use."""
    places = src.table("warehousing_capacity").filter(F.col("type") != "Plant")
    return places.withColumn("location_code", pad_key(F.col("location_code"), F.col("type"), "Warehouse", 10))


def _stock(src: Sources, pallets: DataFrame) -> DataFrame:
    """Finished stock in pallets, summed to what the location tests look at.

    The tests and reports below depend on these five keys only, so the item-level view is
    aggregated once, before any of them. Materials and their lot sizes are joined first, so items are
    moved and sorted once.
    """
    materials = (
        src.client_table("mara")
        .filter(F.col("mtart") == "FERT")
        .join(pallets, F.col("matkl") == F.col("mat_group"))
        .select(F.col("matnr").alias("material"), "types")
    )
    lots = src.client_table("marc").select(
        F.col("matnr").alias("material"), F.col("werks").alias("plant"), F.col("bstrf")
    )
    items = (
        src.table("vw_fct_inventory_aging")
        .filter((F.col("status") != "Stock in Transit") & (F.col("storage_location") != "1300"))
        .join(materials.join(lots, "material"), ["material", "plant"])
    )
    return items.groupBy(
        F.col("date_of_analysis").alias("date"), "plant", "storage_location", "customer", "types"
    ).agg(F.sum(quantity(div0(F.col("stock_at_plant"), F.col("bstrf")))).alias("pallets"))


def due_lines(
    src: Sources, pallets: DataFrame, as_of: dt.date, days: int, order_type: Column | None = None
) -> DataFrame:
    """Open order lines due within the horizon, in pallets."""
    last = as_of + dt.timedelta(days=days)
    schedule = (
        in_months(src.client_table("vbep"), "tddat", as_of, last)
        .filter(digits_between(F.col("tddat"), as_of, last))
        .select("vbeln", "posnr", parse_yyyymmdd(F.col("tddat")).alias("date"), "wmeng")
    )
    lines = src.client_table("vbap").filter(F.col("abgru") == " ").select("vbeln", "posnr", "matnr", "werks")
    headers = src.table("vbak").select("vbeln", "kunnr", "auart")
    if order_type is not None:
        headers = headers.filter(order_type)
    materials = (
        src.client_table("mara")
        .filter(F.col("matkl").startswith("8") | F.col("matkl").startswith("9"))
        .join(pallets, F.col("matkl") == F.col("mat_group"))
        .select("matnr", "types", "pnum")
    )
    return (
        lines.join(schedule, ["vbeln", "posnr"])
        .join(headers, "vbeln")
        .join(materials, "matnr")
        .select(
            "date",
            F.col("werks").alias("plant"),
            F.col("kunnr").alias("customer"),
            F.col("auart").alias("order_type"),
            "types",
            quantity(div0(F.col("wmeng") * 1000, F.col("pnum"))).alias("pallets"),
        )
    )


def _production(src: Sources, pallets: DataFrame, grid: DataFrame, as_of: dt.date, days: int) -> DataFrame:
    """Planned production of the latest load per day; missing days take the group means."""
    lines = src.table("ztbbw_prd_lines").filter(F.col("ctg_rep") == "20")
    planned = (
        latest(lines, "dtcarga")
        .filter(F.col("mandt") == src.client)
        .filter(digits_between(F.col("dtplan"), as_of, as_of + dt.timedelta(days=days)))
        .select(parse_yyyymmdd(F.col("dtplan")).alias("date"), F.col("werks"), F.col("matkl"), "quantidade")
    )
    groups = src.client_table("t023t").filter(F.col("spras") == "P").select("matkl")
    plants = src.client_table("t001w").select("werks")
    per_group = (
        planned.join(groups, "matkl")
        .join(plants, "werks")
        .join(pallets, F.col("matkl") == F.col("mat_group"))
        .groupBy("date", F.col("werks").alias("plant"), "matkl", "types", "pnum")
        .agg(F.sum("quantidade").alias("pieces"))
        .withColumn("pallets", quantity(div0(F.col("pieces") * 1000000, F.col("pnum"))))
        .filter(F.col("pallets") > 0)
    )
    means = per_group.groupBy("plant", "matkl", "types").agg(
        quantity(div0(F.sum("pallets"), F.count("pallets"))).alias("mean_pallets")
    )
    wanted = grid.withColumn("types", F.explode(F.array(*[F.lit(t) for t in TYPES.values()])))
    filled = impute_mean(
        wanted, per_group, means, ["date", "plant", "types"], ["plant", "types"], "pallets", "mean_pallets"
    )
    return category_columns(filled, ["date", "plant"], "types", _named("production"), F.col("pallets"))


def _named(prefix: str) -> dict[str, str]:
    return {f"{prefix}_{t}": label for t, label in TYPES.items()}


def plant_capacity(
    src: Sources, as_of: dt.date, days: int = 30, plants: Sequence[str] | None = None
) -> DataFrame:
    """Daily projection per plant: capacity, stock, sales, production, balance, occupancy.

    ``plants`` limits the report to some plant codes (after code mapping). Places mapped
    to one plant add up to one capacity row per day.
    """
    pallets = _pallets(src, const.PALLETS_PLANT)
    locations = _locations(src)
    own = (
        src.table("warehousing_capacity")
        .filter(F.col("type") == "Plant")
        .groupBy(remap(F.col("location_code"), const.PLANT_CODES).alias("plant"))
        .agg(*[F.sum(f"{c}_capacity").alias(f"capacity_quantity_plant_{t}") for t, c in _CAPACITY.items()])
    )
    if plants is not None:
        own = own.filter(F.col("plant").isin(*plants))
    grid = spread_over(own.filter(F.col("plant").isNotNull()), as_of, days)

    # Each kind of fact is read once: its side and its type together name the column.
    keys = ["date", "plant"]
    value = F.col("pallets")
    stock = mark_sides(
        _stock(src, pallets), ["storage_location", "customer"], locations, "location_code", "side", "ag", "plant"
    )
    sales = due_lines(src, pallets, as_of, days).withColumn(
        "side", F.when(F.col("order_type") == "ZBA3", "ag").when(F.col("order_type") != "ZBA3", "plant")
    )
    side_type = F.concat(F.col("side"), F.lit("_"), F.lower("types"))
    parts = [
        category_columns(
            facts.withColumn("side_type", side_type),
            keys,
            "side_type",
            {f"{name}_{side}_{t}": f"{side}_{t}" for side in ("plant", "ag") for t in TYPES},
            value,
        )
        for facts, name in ((stock, "stock"), (sales, "sales"))
    ]
    parts.append(_production(src, pallets, grid.select("date", "plant"), as_of, days))
    external = (
        locations.join(src.client_table("t001k").select(F.col("bwkey").alias("plant")), "plant")
        .groupBy("plant")
        .agg(*[F.sum(f"{c}_capacity").alias(f"capacity_ag_{t}") for t, c in _CAPACITY.items()])
    )
    df = grid
    for part in parts:
        df = df.join(part, keys, "left")
    df = df.join(external, "plant", "left")

    zero = F.lit(0)
    df = df.withColumns({f"capacity_quantity_ag_{t}": F.coalesce(f"capacity_ag_{t}", zero) for t in TYPES})
    df = df.withColumns(
        {
            f"{what}_quantity_{where}_{t}": F.round(F.coalesce(f"{what}_{where}_{t}", zero), 0)
            for what, where in (("stock", "plant"), ("stock", "ag"), ("sales", "plant"), ("sales", "ag"))
            for t in TYPES
        }
        | {f"production_quantity_plant_{t}": F.round(F.coalesce(f"production_{t}", zero), 0) for t in TYPES}
    )
    df = df.withColumns(
        {
            name: F.col(f"{name}_cans") + F.col(f"{name}_ends")
            for name in (
                "capacity_quantity_plant",
                "capacity_quantity_ag",
                "stock_quantity_plant",
                "stock_quantity_ag",
                "sales_quantity_plant",
                "sales_quantity_ag",
                "production_quantity_plant",
            )
        }
    )
    ends = ("_cans", "_ends", "")
    df = df.withColumns(
        {
            f"capacity_quantity_total{e}": F.col(f"capacity_quantity_plant{e}") + F.col(f"capacity_quantity_ag{e}")
            for e in ends
        }
    )
    changes = {
        f"daily_result_plant{e}": F.col(f"stock_quantity_plant{e}")
        - F.col(f"sales_quantity_plant{e}")
        + F.col(f"production_quantity_plant{e}")
        for e in ends
    } | {f"daily_result_ag{e}": F.col(f"stock_quantity_ag{e}") - F.col(f"sales_quantity_ag{e}") for e in ends}
    df = running_balance(df, ["plant"], "date", changes)
    df = df.withColumns(
        {f"daily_result_total{e}": F.col(f"daily_result_plant{e}") + F.col(f"daily_result_ag{e}") for e in ends}
    )
    df = df.withColumns(
        {
            f"warehouse_ocupation_{w}{e}": div0(F.col(f"daily_result_{w}{e}"), F.col(f"capacity_quantity_{w}{e}"))
            for w in ("plant", "ag", "total")
            for e in ends
        }
    )
    return df.select("date", "plant", *PLANT_MEASURES)


_CAPACITY = {"cans": "can", "ends": "end"}
_SPLIT = ("_cans", "_ends", "")
PLANT_MEASURES = tuple(
    f"{name}{e}"
    for name in (
        "capacity_quantity_plant",
        "capacity_quantity_ag",
        "capacity_quantity_total",
        "stock_quantity_plant",
        "stock_quantity_ag",
        "sales_quantity_plant",
        "sales_quantity_ag",
        "production_quantity_plant",
        "daily_result_plant",
        "daily_result_ag",
        "daily_result_total",
        "warehouse_ocupation_plant",
        "warehouse_ocupation_ag",
        "warehouse_ocupation_total",
    )
    for e in _SPLIT
)
WAREHOUSE_MEASURES = tuple(
    f"{name}_ag_only{e}"
    for name in ("capacity_quantity", "stock_quantity", "sales_quantity", "daily_result", "warehouse_ocupation")
    for e in _SPLIT
)


def warehouse_capacity(
    src: Sources,
    as_of: dt.date,
    days: int = 30,
    plants: Sequence[str] | None = None,
    match_warehouse: bool = False,
) -> DataFrame:
    """Daily projection per outside warehouse.

    Sales are joined by day and plant, so each warehouse of a plant repeats the plant's
    sales, one row per buying customer; ``match_warehouse`` joins them by warehouse too.
    Days with several customers accumulate in customer order.
    """
    pallets = _pallets(src, const.PALLETS_WAREHOUSE)
    locations = _locations(src)
    if plants is not None:
        locations = locations.filter(F.col("plant").isin(*plants))
    all_locations = _locations(src)
    grid = densify(
        locations.select("plant", F.col("location_code").alias("warehouse")), ["plant", "warehouse"], as_of, days
    )
    keys = ["date", "plant", "warehouse"]
    value = F.col("pallets")
    stocked = stack_by_alt_key(
        _stock(src, pallets), ["storage_location", "customer"], all_locations, "location_code", "warehouse"
    ).filter(F.col("warehouse") != " ")
    stock = category_columns(stocked, keys, "types", _named("stock"), value)
    sold = due_lines(src, pallets, as_of, days, F.col("auart") == "ZBA3")
    sales = category_columns(sold, ["date", "plant", "customer"], "types", _named("sales"), value)
    capacity = (
        locations.join(src.client_table("t001k").select(F.col("bwkey").alias("plant")), "plant")
        .groupBy("plant", F.col("location_code").alias("warehouse"))
        .agg(*[F.sum(f"{c}_capacity").alias(f"capacity_{t}") for t, c in _CAPACITY.items()])
    )
    df = grid.join(stock, keys, "left").join(capacity, ["plant", "warehouse"], "left")
    if match_warehouse:
        df = df.join(sales.withColumn("warehouse", F.col("customer")), keys, "left")
    else:
        df = df.join(sales, ["date", "plant"], "left")

    zero = F.lit(0)
    df = df.withColumns({f"capacity_quantity_ag_only_{t}": F.coalesce(f"capacity_{t}", zero) for t in TYPES})
    df = df.withColumns(
        {
            f"{what}_quantity_ag_only_{t}": F.round(F.coalesce(f"{what}_{t}", zero), 0)
            for what in ("stock", "sales")
            for t in TYPES
        }
    )
    df = df.withColumns(
        {
            f"{what}_quantity_ag_only": F.col(f"{what}_quantity_ag_only_cans") + F.col(f"{what}_quantity_ag_only_ends")
            for what in ("capacity", "stock", "sales")
        }
    )
    # without the match by warehouse, a warehouse has the sales of all customers of its plant
    df = running_balance_in_blocks(
        df,
        ["plant", "warehouse"],
        ["date", "customer"],
        {
            f"daily_result_ag_only{e}": F.col(f"stock_quantity_ag_only{e}") - F.col(f"sales_quantity_ag_only{e}")
            for e in _SPLIT
        },
    )
    df = df.withColumns(
        {
            f"warehouse_ocupation_ag_only{e}": div0(
                F.col(f"daily_result_ag_only{e}"), F.col(f"capacity_quantity_ag_only{e}")
            )
            for e in _SPLIT
        }
    )
    return df.select("date", "plant", "warehouse", *WAREHOUSE_MEASURES)


def packaging_availability(src: Sources) -> DataFrame:
    """Packaging stock in pallets per material and plant against the plant's places."""
    packs = inline(src.spark, ["material", "material_type", "pieces"], const.PACKAGING)
    packs = packs.withColumn("pieces", F.col("pieces").cast("decimal(5,1)"))
    codes = sorted({code for code, _, _ in const.PACKAGING})
    stock = (
        src.table("vw_fct_inventory_aging")
        .filter(F.col("material").isin(*codes))
        .join(packs, "material")
        .groupBy(F.col("date_of_analysis").alias("date"), "material", "material_type", "plant")
        .agg(F.sum(quantity(div0(F.col("stock_at_plant"), F.col("pieces")))).alias("utilization_quantity"))
    )
    materials = src.client_table("mara").select(F.col("matnr").alias("material"), F.col("mtart").alias("material_type"))
    texts = (
        src.client_table("makt")
        .filter(F.col("spras") == "P")
        .select(F.col("matnr").alias("material"), F.col("maktx").alias("material_description"))
    )
    places = (
        src.table("warehousing_capacity")
        .filter(F.col("type") == "Plant")
        .select("plant", (F.col("pallet_capacity") + F.col("topframe_capacity")).alias("packaging_capacity"))
    )
    return (
        stock.join(materials, ["material", "material_type"])
        .join(texts, "material")
        .join(places, "plant")
        .select(
            "date",
            "material",
            "material_type",
            "material_description",
            "plant",
            "utilization_quantity",
            "packaging_capacity",
            div0(F.col("utilization_quantity"), F.col("packaging_capacity")).alias("packaging_utilization"),
        )
    )
