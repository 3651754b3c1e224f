"""Completeness checks on the cost inputs of the latest plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.functions import flag
from tallyworks.operators.validate import counts_match, coverage, fully_covered, is_present, sums_to, total_by
from tallyworks.plans.cost_base import PLAN, PLAN_NAME, newest
from tallyworks.sources import Sources


def _latest(src: Sources, name: str) -> DataFrame:
    return src.table(name).filter(F.col(PLAN_NAME) == newest(src))


def _active_applications(src: Sources) -> DataFrame:
    return _latest(src, "tco_application").filter(F.col("statuscodename") == "Active")


def _functions(src: Sources) -> DataFrame:
    """Owner and function pairs of the latest plan's centres."""
    return _latest(src, "tco_cost_center").select("tco_capabilityownername", "tco_function").distinct()


def region_assignment(src: Sources) -> DataFrame:
    """Do the region percentages of each application sum to 100."""
    totals = total_by(
        src.table("tco_application_buregion_assign"),
        {"tco_applicationid": "tco_application", PLAN: PLAN},
        "tco_assignment",
    )
    return (
        _active_applications(src)
        .join(totals, ["tco_applicationid", PLAN], "left")
        .join(_functions(src), "tco_capabilityownername", "left")
        .select(
            PLAN,
            "tco_applicationid",
            "tco_application_name",
            "tco_capabilityownername",
            "tco_ownerstring",
            "tco_function",
            "total_assignment",
            sums_to(F.col("total_assignment")).alias("assignment_check"),
            flag(F.col("tco_applicationid").isNotNull()).alias("appburegion_count"),
        )
        .distinct()
    )


def cost_center_assignment(src: Sources) -> DataFrame:
    """Does each cost centre have an allocation."""
    totals = total_by(
        src.table("tco_cost_center_allocation"),
        {
            "tco_cost_centerid": "tco_cost_center_allocation_cost_center",
            PLAN: "tco_cost_center_allocation_financial_plan",
        },
        "tco_assignment",
    )
    return (
        _latest(src, "tco_cost_center")
        .join(totals, ["tco_cost_centerid", PLAN], "left")
        .select(
            PLAN,
            "tco_cost_centerid",
            "tco_cost_center_id",
            "tco_cost_center_nm",
            "tco_capabilityownername",
            "tco_function",
            "total_assignment",
            is_present(F.col("total_assignment")).alias("assignment_check"),
            flag(F.col("tco_cost_centerid").isNotNull()).alias("cc_alloc_count"),
        )
        .distinct()
    )


def application_assignment(src: Sources) -> DataFrame:
    """Are as many centres assigned to an application as its owner has.

    Assigned centres are counted over all plans, the owner's centres in the latest one.
    """
    shares = src.table("tco_application_assignment")
    app = F.col("tco_application").alias("tco_applicationid")
    in_plan = F.when(F.col(PLAN_NAME) == newest(src), F.col("tco_assignment"))
    totals = shares.groupBy(app, PLAN).agg(F.sum(in_plan).alias("total_assignment")).withColumn("_known", F.lit(True))
    assigned = shares.groupBy(app).agg(F.countDistinct("tco_cost_center").alias("n_assigned"))
    available = (
        _latest(src, "tco_cost_center")
        .groupBy("tco_capabilityownername")
        .agg(F.count("tco_cost_centerid").alias("n_available"))
    )
    n_assigned = F.when(F.col("_known"), F.coalesce("n_assigned", F.lit(0))).otherwise(F.lit(0))
    df = (
        _active_applications(src)
        .join(totals, ["tco_applicationid", PLAN], "left")
        .join(assigned, "tco_applicationid", "left")
        .join(available, "tco_capabilityownername", "left")
        .join(_functions(src).filter(F.col("tco_function").isNotNull()), "tco_capabilityownername")
        .withColumn("assigned_cost_center_count", n_assigned)
        .withColumn("cost_center_count", F.coalesce("n_available", F.lit(0)))
    )
    check = counts_match(
        F.col("assigned_cost_center_count"), F.col("cost_center_count"), F.col("total_assignment")
    )
    return df.select(
        PLAN,
        "tco_applicationid",
        "tco_application_name",
        "tco_application_id",
        "tco_capabilityownername",
        "tco_ownername",
        "tco_function",
        "assigned_cost_center_count",
        "cost_center_count",
        check.alias("assignment_check"),
        flag(F.col("tco_applicationid").isNotNull()).alias("app_assignment_count"),
    ).distinct()


def shared_component_assignment(src: Sources) -> DataFrame:
    """Is each shared component assigned in the latest plan.

    ``assignment_check`` only asks whether an assignment exists; ``sums_to_100`` tells
    whether its percentages are complete.
    """

    def shares(name: str, out: str) -> DataFrame:
        keys = {"tco_shared_component_assignmentid": "tco_shared_component_assignment", PLAN_NAME: PLAN_NAME}
        return total_by(src.table(name), keys, "tco_assignment", out)

    keys = ["tco_shared_component_assignmentid", PLAN_NAME]
    total = F.when(F.col("tco_assignment_type") == "app", F.col("by_app")).otherwise(F.col("by_region"))
    found = (
        _latest(src, "tco_shared_component_assignment")
        .join(shares("tco_shared_component_app_assignment", "by_app"), keys, "left")
        .join(shares("tco_shared_component_buregion_assignment", "by_region"), keys, "left")
        .select(
            F.col("tco_shared_component_type").alias("tco_shared_component_typeid"),
            PLAN,
            total.alias("total_assignment"),
            F.lit(1).alias("_found"),
        )
        .distinct()
    )
    return src.table("tco_shared_component_type").join(found, "tco_shared_component_typeid", "left").select(
        "tco_description",
        "tco_ownername",
        is_present(F.col("_found")).alias("assignment_check"),
        sums_to(F.col("total_assignment")).alias("sums_to_100"),
        F.lit(1).alias("shared_comp_count"),
    )


def _asset_centers(src: Sources) -> DataFrame:
    return _latest(src, "tco_cost_center").select(
        F.col("tco_cost_centerid").alias("tco_cost_center"), PLAN_NAME, "tco_capabilityownername", "tco_function"
    )


def asset_assignment(src: Sources) -> DataFrame:
    """Share of a centre's application-related assets that name an application."""
    assets = _latest(src, "tco_assets").filter(F.col("tco_net_book_value") > 1)
    related = F.col("tco_app_releted") == 1
    item = F.col("tco_asset_item_number")
    counts = assets.groupBy(PLAN, "tco_cost_center").agg(
        F.count(F.when(related & F.col("tco_application").isNotNull(), item)).alias("total_assignment"),
        F.count(F.when(related, item)).alias("assets_per_costctr"),
    )
    part, whole = F.col("total_assignment"), F.col("assets_per_costctr")
    return (
        assets.select(PLAN, PLAN_NAME, "tco_cost_center", "tco_cost_centername")
        .distinct()
        .join(counts, [PLAN, "tco_cost_center"])
        .join(_asset_centers(src), ["tco_cost_center", PLAN_NAME])
        .filter(F.col("tco_function").isNotNull())
        .select(
            PLAN,
            "tco_capabilityownername",
            "tco_cost_center",
            "tco_cost_centername",
            "tco_function",
            "total_assignment",
            "assets_per_costctr",
            coverage(part, whole).alias("asset_total_assignment"),
            fully_covered(part, whole).alias("asset_assignment_check"),
            F.lit(1).alias("asset_count"),
        )
        .distinct()
    )


def asset_details(src: Sources) -> DataFrame:
    """The assets behind the check, one row per asset and application."""
    assets = _latest(src, "tco_assets")
    columns = [
        PLAN,
        PLAN_NAME,
        "tco_capabilityownername",
        "tco_asset_item_number",
        "tco_description",
        "tco_app_reletedname",
        "tco_cost_center",
        "tco_cost_centername",
        "tco_function",
    ]
    return (
        assets.join(_asset_centers(src).filter(F.col("tco_function").isNotNull()), ["tco_cost_center", PLAN_NAME])
        .select(*columns, "tco_application")
        .distinct()
        .select(*columns)
    )
