"""Financial reports on allocated costs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.functions import charge_share, flag
from tallyworks.operators.allocate import split_cost
from tallyworks.operators.validate import multi_valued, zero_total
from tallyworks.plans import cost_base as base
from tallyworks.sources import Sources

_COST = (
    "tco_costid",
    "tco_cost_id",
    "tco_cost_financial_plan",
    "tco_cost_financial_planname",
    "tco_cost_gl_account",
    "tco_cost_gl_accountname",
    "tco_cost_value",
    "tco_stringmonth",
)
_ACCOUNT = ("tco_gl_account_id", "tco_gl_account_account_group", "tco_gl_account_account_groupname")


def _latest_chain(src: Sources) -> DataFrame:
    df = base.with_accounts(src, base.costs(src), by_id=False)
    df = base.with_centers(src, df, by_id=False)
    df = base.with_allocation(src, df, by_id=False)
    return base.with_applications(src, df, by_id=False)


def cost_to_application(src: Sources) -> DataFrame:
    """Each cost line with what it charges to each active application."""
    value, center, app = F.col("tco_cost_value"), F.col("center_pct"), F.col("application_pct")
    df = _latest_chain(src)
    share = base.application_share(df)
    return df.select(
        *_COST,
        "tco_cost_center_id",
        "tco_cost_center_nm",
        "tco_function",
        "tco_totalassigned",
        F.col("center_owner").alias("tco_capabilityownername"),
        F.col("center_owner_yomi").alias("tco_capabilityowneryominame"),
        *_ACCOUNT,
        base.center_share(df).alias("app_assigned_amount"),
        flag(center.isNotNull()).alias("cost_center_assignment_complete"),
        flag(app.isNotNull()).alias("application_assignment_complete"),
        app.alias("application_assignment"),
        share.alias("app_assignment"),
        charge_share(df, value, app).alias("app_assignment2"),
        # 100 less the amount, as reported; not the unassigned percentage.
        (F.lit(100) - share).alias("app_unassigned"),
        "tco_applicationid",
        "tco_application_id",
        "tco_application_name",
        "tco_shared_component_typename",
    )


def cost_to_center(src: Sources) -> DataFrame:
    """Each cost line split into its allocated part and the remaining service part."""
    df = base.with_accounts(src, base.costs(src), by_id=True)
    df = base.with_centers(src, df, by_id=True)
    df = base.with_allocation(src, df, by_id=True)
    allocated, service = split_cost(df, F.col("tco_cost_value"), F.col("center_pct"))
    return df.select(
        *_COST,
        "tco_cost_center_id",
        "tco_cost_center_nm",
        "tco_function",
        F.col("center_owner_id").alias("tco_capabilityowner"),
        F.col("center_owner").alias("tco_capabilityownername"),
        "tco_totalassigned",
        *_ACCOUNT,
        F.col("center_pct").alias("tco_assignment"),
        allocated.alias("app_assigned_amount"),
        service.alias("service_assigned_amount"),
        flag(F.col("center_pct").isNotNull()).alias("assignment_complete"),
    )


def _owned(src: Sources) -> DataFrame:
    """Distinct application, plan and charging centre.

    The reports on owners only ask which combinations occur, so cost lines and
    assignments are reduced to their distinct keys before they meet.
    """
    keys = ["tco_cost_cost_center", "tco_cost_gl_account", "_month", "tco_cost_financial_plan"]
    lines = base.costs(src).select(*keys).distinct()
    df = base.with_applications(src, base.with_accounts(src, lines, by_id=False), by_id=False)
    pairs = (
        df.filter(F.col("tco_application_id").isNotNull())
        .select("tco_application_id", "tco_application_name", "tco_cost_financial_plan", "tco_cost_cost_center")
        .distinct()
    )
    return base.with_centers(src, pairs, by_id=False)


def cross_owner_details(src: Sources) -> DataFrame:
    """Applications with every centre and owner that charges them."""
    return (
        _owned(src)
        .select(
            "tco_application_id",
            "tco_application_name",
            "tco_cost_financial_plan",
            "tco_cost_center_id",
            "tco_cost_center_nm",
            F.col("center_owner").alias("tco_capabilityownername"),
            "tco_function",
        )
        .distinct()
    )


def cross_owner_counts(src: Sources) -> DataFrame:
    """Applications charged by centres of more than one owner."""
    keys = ["tco_application_id", "tco_application_name", "tco_cost_financial_plan"]
    return multi_valued(_owned(src), keys, "center_owner", "count_owner")


def zero_cost_applications(src: Sources) -> DataFrame:
    """Active applications whose charged costs total 0 for some centre."""
    df = base.with_applications(src, base.with_allocation(src, base.costs(src), by_id=True), by_id=True)
    plan = ["tco_cost_financial_plan", "tco_cost_financial_planname"]
    per_center = df.groupBy(
        *plan, "tco_cost_cost_center", "tco_application_id", "tco_application_name"
    ).agg(F.sum(base.application_share(df)).alias("share"))
    owner = ["tco_cost_center_id", "tco_cost_center_nm", "center_owner", "tco_function"]
    totals = zero_total(
        base.with_centers(src, per_center, by_id=True),
        [*plan, *owner, "tco_application_id", "tco_application_name"],
        F.col("share"),
        "total_app_assignment",
    )
    return (
        totals.select(
            *plan,
            F.col("center_owner").alias("tco_capabilityownername"),
            "total_app_assignment",
            "tco_application_id",
            "tco_application_name",
            F.lit(1).alias("app_with_no_cost_count"),
            "tco_function",
        )
        .distinct()
    )
