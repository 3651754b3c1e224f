"""Cost lines with their centre, account, allocation, application: shared by the reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions import charge_share
from tallyworks.operators.membership import latest_plan
from tallyworks.sources import Sources

PLAN, PLAN_NAME = "tco_financial_plan", "tco_financial_planname"


def newest(src: Sources) -> Column:
    """Name of the latest plan. Plans are compared as text."""
    return latest_plan(src.table("tco_financial_plan"))


def costs(src: Sources, latest_only: bool = True) -> DataFrame:
    df = src.table("tco_cost").select(
        "tco_costid",
        "tco_cost_id",
        F.col("tco_cost_financial_plan"),
        F.col("tco_cost_financial_planname"),
        "tco_cost_gl_account",
        "tco_cost_gl_accountname",
        "tco_cost_value",
        "tco_stringmonth",
        "tco_cost_cost_center",
        F.upper("tco_stringmonth").alias("_month"),
    )
    return df.filter(F.col("tco_cost_financial_planname") == newest(src)) if latest_only else df


def growing(df: DataFrame) -> DataFrame:
    """A dimension that grows with customers or applications: always sorted and merged, never sent to the driver.

    Spark plans a broadcast by an estimate from file sizes, which leaves out how often ``explode`` repeats a row and how far
    columns unpack, so millions of rows may pass for less than 10 MB.
    """
    return df.hint("merge")


def _on_plan(src: Sources, df: DataFrame, plan: str, name: str, by_id: bool) -> tuple[DataFrame, list[str]]:
    """A dimension's rows of the cost's own plan (a join key) or of the latest plan (a filter)."""
    if by_id:
        return df.withColumnRenamed(plan, "tco_cost_financial_plan").drop(name), ["tco_cost_financial_plan"]
    return df.filter(F.col(name) == newest(src)).drop(plan, name), []


def with_centers(src: Sources, df: DataFrame, by_id: bool) -> DataFrame:
    centers = src.table("tco_cost_center").select(
        F.col("tco_cost_centerid").alias("tco_cost_cost_center"),
        "tco_cost_center_id",
        "tco_cost_center_nm",
        "tco_function",
        "tco_totalassigned",
        F.col("tco_capabilityowner").alias("center_owner_id"),
        F.col("tco_capabilityownername").alias("center_owner"),
        F.col("tco_capabilityowneryominame").alias("center_owner_yomi"),
        PLAN,
        PLAN_NAME,
    )
    centers, keys = _on_plan(src, centers, PLAN, PLAN_NAME, by_id)
    return df.join(growing(centers), ["tco_cost_cost_center", *keys], "left")


def with_accounts(src: Sources, df: DataFrame, by_id: bool, how: str = "inner") -> DataFrame:
    """Accounts marked for display; ``how='left'`` keeps costs without one."""
    accounts = (
        src.table("tco_gl_account")
        .filter(F.col("tco_todisplay").cast("string") == "1")
        .select(
            F.col("tco_gl_accountid").alias("tco_cost_gl_account"),
            "tco_gl_account_id",
            "tco_gl_account_account_group",
            "tco_gl_account_account_groupname",
            PLAN,
            PLAN_NAME,
        )
    )
    accounts, keys = _on_plan(src, accounts, PLAN, PLAN_NAME, by_id)
    return df.join(accounts, ["tco_cost_gl_account", *keys], how)


def with_allocation(src: Sources, df: DataFrame, by_id: bool) -> DataFrame:
    """The centre's percentage per account and month."""
    plan, name = "tco_cost_center_allocation_financial_plan", "tco_cost_center_allocation_financial_planname"
    shares = src.table("tco_cost_center_allocation").select(
        F.col("tco_cost_center_allocation_cost_center").alias("tco_cost_cost_center"),
        F.col("tco_cost_center_allocation_gl_account").alias("tco_cost_gl_account"),
        F.upper("tco_monthname").alias("_month"),
        F.col("tco_assignment").alias("center_pct"),
        plan,
        name,
    )
    shares, keys = _on_plan(src, shares, plan, name, by_id)
    return df.join(growing(shares), ["tco_cost_cost_center", "tco_cost_gl_account", "_month", *keys], "left")


def with_applications(src: Sources, df: DataFrame, by_id: bool) -> DataFrame:
    """Application percentages and the applications; costs of inactive ones are dropped."""
    shares = src.table("tco_application_assignment").select(
        F.col("tco_cost_center").alias("tco_cost_cost_center"),
        F.col("tco_gl_account").alias("tco_cost_gl_account"),
        F.upper("tco_monthname").alias("_month"),
        F.col("tco_application").alias("tco_applicationid"),
        F.col("tco_assignment").alias("application_pct"),
        PLAN,
        PLAN_NAME,
    )
    apps = src.table("tco_application").filter(F.col("statuscodename") == "Active").select(
        "tco_applicationid",
        "tco_application_id",
        "tco_application_name",
        F.col("tco_capabilityownername").alias("app_owner"),
        "tco_shared_component_type",
        "tco_shared_component_typename",
        PLAN,
        F.col(PLAN_NAME).alias("app_plan_name"),
    )
    shares, keys = _on_plan(src, shares, PLAN, PLAN_NAME, by_id)
    df = df.join(growing(shares), ["tco_cost_cost_center", "tco_cost_gl_account", "_month", *keys])
    if by_id:
        return df.join(growing(apps.withColumnRenamed(PLAN, "tco_cost_financial_plan")), ["tco_applicationid", *keys])
    apps = apps.filter(F.col("app_plan_name") == newest(src)).drop(PLAN, "app_plan_name")
    return df.join(growing(apps), "tco_applicationid")


def center_share(df: DataFrame) -> Column:
    return charge_share(df, F.col("tco_cost_value"), F.col("center_pct"))


def application_share(df: DataFrame) -> Column:
    return charge_share(df, F.col("tco_cost_value"), F.col("center_pct"), F.col("application_pct"))
