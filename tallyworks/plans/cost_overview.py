"""Direct and shared costs by application, component, owner and region."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.functions import text_key
from tallyworks.operators.allocate import factor_of, pair_with, subtotal, weigh
from tallyworks.plans import cost_base as base
from tallyworks.plans.cost_base import PLAN, PLAN_NAME
from tallyworks.session import stage
from tallyworks.sources import Sources

REGION = "tco_buregionname"
COMPONENT = "tco_shared_component_typename"


def application_totals(src: Sources, centers: bool = True, reuse: bool = True) -> DataFrame:
    """Charged costs per application, before any region or component.

    The one pass over the cost lines that the overview reports need. Plans and the display
    mark stay among the keys, so that each report cuts its own part; with ``reuse`` the
    result, small next to the costs, is written once and read by every branch.
    """
    df = base.with_accounts(src, base.costs(src, latest_only=False), by_id=True, how="left")
    if centers:
        df = base.with_centers(src, df, by_id=True)
    df = base.with_applications(src, base.with_allocation(src, df, by_id=True), by_id=True)
    keys = ["tco_cost_financial_plan", "tco_cost_financial_planname", "displayed", "tco_applicationid"]
    keys += ["tco_application_name", "app_plan_name", "app_owner", COMPONENT]
    keys += ["center_owner", "tco_function"] if centers else []
    df = df.withColumn("displayed", F.col("tco_gl_account_id").isNotNull())
    totals = subtotal(df, keys, base.application_share(df), "app_total").withColumnRenamed("tco_cost_financial_plan", PLAN)
    return stage(totals, "application-totals") if reuse else totals


def _of_latest_applications(src: Sources, totals: DataFrame) -> DataFrame:
    return totals.filter(F.col("app_plan_name") == base.newest(src)).withColumnRenamed("app_plan_name", PLAN_NAME)


def _regions(src: Sources) -> DataFrame:
    """Shares of each application by region, a row for each application, plan and region."""
    regions = src.table("tco_application_buregion_assign").select(
        F.col("tco_application").alias("tco_applicationid"), PLAN, REGION, F.col("tco_assignment").alias("region_pct")
    )
    return base.growing(regions)


def _component_regions(src: Sources) -> DataFrame:
    return src.table("tco_shared_component_buregion_assignment").select(
        REGION,
        PLAN,
        F.col("tco_shared_component_assignmentname").alias("tco_name"),
        F.col("tco_assignment").alias("component_region_pct"),
    )


def _with_regions(src: Sources, totals: DataFrame) -> DataFrame:
    df = totals.join(_regions(src), ["tco_applicationid", PLAN], "left")
    return df.join(_component_regions(src), [REGION, PLAN], "left")


def _component_names(src: Sources) -> DataFrame:
    return src.table("tco_shared_component_assignment").select("tco_name", F.col(COMPONENT).alias("component"))


def _key(component: str = COMPONENT, kind: str = "shared"):
    return text_key(F.col(PLAN_NAME), F.lit(kind), F.col(component), F.col(REGION)).alias("pk")


def regional_cost(src: Sources, reuse: bool = True, totals: DataFrame | None = None) -> DataFrame:
    """Costs by application and region: shared-component rows and direct rows."""
    totals = application_totals(src, reuse=reuse) if totals is None else totals
    shared = (
        _with_regions(src, _of_latest_applications(src, totals))
        .join(_component_names(src), "tco_name", "left")
        .groupBy(
            PLAN,
            PLAN_NAME,
            "app_owner",
            "tco_application_name",
            "component",
            "tco_function",
            REGION,
            "region_pct",
            "component_region_pct",
        )
        .agg(F.sum("app_total").alias("sum_app_assignment"))
    )
    shared = shared.select(
        _key("component"),
        PLAN,
        PLAN_NAME,
        F.col("app_owner").alias("tco_capabilityownername"),
        "tco_application_name",
        F.lit("shared").alias("tco_cost_type"),
        F.col("component").alias(COMPONENT),
        "tco_function",
        REGION,
        factor_of(shared, F.col("component_region_pct")).alias("tco_buregion_assignment"),
        "sum_app_assignment",
        weigh(shared, F.col("sum_app_assignment"), F.col("region_pct"), 2).alias(_AMOUNT),
    )
    direct = (
        totals.filter(F.col("tco_cost_financial_planname") == base.newest(src))
        .withColumnRenamed("tco_cost_financial_planname", PLAN_NAME)
        .join(_regions(src), ["tco_applicationid", PLAN], "left")
        .groupBy(PLAN, PLAN_NAME, "center_owner", "tco_application_name", "tco_function", REGION, "region_pct")
        .agg(F.sum("app_total").alias("sum_app_assignment"))
        .withColumn(COMPONENT, F.lit("Direct"))
    )
    direct = direct.select(
        _key(kind="direct"),
        PLAN,
        PLAN_NAME,
        F.col("center_owner").alias("tco_capabilityownername"),
        "tco_application_name",
        F.lit("direct").alias("tco_cost_type"),
        COMPONENT,
        "tco_function",
        REGION,
        factor_of(direct, F.col("region_pct")).alias("tco_buregion_assignment"),
        "sum_app_assignment",
        weigh(direct, F.col("sum_app_assignment"), F.col("region_pct")).alias(_AMOUNT),
    )
    return shared.unionByName(direct)


_AMOUNT = "tco_total_shared_component_app_buregion_assignment_amt"


def shared_cost(src: Sources, reuse: bool = True, totals: DataFrame | None = None) -> DataFrame:
    """Shared-component costs by owner and region.

    Applications count for the component they are typed as, and for every component they
    are assigned to; the two lists repeat an application as often as they name it. Only
    the first list is cut to the costs of the latest plan. ``totals`` must not carry
    cost centres.
    """
    totals = application_totals(src, centers=False, reuse=reuse) if totals is None else totals
    shown = _of_latest_applications(src, totals.filter("displayed"))
    assignments = src.table("tco_shared_component_assignment")
    typed = shown.filter(F.col("tco_cost_financial_planname") == base.newest(src)).join(
        assignments.filter(F.col("tco_assignment_type") == "bu-region").select(COMPONENT), COMPONENT, "left"
    )
    named = assignments.select(
        F.col("tco_name").alias("_name"), F.col(PLAN).alias("_plan"), F.col(COMPONENT).alias("_component")
    )
    listed = src.table("tco_shared_component_app_assignment").select(
        F.col("tco_application").alias("tco_applicationid"),
        F.col("tco_shared_component_assignmentname").alias("_name"),
        F.col(PLAN).alias("_plan"),
    )
    assigned = (
        shown.drop(COMPONENT)
        .join(base.growing(listed), "tco_applicationid", "left")
        .join(named, ["_name", "_plan"], "left")
        .withColumnRenamed("_component", COMPONENT)
    )
    columns = ["tco_applicationid", "tco_application_name", PLAN, PLAN_NAME, "app_owner", COMPONENT, "app_total"]
    both = typed.select(*columns).unionByName(assigned.select(*columns))
    per_app = (
        _with_regions(src, both)
        .groupBy(PLAN, PLAN_NAME, "app_owner", "tco_application_name", COMPONENT, REGION, "component_region_pct")
        .agg(F.sum("app_total").alias("sum_app_assignment"))
    )
    by_owner = per_app.groupBy(PLAN, PLAN_NAME, "app_owner", COMPONENT, REGION, "component_region_pct").agg(
        F.sum("sum_app_assignment").alias("total")
    )
    return by_owner.select(
        _key(),
        PLAN,
        F.col("app_owner").alias("tco_capabilityownername"),
        COMPONENT,
        REGION,
        weigh(by_owner, F.col("total"), F.col("component_region_pct")).alias("total_sum_app_assignment"),
    )


def shared_total(src: Sources, reuse: bool = True, totals: DataFrame | None = None) -> DataFrame:
    """Shared-component total by region; rounded per application and again in total."""
    totals = application_totals(src, reuse=reuse) if totals is None else totals
    per_app = (
        _with_regions(src, _of_latest_applications(src, totals))
        .join(_component_names(src), "tco_name", "left")
        .groupBy("tco_application_name", PLAN_NAME, "component", REGION, "region_pct")
        .agg(F.sum("app_total").alias("total"))
    )
    return (
        per_app.withColumn("amount", weigh(per_app, F.col("total"), F.col("region_pct"), 2))
        .groupBy(REGION, PLAN_NAME, "component")
        .agg(F.round(F.sum("amount"), 2).alias("tco_shared_component_buregion_assignment_amt"))
        .select(
            _key("component"),
            REGION,
            PLAN_NAME,
            F.col("component").alias(COMPONENT),
            "tco_shared_component_buregion_assignment_amt",
        )
    )


def shared_by_region(src: Sources) -> DataFrame:
    """Amounts assigned to applications, for every region, with the region's share.

    Every assignment appears once per region, so the region list, a small dimension, is
    paired with the assignments after both have been cut to the latest plan.
    """
    amounts = (
        src.table("tco_shared_component_app_assignment")
        .filter(F.col(PLAN_NAME) == base.newest(src))
        .select(
            F.col("tco_shared_component_assignmentname").alias("tco_name"),
            PLAN,
            PLAN_NAME,
            F.col("tco_applicationname").alias("tco_application_name"),
            "tco_dolassigned",
        )
    )
    components = src.table("tco_shared_component_assignment").select("tco_name", PLAN, COMPONENT)
    descriptions = src.table("tco_shared_component_type").select(F.col("tco_description").alias(COMPONENT))
    regions = (
        src.table("tco_business_unit_region")
        .select(F.col("tco_business_unit_region_name").alias(REGION))
        .join(src.table("tco_shared_component_buregion_assignment").select(REGION), REGION, "left")
        .groupBy(REGION)
        .agg(F.count(F.lit(1)).alias("times"))
    )
    apps = src.table("tco_application").select(
        "tco_application_name",
        PLAN,
        PLAN_NAME,
        "tco_applicationid",
        F.col("tco_capabilityownername").alias("owner"),
    )
    functions = (
        src.table("tco_application_assignment")
        .select(F.col("tco_applicationname").alias("tco_application_name"), PLAN, F.col("tco_cost_center"))
        .distinct()
        .join(
            src.table("tco_cost_center").select(F.col("tco_cost_centerid").alias("tco_cost_center"), PLAN, "tco_function"),
            ["tco_cost_center", PLAN],
            "left",
        )
        .select("tco_application_name", PLAN, "tco_function")
        .distinct()
    )
    owners = (
        apps.filter(F.col(PLAN_NAME) == base.newest(src))
        .join(functions, ["tco_application_name", PLAN], "left")
        .join(_regions(src), ["tco_applicationid", PLAN], "left")
        .select(PLAN_NAME, "tco_application_name", "owner", "tco_function", REGION, "region_pct")
        .distinct()
    )
    named = amounts.join(components, ["tco_name", PLAN]).join(descriptions, COMPONENT, "left")
    paired = pair_with(named, regions).withColumn("_time", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    known = owners.withColumn("matched_region", F.col(REGION))
    weighed = paired.join(known, ["tco_application_name", PLAN_NAME, REGION], "left")
    return weighed.select(
        _key(),
        PLAN,
        F.col("owner").alias("tco_capabilityownername"),
        "tco_function",
        "tco_application_name",
        F.lit("shared").alias("tco_cost_type"),
        COMPONENT,
        F.col("matched_region").alias(REGION),
        factor_of(weighed, F.col("region_pct")).alias("tco_shared_component_buregion_assignment_perc"),
        F.col("tco_dolassigned").alias("tco_shared_component_app_assignment_amt"),
        weigh(weighed, F.col("tco_dolassigned"), F.col("region_pct"), 2).alias(
            "tco_total_shared_component_app_buregion_assignment_amt"
        ),
    )


def cost_overview(src: Sources, reuse: bool = True) -> dict[str, DataFrame]:
    """The four overview reports from one pass over the costs with centres, and one without."""
    totals = application_totals(src, reuse=reuse)
    return {
        "regional_cost": regional_cost(src, totals=totals),
        "shared_cost": shared_cost(src, reuse=reuse),
        "shared_total": shared_total(src, totals=totals),
        "shared_by_region": shared_by_region(src),
    }
