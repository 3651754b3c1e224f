"""The end-to-end reports as registered queries."""

from __future__ import annotations

from checks import capacity_reports as cap
from checks import cost_reports as cost
from checks import invoice_reports as inv
from checks import transit_reports as tr
from checks.adapters import AS_OF, CHECK_AS_OF, LEDGER_AS_OF, adapted
from checks.registry import register
from tallyworks import plans

register(
    "report_plant_capacity",
    lambda spark, sf: plans.plant_capacity(adapted(spark, sf), AS_OF),
    cap.plant_sql(),
)
register(
    "report_warehouse_capacity",
    lambda spark, sf: plans.warehouse_capacity(adapted(spark, sf), AS_OF),
    cap.warehouse_sql(),
)
register(
    "report_warehouse_capacity_matched",
    lambda spark, sf: plans.warehouse_capacity(adapted(spark, sf), AS_OF, match_warehouse=True),
    cap.warehouse_sql(matched=True),
)
register(
    "report_packaging",
    lambda spark, sf: plans.packaging_availability(adapted(spark, sf)),
    cap.packaging_sql(),
)


def _transit(table: str):
    return lambda spark, sf: plans.transit_tables(adapted(spark, sf), LEDGER_AS_OF)[table]


register(
    "report_transit_summary",
    lambda spark, sf: plans.transit_reconciliation(adapted(spark, sf), LEDGER_AS_OF),
    tr.summary_sql(),
)
register("report_transit_sales", _transit("sales_base"), tr.sales_sql())
register("report_transit_sales_previous_month", _transit("sales_previous_month"), tr.previous_month_sql())
register("report_transit_cleared", _transit("cleared"), tr.cleared_sql())
register("report_transit_open_ledger", _transit("open_ledger"), tr.open_ledger_sql())
register("report_transit_match_diagnostic", _transit("match_diagnostic"), tr.diagnostic_sql())
register("report_transit_base", _transit("base"), tr.base_sql())
register(
    "report_invoice_check",
    lambda spark, sf: plans.invoice_check(adapted(spark, sf), CHECK_AS_OF),
    inv.check_sql(),
)
register(
    "report_invoice_snapshot",
    lambda spark, sf: plans.invoice_snapshot(adapted(spark, sf), AS_OF),
    inv.snapshot_sql(),
)

register(
    "report_invoice_snapshot_proper",
    lambda spark, sf: plans.invoice_snapshot(adapted(spark, sf), AS_OF, compat=False),
    inv.snapshot_sql(compat=False),
)

for _name, _report, _sql in (
    ("region_assignment", plans.region_assignment, cost.region_assignment_sql()),
    ("cost_center_assignment", plans.cost_center_assignment, cost.cost_center_assignment_sql()),
    ("application_assignment", plans.application_assignment, cost.application_assignment_sql()),
    ("shared_component_assignment", plans.shared_component_assignment, cost.shared_component_assignment_sql()),
    ("asset_assignment", plans.asset_assignment, cost.asset_assignment_sql()),
    ("asset_details", plans.asset_details, cost.asset_details_sql()),
    ("cost_to_application", plans.cost_to_application, cost.cost_to_application_sql()),
    ("cost_to_center", plans.cost_to_center, cost.cost_to_center_sql()),
    ("cross_owner_details", plans.cross_owner_details, cost.cross_owner_details_sql()),
    ("cross_owner_counts", plans.cross_owner_counts, cost.cross_owner_counts_sql()),
    ("zero_cost_applications", plans.zero_cost_applications, cost.zero_cost_sql()),
    ("regional_cost", plans.regional_cost, cost.regional_sql()),
    ("shared_cost", plans.shared_cost, cost.shared_cost_sql()),
    ("shared_total", plans.shared_total, cost.shared_total_sql()),
    ("shared_by_region", plans.shared_by_region, cost.shared_by_region_sql()),
):
    register(f"report_{_name}", lambda spark, sf, report=_report: report(adapted(spark, sf)), _sql)
