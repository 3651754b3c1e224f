"""The reports: thin compositions of the operators over named input tables."""

from .capacity import packaging_availability, plant_capacity, warehouse_capacity
from .cost_checks import (
    application_assignment,
    asset_assignment,
    asset_details,
    cost_center_assignment,
    region_assignment,
    shared_component_assignment,
)
from .cost_overview import regional_cost, shared_by_region, shared_cost, shared_total
from .cost_reports import (
    cost_to_application,
    cost_to_center,
    cross_owner_counts,
    cross_owner_details,
    zero_cost_applications,
)
from .invoice_check import invoice_check
from .invoice_snapshot import invoice_snapshot
from .transit import transit_reconciliation, transit_tables

__all__ = [name for name in dir() if not name.startswith("_")]
