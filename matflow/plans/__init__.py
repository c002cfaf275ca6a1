from matflow.plans import bucketed
from matflow.plans.bom import bom_demand, lag1_lookup
from matflow.plans.exceptions import exception_enriched
from matflow.plans.forecast import (
    forecast_cases,
    forecast_lag1,
    forecast_wide_all,
    poisoned_groups,
)
from matflow.plans.incremental import landed_inputs, publish_new_runs, publish_new_weeks
from matflow.plans.inventory import (
    fg_inventory_balance,
    fg_inventory_lot,
    fg_inventory_mfg,
    label_inventory,
    label_inventory_sites,
    rm_inventory,
    rm_inventory_balance,
    rm_inventory_lot,
)
from matflow.plans.orders import open_po, receipts
from matflow.plans.weekly import WeeklyInputs, publish_weekly, weekly_summary, weekly_tables

__all__ = [
    "WeeklyInputs",
    "bom_demand",
    "bucketed",
    "exception_enriched",
    "fg_inventory_balance",
    "fg_inventory_lot",
    "fg_inventory_mfg",
    "forecast_cases",
    "forecast_lag1",
    "forecast_wide_all",
    "label_inventory",
    "label_inventory_sites",
    "lag1_lookup",
    "landed_inputs",
    "open_po",
    "poisoned_groups",
    "publish_new_runs",
    "publish_new_weeks",
    "publish_weekly",
    "receipts",
    "rm_inventory",
    "rm_inventory_balance",
    "rm_inventory_lot",
    "weekly_summary",
    "weekly_tables",
]
