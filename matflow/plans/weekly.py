"""All reports for all run dates in one job: every key carries ``as_of``."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, fields, replace
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matflow.operators.lookups import broadcast_if_small, lookup_join
from matflow.plans.bom import bom_demand
from matflow.plans.exceptions import exception_enriched
from matflow.plans.forecast import (
    complete_months,
    forecast_lag1,
    lag1_of_months,
    monthly_cases,
    poisoned_groups,
    poisoned_months,
    snapshot_months,
)
from matflow.plans.inventory import fg_inventory_lot, rm_inventory
from matflow.plans.orders import open_po, receipts
from matflow.sources.grid import named_sheet
from matflow.sources.manifests import publish_set
from matflow.sources.published import folder_files, publish_tables
from matflow.sources.snapshots import select_snapshot

RUN = ("as_of",)

# Up to so many run dates are listed with their snapshots on the driver, once; more stay a plan.
LISTED_RUNS = 10_000

# Quantity column that the run summary adds up, by table.
QUANTITY = {
    "po": "qty",
    "receipt": "qty",
    "bom": "dep_m01",
    "exception_report": "item_number",
    "rm_inventory": "inventory",
    "fg_inventory": "inventory_qty_cases",
}

@dataclass(frozen=True)
class WeeklyInputs:
    """Inputs of many runs: all carry ``as_of``, the forecast ``snapshot_date``, campus neither.

    ``runs`` lists the run dates of the other inputs in column ``as_of``.
    """

    runs: DataFrame
    campus: DataFrame
    po: DataFrame
    receipt: DataFrame
    bom: DataFrame
    forecast: DataFrame
    exception_report: DataFrame
    lots: DataFrame
    erp_lots: DataFrame

    def only(self, *run_dates: date) -> WeeklyInputs:
        """The same inputs for some run dates; stored inputs then read only those partitions."""
        dated = {
            field.name: getattr(self, field.name).filter(F.col("as_of").isin(*run_dates))
            for field in fields(self)
            if "as_of" in getattr(self, field.name).columns
        }
        return replace(self, **dated)


def forecasts_in_reach(forecast: DataFrame, runs: DataFrame) -> DataFrame:
    """The snapshots that any run can use: a static range of dates, which prunes stored partitions."""
    first, last = runs.agg(F.min("as_of"), F.max("as_of")).first()
    if first is None:
        return forecast.limit(0)
    month_before = (first.replace(day=1) - timedelta(days=1)).replace(day=1)
    day = F.col("snapshot_date")
    return forecast.filter((day >= F.lit(month_before)) & (day < F.lit(last.replace(day=1))))


def choose_snapshots(runs: DataFrame, forecast: DataFrame) -> DataFrame:
    """(as_of, snapshot_date, months_found) of every run date; up to ``LISTED_RUNS`` of them are computed once, here.

    ``snapshot_date`` is the lag-1 snapshot or NULL, ``months_found`` how many months it has.
    """
    months = snapshot_months(forecast)
    chosen = select_snapshot(runs, months).join(months, "snapshot_date", "left")
    chosen = chosen.select("as_of", "snapshot_date", "months_found")
    rows = chosen.take(LISTED_RUNS + 1)
    if len(rows) > LISTED_RUNS:
        return chosen
    schema = "as_of date, snapshot_date date, months_found int"
    # The hint stays with the table through filters and projections.
    return F.broadcast(runs.sparkSession.createDataFrame([tuple(row) for row in rows], schema))


def _complete(months_found: str = "months_found") -> Column:
    return F.coalesce(F.col(months_found) >= complete_months(), F.lit(False))


def forecast_gaps(chosen: DataFrame) -> DataFrame:
    """Run dates without a complete lag-1 snapshot; their demand is published without a forecast."""
    return chosen.filter(~_complete()).select("as_of", "snapshot_date", F.coalesce("months_found", F.lit(0)).alias("months_found"))


def weekly_bom_demand(
    bom: DataFrame, forecast: DataFrame, runs: DataFrame, chosen: DataFrame | None = None, months: DataFrame | None = None
) -> DataFrame:
    """Material demand of every run with its own lag-1 snapshot.

    A snapshot serves all runs of a month, so it is pivoted once per snapshot and not once per run. Runs whose
    snapshot is missing or has too few months have no forecast (NULL) and are listed by ``forecast_gaps``. ``months``
    is what ``monthly_cases`` gives for the forecast, where it is at hand. The pivoted forecast is measured first: where
    it is small, the wide lines of the bill of materials are not shuffled.
    """
    reach = forecasts_in_reach(forecast, runs) if months is None else months
    chosen = choose_snapshots(runs, reach) if chosen is None else chosen
    used = chosen.filter(_complete()).select("snapshot_date").distinct()
    in_use = reach.join(used, "snapshot_date", "left_semi")
    lag1 = (forecast_lag1 if months is None else lag1_of_months)(in_use, by=["snapshot_date"])
    dated = lookup_join(bom, chosen, RUN, null_safe=False)
    keys = ["as_of", "snapshot_date", "months_found"]
    return bom_demand(dated, broadcast_if_small(lag1), by=["snapshot_date"], keys=keys, known=_complete()).drop("months_found")


def weekly_tables(inputs: WeeklyInputs, store: Callable[[DataFrame], DataFrame] | None = None) -> dict[str, DataFrame]:
    """Every published table, for every run date of the inputs; the last two tell what the others lack.

    ``store`` writes a table and reads it again. With it the forecast is read once: choosing snapshots, pivoting them
    and listing what counts as 0 then work on its sums by month. Without it each of them is a plan on the forecast.
    """
    rm, fg = named_sheet(inputs.lots, "RM"), named_sheet(inputs.lots, "FG")
    reach = forecasts_in_reach(inputs.forecast, inputs.runs)
    months = None if store is None else store(monthly_cases(reach, by=["snapshot_date"]))
    chosen = choose_snapshots(inputs.runs, reach if months is None else months)
    used = chosen.filter(_complete()).select("as_of", "snapshot_date")
    poisoned = (poisoned_groups if months is None else poisoned_months)(reach if months is None else months, by=["snapshot_date"])
    return {
        "po": open_po(inputs.po, inputs.campus, by=RUN),
        "receipt": receipts(inputs.receipt, inputs.campus, by=RUN),
        "bom": weekly_bom_demand(inputs.bom, inputs.forecast, inputs.runs, chosen, months),
        "exception_report": exception_enriched(inputs.exception_report, inputs.campus),
        "rm_inventory": rm_inventory(rm, inputs.erp_lots, inputs.exception_report, by=RUN),
        "fg_inventory": fg_inventory_lot(fg, by=RUN),
        "forecast_gaps": forecast_gaps(chosen),
        "poisoned_forecast": poisoned.join(used, "snapshot_date"),
    }


def publish_weekly(inputs: WeeklyInputs, root: str, together: bool = False) -> None:
    """Write all tables. The run dates of the inputs are replaced, also where they have no rows; others stay.

    ``together`` publishes them as one set (``read_set``): readers see all tables of the new week or none. The sums of
    the forecast by month lie below ``root`` until all tables are written.
    """
    spark = inputs.runs.sparkSession
    days = [row["as_of"] for row in inputs.runs.select("as_of").distinct().collect()]
    aside = f"{root}/_months-{uuid.uuid4().hex}"

    def store(months: DataFrame) -> DataFrame:
        months.write.parquet(aside)
        return spark.read.schema(months.schema).parquet(aside)

    write = publish_set if together else publish_tables
    try:
        write(weekly_tables(inputs, store), root, run_dates=days)
    finally:
        system, path, _ = folder_files(spark, aside)
        system.delete(path, True)


def weekly_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """(as_of, table, rows, total) of every table and run date."""
    parts = [
        tables[name].groupBy("as_of")
        .agg(F.count(F.lit(1)).alias("rows"), F.sum(quantity).alias("total"))
        .select("as_of", F.lit(name).alias("table"), "rows", "total")
        for name, quantity in QUANTITY.items()
    ]
    return reduce(DataFrame.unionByName, parts)
