"""Material demand: the bill of materials times the forecast of its parent item."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matflow.functions.casts import tolerant_double
from matflow.functions.nulls import null_to_zero
from matflow.operators.frames import project_positional
from matflow.operators.lookups import join_bom_forecast, lookup_join
from matflow.operators.reshape import month_names, scale_month_vector

# Fixed value: the columns of the bill of materials that the job uses.
BOM_COLUMNS = 31


def bom_demand(
    bom: DataFrame,
    forecast: DataFrame,
    by: Sequence[str] = (),
    width: int = BOM_COLUMNS,
    keys: Sequence[str] = (),
    known: Column | None = None,
) -> DataFrame:
    """The first ``width`` columns of the bill of materials, its forecast and its demand by month.

    ``forecast`` is a result of ``forecast_lag1``, with the same ``by`` columns. ``keys`` are columns of a run that
    stand before those of the bill of materials and don't count. Lines without a forecast get 0 where ``known``
    holds, and no forecast at all elsewhere. A narrower table than ``width`` is an error.
    """
    lines = project_positional(bom.drop(*keys), range(1, width + 1)).columns
    keyed = bom.select(*keys, *lines).withColumnRenamed("ref", "mfg_ref")
    planned = join_bom_forecast(keyed, forecast, by)
    if known is not None:
        planned = planned.withColumns({name: F.when(known, F.col(name)) for name in month_names("fcst")})
    numeric = planned.withColumns(
        {
            "quantity_w_scrap": tolerant_double("quantity_w_scrap"),
            "next_28_days_open_order": tolerant_double("next_28_days_open_order"),
        }
    )
    return scale_month_vector(numeric)


def lag1_lookup(refs: DataFrame, forecast: DataFrame, month: int = 1) -> DataFrame:
    """(ref, lag1): the forecast of one month by key, 0 where there is none, rounded half away from 0.

    Every ref gives one row. Of forecast keys that became the same text the one of the smallest raw_ref counts, or
    without that column (``forecast_lag1(keep_raw=True)``) the smallest value.
    """
    name = month_names("fcst")[month - 1]
    order = F.col("raw_ref") if "raw_ref" in forecast.columns else F.col(name)
    lookup = forecast.groupBy(F.col("mfg_ref").alias("ref")).agg(F.min(F.struct(order.alias("order"), name)).alias("__first"))
    # The forecast key is never NULL, so plain equality is exact.
    lookup = lookup.select("ref", F.col(f"__first.{name}").alias(name))
    found = lookup_join(refs.select("ref"), lookup, ["ref"], null_safe=False)
    return found.select("ref", F.round(null_to_zero(name), 0).alias("lag1"))
