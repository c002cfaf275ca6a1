"""Demand forecast snapshots by manufacturing location and item."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matflow.functions.aggregates import strict_sum
from matflow.functions.casts import tolerant_double
from matflow.functions.keys import composite_key, remove_char, replace_char
from matflow.operators.reshape import HORIZON, SKIP_MONTHS, pivot_all_months, pivot_months

MONTH = "forecast_month_year_id"
CASES = "adjusted_forecast_cases"


def forecast_cases(forecast: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(mfg_ref, month, cases); the key still has its '_' separator."""
    item = remove_char("product_label_sku_code")
    return forecast.select(
        *by,
        composite_key("product_manufacturing_location_code", item, sep="_").alias("mfg_ref"),
        MONTH,
        tolerant_double(CASES).alias(CASES),
    )


def forecast_lag1(
    forecast: DataFrame,
    by: Sequence[str] = (),
    skip: int = SKIP_MONTHS,
    take: int = HORIZON,
    keep_raw: bool = False,
) -> DataFrame:
    """One row per mfg_ref with fcst_m01..m12: the months of the snapshot after the first two.

    Months are placed by their calendar order over the whole snapshot. Rows are grouped by the key
    with '_' and only then get their '-', as two different keys may become the same text.
    ``keep_raw`` adds the key with '_' as raw_ref. A snapshot of fewer than ``skip`` + ``take`` months is an error;
    with ``by`` columns the caller leaves such snapshots out (``complete_months``).
    """
    cases = forecast_cases(forecast, by)
    wide = pivot_months(cases, "mfg_ref", MONTH, CASES, by, skip, take)
    if keep_raw:
        wide = wide.withColumn("raw_ref", F.col("mfg_ref"))
    return wide.withColumn("mfg_ref", replace_char("mfg_ref"))


def monthly_cases(forecast: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, mfg_ref, month, cases, rows, bad_rows): one row a key and month, whose cases are NULL if a row has none.

    What the forecast says in one pass: months of a snapshot, ``lag1_of_months`` and ``poisoned_months`` need no more.
    """
    groups = forecast_cases(forecast, by).groupBy(*by, "mfg_ref", MONTH)
    rows = {"rows": F.count(F.lit(1)), "bad_rows": F.count_if(F.col(CASES).isNull())}
    return groups.agg(strict_sum(CASES).alias(CASES), *(column.alias(name) for name, column in rows.items()))


def lag1_of_months(months: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``forecast_lag1`` from ``monthly_cases``."""
    wide = pivot_months(months, "mfg_ref", MONTH, CASES, by)
    return wide.withColumn("mfg_ref", replace_char("mfg_ref"))


def poisoned_months(months: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``poisoned_groups`` from ``monthly_cases``."""
    return months.filter(F.col("bad_rows") > 0).select(*by, "mfg_ref", MONTH, "rows", "bad_rows")


def forecast_wide_all(forecast: DataFrame) -> DataFrame:
    """One row per mfg_ref with one column per month of the snapshot."""
    wide = pivot_all_months(forecast_cases(forecast), "mfg_ref", MONTH, CASES)
    return wide.withColumn("mfg_ref", replace_char("mfg_ref"))


def snapshot_months(forecast: DataFrame) -> DataFrame:
    """(snapshot_date, months_found): how many different months each snapshot has."""
    months = forecast.select("snapshot_date", MONTH).distinct()
    return months.groupBy("snapshot_date").agg(F.count(F.lit(1)).cast("int").alias("months_found"))


def complete_months(skip: int = SKIP_MONTHS, take: int = HORIZON) -> int:
    """The months a snapshot needs."""
    return skip + take


def poisoned_groups(forecast: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Key and month pairs that count as 0 because some of their rows have no quantity."""
    groups = forecast_cases(forecast, by).groupBy(*by, "mfg_ref", MONTH).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col(CASES).isNull()).alias("bad_rows")
    )
    return groups.filter(F.col("bad_rows") > 0)
