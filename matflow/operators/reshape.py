"""Long to wide, wide to long, and arithmetic over the twelve forecast months."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matflow.functions.aggregates import exact_total, fraction, whole_part
from matflow.functions.casts import tolerant_double
from matflow.functions.nulls import null_propagating_max, null_to_zero
from matflow.operators.lookups import lookup_join

SKIP_MONTHS = 2
HORIZON = 12

# Hold-status label of each quantity column of the balance report.
HOLD_STATUS = {"usable": "Useable", "soft_hold": "Soft Hold", "hard_hold": "Hard Hold"}


def month_names(prefix: str, count: int = HORIZON) -> list[str]:
    return [f"{prefix}_m{i:02d}" for i in range(1, count + 1)]


def month_positions(
    df: DataFrame, month: str, by: Sequence[str] = (), skip: int = SKIP_MONTHS, take: int = HORIZON
) -> DataFrame:
    """(by, month, month_no): the distinct months in ascending order without the first ``skip``.

    Gives at most ``skip`` + ``take`` rows per ``by`` group; those of the skipped months have a month_no of 0 or
    less. Without groups, fewer months than that are an error when the query runs.
    """
    in_order = Window.partitionBy(*by).orderBy(F.col(month).asc_nulls_last())
    ranked = df.select(*by, month).distinct().withColumn("__rank", F.row_number().over(in_order))
    chosen = ranked.filter(F.col("__rank") <= skip + take)
    number = F.col("__rank") - skip
    if not by:
        found = F.count(F.lit(1)).over(Window.partitionBy())
        message = F.concat(F.lit(f"the snapshot needs {skip + take} months and has "), found.cast("string"))
        number = F.when(found == skip + take, number).otherwise(F.raise_error(message).cast("int"))
    return chosen.select(*by, month, number.alias("month_no"))


def pivot_months(
    df: DataFrame,
    key: str,
    month: str,
    qty: str,
    by: Sequence[str] = (),
    skip: int = SKIP_MONTHS,
    take: int = HORIZON,
) -> DataFrame:
    """One row per key with the ``take`` months after the first ``skip`` as fcst_m01, fcst_m02, ...

    A month of a key is 0 when it has no rows or when any of its rows has no quantity. All months are
    conditional aggregates of one groupBy, so there is a single shuffle on the key. A snapshot of fewer than
    ``skip`` + ``take`` months is an error; with ``by`` groups the caller leaves such groups out.

    The month positions, at most ``skip`` + ``take`` rows, are broadcast if there are no groups; otherwise
    adaptive execution picks the join from their real size.
    """
    positions = month_positions(df, month, by, skip, take)
    if not by:
        positions = F.broadcast(positions)
    placed = lookup_join(df.select(*by, key, month, qty), positions, [*by, month])
    numbered = enumerate(month_names("fcst", take), start=1)
    return _month_sums(placed, [*by, key], qty, {n: F.col("month_no") == number for number, n in numbered})


def _month_sums(rows: DataFrame, keys: Sequence[str], qty: str, months: Mapping[str, Column]) -> DataFrame:
    """One exact sum of ``qty`` by key for each named month; 0 without rows or if any of them has no quantity."""
    # A missing quantity counts as NaN, which stays NaN in any sum.
    whole = F.coalesce(whole_part(qty), F.lit(float("nan")))
    marked = rows.withColumns({"__whole": whole, "__fraction": F.coalesce(fraction(qty), F.lit(0).cast("bigint"))})
    sums = [F.sum(F.when(month, F.col("__whole"))).alias(f"__w{n}") for n, month in enumerate(months.values())]
    sums += [F.sum(F.when(month, F.col("__fraction"))).alias(f"__f{n}") for n, month in enumerate(months.values())]
    totals = marked.groupBy(*keys).agg(*sums)
    named = [null_to_zero(exact_total(f"__w{n}", f"__f{n}")).alias(name) for n, name in enumerate(months)]
    return totals.select(*keys, *named)


def pivot_all_months(df: DataFrame, key: str, month: str, qty: str) -> DataFrame:
    """One row per key, one column per distinct month, named by the month ('NA' if it is missing).

    The months become the schema, so the driver reads their distinct values; more of them than
    ``spark.sql.pivotMaxValues`` is an error.
    """
    limit = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues", "10000"))
    named = df.withColumn(month, F.coalesce(F.col(month), F.lit("NA")))
    months = [row[0] for row in named.select(month).distinct().orderBy(month).take(limit + 1)]
    if len(months) > limit:
        raise ValueError(f"more than {limit} distinct values in {month}")
    return _month_sums(named, [key], qty, {m: F.col(month) == m for m in months})


def unpivot_hold_status(
    df: DataFrame, ids: Sequence[str], status: str = "inventory_hold_status", qty: str = "inventory_qty_cases"
) -> DataFrame:
    """Three rows per input row, one per hold status, with a missing quantity as 0."""
    named = df.select(*ids, *(tolerant_double(c).alias(label) for c, label in HOLD_STATUS.items()))
    long = named.unpivot(list(ids), list(HOLD_STATUS.values()), status, qty)
    return long.withColumn(qty, null_to_zero(qty))


def scale_month_vector(
    df: DataFrame,
    factor: str = "quantity_w_scrap",
    open_order: str = "next_28_days_open_order",
    count: int = HORIZON,
) -> DataFrame:
    """Dependent demand per month: forecast x factor, where month 1 takes the open order if larger."""
    forecast, demand = month_names("fcst", count), month_names("dep", count)
    first = null_propagating_max(open_order, forecast[0])
    bases = [first, *(F.col(name) for name in forecast[1:])]
    return df.withColumns({name: base * F.col(factor) for name, base in zip(demand, bases)})
