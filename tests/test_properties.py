"""Properties that must hold whatever the data."""

from __future__ import annotations

from collections import Counter
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matflow import functions as fn
from matflow import operators as op
from matflow import plans
from matflow import sources as src
from testbed import adapters as fx
from testbed.queries import QUERIES, weekly_inputs

SF_DIR = "/root/testdata/sf0.001"


def bag(df: DataFrame) -> Counter:
    names = sorted(df.columns)
    return Counter(tuple(row) for row in df.select(*names).collect())


@pytest.fixture(scope="module")
def lots(spark):
    return fx.fx_lot(spark, SF_DIR).cache()


def test_pivot_and_unpivot_round_trip(spark):
    cases = plans.forecast_cases(fx.fx_dsx(spark, SF_DIR))
    names = op.month_names("fcst", 14)
    wide = plans.forecast_lag1(fx.fx_dsx(spark, SF_DIR), skip=0, take=14)
    long = wide.unpivot(["mfg_ref"], names, "name", "qty").filter("qty <> 0")
    place = op.month_positions(cases, "forecast_month_year_id", skip=0, take=14)
    sums = op.group_sum_strict(cases, ["mfg_ref", "forecast_month_year_id"], "adjusted_forecast_cases", "qty")
    name = F.format_string("fcst_m%02d", "month_no")
    expected = sums.join(place, "forecast_month_year_id").filter("qty <> 0")
    expected = expected.select(fn.replace_char("mfg_ref").alias("mfg_ref"), name.alias("name"), "qty")
    assert bag(long) == bag(expected)


def test_both_month_pivots_agree(spark):
    dsx = fx.fx_dsx(spark, SF_DIR)
    wide = plans.forecast_wide_all(dsx)
    cut = op.ordinal_rename(wide.select("mfg_ref", *wide.columns[3:15]), 2, "fcst_m")
    assert bag(cut) == bag(plans.forecast_lag1(dsx))


def test_stock_adds_up(lots):
    known = lots.filter("current_inventory_balance is not null").drop("sheet")
    stock = [
        plans.rm_inventory_lot(known).agg(F.sum("inventory")).first()[0],
        plans.fg_inventory_lot(known).agg(F.sum("inventory_qty_cases")).first()[0],
    ]
    item = fn.remove_char("item")
    taken = (fn.is_raw_material(item) | fn.is_finished_good(item)) & fn.keeps_description("description")
    left_out = known.filter(~taken).agg(F.sum(fn.tolerant_double("current_inventory_balance"))).first()[0]
    total = known.agg(F.sum(fn.tolerant_double("current_inventory_balance"))).first()[0]
    assert sum(stock) + (left_out or 0) == total


def test_rm_inventory_is_lots_plus_labels(spark):
    counts = {n: QUERIES[n](spark, SF_DIR).count() for n in ("rm_inventory", "rm_inventory_lot", "label_inventory")}
    assert counts["rm_inventory"] == counts["rm_inventory_lot"] + counts["label_inventory"]
    assert counts["label_inventory"] > 0


def test_demand_is_linear_in_quantity(spark):
    bom, lag1 = fx.fx_bom(spark, SF_DIR), plans.forecast_lag1(fx.fx_dsx(spark, SF_DIR))
    thrice = bom.withColumn("quantity_w_scrap", (F.col("quantity_w_scrap").cast("int") * 3).cast("string"))
    demand = op.month_names("dep")
    once = plans.bom_demand(bom, lag1).select("component", *((F.col(n) * 3).alias(n) for n in demand))
    assert bag(once) == bag(plans.bom_demand(thrice, lag1).select("component", *demand))


def test_semi_join_is_join_and_not_null(spark):
    erp, report = fx.fx_jde_lot(spark, SF_DIR), fx.fx_exception(spark, SF_DIR)
    rows = erp.select(fn.tolerant_double("item_number").alias("item"), "bp", "on_hand")
    labels = op.label_items(report)
    joined = op.lookup_join(rows, labels.withColumn("label", F.lit("LBL")), ["item"])
    assert bag(op.semi_join_labels(rows, labels)) == bag(joined.filter("label is not null").drop("label"))


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_partitioning_and_order_do_not_matter(spark, lots, partitions):
    mixed = lots.orderBy(F.rand(partitions)).repartition(partitions)
    for report in (plans.rm_inventory_lot, plans.fg_inventory_lot):
        assert bag(report(mixed)) == bag(report(lots))
    dsx = fx.fx_dsx(spark, SF_DIR)
    assert bag(plans.forecast_lag1(dsx.repartition(partitions))) == bag(plans.forecast_lag1(dsx))


def test_all_weeks_equal_the_single_weeks(spark, tmp_path):
    """One job over all run dates gives what one run per date gives."""
    inputs = weekly_inputs(spark, SF_DIR)
    together = plans.weekly_tables(inputs)
    gaps = {r.as_of for r in together["forecast_gaps"].collect()}
    assert gaps
    complete = [r.as_of for r in inputs.runs.orderBy("as_of").collect() if r.as_of not in gaps]
    weeks = [complete[len(complete) // 3], complete[len(complete) * 2 // 3]]
    lots, campus = inputs.lots, inputs.campus

    def week(df, as_of):
        return df.filter(F.col("as_of") == F.lit(as_of))

    def single(as_of) -> dict[str, DataFrame]:
        chosen = src.select_snapshot(
            spark.createDataFrame([(as_of,)], "as_of date"), inputs.forecast.select("snapshot_date")
        ).first()["snapshot_date"]
        snapshot = inputs.forecast.filter(F.col("snapshot_date") == F.lit(chosen)).drop("snapshot_date")
        bom = plans.bom_demand(week(inputs.bom, as_of).drop("as_of"), plans.forecast_lag1(snapshot))
        rm, fg = (src.named_sheet(week(lots, as_of), sheet).drop("as_of") for sheet in ("RM", "FG"))
        report = week(inputs.exception_report, as_of)
        return {
            "po": plans.open_po(week(inputs.po, as_of), campus),
            "receipt": plans.receipts(week(inputs.receipt, as_of), campus),
            "bom": bom,
            "exception_report": plans.exception_enriched(report, campus).drop("as_of"),
            "rm_inventory": plans.rm_inventory(rm, week(inputs.erp_lots, as_of), report),
            "fg_inventory": plans.fg_inventory_lot(fg),
        }

    runs = [{n: df.withColumn("as_of", F.lit(w)) for n, df in single(w).items()} for w in weeks]
    assert together.keys() - runs[0].keys() == {"forecast_gaps", "poisoned_forecast"}
    for name in runs[0]:
        df = together[name]
        expected = reduce(DataFrame.unionByName, [run[name] for run in runs])
        got = df.filter(F.col("as_of").isin(weeks)).select(expected.columns)
        assert bag(got) == bag(expected), name
    assert len(weeks) == 2


def test_publishing_again_changes_nothing(spark, tmp_path):
    inputs = weekly_inputs(spark, SF_DIR)
    weeks = [r.as_of for r in inputs.runs.orderBy("as_of").collect()]
    late = inputs.only(*weeks[-8:])
    root = str(tmp_path)
    plans.publish_weekly(late, root)
    kinds = {n: df.schema for n, df in plans.weekly_tables(late).items()}
    first = {n: src.read_published(spark, root, n, kind).count() for n, kind in kinds.items()}
    plans.publish_weekly(late, root)
    again = {n: src.read_published(spark, root, n, kinds[n]).count() for n in first}
    assert first == again
    assert all(n for name, n in first.items() if name not in ("forecast_gaps", "poisoned_forecast"))
    rm = src.read_published(spark, root, "rm_inventory")
    assert bag(rm) == bag(plans.weekly_tables(late)["rm_inventory"].select(rm.columns))
