"""One query per operator and dataflow, over the inputs of ``testbed/adapters.py``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matflow import functions as fn
from matflow import operators as op
from matflow import plans
from matflow import sources as src
from testbed.scratch import scratch_folder
from testbed import adapters as fx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def run_date(day: str):
    return F.lit(day).cast("date")


# --- sources and sinks ------------------------------------------------------------------------


@query
def src_delimited_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{scratch_folder(spark)}/12.12.2023"
    fx.fx_po(spark, sf_dir).select("line").write.text(folder)
    return src.read_record_lines(spark, folder)


@query
def src_numbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{scratch_folder(spark)}/01.02.2024"
    numbered = fx.fx_po(spark, sf_dir).select(F.monotonically_increasing_id().alias("no"), "line")
    numbered.write.csv(folder, header=True)
    return src.read_numbered_lines(spark, folder)


@query
def promote_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.promote_header(fx.exception_grid(spark, sf_dir), 4)


@query
def drop_leading_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.drop_leading_rows(fx.exception_grid(spark, sf_dir), 4)


@query
def named_sheet_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.named_sheet(fx.fx_lot(spark, sf_dir), "RM")


def _week_name() -> Column:
    return F.date_format("as_of", "MM.dd.yyyy")


@query
def workbook_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lot report as a workbook a week with two sheets; the RM sheets are read back, with header and run date."""
    folder = scratch_folder(spark)
    lots = fx.fx_lot(spark, sf_dir)
    sheets = {name: src.named_sheet(lots, name) for name in ("RM", "FG")}
    src.write_workbooks(sheets, folder, _week_name(), leave_out=["as_of"])

    def dated(first: int | None = None) -> DataFrame:
        grid = src.read_workbooks(spark, folder, len(fx.LOT_COLUMNS), "RM", first)
        return grid.select(src.as_of_from_path(F.col("file")).alias("as_of"), *grid.columns[2:])

    tops = dated(first=1)
    heads = tops.select("as_of", F.lit(1).alias("header_row")).distinct()
    return src.promote_header_per_run(dated(), heads, tops=tops)


@query
def workbook_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and receipts as two named sheets of one workbook, of several files where they are long; read back."""
    folder = scratch_folder(spark)
    tables = {"RM PO Data": open_po(spark, sf_dir), "RM Receipt Data": receipts(spark, sf_dir)}
    src.write_workbooks(tables, folder, F.lit("po, receipt 01.09.2024"), rows=20_000)
    parts = []
    for (sheet, df), table, number in zip(tables.items(), ("po", "receipt"), ("po_no", "receipt_no")):
        grid, tops = (src.read_workbooks(spark, folder, len(df.columns), sheet, n).drop("file", "sheet") for n in (None, 1))
        read = src.promote_header(grid, 1, tops).select(*(F.col(f.name).cast(f.dataType) for f in df.schema))
        parts.append(read.select(F.lit(table).alias("table"), *df.columns[:-1], F.col(number).alias("number")))
    return parts[0].unionByName(parts[1])


@query
def promote_header_per_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = src.named_sheet(fx.lot_grid(spark, sf_dir), "RM")
    return src.promote_header_per_run(grid, fx.lot_header_rows(spark, sf_dir))


@query
def header_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many declared names each of the first rows of every sheet has."""
    grid = src.named_sheet(fx.lot_grid(spark, sf_dir), "RM")
    return src.header_scores(grid, fx.LOT_COLUMNS)


@query
def promote_header_detected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The header of every week is found by the declared names, in whatever row and order it stands."""
    grid = src.named_sheet(fx.lot_grid(spark, sf_dir), "FG")
    return src.promote_header_per_run(grid, names=src.SOURCES["lot_inventory"])


@query
def record_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short and long records with the reason; accepted ones are written in the same pass."""
    folder = scratch_folder(spark)
    src.publish_checked(fx.fx_po_mixed(spark, sf_dir), folder, 8)
    return src.read_checked(spark, folder, src.REJECTED)


@query
def record_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the pass that writes both tables has counted, and what the tables then hold."""
    folder = scratch_folder(spark)
    counts = src.publish_checked(fx.fx_po_mixed(spark, sf_dir), folder, 8)
    held = src.read_checked(spark, folder).agg(F.count(F.lit(1)).alias("held"))
    return held.select(*(F.lit(n).cast("bigint").alias(name) for name, n in counts.items()), "held")


@query
def snapshot_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.select_snapshot(fx.fx_runs(spark, sf_dir), fx.fx_snapshots(spark, sf_dir))


@query
def snapshot_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three run dates: the first stays, the second is replaced, and the third is published again without rows."""
    root = scratch_folder(spark)
    older, newer = open_po_underscore(spark, sf_dir), open_po(spark, sf_dir)
    src.publish(older, root, "po", run_date("2024-01-02"))
    src.publish(older, root, "po", run_date("2024-01-09"))
    src.publish(newer, root, "po", run_date("2024-01-09"))
    src.publish(older, root, "po", run_date("2024-01-16"))
    src.publish(older.limit(0), root, "po", run_date("2024-01-16"), run_dates=[date(2024, 1, 16)])
    return src.read_published(spark, root, "po")


@query
def multi_table_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_folder(spark)
    tables = {"po": open_po(spark, sf_dir), "receipt": receipts(spark, sf_dir)}
    src.publish_tables(tables, root, run_date("2024-01-09"))
    return src.read_tables(spark, root, *tables)


@query
def published_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two weeks published as sets, and one whose second table fails: readers still see the whole sets before it."""
    root = scratch_folder(spark)
    older, newer, received = open_po_underscore(spark, sf_dir), open_po(spark, sf_dir), receipts(spark, sf_dir)
    src.publish_set({"po": older, "receipt": received}, root, run_date("2024-01-02"))
    src.publish_set({"po": newer, "receipt": received}, root, run_date("2024-01-09"))
    failing = received.withColumn("qty", F.raise_error(F.lit("no receipts this week")).cast("double"))
    try:
        src.publish_set({"po": older, "receipt": failing}, root, run_date("2024-01-09"))
    except Exception as error:
        if "no receipts this week" not in str(error):
            raise
    return src.read_tables_of_set(spark, root, "po", "receipt")


@query
def weekly_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and receipts by week in two starts, of which the second publishes what the first has not seen."""
    landing, root = scratch_folder(spark), scratch_folder(spark)
    campus, weeks = fx.fx_campus(spark, sf_dir), fx.fx_ship_weeks(spark, sf_dir)
    src.publish(fx.fx_po(spark, sf_dir), landing, "po")
    src.publish(fx.fx_receipt(spark, sf_dir), landing, "receipt")

    def tables(session: SparkSession, days: list[date]) -> dict[str, DataFrame]:
        po, receipt = (
            src.read_published(session, landing, name).filter(F.col("as_of").isin(days)) for name in ("po", "receipt")
        )
        return {"po": plans.open_po(po, campus, by=["as_of"]), "receipt": plans.receipts(receipt, campus, by=["as_of"])}

    for half in (0, 1):
        new = weeks.filter(F.floor(F.datediff("as_of", F.lit("1970-01-05").cast("date")) / 7) % 2 == half)
        new.coalesce(1).write.mode("append").parquet(f"{landing}/runs")
        plans.publish_new_runs(spark, f"{landing}/runs", tables, root, f"{landing}/checkpoint").awaitTermination()
    return src.read_tables_of_set(spark, root, "po", "receipt")


# --- projection, renaming, derivation ---------------------------------------------------------


@query
def project_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = ["mfg_ref", "component", "dep_m01", "dep_m02"]
    return op.project_drop(bom_demand(spark, sf_dir), kept, ["component"])


@query
def project_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.project_positional(fx.fx_lot(spark, sf_dir), range(2, 5))


@query
def rename_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = fx.fx_exception(spark, sf_dir).drop("b_p")
    return op.rename_cols(report, {"item_number": "item", "mpf_or_line": "label"})


@query
def relocate_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.relocate_cols(fx.fx_bom(spark, sf_dir), "component")


@query
def ordinal_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.ordinal_rename(forecast_lag1(spark, sf_dir), 2, "month_")


@query
def clean_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = fx.fx_exception(spark, sf_dir)
    names = ("b_p", "item_number", "mpf_or_line")
    return op.clean_names(
        report.select(*names, *names).toDF("B/P", "Item Number", "NA", "NA", "...", "% w/ Scrap")
    )


@query
def derive_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    line_ref = fn.composite_key("ref", F.col("component").cast("string"))
    doubled = fn.tolerant_double("quantity_w_scrap") * 2
    return fx.fx_bom(spark, sf_dir).withColumns({"doubled": doubled, "line_ref": line_ref})


# --- casts and type inference -----------------------------------------------------------------


@query
def tolerant_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.fx_inv_bal(spark, sf_dir).select(
        F.col("item").alias("value"), fn.tolerant_double("item").alias("number")
    )


@query
def infer_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.inferred_types(fx.fx_inv_bal(spark, sf_dir))


@query
def infer_types_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.infer_types(fx.fx_inv_bal(spark, sf_dir))


@query
def infer_types_by_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the columns of each month's rows can be read as, one set of bits a column."""
    return op.type_masks(fx.fx_typed(spark, sf_dir), by=["month"])


@query
def infer_types_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The types over all months, merged from those of each month."""
    return op.types_of(op.merge_masks(op.type_masks(fx.fx_typed(spark, sf_dir), by=["month"])))


@query
def infer_types_merged_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = fx.fx_typed(spark, sf_dir)
    found = op.types_of(op.type_masks(typed.drop("month")))
    return op.cast_columns(typed, {row["column"]: row["type"] for row in found.collect()})


@query
def tolerant_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = fn.split_fixed("line", ["", "", "", "", "", "", "value", ""])
    dashes = fx.fx_po(spark, sf_dir).select(*day)
    slashes = dashes.select(F.translate("value", "-", "/").alias("value"))
    return dashes.unionAll(slashes).withColumn("date", fn.tolerant_date("value"))


@query
def code_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbers = fx.fx_exception(spark, sf_dir).select(fn.tolerant_double("item_number").alias("number"))
    return numbers.withColumn("code", fn.code_to_text("number"))


# --- scalar functions and predicates ----------------------------------------------------------


@query
def split_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.fx_po(spark, sf_dir).select(*fn.split_fixed("line", [f"f{i}" for i in range(1, 9)]))


@query
def split_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = fx.fx_po(spark, sf_dir).select(*fn.split_fixed("line", ["code"]))
    return codes.select(*fn.split_regex("code", ["global", "rp", "item"]))


@query
def strip_leading_zeros(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fx.fx_po(spark, sf_dir).select(*fn.split_fixed("line", ["", "raw"]))
    return raw.withColumn("location", fn.strip_leading_zeros("raw"))


@query
def remove_or_replace_char(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = fn.remove_char("product_label_sku_code")
    return fx.fx_dsx(spark, sf_dir).select(
        F.col("product_label_sku_code").alias("sku"),
        item.alias("item"),
        fn.dash_key("product_manufacturing_location_code", item).alias("mfg_ref"),
    )


@query
def composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exception_enriched(spark, sf_dir).select("b_p", "item_number", "campus", "ref", "campus_ref")


@query
def null_to_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    holds = ("usable", "soft_hold", "hard_hold")
    return fx.fx_inv_bal(spark, sf_dir).select(
        "bp", "item", *(fn.null_to_zero(fn.tolerant_double(name)).alias(name) for name in holds)
    )


@query
def null_propagating_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    open_order, factor = (
        fn.tolerant_double(name) for name in ("next_28_days_open_order", "quantity_w_scrap")
    )
    return fx.fx_bom(spark, sf_dir).select(
        "component", fn.null_propagating_max(open_order, factor).alias("larger")
    )


@query
def filter_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    site = fn.tolerant_double("bp")
    sites = (*fx.TWO_WAREHOUSES, *fx.LABEL_SITES)
    return fx.fx_inv_bal(spark, sf_dir).filter((site != fx.WAREHOUSES[0]) & site.isin(*sites))


@query
def filter_item_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    lots = fx.fx_lot(spark, sf_dir)
    group = F.when(fn.is_raw_material("item"), "RM").when(fn.is_finished_good("item"), "FG")
    return lots.select(group.alias("class"), "location", "item").filter(F.col("class").isNotNull())


@query
def filter_prefix_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    lots = fx.fx_lot(spark, sf_dir).select("location", "item", "description")
    return lots.filter(fn.keeps_description("description"))


@query
def filter_castable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.fx_inv_bal(spark, sf_dir).select("item", fn.is_castable("item").alias("castable"))


# --- joins ------------------------------------------------------------------------------------


@query
def join_campus_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = plans.orders.parse_records(fx.fx_po(spark, sf_dir), "po_no").select("location", "item")
    return op.join_campus_text(parsed, fx.fx_campus(spark, sf_dir))


@query
def join_campus_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = fx.fx_exception(spark, sf_dir).select(
        fn.tolerant_double("b_p").alias("b_p"), fn.tolerant_double("item_number").alias("item_number")
    )
    return op.join_campus_numeric(report, fx.fx_campus(spark, sf_dir), "b_p")


def _analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.fx_inv_analysis(spark, sf_dir).select(
        "location",
        "location_nm",
        fn.remove_char("product_label_sku").alias("item"),
        "description",
        F.col("inventory_hold_status").alias("hold_status"),
        fn.tolerant_double("inventory_qty_cases").alias("balance"),
    )
    return rows.withColumn("ref", fn.composite_key("location", "item", sep="_"))


@query
def join_mfg_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.join_mfg_map(_analysis(spark, sf_dir), fx.fx_mfg_map(spark, sf_dir))


@query
def join_bom_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    bom = fx.fx_bom(spark, sf_dir).select(F.col("ref").alias("mfg_ref"), "component")
    return op.join_bom_forecast(bom, forecast_lag1(spark, sf_dir))


@query
def semi_join_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.label_inventory(fx.fx_jde_lot(spark, sf_dir), fx.fx_exception(spark, sf_dir))


@query
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.duplicate_keys(fx.fx_campus(spark, sf_dir), ["campus"])


# --- aggregation, distinct, reshape, set operations -------------------------------------------


@query
def pivot_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = plans.forecast_cases(fx.fx_dsx(spark, sf_dir))
    wide = op.pivot_months(cases, "mfg_ref", "forecast_month_year_id", "adjusted_forecast_cases")
    return wide.withColumn("mfg_ref", fn.replace_char("mfg_ref"))


@query
def unpivot_hold_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.unpivot_hold_status(fx.fx_inv_bal(spark, sf_dir), ["bp", "item"])


@query
def group_sum_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    lots = fx.fx_lot(spark, sf_dir)
    balance = fn.tolerant_double("current_inventory_balance")
    return op.group_sum_strict(lots, ["location", "item"], balance, "inventory")


@query
def group_sum_fractional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of amounts with up to four digits after the point, negative ones among them, in few large groups."""
    amounts = fx.fx_amounts(spark, sf_dir)
    return op.group_sum_strict(amounts, ["site"], fn.tolerant_double("amount"), "total")


@query
def pivot_months_fractional(spark: SparkSession, sf_dir: str) -> DataFrame:
    amounts = fx.fx_amounts(spark, sf_dir).withColumn("amount", fn.tolerant_double("amount"))
    return op.pivot_months(amounts, "site", "month", "amount", skip=0)


@query
def group_first_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Every descriptive column is also a key, so the first value of a group is the key itself.
    keys = ["ref", "location", "location_nm", "item", "description", "hold_status"]
    return op.group_sum_strict(_analysis(spark, sf_dir), keys, "balance", "current_inventory_balance")


@query
def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = fx.fx_exception(spark, sf_dir).filter(F.col("mpf_or_line") == "LBL")
    numbered = labels.select(
        fn.tolerant_double("item_number").alias("item"), F.col("mpf_or_line").alias("label")
    )
    return op.distinct_rows(numbered, "item", "label")


@query
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    lots, labels = rm_inventory_lot(spark, sf_dir), label_inventory(spark, sf_dir)
    shuffled = labels.select(*reversed(labels.columns))
    return op.union_by_name(lots, shuffled, src.TABLES["rm_inventory"])


@query
def scale_month_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = fx.fx_bom(spark, sf_dir).select(
        F.col("ref").alias("mfg_ref"),
        "component",
        fn.tolerant_double("quantity_w_scrap").alias("factor"),
        fn.tolerant_double("next_28_days_open_order").alias("open_order"),
    )
    joined = op.join_bom_forecast(planned, forecast_lag1(spark, sf_dir))
    scaled = op.scale_month_vector(joined, "factor", "open_order")
    return scaled.select("mfg_ref", "component", *op.month_names("dep"))


# --- dataflows --------------------------------------------------------------------------------


@query
def open_po(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.open_po(fx.fx_po(spark, sf_dir), fx.fx_campus(spark, sf_dir))


@query
def open_po_underscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.open_po(fx.fx_po(spark, sf_dir), fx.fx_campus(spark, sf_dir), sep="_")


@query
def receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.receipts(fx.fx_receipt(spark, sf_dir), fx.fx_campus(spark, sf_dir))


@query
def forecast_lag1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.forecast_lag1(fx.fx_dsx(spark, sf_dir))


@query
def forecast_wide_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.forecast_wide_all(fx.fx_dsx(spark, sf_dir))


@query
def forecast_poisoned_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.poisoned_groups(fx.fx_dsx(spark, sf_dir))


@query
def bom_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.bom_demand(fx.fx_bom(spark, sf_dir), forecast_lag1(spark, sf_dir))


@query
def exception_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.exception_enriched(fx.fx_exception(spark, sf_dir), fx.fx_campus(spark, sf_dir))


def _sheet(spark: SparkSession, sf_dir: str, sheet: str) -> DataFrame:
    return src.named_sheet(fx.fx_lot(spark, sf_dir), sheet)


@query
def rm_inventory_lot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.rm_inventory_lot(_sheet(spark, sf_dir, "RM"))


@query
def label_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.label_inventory(fx.fx_jde_lot(spark, sf_dir), fx.fx_exception(spark, sf_dir))


@query
def rm_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.rm_inventory(
        _sheet(spark, sf_dir, "RM"), fx.fx_jde_lot(spark, sf_dir), fx.fx_exception(spark, sf_dir)
    )


def _balance(plan, warehouse, sites):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        inputs = (fx.fx_inv_bal, warehouse, fx.fx_campus)
        return plan(*(read(spark, sf_dir) for read in inputs), warehouses=sites)

    return run


QUERIES["rm_inventory_balance"] = _balance(plans.rm_inventory_balance, fx.fx_wh_rm, fx.WAREHOUSES)
QUERIES["rm_inventory_balance_two_sites"] = _balance(
    plans.rm_inventory_balance, fx.fx_wh_rm, fx.TWO_WAREHOUSES
)


@query
def label_inventory_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.label_inventory_sites(fx.fx_inv_bal(spark, sf_dir), fx.fx_exception(spark, sf_dir))


@query
def fg_inventory_lot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.fg_inventory_lot(_sheet(spark, sf_dir, "FG"))


QUERIES["fg_inventory_balance"] = _balance(plans.fg_inventory_balance, fx.fx_wh_fg, fx.WAREHOUSES)
QUERIES["fg_inventory_balance_two_sites"] = _balance(
    plans.fg_inventory_balance, fx.fx_wh_fg, fx.TWO_WAREHOUSES
)


@query
def fg_inventory_mfg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.fg_inventory_mfg(fx.fx_inv_analysis(spark, sf_dir), fx.fx_mfg_map(spark, sf_dir))


@query
def fg_inventory_mfg_zero_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.fg_inventory_mfg(
        fx.fx_inv_analysis(spark, sf_dir),
        fx.fx_mfg_map(spark, sf_dir),
        missing_is_zero=True,
        drop_items=["'1"],
    )


@query
def lag1_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    forecast = plans.forecast_lag1(fx.fx_dsx(spark, sf_dir), keep_raw=True)
    return plans.lag1_lookup(fx.fx_bom(spark, sf_dir), forecast)


@query
def weekly_bom_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.weekly.weekly_bom_demand(
        fx.fx_bom_week(spark, sf_dir),
        fx.fx_dsx_snapshots(spark, sf_dir),
        fx.fx_ship_weeks(spark, sf_dir),
    )


@query
def bucketed_bom_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same demand, from lines and forecasts that lie in buckets of the join's key."""
    root, buckets = scratch_folder(spark), 8
    inputs = (fx.fx_bom_week(spark, sf_dir), fx.fx_dsx_snapshots(spark, sf_dir), fx.fx_ship_weeks(spark, sf_dir))
    plans.bucketed.publish_demand_inputs(*inputs, root, buckets)
    return plans.bucketed.bucketed_bom_demand(spark, root)


def weekly_inputs(spark: SparkSession, sf_dir: str) -> plans.WeeklyInputs:
    return plans.WeeklyInputs(
        runs=fx.fx_ship_weeks(spark, sf_dir),
        campus=fx.fx_campus(spark, sf_dir),
        po=fx.fx_po(spark, sf_dir),
        receipt=fx.fx_receipt(spark, sf_dir),
        bom=fx.fx_bom_week(spark, sf_dir),
        forecast=fx.fx_dsx_snapshots(spark, sf_dir),
        exception_report=fx.fx_exception_week(spark, sf_dir),
        lots=fx.fx_lot(spark, sf_dir),
        erp_lots=fx.fx_jde_lot(spark, sf_dir),
    )


@query
def weekly_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.weekly_summary(plans.weekly_tables(weekly_inputs(spark, sf_dir)))


@query
def rm_inventory_from_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the sheets of all weeks to the inventory: sheet, header, declared columns, flow."""
    lots = src.enforce(promote_header_per_run(spark, sf_dir), "lot_inventory", keys=("as_of",))
    erp, report = fx.fx_jde_lot(spark, sf_dir), fx.fx_exception_week(spark, sf_dir)
    return plans.rm_inventory(lots, erp, report, by=["as_of"])


@query
def forecast_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs, forecast = fx.fx_ship_weeks(spark, sf_dir), fx.fx_dsx_snapshots(spark, sf_dir)
    return plans.weekly.forecast_gaps(plans.weekly.choose_snapshots(runs, forecast))


def _published(name: str) -> Query:
    """One weekly table, published and read back."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = scratch_folder(spark)
        src.publish(plans.weekly_tables(weekly_inputs(spark, sf_dir))[name], root, name)
        return src.read_published(spark, root, name)

    return run


PUBLISHED = ("po", "receipt", "exception_report", "rm_inventory", "fg_inventory", "poisoned_forecast")
QUERIES.update({f"weekly_{name}": _published(name) for name in PUBLISHED})
