"""The inputs of the weekly job, derived from the driver tables.

Every function reads whole tables. ``SQL`` in ``testbed/oracles.py`` states the same inputs in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Site numbers that play the special sites of the real data.
WAREHOUSES = (26,)
TWO_WAREHOUSES = (6, 26)
LABEL_SITES = (25, 55)


# Declared, so that reading a table starts no job to find its schema.
SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def text(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("string")


def whole(value: Column | str) -> Column:
    return text((F.col(value) if isinstance(value, str) else value).cast("bigint"))


def year_month(day: Column) -> Column:
    return text(F.year(day) * 100 + F.month(day))


def week_of(column: str) -> Column:
    return F.trunc(F.col(column).cast("date"), "week")


def hold_status() -> Column:
    flag = F.col("l_returnflag")
    return F.when(flag == "R", "Hard Hold").when(flag == "A", "Soft Hold").otherwise("Useable")


def known_qty() -> Column:
    """Quantity, missing for some orders."""
    return F.when(F.col("l_orderkey") % 50 != 0, whole("l_quantity"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


def _with_part(lines: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return lines.join(part, lines["l_partkey"] == part["p_partkey"])


def _with_supplier(lines: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    return lines.join(supplier, lines["l_suppkey"] == supplier["s_suppkey"])


def fx_campus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers in debt stand under another number, so some locations find none; one location is missing."""
    supplier = F.col("s_suppkey")
    moved = F.when(F.col("s_acctbal") < 0, supplier + 90_000_000).otherwise(supplier)
    location = F.when(supplier != 1, text(moved))
    return table(spark, sf_dir, "supplier").select(location.alias("location"), text("s_nationkey").alias("campus"))


def _record(qty: Column, number: Column) -> Column:
    return F.concat_ws(
        "~",
        F.concat(F.lit("GLB-RP-"), text("l_partkey")),
        F.lpad(text("l_suppkey"), 5, "0"),
        "l_returnflag",
        "l_linestatus",
        qty,
        number,
        text(F.col("l_shipdate").cast("date")),
        text("l_linenumber"),
    )


def fx_po(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(line, as_of); some quantities are no numbers and some records are cut short."""
    order, qty = F.col("l_orderkey"), whole("l_quantity")
    full = _record(F.when(order % 89 == 0, "n/a").otherwise(qty), text(order))
    cut = F.concat_ws(
        "~",
        F.concat(F.lit("GLB-RP-"), text("l_partkey")),
        F.lpad(text("l_suppkey"), 5, "0"),
        F.lit("x"),
        F.lit("y"),
        qty,
    )
    line = F.when(order % 97 == 0, cut).otherwise(full)
    lines = _lines(spark, sf_dir).filter(F.col("l_linestatus") == "O")
    return lines.select(line.alias("line"), week_of("l_shipdate").alias("as_of"))


def fx_po_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of ``fx_po``, some with a field too many and some missing altogether."""
    po = fx_po(spark, sf_dir)
    number = F.regexp_extract("line", r"^GLB-RP-(\d+)", 1).cast("bigint")
    line = F.when(number % 13 == 1, F.concat("line", F.lit("~more"))).when(number % 29 != 2, F.col("line"))
    return po.withColumn("line", line)


def fx_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(site, month, amount) of amounts with up to four digits after the point; returned ones are negative."""
    cents = F.col("l_extendedprice").cast("decimal(14,2)") * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))
    signed = F.when(F.col("l_returnflag") == "R", -cents).otherwise(cents).cast("decimal(20,4)")
    unknown = (F.col("l_suppkey") % 20 == 7) & (F.col("l_orderkey") % 1000 == 0)
    return _lines(spark, sf_dir).select(
        text(F.col("l_suppkey") % 20).alias("site"),
        text(F.month("l_shipdate")).alias("month"),
        F.when(~unknown, text(signed)).alias("amount"),
    )


def fx_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text columns of every type by month; in some months a column is narrower than in others."""
    order, day = F.col("l_orderkey"), F.col("l_shipdate").cast("date")
    clock = lambda n: F.lpad(text(n), 2, "0")
    hours, minutes, seconds = clock(order % 24), clock(order % 60), clock((order * 7) % 60)
    time = F.concat_ws(":", hours, minutes, seconds)
    return _lines(spark, sf_dir).select(
        year_month(day).alias("month"),
        F.when(F.col("l_linestatus") == "F", "TRUE").otherwise("F").alias("flag"),
        F.when(order % 5 == 0, " NA ").otherwise(whole("l_quantity")).alias("count"),
        F.when(F.month(day) == 5, text(F.col("l_discount").cast("decimal(4,2)"))).otherwise(whole("l_quantity")).alias("number"),
        F.when(order % 3 == 0, F.concat_ws(":", hours, minutes)).otherwise(time).alias("time"),
        F.when(order % 2 == 0, text(day)).otherwise(F.translate(text(day), "-", "/")).alias("day"),
        F.when(order % 4 == 0, text(day)).otherwise(F.concat(text(day), F.lit(" "), time)).alias("moment"),
        F.lpad(text("l_partkey"), 6, "0").alias("code"),
        F.when(F.year(day) == 2001, "n/a").otherwise(whole("l_quantity")).alias("mixed"),
        F.when(order % 2 == 0, "").alias("nothing"),
    )


def fx_receipt(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = _record(whole("l_quantity"), F.concat(F.lit("R"), text("l_orderkey")))
    lines = _lines(spark, sf_dir).filter(F.col("l_linestatus") == "F")
    return lines.select(line.alias("line"), week_of("l_shipdate").alias("as_of"))


def fx_dsx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forecast snapshot of 14 months, 200001 to 200102."""
    ahead = (F.col("l_orderkey") % 14).cast("int")
    return _lines(spark, sf_dir).select(
        text(F.col("l_suppkey") % 20).alias("product_manufacturing_location_code"),
        F.concat(text(F.col("l_partkey") % 200), F.lit("-ABC")).alias("product_label_sku_code"),
        year_month(F.add_months(F.lit("2000-01-01").cast("date"), ahead)).alias("forecast_month_year_id"),
        known_qty().alias("adjusted_forecast_cases"),
    )


def fx_dsx_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast snapshots of every month, up to three per month, 14 months each."""
    month = F.trunc(F.col("l_shipdate").cast("date"), "MM")
    ahead = (F.col("l_orderkey") % 14).cast("int")
    return _lines(spark, sf_dir).select(
        F.date_add(month, (F.col("l_linenumber") % 3).cast("int")).alias("snapshot_date"),
        text(F.col("l_partkey") % 20).alias("product_manufacturing_location_code"),
        F.concat(text(F.col("l_partkey") % 200), F.lit("-ABC")).alias("product_label_sku_code"),
        year_month(F.add_months(month, ahead)).alias("forecast_month_year_id"),
        known_qty().alias("adjusted_forecast_cases"),
    )


# The bill of materials is wider than what the job uses of it.
BOM_WIDTH = 43


def _bom_columns() -> list[Column]:
    part, size = F.col("p_partkey"), F.col("p_size")
    return [
        F.concat(text(part % 20), F.lit("-"), text(part % 200), F.lit("ABC")).alias("ref"),
        part.alias("component"),
        text(size).alias("quantity_w_scrap"),
        F.when(size % 10 != 0, text(size * 3)).alias("next_28_days_open_order"),
        *(F.concat("p_brand", F.lit(f"-{n}")).alias(f"x{n:02d}") for n in range(5, BOM_WIDTH + 1)),
    ]


def fx_bom(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(*_bom_columns())


def _exception_columns() -> list[Column]:
    part, kind = F.col("p_partkey"), F.col("p_type")
    return [
        F.when(part % 101 == 0, "OLD").when(part % 103 != 0, text(part % 100)).alias("b_p"),
        text(part).alias("item_number"),
        F.when(kind == "SMALL", "LBL").otherwise(kind).alias("mpf_or_line"),
    ]


def fx_exception(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(*_exception_columns())


def _parts_by_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts shipped in a week, each once."""
    active = _lines(spark, sf_dir).select(week_of("l_shipdate").alias("as_of"), "l_partkey").distinct()
    return _with_part(active, spark, sf_dir)


def fx_ship_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run dates of the weekly inputs."""
    return _lines(spark, sf_dir).select(week_of("l_shipdate").alias("as_of")).distinct()


def fx_bom_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parts_by_week(spark, sf_dir).select("as_of", *_bom_columns())


def fx_exception_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parts_by_week(spark, sf_dir).select("as_of", *_exception_columns())


LOT_COLUMNS = (
    *("location", "campus_no", "item", "description"),
    *("inventory_hold_status", "current_inventory_balance"),
)


def _lots(spark: SparkSession, sf_dir: str) -> DataFrame:
    lots = _with_supplier(_with_part(_lines(spark, sf_dir), spark, sf_dir), spark, sf_dir)
    size = F.col("p_size")
    prefix = (
        F.when(size % 10 == 0, "PWS ")
        .when(size % 10 == 1, "SUB ")
        .when(size % 10 == 2, "THW ")
        .when(size % 10 == 3, "PALLET ")
        .otherwise("")
    )
    code = F.when(size % 3 == 0, F.concat(text("l_partkey"), F.lit("-ABC")))
    return lots.select(
        F.when(size % 2 == 0, "RM").otherwise("FG").alias("sheet"),
        text("l_suppkey").alias("location"),
        text("s_nationkey").alias("campus_no"),
        code.otherwise(F.lpad(text("l_partkey"), 6, "0")).alias("item"),
        F.concat(prefix, F.col("p_name")).alias("description"),
        hold_status().alias("inventory_hold_status"),
        known_qty().alias("current_inventory_balance"),
        week_of("l_shipdate").alias("as_of"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber") + 10).alias("row_no"),
    )


def fx_lot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lot report with an RM and an FG sheet, and its week as ``as_of``."""
    return _lots(spark, sf_dir).drop("row_no")


def _later_layout(as_of: Column) -> Column:
    """Every other week has its columns in reverse order, below two more title rows."""
    return F.floor(F.datediff(as_of, F.lit("1970-01-05").cast("date")) / 7) % 2 == 1


def lot_header_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    weeks = fx_ship_weeks(spark, sf_dir)
    return weeks.select("as_of", F.when(_later_layout(F.col("as_of")), 5).otherwise(3).alias("header_row"))


def lot_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lot report as sheets of many weeks: a title row, the header where ``lot_header_rows`` says, and the data."""

    def cells(values: list[Column]) -> list[Column]:
        pairs = zip(values, reversed(values), strict=True)
        later = _later_layout(F.col("as_of"))
        return [F.when(later, b).otherwise(a).alias(f"c{n}") for n, (a, b) in enumerate(pairs, start=1)]

    names = [F.lit(name.replace("_", " ").title()) for name in LOT_COLUMNS]
    sheets = F.explode(F.array(F.lit("RM"), F.lit("FG"))).alias("sheet")
    heads = lot_header_rows(spark, sf_dir).select("as_of", "header_row", sheets)
    title = heads.select("as_of", "sheet", F.lit(1).cast("bigint").alias("row_no"), *cells([F.lit("Lots")] * len(names)))
    header = heads.select("as_of", "sheet", F.col("header_row").cast("bigint").alias("row_no"), *cells(names))
    data = _lots(spark, sf_dir).select("as_of", "sheet", "row_no", *cells([F.col(name) for name in LOT_COLUMNS]))
    return title.unionByName(header).unionByName(data)


def fx_jde_lot(spark: SparkSession, sf_dir: str) -> DataFrame:
    lots = _with_part(_lines(spark, sf_dir), spark, sf_dir)
    suffix = F.when(F.col("p_size") % 3 == 0, "ABC").otherwise("")
    return lots.select(
        text("l_suppkey").alias("bp"),
        F.concat(text("l_partkey"), suffix).alias("item_number"),
        F.col("p_name").alias("description"),
        whole("l_quantity").alias("on_hand"),
        week_of("l_shipdate").alias("as_of"),
    )


def _stock(lines: DataFrame, *keys: str) -> DataFrame:
    """Summed before any join, so the joins see one row per key."""
    return lines.groupBy(*keys).agg(F.sum("l_quantity").alias("qty"))


def fx_inv_bal(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag, qty = F.col("l_returnflag"), F.col("l_quantity")
    sums = _lines(spark, sf_dir).groupBy("l_suppkey", "l_partkey").agg(
        F.sum(qty).alias("all"),
        *(F.sum(F.when(flag == f, qty)).alias(f) for f in ("N", "A", "R")),
    )
    size = F.col("p_size")
    suffix = F.when(size % 3 == 0, "ABC").when(size % 7 == 0, "F").otherwise("")
    return _with_part(sums, spark, sf_dir).select(
        text("l_suppkey").alias("bp"),
        F.concat(text("l_partkey"), suffix).alias("item"),
        F.col("p_name").alias("description"),
        whole("all").alias("inventory"),
        whole("N").alias("usable"),
        whole("A").alias("soft_hold"),
        whole("R").alias("hard_hold"),
    )


def fx_wh_rm(spark: SparkSession, sf_dir: str) -> DataFrame:
    stock = _with_part(_stock(_lines(spark, sf_dir), "l_suppkey", "l_partkey"), spark, sf_dir)
    return _with_supplier(stock.filter(F.col("p_size") % 3 != 0), spark, sf_dir).select(
        text("l_suppkey").alias("location"),
        text("s_nationkey").alias("campus"),
        text("l_partkey").alias("item"),
        F.col("p_name").alias("na_2"),
        whole("qty").alias("current_inventory_balance"),
    )


def fx_wh_fg(spark: SparkSession, sf_dir: str) -> DataFrame:
    stock = _stock(_lines(spark, sf_dir), "l_suppkey", "l_partkey", "l_returnflag")
    goods = _with_part(stock, spark, sf_dir).filter(F.col("p_size") % 3 == 0)
    return goods.select(
        text("l_suppkey").alias("location"),
        text(F.col("l_suppkey") % 20).alias("product_manufacturing_location"),
        F.concat(text("l_partkey"), F.lit("-ABC")).alias("item"),
        F.col("p_name").alias("na_2"),
        hold_status().alias("hold_status"),
        whole("qty").alias("current_inventory_balance"),
    )


def fx_inv_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    lots = _with_supplier(_with_part(_lines(spark, sf_dir), spark, sf_dir), spark, sf_dir)
    return lots.select(
        text("l_suppkey").alias("location"),
        F.col("s_name").alias("location_nm"),
        F.concat(text("l_partkey"), F.lit("-ABC")).alias("product_label_sku"),
        F.col("p_name").alias("description"),
        hold_status().alias("inventory_hold_status"),
        known_qty().alias("inventory_qty_cases"),
    )


def fx_mfg_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to two makers of every item delivered to a location; items on order have another code."""
    maker = (F.col("l_suppkey") + F.col("l_linenumber") % 2) % 20
    suffix = F.when(F.col("l_linestatus") == "F", "-ABC").otherwise("-OPN")
    made = _lines(spark, sf_dir).select("l_suppkey", "l_partkey", maker.alias("maker"), suffix.alias("suffix"))
    return made.distinct().select(
        text("l_suppkey").alias("location_no"),
        F.concat(text("l_partkey"), "suffix").alias("product_label_sku_code"),
        text("maker").alias("product_manufacturing_location_code"),
    )


def fx_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots are taken on working days only: those of a weekend on the Friday before."""
    day = F.col("o_orderdate").cast("date")
    working = F.date_sub(day, F.greatest(F.weekday(day) - 4, F.lit(0)))
    return table(spark, sf_dir, "orders").select(working.alias("snapshot_date")).distinct()


def fx_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(week_of("o_orderdate").alias("as_of")).distinct()


def exception_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exception report as a sheet: three title rows, the header in row 4, data from row 5 on."""
    titles = [
        (1, "Item exceptions", None, None),
        (2, None, None, None),
        (3, "All branches", None, None),
        (4, "B/P", "Item Number", "MPF or Line"),
    ]
    head = spark.createDataFrame(titles, "row_no bigint, c1 string, c2 string, c3 string")
    # Part keys count from 0, so they number the data rows.
    rows = table(spark, sf_dir, "part").select((F.col("p_partkey") + 5), *_exception_columns())
    return head.unionAll(rows)
