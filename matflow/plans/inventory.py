"""Raw-material (RM) and finished-goods (FG) inventory, from lot reports and older balance reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matflow.functions.aggregates import strict_sum
from matflow.functions.casts import blank_to_null, code_to_text, tolerant_double
from matflow.functions.keys import composite_key, dash_key, remove_char, replace_char
from matflow.functions.predicates import (
    is_castable,
    is_finished_good,
    is_raw_material,
    keeps_description,
)
from matflow.operators.frames import union_by_name
from matflow.operators.grouping import group_sum_strict
from matflow.operators.lookups import (
    join_campus_numeric,
    label_items,
    manufacturer_keys,
    semi_join_labels,
)
from matflow.operators.reshape import unpivot_hold_status
from matflow.sources.schemas import FG_INVENTORY, RM_INVENTORY

RM_COLUMNS = RM_INVENTORY.names
FG_COLUMNS = FG_INVENTORY.names

# The warehouse whose stock comes from its own report, and the sites whose label stock
# was added back from the balance report.
WAREHOUSES = (226,)
LABEL_SITES = (25, 55)


# --- lot reports ------------------------------------------------------------------------------


def _lots(report: DataFrame, wanted: Column, by: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """Lots of one item class without excluded descriptions, reduced to the columns in use.

    Class and description are grouping keys of the later sum, so filtering first is exact.
    """
    lots = report.select(
        *by,
        "location",
        F.col("campus_no").alias("campus"),
        remove_char("item").alias("item"),
        "description",
        *extra,
        tolerant_double("current_inventory_balance").alias("balance"),
    )
    return lots.filter(wanted & keeps_description("description"))


def rm_inventory_lot(report: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Raw-material stock per location, campus, item text and description.

    '007' and '7' stay two rows with the same key.
    """
    lots = _lots(report, is_raw_material("item"), by)
    stock = group_sum_strict(
        lots, [*by, "location", "campus", "item", "description"], "balance", "inventory"
    )
    numeric = stock.withColumn("item", F.col("item").cast("double"))
    item = code_to_text("item")
    keyed = numeric.withColumns(
        {"ref": dash_key("location", item), "campus_ref": dash_key("campus", item)}
    )
    return keyed.select(*by, *RM_COLUMNS)


def label_inventory(erp_lots: DataFrame, exceptions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Label stock, lot by lot; the site is its own campus, keys keep the item as text."""
    lots = erp_lots.filter(is_raw_material("item_number")).select(
        *by,
        dash_key("bp", "item_number").alias("ref"),
        dash_key("bp", "item_number").alias("campus_ref"),
        F.col("bp").alias("location"),
        F.col("bp").alias("campus"),
        F.col("item_number").cast("double").alias("item"),
        "description",
        tolerant_double("on_hand").alias("inventory"),
    )
    return semi_join_labels(lots, label_items(exceptions, by), by)


def rm_inventory(
    report: DataFrame, erp_lots: DataFrame, exceptions: DataFrame, by: Sequence[str] = ()
) -> DataFrame:
    """Raw-material stock plus label stock, each label lot once."""
    return rm_inventory_lot(report, by).unionByName(label_inventory(erp_lots, exceptions, by))


def fg_inventory_lot(report: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Finished-goods stock per location, campus, item, description and hold status."""
    lots = _lots(report, is_finished_good("item"), by, ["inventory_hold_status"])
    keys = [*by, "location", "campus", "item", "description", "inventory_hold_status"]
    stock = group_sum_strict(lots, keys, "balance", "inventory_qty_cases")
    keyed = stock.withColumns(
        {"ref": dash_key("location", "item"), "campus_ref": dash_key("campus", "item")}
    )
    return keyed.select(*by, *FG_COLUMNS)


# --- older balance reports --------------------------------------------------------------------


def _is_site(site: Column, sites: Sequence[int]) -> Column:
    return site.isin(*(float(s) for s in sites))


def rm_inventory_balance(
    inv_bal: DataFrame,
    warehouse: DataFrame,
    campus: DataFrame,
    warehouses: Sequence[int] = WAREHOUSES,
) -> DataFrame:
    """Raw materials of the balance report, with the warehouse rows taken from the warehouse report."""
    site = tolerant_double("bp")
    sites = inv_bal.filter(~_is_site(site, warehouses) & is_castable("item")).select(
        site.alias("bp"),
        tolerant_double("item").alias("item"),
        blank_to_null("description").alias("description"),
        tolerant_double("inventory").alias("inventory"),
    )
    located = join_campus_numeric(sites, campus, "bp")
    item = code_to_text("item")
    own = located.select(
        dash_key(code_to_text("bp"), item).alias("ref"),
        dash_key("campus", item).alias("campus_ref"),
        code_to_text("bp").alias("location"),
        *("campus", "item", "description", "inventory"),
    )
    number = tolerant_double("item")
    stored = warehouse.filter(_is_site(tolerant_double("location"), warehouses)).select(
        dash_key("location", code_to_text(number)).alias("ref"),
        dash_key("campus", code_to_text(number)).alias("campus_ref"),
        code_to_text(tolerant_double("location")).alias("location"),
        blank_to_null("campus").alias("campus"),
        number.alias("item"),
        blank_to_null("na_2").alias("description"),
        tolerant_double("current_inventory_balance").alias("inventory"),
    )
    return union_by_name(own, stored, RM_INVENTORY)


def label_inventory_sites(
    inv_bal: DataFrame, exceptions: DataFrame, sites: Sequence[int] = LABEL_SITES
) -> DataFrame:
    """Label stock of the given sites from the balance report; the site is its own campus."""
    site, number = tolerant_double("bp"), tolerant_double("item")
    key = composite_key(code_to_text(site), code_to_text(number))
    rows = inv_bal.filter(_is_site(site, sites) & is_castable("item")).select(
        key.alias("ref"),
        key.alias("campus_ref"),
        code_to_text(site).alias("location"),
        code_to_text(site).alias("campus"),
        number.alias("item"),
        blank_to_null("description").alias("description"),
        tolerant_double("inventory").alias("inventory"),
    )
    return semi_join_labels(rows, label_items(exceptions))


def fg_inventory_balance(
    inv_bal: DataFrame,
    warehouse: DataFrame,
    campus: DataFrame,
    warehouses: Sequence[int] = WAREHOUSES,
) -> DataFrame:
    """Finished goods of the balance report by hold status, with the warehouse rows taken from the
    warehouse report, where the manufacturing location stands for the campus."""
    site = tolerant_double("bp")
    goods = inv_bal.filter(~_is_site(site, warehouses) & ~is_castable("item")).select(
        site.alias("bp"), "item", "description", "usable", "soft_hold", "hard_hold"
    )
    located = join_campus_numeric(goods, campus, "bp")
    keyed = located.select(
        dash_key(code_to_text("bp"), "item").alias("ref"),
        dash_key("campus", "item").alias("campus_ref"),
        code_to_text("bp").alias("location"),
        *("campus", "item", "description", "usable", "soft_hold", "hard_hold"),
    )
    own = unpivot_hold_status(keyed, FG_COLUMNS[:6])
    maker, item = F.col("product_manufacturing_location"), remove_char("item")
    place = code_to_text(tolerant_double("location"))
    stored = warehouse.filter(_is_site(tolerant_double("location"), warehouses)).select(
        dash_key(place, item).alias("ref"),
        dash_key(maker, item).alias("campus_ref"),
        place.alias("location"),
        blank_to_null(maker).alias("campus"),
        blank_to_null(item).alias("item"),
        blank_to_null("na_2").alias("description"),
        blank_to_null("hold_status").alias("inventory_hold_status"),
        tolerant_double("current_inventory_balance").alias("inventory_qty_cases"),
    )
    return union_by_name(own, stored, FG_INVENTORY)


def fg_inventory_mfg(
    analysis: DataFrame,
    mfg_map: DataFrame,
    missing_is_zero: bool = False,
    drop_items: Sequence[str] = (),
) -> DataFrame:
    """Finished goods by location and manufacturing location.

    Both sides are reduced before the join: stock to one row per key, the map to its distinct rows
    with their number. A repeated map row would repeat the stock rows, so it multiplies their sum.
    """
    # Only a missing text counts as 0; a text that is no number stays unknown.
    qty = F.coalesce("inventory_qty_cases", F.lit("0")) if missing_is_zero else "inventory_qty_cases"
    rows = analysis.select(
        "location",
        "location_nm",
        remove_char("product_label_sku").alias("item"),
        "description",
        F.col("inventory_hold_status").alias("hold_status"),
        tolerant_double(qty).alias("balance"),
    )
    if drop_items:
        rows = rows.filter(~F.col("item").isin(*drop_items))
    stock = rows.groupBy("location", "location_nm", "item", "description", "hold_status").agg(
        strict_sum("balance").alias("balance")
    )
    stock = stock.withColumn("ref", composite_key("location", "item", sep="_"))
    makers = manufacturer_keys(mfg_map)
    makers = makers.groupBy(*makers.columns).agg(F.count(F.lit(1)).alias("copies"))
    # Both refs are built keys and never NULL, so plain equality is exact.
    return stock.join(makers, "ref", "left").select(
        replace_char("ref").alias("ref"),
        replace_char("mfg_ref").alias("mfg_ref"),
        *("location", "location_nm", "product_manufacturing_location"),
        *("item", "description", "hold_status"),
        (F.col("balance") * F.coalesce("copies", F.lit(1))).alias("current_inventory_balance"),
    )
