"""Declared columns of the input tables and declared schemas of the published tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Named columns of each input. They arrive as text; further columns are carried along as text.
SOURCES: dict[str, tuple[str, ...]] = {
    "campus": ("location", "campus"),
    "forecast": (
        "product_manufacturing_location_code",
        "product_label_sku_code",
        "forecast_month_year_id",
        "adjusted_forecast_cases",
    ),
    "bom": ("ref", "quantity_w_scrap", "next_28_days_open_order"),
    "exception_report": ("b_p", "item_number", "mpf_or_line"),
    "lot_inventory": ("location", "campus_no", "item", "description", "current_inventory_balance"),
    "erp_lot_detail": ("bp", "item_number", "description", "on_hand"),
    "inv_bal": ("bp", "item", "description", "inventory", "usable", "soft_hold", "hard_hold"),
    "warehouse_rm": ("location", "na_2", "current_inventory_balance", "campus", "item"),
    "warehouse_fg": (
        "location",
        "product_manufacturing_location",
        "item",
        "na_2",
        "hold_status",
        "current_inventory_balance",
    ),
    "inventory_analysis": (
        "location",
        "location_nm",
        "product_label_sku",
        "description",
        "inventory_hold_status",
        "inventory_qty_cases",
    ),
    "manufacturer_map": (
        "location_no",
        "product_label_sku_code",
        "product_manufacturing_location_code",
    ),
}

_TEXT, _NUMBER, _DATE = T.StringType(), T.DoubleType(), T.DateType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_STOCK_KEYS = {"ref": _TEXT, "campus_ref": _TEXT, "location": _TEXT, "campus": _TEXT}
_ORDER_FIELDS = {
    **{"ref": _TEXT, "campus_ref": _TEXT, "campus": _TEXT, "item": _TEXT, "location": _TEXT},
    **{"qty": _NUMBER, "date": _DATE},
}

RM_INVENTORY = _schema(**_STOCK_KEYS, item=_NUMBER, description=_TEXT, inventory=_NUMBER)
FG_INVENTORY = _schema(
    **_STOCK_KEYS,
    item=_TEXT,
    description=_TEXT,
    inventory_hold_status=_TEXT,
    inventory_qty_cases=_NUMBER,
)
ORDERS = _schema(**_ORDER_FIELDS, po_no=_TEXT)
RECEIPTS = _schema(**_ORDER_FIELDS, receipt_no=_TEXT)

TABLES: dict[str, T.StructType] = {
    "po": ORDERS,
    "receipt": RECEIPTS,
    "rm_inventory": RM_INVENTORY,
    "fg_inventory": FG_INVENTORY,
}


def enforce(df: DataFrame, source: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """``keys`` as they are, then declared columns, then unknown ones, all as text; a missing one is an error."""
    declared = SOURCES[source]
    missing = [name for name in declared if name not in df.columns]
    if missing:
        raise ValueError(f"{source} lacks the columns {missing}")
    extra = [name for name in df.columns if name not in (*declared, *keys)]
    return df.select(*keys, *(F.col(f"`{name}`").cast("string").alias(name) for name in (*declared, *extra)))
