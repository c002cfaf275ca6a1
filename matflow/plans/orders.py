"""Open purchase orders and receipts: one narrow stage and one campus lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from matflow.functions.casts import tolerant_date, tolerant_double
from matflow.functions.keys import composite_key, split_fixed, split_regex, strip_leading_zeros
from matflow.operators.lookups import join_campus_text


def parse_records(lines: DataFrame, number: str, by: Sequence[str] = ()) -> DataFrame:
    """(item, location, qty, date) and the document number, named ``number``, of every record."""
    # Fields 3, 4 and 8 are not used.
    fields = lines.select(
        *by, *split_fixed("line", ["code", "site", "", "", "amount", number, "day", ""])
    )
    return fields.select(
        *by,
        *split_regex("code", ["", "", "item"]),
        strip_leading_zeros("site").alias("location"),
        tolerant_double("amount").alias("qty"),
        tolerant_date("day").alias("date"),
        number,
    )


def _keyed(
    lines: DataFrame, campus: DataFrame, number: str, sep: str, by: Sequence[str]
) -> DataFrame:
    located = join_campus_text(parse_records(lines, number, by), campus)
    return located.select(
        *by,
        composite_key("location", "item", sep=sep).alias("ref"),
        composite_key("campus", "item", sep=sep).alias("campus_ref"),
        *("campus", "item", "location", "qty", "date", number),
    )


def open_po(lines: DataFrame, campus: DataFrame, sep: str = "-", by: Sequence[str] = ()) -> DataFrame:
    """Open purchase orders from column ``line``; ``sep`` is '_' in the older reports."""
    return _keyed(lines, campus, "po_no", sep, by)


def receipts(lines: DataFrame, campus: DataFrame, sep: str = "-", by: Sequence[str] = ()) -> DataFrame:
    """Receipts from column ``line``; ``sep`` is '_' in the older reports."""
    return _keyed(lines, campus, "receipt_no", sep, by)
