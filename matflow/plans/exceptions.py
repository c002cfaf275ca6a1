"""Item exception report with keys and campus."""

from __future__ import annotations

from pyspark.sql import DataFrame

from matflow.functions.casts import code_to_text, tolerant_double
from matflow.functions.keys import dash_key
from matflow.operators.frames import relocate_cols
from matflow.operators.lookups import join_campus_numeric


def exception_enriched(report: DataFrame, campus: DataFrame) -> DataFrame:
    """ref, campus_ref and campus, then all report columns with b_p and item_number as numbers."""
    numeric = report.withColumns(
        {"b_p": tolerant_double("b_p"), "item_number": tolerant_double("item_number")}
    )
    located = join_campus_numeric(numeric, campus, "b_p")
    item = code_to_text("item_number")
    keyed = located.withColumns(
        {"ref": dash_key(code_to_text("b_p"), item), "campus_ref": dash_key("campus", item)}
    )
    return relocate_cols(keyed, "ref", "campus_ref", "campus")
