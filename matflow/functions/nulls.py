"""Row-wise rules for missing numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from matflow.functions.casts import as_column


def null_to_zero(value: Column | str) -> Column:
    return F.coalesce(as_column(value), F.lit(0.0))


def null_propagating_max(left: Column | str, right: Column | str) -> Column:
    """Larger of two values, NULL if either is NULL (``greatest`` would skip the NULL)."""
    left, right = as_column(left), as_column(right)
    return F.when(left.isNotNull() & right.isNotNull(), F.greatest(left, right))
