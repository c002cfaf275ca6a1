"""Grouped sums and distinct rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from matflow.functions.aggregates import strict_sum


def group_sum_strict(df: DataFrame, keys: Sequence[str], value: Column | str, name: str) -> DataFrame:
    """One row per key with the strict sum (NULL if any value of the group is NULL)."""
    return df.groupBy(*keys).agg(strict_sum(value).alias(name))


def distinct_rows(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()
