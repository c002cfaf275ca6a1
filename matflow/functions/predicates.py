"""Row filters on item codes and descriptions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from matflow.functions.casts import as_column, tolerant_double

# Descriptions that start with one of these are not stock of interest.
EXCLUDED_PREFIXES = ("PWS ", "SUB ", "THW ", "PALLET")


def is_raw_material(item: Column | str) -> Column:
    """Raw-material codes are all digits."""
    return as_column(item).rlike("^[0-9]+$")


def is_finished_good(item: Column | str) -> Column:
    """Finished-goods codes end in a three-letter label."""
    return as_column(item).rlike("[A-Za-z]{3}$")


def is_castable(item: Column | str) -> Column:
    """True where the code reads as a number, never NULL."""
    return tolerant_double(item).isNotNull()


def has_excluded_prefix(description: Column | str) -> Column:
    description = as_column(description)
    tests = [description.startswith(F.lit(prefix)) for prefix in EXCLUDED_PREFIXES]
    return reduce(Column.__or__, tests)


def keeps_description(description: Column | str) -> Column:
    """NULL for a NULL description, so a filter on it drops that row."""
    return ~has_excluded_prefix(description)
