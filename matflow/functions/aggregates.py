"""Aggregates in which a missing value is not silently skipped and whose result doesn't depend on the order of rows.

A quantity is split into its whole part and its digits after the point, as a whole number of 10^-9. Whole numbers add
up without rounding in any order, so a sum is rounded once, at its end, and costs two plain sums.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from matflow.functions.casts import as_column

#: Digits after the point; further ones are rounded, each value for itself.
DIGITS = 9
#: From here on every double is a whole number.
_WHOLE = 2.0**53
# Types that leave room for all digits in the operations below.
_DECIMAL, _SUM, _UNIT = f"decimal(28,{DIGITS})", f"decimal(37,{DIGITS})", f"decimal({DIGITS + 1},{DIGITS})"


def _is_whole(value: Column) -> Column:
    return (F.abs(value) >= _WHOLE) | (value == F.floor(value))


def whole_part(value: Column | str) -> Column:
    """The largest whole number that is not above the value."""
    value = as_column(value)
    return F.when(_is_whole(value), value).otherwise(F.floor(value.try_cast(_DECIMAL)).cast("double"))


def fraction(value: Column | str) -> Column:
    """What the value has above ``whole_part``, in units of 10^-9, of the shortest decimal that reads as it."""
    value = as_column(value)
    digits = value.try_cast(_DECIMAL)
    above = (digits - F.floor(digits)).cast(_UNIT) * 10**DIGITS
    return F.when(_is_whole(value), F.lit(0).cast("bigint")).otherwise(above.cast("bigint"))


def exact_total(whole: Column | str, fractions: Column | str) -> Column:
    """The double nearest to a sum of whole parts and a sum of fractions; NULL if the whole part is NULL or NaN."""
    whole, fractions = F.nanvl(as_column(whole), F.lit(None).cast("double")), as_column(fractions)
    digits = fractions.cast("decimal(19,0)") * F.lit(f"{Decimal(1).scaleb(-DIGITS):f}").cast(_UNIT)
    # A sum from 10^28 on has no room for digits.
    exact = (whole.try_cast(_SUM) + digits).cast("double")
    return F.when(fractions == 0, whole).otherwise(F.coalesce(exact, whole))


def strict_sum(value: Column | str) -> Column:
    """Sum of a group, NULL as soon as one value of the group is NULL.

    Exact up to 9 digits after the point as long as whole parts add up to less than 2^53, so neither partitions nor
    their order show in it. All parts are plain partial aggregates: a hot key is reduced before the shuffle.
    """
    whole = whole_part(value)
    return F.when(F.count_if(whole.isNull()) == 0, exact_total(F.sum(whole), F.sum(fraction(value))))
