"""Casts that turn bad text into NULL instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plain decimal notation only. Spark would read the type suffixes of '12345F' and '12345D' as part
# of a number; here such texts are finished-goods codes and must not become numbers.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

# A date may be followed by anything, for instance a time of day.
DATE_PATTERN = r"^\s*(\d{4}-\d{1,2}-\d{1,2}|\d{4}/\d{1,2}/\d{1,2})"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def tolerant_double(value: Column | str) -> Column:
    """Text to double; anything that is not a plain decimal number gives NULL."""
    value = as_column(value)
    return F.when(value.rlike(NUMBER_PATTERN), value.try_cast("double"))


def tolerant_date(value: Column | str) -> Column:
    """Text that starts with y-m-d or y/m/d to date; anything else gives NULL."""
    value = as_column(value)
    # A plain cast reads the usual y-m-d. It would also read a bare year or month, hence the test.
    usual = (F.substring(value, 5, 1) == "-") & (F.length(F.trim(value)) >= 8)
    leading = F.regexp_extract(value, DATE_PATTERN, 1)
    return F.coalesce(
        F.when(usual, value.try_cast("date")),
        F.replace(leading, F.lit("/"), F.lit("-")).try_cast("date"),
    )


def code_to_text(number: Column | str) -> Column:
    """Numeric code to plain digits: 12345.0 -> '12345', 100000.0 -> '100000', 12.5 -> '12.5'."""
    number = as_column(number)
    decimal = number.try_cast("decimal(38,15)").cast("string")
    plain = F.regexp_replace(decimal, r"\.?0+$", "")
    return F.when(
        (number == F.floor(number)) & (F.abs(number) < F.lit(1e15)),
        number.try_cast("bigint").cast("string"),
    ).otherwise(F.coalesce(plain, number.cast("string")))


def blank_to_null(text: Column | str) -> Column:
    """Trimmed text; the empty text and the text 'NA' count as missing."""
    trimmed = F.trim(as_column(text))
    return F.when(~trimmed.isin("", "NA"), trimmed)
