"""Types of text columns. What a value can be read as is a set of bits; a column can be read as what all its values
can, which is the bitwise AND. Sets of bits are one number a column, and merge over weeks without reading them again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matflow.functions.casts import DATE_PATTERN, blank_to_null, tolerant_date

#: Types in the order in which they are tried; the place in it is the bit.
TYPES = ("boolean", "integer", "double", "time", "date", "timestamp")
TEXT = "string"
ALL = (1 << len(TYPES)) - 1

_LOGICAL = ("T", "F", "TRUE", "FALSE", "true", "false")
# A number with a leading zero stays text: it is a code.
_INTEGER = r"^[+-]?(0|[1-9]\d{0,17})$"
_NUMBER = r"^[+-]?((0|[1-9]\d*)(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"
_CLOCK = r"([01]?\d|2[0-3]):([0-5]\d)(:([0-5]\d)(\.\d{1,6})?)?"
_MOMENT = rf"{DATE_PATTERN}([ T]{_CLOCK}Z?)?$"


def tolerant_time(value: Column) -> Column:
    """h:mm, with seconds or not, as the seconds since midnight; anything else gives NULL."""
    part = lambda n: F.regexp_extract(value, f"^{_CLOCK}$", n)
    seconds = F.concat(F.when(part(4) == "", "0").otherwise(part(4)), part(5)).try_cast("double")
    return F.when(value.rlike(f"^{_CLOCK}$"), part(1).try_cast("int") * 3600 + part(2).try_cast("int") * 60 + seconds)


def tolerant_timestamp(value: Column) -> Column:
    """A date, or a date and a time, as a moment without a zone; anything else gives NULL."""
    plain = F.regexp_replace(F.translate(value, "/TZ", "- "), " $", "")
    return F.when(value.rlike(_MOMENT), plain.try_cast("timestamp_ntz"))


def _bit(name: str) -> Column:
    return F.lit(1 << TYPES.index(name))


def _bits(value: Column) -> Column:
    """The bits of a text without blanks around it. Numbers, booleans, times and dates look different, so the first
    look that fits decides, and of most texts only the first few characters are read."""
    whole = F.when(value.rlike(_INTEGER), _bit("integer")).otherwise(0)
    # A clock that matches is a time; a date may still name a day that never was.
    is_time = F.contains(value, F.lit(":")) & value.rlike(f"^{_CLOCK}$")
    is_dated = (F.contains(value, F.lit("-")) | F.contains(value, F.lit("/"))) & value.rlike(DATE_PATTERN)
    day = value.rlike(DATE_PATTERN + "$") & tolerant_date(value).isNotNull()
    dated = [F.when(day, _bit("date")).otherwise(0), F.when(tolerant_timestamp(value).isNotNull(), _bit("timestamp")).otherwise(0)]
    found = F.when(value.isNull(), F.lit(ALL)).when(value.rlike(_NUMBER), whole + _bit("double"))
    found = found.when(value.isin(*_LOGICAL), _bit("boolean")).when(is_time, _bit("time"))
    return found.when(is_dated, reduce(Column.__add__, dated)).otherwise(0)


def type_bits(value: Column) -> Column:
    """The bits of what a text can be read as; a missing one (NULL, blank, NA) can be anything."""
    return _bits(blank_to_null(value))


def text_columns(df: DataFrame) -> list[str]:
    return [field.name for field in df.schema if isinstance(field.dataType, T.StringType)]


def type_masks(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, column, mask) of every text column, from one pass: the cells become rows, with one aggregate for all columns.

    One expression for all columns stays small enough to be compiled, however many columns there are.
    """
    names = [name for name in text_columns(df) if name not in by]
    cells = df.unpivot(list(by), [F.col(f"`{name}`") for name in names], "column", "__text")
    if not by:  # a missing value of every column: it changes no mask, and a table without rows has masks, too
        missing = df.sparkSession.createDataFrame([(name, None) for name in names], "column string, __text string")
        cells = cells.unionByName(missing)
    read = cells.withColumn("__text", blank_to_null("__text")).withColumn("mask", _bits(F.col("__text")))
    masks = read.groupBy(*by, "column").agg(F.bit_and("mask").alias("mask"))
    if not by:  # one row a column, in the table's order
        place = F.array_position(F.array(*map(F.lit, names)), F.col("column"))
        masks = masks.coalesce(1).sortWithinPartitions(place)
    return masks.withColumn("mask", F.coalesce("mask", F.lit(ALL)))


def merge_masks(masks: DataFrame) -> DataFrame:
    """(column, mask) over all weeks, tables or earlier merges."""
    return masks.groupBy("column").agg(F.bit_and("mask").alias("mask"))


def types_of(masks: DataFrame, integers: bool = True) -> DataFrame:
    """``masks`` with the first type that its bits allow instead; without ``integers`` whole numbers are doubles."""
    found: Column = F.lit(TEXT)
    for bit, name in reversed(list(enumerate(TYPES))):
        if integers or name != "integer":
            found = F.when(F.col("mask").bitwiseAND(1 << bit) != 0, name).otherwise(found)
    return masks.select(*(c for c in masks.columns if c != "mask"), found.alias("type"))


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """The named text columns in their types; blanks and NA become NULL, a time becomes its seconds since midnight."""
    casts = {"time": tolerant_time, "date": tolerant_date, "timestamp": tolerant_timestamp}

    def typed(name: str) -> Column:
        column = F.col(f"`{name}`")
        if name not in types:
            return column
        value, kind = blank_to_null(column), types[name]
        cast = casts[kind](value) if kind in casts else value.try_cast("bigint" if kind == "integer" else kind)
        return cast.alias(name)

    return df.select(*(typed(name) for name in df.columns))
