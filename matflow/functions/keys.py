"""Splitting record fields and building the text keys that tie the tables together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from matflow.functions.casts import as_column

MISSING = "NA"
NON_ALPHANUMERIC = "[^0-9A-Za-z]+"
SINGLE_HYPHENS = r"^[0-9A-Za-z]*+(?:-[0-9A-Za-z]++)*+-?\z"


def _fields(parts: Column, names: Sequence[str]) -> list[Column]:
    return [F.get(parts, F.lit(i)).alias(name) for i, name in enumerate(names) if name]


def split_fixed(value: Column | str, names: Sequence[str], sep: str = "~") -> list[Column]:
    """Named fields of a delimited record: missing fields are NULL, extra ones are dropped.

    An empty name skips that field.
    """
    # A single escaped character is split without a regular expression.
    literal = "".join(char if char.isalnum() else f"\\{char}" for char in sep)
    return _fields(F.split(as_column(value), literal), names)


def split_regex(value: Column | str, names: Sequence[str]) -> list[Column]:
    """Named parts of a compound code, cut at every run of non-alphanumeric characters.

    Runs become one '~' first: ``split`` would compile its expression anew for every row. Where all runs are one
    hyphen, a plain replacement gives the same and takes a fraction of the time.
    """
    value = as_column(value)
    hyphens = F.replace(value, F.lit("-"), F.lit("~"))
    marked = F.when(value.rlike(SINGLE_HYPHENS), hyphens).otherwise(F.regexp_replace(value, NON_ALPHANUMERIC, "~"))
    return split_fixed(marked, names, "~")


def strip_leading_zeros(value: Column | str) -> Column:
    return F.ltrim(as_column(value), F.lit("0"))


def remove_char(value: Column | str, char: str = "-") -> Column:
    return replace_char(value, char, "")


def replace_char(value: Column | str, old: str = "_", new: str = "-") -> Column:
    return F.replace(as_column(value), F.lit(old), F.lit(new))


def composite_key(*parts: Column | str, sep: str = "-") -> Column:
    """Parts joined by ``sep``; a missing part is spelled 'NA', so the key itself is never NULL."""
    pieces: list[Column] = []
    for part in parts:
        if pieces:
            pieces.append(F.lit(sep))
        pieces.append(F.coalesce(as_column(part), F.lit(MISSING)))
    return F.concat(*pieces)


def dash_key(*parts: Column | str) -> Column:
    """Key in its published form: joined by '_', then every '_' (also inside a part) becomes '-'."""
    return replace_char(composite_key(*parts, sep="_"))
