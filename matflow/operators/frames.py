"""Column bookkeeping: choosing, naming, ordering, typing and stacking columns.

All of it is metadata work on the plan; only ``infer_types`` reads data, and only one row of it.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matflow.operators.inference import cast_columns, type_masks, types_of


def project_drop(df: DataFrame, keep: Sequence[str] | None = None, drop: Sequence[str] = ()) -> DataFrame:
    """Keep the named columns (all if none are named), then drop others by name."""
    kept = df.select(*keep) if keep is not None else df
    return kept.drop(*drop)


def project_positional(df: DataFrame, positions: Iterable[int]) -> DataFrame:
    """Columns by their number, counted from 1, in the given order; a number that is no column is an error."""
    wanted = list(positions)
    if wrong := [at for at in wanted if not 1 <= at <= len(df.columns)]:
        raise ValueError(f"the table has {len(df.columns)} columns, so none with the numbers {wrong}")
    return df.select(*(F.col(f"`{df.columns[at - 1]}`") for at in wanted))


def rename_cols(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename ``{old: new}``."""
    return df.withColumnsRenamed(names)


def relocate_cols(df: DataFrame, *front: str) -> DataFrame:
    """Move the named columns to the front, in that order."""
    return df.select(*front, *(name for name in df.columns if name not in front))


def ordinal_rename(df: DataFrame, first: int, prefix: str) -> DataFrame:
    """Name the columns from position ``first`` on by their ordinal: prefix01, prefix02, ..."""
    kept = df.columns[: first - 1]
    numbered = [f"{prefix}{i:02d}" for i in range(1, len(df.columns) - len(kept) + 1)]
    return df.toDF(*kept, *numbered)


def clean_name_list(names: Iterable[str | None]) -> list[str]:
    """snake_case names; a missing name becomes 'na', an empty one 'x', repeats get the next free of _2, _3, ...

    Letters with accents become plain ones.
    """
    seen: dict[str, int] = {}
    cleaned: list[str] = []
    for raw in names:
        name = "NA" if raw is None else raw
        name = "".join(c for c in unicodedata.normalize("NFKD", name) if not unicodedata.combining(c))
        name = re.sub("['\"]", "", name).replace("%", "_percent_").replace("#", "_number_")
        name = re.sub("[^0-9A-Za-z]+", "_", name).strip("_")
        name = re.sub("([a-z0-9])([A-Z])", r"\1_\2", name)
        name = re.sub("([A-Z]+)([A-Z][a-z])", r"\1_\2", name).lower()
        if not name or name[0].isdigit():
            name = "x" + name
        free = name
        while free in cleaned:
            seen[name] = seen.get(name, 1) + 1
            free = f"{name}_{seen[name]}"
        cleaned.append(free)
    return cleaned


def clean_names(df: DataFrame) -> DataFrame:
    return df.toDF(*clean_name_list(df.columns))


def union_by_name(top: DataFrame, bottom: DataFrame, schema: T.StructType) -> DataFrame:
    """Stack two tables by column name, both cast to the declared schema first."""

    def declared(df: DataFrame) -> DataFrame:
        return df.select(*(F.col(field.name).cast(field.dataType) for field in schema))

    return declared(top).unionByName(declared(bottom))


# --- type inference ---------------------------------------------------------------------------


def inferred_types(df: DataFrame) -> DataFrame:
    """(column, type) of every text column, from one pass over the table; whole numbers count as doubles.

    A type fits when every value that is not missing reads as it; 'string' fits always.
    """
    return types_of(type_masks(df), integers=False)


def infer_types(df: DataFrame) -> DataFrame:
    """Cast the text columns to the types that ``inferred_types`` finds (one row per column is read)."""
    return cast_columns(df, {row["column"]: row["type"] for row in inferred_types(df).collect()})
