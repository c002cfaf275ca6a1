"""Left and semi joins of a large table to a lookup.

A lookup is broadcast only when its size is known to be small. For a stored lookup that is the
planner's own test of its files against ``spark.sql.autoBroadcastJoinThreshold``, so it gets no hint.
For a computed lookup, whose size the planner cannot know, ``broadcast_if_small`` measures rows and
bytes first. Any other lookup is joined by a shuffle, where adaptive execution splits hot keys of the
large side (``spark.sql.adaptive.skewJoin``).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matflow.functions.casts import tolerant_double
from matflow.functions.keys import composite_key, remove_char
from matflow.functions.nulls import null_to_zero

BROADCAST_BYTES = 64 * 1024 * 1024
# Room for object headers and hash slots on top of the values themselves.
_ROW_BYTES, _FIELD_BYTES = 48, 16


def measured_bytes(df: DataFrame) -> int:
    """Upper bound of the in-memory size, from one aggregate over the table."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    text_bytes = sum((F.coalesce(F.octet_length(c), F.lit(0)).cast("bigint") for c in texts), F.lit(0))
    rows, text = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(text_bytes), F.lit(0))).first()
    return rows * (_ROW_BYTES + _FIELD_BYTES * len(df.columns)) + text


def fits_broadcast(lookup: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """True if the lookup measures at most ``max_bytes``.

    Measuring costs one scan of the lookup and saves a shuffle of the large side. A session that has
    switched broadcasts off (a negative threshold) gets none.
    """
    threshold = lookup.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    return not threshold.startswith("-") and measured_bytes(lookup) <= max_bytes


def broadcast_if_small(lookup: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast if the lookup is measured to be small; else return it as it is."""
    return F.broadcast(lookup) if fits_broadcast(lookup, max_bytes) else lookup


def lookup_join(
    large: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "left", null_safe: bool = True
) -> DataFrame:
    """Equi-join on the named keys; a NULL key matches a NULL key unless ``null_safe`` is off.

    The key list is explicit, and any other shared column name is an error.
    """
    if how != "left_semi":
        shared = (set(large.columns) & set(lookup.columns)) - set(on)
        if shared:
            raise ValueError(f"columns on both sides that are not join keys: {sorted(shared)}")
    if not null_safe:
        return large.join(lookup, list(on), how)
    right = lookup.withColumnsRenamed({name: f"__{name}" for name in on})
    matches: list[Column] = [F.col(name).eqNullSafe(F.col(f"__{name}")) for name in on]
    joined = large.join(right, reduce(Column.__and__, matches), how)
    return joined.drop(*(f"__{name}" for name in on))


def duplicate_keys(lookup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once in a lookup, each of which multiplies the rows it matches."""
    return lookup.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def join_campus_text(df: DataFrame, campus: DataFrame) -> DataFrame:
    """Add ``campus`` by the location text."""
    return lookup_join(df, campus.select("location", "campus"), ["location"])


def join_campus_numeric(df: DataFrame, campus: DataFrame, key: str) -> DataFrame:
    """Add ``campus`` by the location number in ``key``."""
    lookup = campus.select(tolerant_double("location").alias(key), "campus")
    return lookup_join(df, lookup, [key])


def manufacturer_keys(mfg_map: DataFrame) -> DataFrame:
    """(ref, mfg_ref, product_manufacturing_location) of the manufacturer map."""
    item = remove_char("product_label_sku_code")
    maker = F.col("product_manufacturing_location_code")
    return mfg_map.select(
        composite_key("location_no", item, sep="_").alias("ref"),
        composite_key(maker, item, sep="_").alias("mfg_ref"),
        maker.alias("product_manufacturing_location"),
    )


def join_mfg_map(df: DataFrame, mfg_map: DataFrame) -> DataFrame:
    """Add the manufacturing location by ``ref``; a ref with several makers gives several rows."""
    # Both refs are built keys and never NULL, so plain equality is exact.
    return lookup_join(df, manufacturer_keys(mfg_map), ["ref"], null_safe=False)


def join_bom_forecast(bom: DataFrame, forecast: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Add the forecast months to every bill-of-material line; lines without a forecast get 0."""
    # The forecast key is a built key and never NULL, so plain equality is exact.
    months = [name for name in forecast.columns if name not in (*by, "mfg_ref")]
    joined = lookup_join(bom, forecast, [*by, "mfg_ref"], null_safe=False)
    return joined.select(*bom.columns, *(null_to_zero(name).alias(name) for name in months))


def label_items(exceptions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Items that the exception report calls labels, each once."""
    labels = exceptions.filter(F.col("mpf_or_line") == "LBL")
    return labels.select(*by, tolerant_double("item_number").alias("item")).distinct()


def semi_join_labels(lots: DataFrame, labels: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Keep the lots whose (numeric) item is a label; adaptive execution picks the join from the real size."""
    return lookup_join(lots, labels, [*by, "item"], how="left_semi")
