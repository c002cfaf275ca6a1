"""Sharding by a hierarchical weighted hash tree: region, rack, shard."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Shape of a cluster that is filled shard by shard.
RACKS, SHARDS = 5, 2
#: Parts of a shard that are numbered apart, so that no task sorts a whole shard.
PARTS = 4096
ROW_BYTES = 16


@dataclass(frozen=True)
class Shard:
    number: int
    region: int
    rack: int
    weight: float = 1.0


def even_tree(count: int) -> list[Shard]:
    """``count`` shards of equal weight, two to a rack and five racks to a region, filled in order.

    The next shard changes the weights of one rack and one region only; where these are new, rows move into the
    new shard alone.
    """
    size = RACKS * SHARDS
    return [Shard(i, i // size, i % size // SHARDS) for i in range(count)]


def _draw(key: Column, path: Column) -> Column:
    """A number in (0, 1) that is a hash of the key and the place in the tree (52 bits of md5)."""
    digits = F.substring(F.md5(F.concat_ws("/", key, path).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)


def _descend(key: Column, path: Column, weights: Column) -> Column:
    """The child with the least exponential draw, whose rate is the child's weight: a share equal to its weight."""
    draws = F.transform(
        weights,
        lambda child: F.struct(
            (-F.ln(_draw(key, F.concat_ws(".", path, child["name"].cast("string")))) / child["weight"]).alias("draw"),
            child["name"].alias("name"),
        ),
    )
    return F.array_min(draws)["name"]


def _children(weights: dict[int, float]) -> Column:
    listed = [F.struct(F.lit(n).alias("name"), F.lit(float(w)).alias("weight")) for n, w in sorted(weights.items()) if w > 0]
    return F.array(*listed)


def place(df: DataFrame, shards: Sequence[Shard], key: Column, name: str) -> DataFrame:
    """``df`` with the shard of each key as ``name``, found by one draw among the children of each level.

    The tree is part of the expression, so it is bounded by what a plan can hold (thousands of shards). A change
    of weight moves rows into or out of the changed subtree only; all other draws stay as they are.
    """
    sums: tuple[dict, dict, dict] = ({}, {}, {})
    for s in shards:
        for level, (path, child) in enumerate((("", s.region), (f"{s.region}", s.rack), (f"{s.region}.{s.rack}", s.number))):
            level_sums = sums[level].setdefault(path, {})
            level_sums[child] = level_sums.get(child, 0) + s.weight
    # A subtree of weight 0 is never entered, so it has no children to list.
    tables = [{path: weights for path, weights in level.items() if sum(weights.values()) > 0} for level in sums]
    if not tables[0]:
        raise ValueError("no shard has a weight")

    def listed(level: int, path: Column) -> Column:
        entries = [x for p, weights in sorted(tables[level].items()) for x in (F.lit(p), _children(weights))]
        return F.element_at(F.create_map(*entries), path)

    region, rack = f"__{name}_region", f"__{name}_rack"
    root = F.lit("")
    placed = df.withColumn(region, _descend(key, root, listed(0, root)).cast("string"))
    path = F.col(region)
    placed = placed.withColumn(rack, F.concat_ws(".", path, _descend(key, path, listed(1, path)).cast("string")))
    path = F.col(rack)
    return placed.withColumn(name, _descend(key, path, listed(2, path)).cast("int")).drop(region, rack)


def number_slots(df: DataFrame, group: str, part: Column, order: Sequence[str], name: str) -> DataFrame:
    """``df`` with a position ``name`` in each group: 0, 1, ... without gaps.

    Rows are numbered in each (group, part) and moved by what the parts before hold, so that a task sorts one part.
    """
    parted = df.withColumn("__part", part)
    own = Window.partitionBy(group, "__part").orderBy(*(F.col(c).asc_nulls_first() for c in order))
    before = Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = parted.groupBy(group, "__part").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select(group, "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    numbered = parted.withColumn("__row", F.row_number().over(own)).join(offsets, [group, "__part"])
    return numbered.withColumn(name, F.col("__before") + F.col("__row") - 1).drop("__part", "__row", "__before")


def shard_documents(docs: DataFrame, count: int) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every document.

    doc_id and the number of shards decide (law ``key``): equal ids share a shard, a missing id counts as one of its
    own. ``size`` is the UTF-8 bytes of the text plus 16; a missing text has none, and the checksum of no bytes is 0.
    ``grown_shard`` is the shard among ``count`` + 1. Slots order a shard by a hash of the id, then id, size and checksum.
    """
    raw = F.encode(F.col("text"), "UTF-8")
    rows = docs.select(
        F.col("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).cast("bigint").alias("size"),
        F.coalesce(F.crc32(raw), F.lit(0)).cast("bigint").alias("text_crc32"),
        F.lit("key").alias("law"),
        F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("__key"),
    )
    key = F.col("__key")
    placed = place(place(rows, even_tree(count), key, "shard"), even_tree(count + 1), key, "grown_shard")
    part = F.floor(_draw(key, F.lit("slot")) * PARTS).cast("int")
    numbered = number_slots(placed, "shard", part, ["doc_id", "size", "text_crc32"], "slot")
    return numbered.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
