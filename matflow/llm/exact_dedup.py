"""Exact duplicates by a tree merge of sorted digest runs.

A row's key is the SHA-256 of its text without white space, followed by an independent hash and the length: rows are
taken for equal only where all three agree, at every level. Each task sorts its keys into runs, one entry a key with
the best row and the number of rows. Then the runs are exchanged in rounds, as in a binomial tree but with ``RADIX``
children a node: in round r an entry moves to the node whose r-th digit is that of its key, so a node gets one sorted
run from each of ``RADIX`` others, merges them and keeps one entry a key. After the last round every node owns its
range of keys. A key that a third of all rows have takes one entry a run, whatever its number of rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matflow.llm.blocks import WHITE_SPACE, give_back_memory, parts
from matflow.llm.storage import stored

#: Runs that a node merges in a round.
RADIX = 8
#: Entries of a run, and what a node should get in the end: they bound the memory of a task.
RUN_ENTRIES = 1 << 18
NODE_ENTRIES = 1 << 16
LEAST_ROUNDS = 2
DIGEST_BYTES = 32
KEY_BYTES = DIGEST_BYTES + 16 + 8

#: Of equal texts the row of the most code points, then of the least doc_id (a missing one last), then the first stays.
_BEST = [("points", "descending"), ("doc_id", "ascending"), ("row", "ascending")]
_KEPT = ["key", "points", "doc_id", "row", "n"]


def _sha256(text: bytes) -> bytes:
    return hashlib.sha256(text).digest()


def text_key(text: str = "text", digest: Callable[[bytes], bytes] = _sha256) -> Column:
    """``KEY_BYTES`` bytes that two texts share if they are equal without white space; a missing text is an empty one."""

    def keyed(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            keys = []
            for _, _, texts in parts(column):
                for value in texts:
                    bare = value.translate(None, WHITE_SPACE)
                    check = hashlib.blake2b(bare, digest_size=16).digest()
                    keys.append(digest(bare) + check + len(bare).to_bytes(8, "big"))
            yield pa.array(keys, pa.binary())

    keyed.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(keyed, "binary")(F.col(text))


def _key_rows(entries: pa.Table) -> np.ndarray:
    """The keys as rows of bytes."""
    return np.frombuffer(b"".join(entries.column("key").to_pylist()), np.uint8).reshape(-1, KEY_BYTES)


def _reduced(entries: pa.Table) -> pa.Table:
    """One entry of each run of equal keys: its first, with the rows of all."""
    if not entries.num_rows:
        return entries
    rows = _key_rows(entries)
    changed = np.ones(len(rows), bool)
    changed[1:] = (rows[1:] != rows[:-1]).any(axis=1)
    first = np.flatnonzero(changed)
    total = np.add.reduceat(entries.column("n").to_numpy(), first)
    return entries.take(first).set_column(entries.schema.get_field_index("n"), "n", pa.array(total, pa.int64()))


def _sorted_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries of a task's rows in sorted runs of at most ``RUN_ENTRIES``, each with its number."""
    task, waiting, count, number = TaskContext.get().partitionId(), [], 0, 0

    def run() -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(waiting)
        order = pc.sort_indices(table, sort_keys=[("key", "ascending"), *_BEST], null_placement="at_end")
        found = _reduced(table.take(order))
        name = pa.array(np.full(found.num_rows, task + 1_000_003 * number, np.int64))
        yield from found.append_column("run", name).to_batches()

    for batch in batches:
        waiting.append(batch)
        count += batch.num_rows
        if count >= RUN_ENTRIES:
            yield from run()
            waiting, count, number = [], 0, number + 1
    if count:
        yield from run()
    give_back_memory()


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries of a node, which come in the order of all its runs, with equal keys joined; only a batch is held."""
    last = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        found = _reduced(table if last is None else pa.concat_tables([last, table]))
        if found.num_rows:
            last = found.slice(found.num_rows - 1)
            yield from found.slice(0, found.num_rows - 1).to_batches()
    if last is not None:
        yield from last.to_batches()


def _digit(number: Column, place: int) -> Column:
    return F.pmod(F.shiftright(number, place * (RADIX.bit_length() - 1)), F.lit(RADIX))


def merge_rounds(rows: int) -> int:
    """Rounds after which a node has about ``NODE_ENTRIES`` entries."""
    rounds = LEAST_ROUNDS
    while rows > NODE_ENTRIES * RADIX**rounds:
        rounds += 1
    return rounds


def _groups(keyed: DataFrame, rounds: int) -> DataFrame:
    """(key, points, doc_id, row, n) of every different key: its best row and its number of rows."""
    entry = keyed.select("key", "points", "doc_id", "row", F.lit(1).cast("bigint").alias("n"))
    kinds = ", ".join(f"{name} {kind}" for name, kind in entry.dtypes)
    # Sixty bits of the digest give the digits of the node that owns a key.
    owner = F.conv(F.hex(F.substring("key", 1, 7)), 16, 10).cast("bigint")
    nodes = RADIX**rounds
    level = entry.mapInArrow(_sorted_runs, f"{kinds}, run bigint")
    level = level.select(*_KEPT, F.pmod("run", F.lit(nodes)).alias("node"))
    for place in range(rounds):
        step = RADIX**place
        moved = (F.col("node") + (_digit(owner, place) - _digit(F.col("node"), place)) * step).cast("int")
        level = level.withColumn("node", moved).repartitionById(nodes, F.col("node"))
        order = [F.col("points").desc(), F.col("doc_id").asc_nulls_last(), F.col("row")]
        level = level.sortWithinPartitions("key", *order).mapInArrow(_merged, f"{kinds}, node int")
    return level.select(*_KEPT)


def exact_duplicates(
    docs: DataFrame, carry: Sequence[str] = (), digest: Callable[[bytes], bytes] = _sha256, rounds: int | None = None
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row, and the columns ``carry``.

    Texts are equal if they are identical without white space; a missing text is an empty one, so all missing, empty
    and blank texts are one group. The row of the most code points stays, then that of the least doc_id; a missing
    doc_id comes last, and of rows that tie in both just one stays. Names of other columns don't matter; a carried
    column that has the name of a result is an error. An empty table gives no rows.
    """
    results = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    if clash := [name for name in carry if name in results[1:]]:
        raise ValueError(f"these columns have the names of results: {clash}")
    carried = [F.col(f"`{name}`").alias(f"__c{n}") for n, name in enumerate(carry)]
    keyed = docs.select(
        "doc_id",
        text_key(digest=digest).alias("key"),
        F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("points"),
        F.monotonically_increasing_id().alias("row"),
        *carried,
    )
    keyed = stored(keyed, "text-keys")
    groups = _groups(keyed, merge_rounds(keyed.count()) if rounds is None else rounds).filter("n > 1")
    groups = stored(groups.select("key", F.col("doc_id").alias("__id"), F.col("row").alias("__row"), "n"), "equal-texts")
    grouped = F.col("n").isNotNull()
    found = {
        "keep_id": F.when(grouped, F.col("__id")).otherwise(F.col("doc_id")),
        "group_size": F.coalesce("n", F.lit(1).cast("bigint")),
        "kept": F.when(grouped, F.col("row") == F.col("__row")).otherwise(F.lit(True)),
        "text_sha256": F.lower(F.hex(F.substring("key", 1, DIGEST_BYTES))),
    }
    named = [F.col(f"__c{n}").alias(name) for n, name in enumerate(carry) if name != "doc_id"]
    return keyed.join(groups, "key", "left").select("doc_id", *(c.alias(n) for n, c in found.items()), *named)


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows that stay, with the columns of ``docs``."""
    names = {name: f"__d{n}" for n, name in enumerate(docs.columns)}
    renamed = docs.select("doc_id", "text", *(F.col(f"`{name}`").alias(new) for name, new in names.items()))
    kept = exact_duplicates(renamed, list(names.values())).filter("kept")
    return kept.select(*(F.col(new).alias(name) for name, new in names.items()))
