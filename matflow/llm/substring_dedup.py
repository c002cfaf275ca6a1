"""Repeated passages by prefix-partitioned suffix trees over words.

Every word begins a suffix of its document. Suffixes are split by prefixes of a variable number of words (1, 2, 4 or
8, else the whole window): a census of all documents finds the prefixes with too many suffixes for one group, and
only those are made longer. So every group holds whole subtrees of the suffix tree and fits into the memory of one
task. The edges of a subtree are compressed down to the depth of a window (13 words) and labelled with a hash of it.
Its internal nodes at that depth are the windows that occur more than once; their leaves, joined where they follow
one another, are the maximal repeats.

Documents are dealt into blocks by a hash; rows equal in id and text go there once. A block sends of each different window one leaf, the one of the least
document, so a window that half of all documents share gives a group one leaf a block. A group answers with one bit
a leaf: whether the window occurs in a document with a smaller id. With these bits each block marks its own words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matflow.llm.blocks import Block, Words, chain, covered, give_back_memory, parts, runs, text_bytes, window_hashes
from matflow.llm.storage import stored

WINDOW = 13
PREFIXES = (1, 2, 4, 8)
#: Text in a block, and suffixes in a group of subtrees: what one task holds at a time.
BLOCK_TEXT = 4 << 20
GROUP_SUFFIXES = 1_500_000
#: Longer prefixes that the census may list of each length; they are broadcast (8 bytes each).
MOST_PREFIXES = 50_000
#: Bytes of text for each suffix, to set the number of groups before words are counted.
BYTES_A_WORD = 6

_LAST_ID = np.iinfo(np.int64).max


class _Suffixes:
    """The windows of a block's documents, in the order of document ids."""

    def __init__(self, texts: list[bytes]):
        self.words = Words(Block(texts))
        self.hashes = self.words.hashes()
        self.start = np.flatnonzero(self.words.whole(WINDOW))
        self.window = window_hashes(self.hashes, WINDOW)[self.start]

    def prefixes(self) -> Iterator[np.ndarray]:
        for size in PREFIXES:
            yield window_hashes(self.hashes, size)[self.start]

    def groups(self, frequent: list[np.ndarray], count: int) -> np.ndarray:
        """The group of each suffix: that of its shortest prefix which is not frequent."""
        key = self.window.copy()
        undecided = np.ones(len(key), bool)
        for prefix, listed in zip(self.prefixes(), frequent):
            short = undecided & ~_among(prefix, listed)
            key[short] = prefix[short]
            undecided &= ~short
        return (chain(key, np.full(1, count, np.uint64)) % np.uint64(count)).astype(np.int64)


def _among(values: np.ndarray, listed: np.ndarray) -> np.ndarray:
    if not len(listed):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(listed, values), len(listed) - 1)
    return listed[at] == values


def _census(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """(size, prefix, n) of the prefixes that have the share ``least`` of this task's suffixes; all are counted.

    A prefix with that share of all suffixes has it in some task.
    """
    tallies = [(np.zeros(0, np.uint64), np.zeros(0, np.int64)) for _ in PREFIXES]
    total = 0
    for batch in batches:
        for _, _, texts in parts(batch.column(0)):
            suffixes = _Suffixes(texts)
            total += len(suffixes.start)
            for level, prefix in enumerate(suffixes.prefixes()):
                tallies[level] = _added(tallies[level], np.unique(prefix, return_counts=True), total * least)
    for size, (prefix, n) in zip(PREFIXES, tallies):
        many = n >= total * least
        yield pa.RecordBatch.from_arrays(
            [pa.array([size] * int(many.sum()), pa.int32()), pa.array(prefix[many].view(np.int64)), pa.array(n[many])],
            ["size", "prefix", "n"],
        )


def _added(tally, more, bound: float):
    """The sum of two tallies; a tally over a million prefixes loses those far below the bound."""
    keys, n = np.concatenate([tally[0], more[0]]), np.concatenate([tally[1], more[1]])
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = runs(keys)
    keys, n = keys[first], np.add.reduceat(n, first) if len(first) else n
    if len(keys) > 1_000_000:
        some = n >= bound / 16
        keys, n = keys[some], n[some]
    return keys, n


def _frequent_prefixes(docs: DataFrame, groups: int) -> list[np.ndarray]:
    """Prefixes of each length whose suffixes would fill an eighth of a group or more; at most MOST_PREFIXES each."""
    least = max(1 / (8 * groups), 1 / MOST_PREFIXES)
    schema = "size int, prefix bigint, n bigint"
    counted = docs.select("text").mapInArrow(lambda batches: _census(batches, least / 2), schema)
    totals = counted.groupBy("size", "prefix").agg(F.sum("n").alias("n"))
    listed = totals.orderBy(F.desc("n"), "size", "prefix").limit(len(PREFIXES) * MOST_PREFIXES).toArrow()
    size, prefix = listed.column("size").to_numpy(), listed.column("prefix").to_numpy().view(np.uint64)
    return [np.sort(prefix[size == length]) for length in PREFIXES]


def _packed(values: np.ndarray) -> bytes:
    """Compressed in planes of equal bytes; sorted values are stored as differences."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, count: int, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = pa.decompress(data, decompressed_size=count * size, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(size, count).T).reshape(-1).view(kind)


class _Leaves:
    """The different windows of a block by group, each with the least document that has it."""

    def __init__(self, ids: pa.Array, texts: list[bytes], frequent: list[np.ndarray], groups: int):
        known = np.array([_LAST_ID if x is None else x for x in ids.to_pylist()], np.int64)
        # Equal ids in the order of their texts, so that the block is the same however its rows arrive.
        self.order = np.array(sorted(range(len(texts)), key=lambda at: (known[at], texts[at])), np.int64)
        self.ids = known[self.order]
        self.suffixes = _Suffixes([texts[at] for at in self.order])
        by_window = np.argsort(self.suffixes.window, kind="stable")
        ordered = self.suffixes.window[by_window]
        first = runs(ordered)
        self.leaf_of = np.empty(len(by_window), np.int64)
        self.leaf_of[by_window] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(by_window))))
        window, owner = ordered[first], self.suffixes.words.text[self.suffixes.start[by_window[first]]]
        group = self.suffixes.groups(frequent, groups)[by_window[first]]
        self.by_group = np.argsort(group, kind="stable")
        self.window, self.owner, self.group = window[self.by_group], owner[self.by_group], group[self.by_group]
        self.bound = runs(self.group)

    def by_groups(self) -> Iterator[tuple[int, slice]]:
        for begin, end in zip(self.bound.tolist(), [*self.bound[1:].tolist(), len(self.group)]):
            yield int(self.group[begin]), slice(begin, end)

    def repeated(self, beaten: np.ndarray) -> np.ndarray:
        """Which words lie in a window that begins in a document of a smaller id; ``beaten`` is in leaf order."""
        outside, least = np.empty(len(beaten), bool), np.empty(len(beaten), np.int64)
        outside[self.by_group], least[self.by_group] = beaten, self.ids[self.owner]
        own = self.ids[self.suffixes.words.text[self.suffixes.start]]
        found = outside[self.leaf_of] | (least[self.leaf_of] < own)
        return covered(self.suffixes.start[found], WINDOW, len(self.suffixes.words.start))


_LEAVES = "__group bigint, __block bigint, n int, windows binary, documents binary, owners binary"
_BITS = "__block bigint, __group bigint, n int, bits binary"


def _block_leaves(table: pa.Table, frequent: list[np.ndarray], groups: int) -> pa.Table:
    give_back_memory()
    leaves = _Leaves(table.column("doc_id").combine_chunks(), text_bytes(table.column("text")), frequent, groups)
    block = table.column("__block")[0].as_py()
    rows = []
    for group, at in leaves.by_groups():
        owner = leaves.owner[at]
        here = np.unique(owner)
        windows = np.diff(leaves.window[at], prepend=np.uint64(0))
        documents = np.diff(leaves.ids[here], prepend=np.int64(0))
        owners = np.searchsorted(here, owner).astype(np.uint32)
        rows.append((group, block, len(owner), _packed(windows), _packed(documents), _packed(owners)))
    names = ["__group", "__block", "n", "windows", "documents", "owners"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    columns = list(zip(*rows)) or [()] * 6
    return pa.table([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)


def _group_bits(table: pa.Table) -> pa.Table:
    """For each leaf of a group whether another one of its node is of a document with a smaller id."""
    give_back_memory()
    blocks, sizes = table.column("__block").to_pylist(), table.column("n").to_pylist()
    windows, ids = [], []
    for n, packed, documents, owners in zip(sizes, *(table.column(c).to_pylist() for c in ("windows", "documents", "owners"))):
        owner = _unpacked(owners, n, np.uint32)
        windows.append(np.cumsum(_unpacked(packed, n, np.uint64)))
        ids.append(np.cumsum(_unpacked(documents, int(owner.max()) + 1, np.int64))[owner])
    window, document = np.concatenate(windows), np.concatenate(ids)
    order = np.argsort(window, kind="stable")
    first = runs(window[order])
    least = np.minimum.reduceat(document[order], first)
    beaten = np.empty(len(order), bool)
    beaten[order] = np.repeat(least, np.diff(np.append(first, len(order)))) < document[order]
    answers = np.split(beaten, np.cumsum(sizes)[:-1])
    group = table.column("__group")[0].as_py()
    bits = [pa.compress(np.packbits(part).tobytes(), codec="zstd", asbytes=True) for part in answers]
    return pa.table(
        [pa.array(blocks, pa.int64()), pa.array([group] * len(blocks), pa.int64()), pa.array(sizes, pa.int32()), pa.array(bits, pa.binary())],
        ["__block", "__group", "n", "bits"],
    )


def _kept_words(words: Words, repeated: np.ndarray) -> list[bytes]:
    """Each text's words that are not repeated, joined by one space."""
    kept = np.flatnonzero(~repeated)
    size = words.end[kept] - words.start[kept] + 1
    ends = np.cumsum(size)
    source = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(words.start[kept] - (ends - size), size)
    data = words.block.data[source]
    data[ends - 1] = 0x20
    joined = data.tobytes()
    bound = np.concatenate([[0], ends])[np.searchsorted(kept, words.first)].tolist()
    return [joined[low : max(low, high - 1)] for low, high in zip(bound, bound[1:])]


def _block_result(docs: pa.Table, bits: pa.Table, frequent: list[np.ndarray], groups: int, kinds: pa.Schema) -> pa.Table:
    give_back_memory()
    if not docs.num_rows:
        return kinds.empty_table()
    leaves = _Leaves(docs.column("doc_id").combine_chunks(), text_bytes(docs.column("text")), frequent, groups)
    answer = dict(zip(bits.column("__group").to_pylist(), bits.column("bits").to_pylist()))
    beaten = np.zeros(len(leaves.group), bool)
    for group, at in leaves.by_groups():
        n = at.stop - at.start
        packed = pa.decompress(answer[group], decompressed_size=(n + 7) // 8, codec="zstd", asbytes=True)
        beaten[at] = np.unpackbits(np.frombuffer(packed, np.uint8), count=n).astype(bool)
    words = leaves.suffixes.words
    repeated = leaves.repeated(beaten)
    removed = np.bincount(words.text, weights=repeated, minlength=words.block.count).astype(np.int64)
    kept = _kept_words(words, repeated)
    rows = docs.take(pa.array(leaves.order))
    found = {
        "n_words": pa.array(words.counts, pa.int64()),
        "n_removed": pa.array(removed),
        "kept_sha256": pa.array([hashlib.sha256(text).hexdigest() for text in kept], pa.string()),
        "kept_text": pa.array([text if n else None for text, n in zip(kept, removed.tolist())], pa.binary()).cast(pa.string()),
    }
    return pa.table([found[f.name] if f.name in found else rows.column(f.name) for f in kinds], kinds)


def _dealt(rows: DataFrame, blocks: int) -> tuple[DataFrame, DataFrame | None]:
    """``rows`` with their __block, where rows equal in id and text are one row; (__row, carried) of all such rows, if any.

    The equal rows are found by 128 bits of their id and text, and counted before they are brought together.
    """
    name = F.concat_ws("/", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.coalesce("text", F.lit("")))
    rows = rows.withColumn("__row", F.unhex(F.md5(name.cast("binary"))))
    repeated = stored(rows.groupBy("__row").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("__row"), "repeated")
    again = None
    if not repeated.isEmpty():
        many = rows.join(repeated, "__row")
        again = stored(many.select("__row", "carried"), "rows")
        one = many.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "__row").distinct()
        one = one.withColumn("carried", F.lit(None).cast(rows.schema["carried"].dataType))
        rows = rows.join(repeated, "__row", "left_anti").unionByName(one)
    return rows.withColumn("__block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks))), again


def remove_repeats(docs: DataFrame, carry: Column | None = None, kept_text: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every document, with ``carry`` and ``kept_text`` if asked for.

    A word goes if it is covered by a window of 13 words that also begins in a document with a smaller doc_id;
    windows are those of the input. ``kept_text`` has the words that stay, joined by one space; it is null where
    none goes. A missing text has no words. A missing doc_id counts as the largest; documents of the same id don't
    take words from each other.
    """
    text = F.col("text")
    size = docs.agg(F.sum(F.octet_length(text)).alias("bytes")).first()["bytes"] or 0
    groups = max(1, -(-size // (BYTES_A_WORD * GROUP_SUFFIXES)))
    blocks = max(1, -(-size // BLOCK_TEXT))
    frequent = _frequent_prefixes(docs, groups)
    carried = (carry if carry is not None else F.lit(0)).alias("carried")
    dealt, again = _dealt(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text, carried), blocks)
    dealt = dealt.repartition("__block")
    leaves = dealt.groupBy("__block").applyInArrow(lambda table: _block_leaves(table, frequent, groups), _LEAVES)
    bits = leaves.groupBy("__group").applyInArrow(_group_bits, _BITS)
    digests = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
    result = T.StructType.fromDDL(digests + (", kept_text string" if kept_text else ""))
    result = result.add("carried", dealt.schema["carried"].dataType).add("__row", T.BinaryType())
    kinds = _arrow_schema(docs, result)
    found = dealt.groupBy("__block").cogroup(bits.groupBy("__block")).applyInArrow(
        lambda rows, answers: _block_result(rows, answers, frequent, groups, kinds), result
    )
    if again is not None:
        each = again.select("__row", F.col("carried").alias("__own"), F.lit(True).alias("__again"))
        own = F.when(F.col("__again"), F.col("__own")).otherwise(F.col("carried"))
        found = found.join(each, "__row", "left").withColumn("carried", own).drop("__own", "__again")
    return found.drop("__row") if carry is not None else found.drop("__row", "carried")


def _arrow_schema(docs: DataFrame, schema: T.StructType) -> pa.Schema:
    return docs.sparkSession.createDataFrame([], schema).toArrow().schema


def rewrite_documents(docs: DataFrame) -> DataFrame:
    """``docs`` without repeated passages: changed texts are their kept words, joined by one space.

    A document all of whose words go is dropped. ``n_chars`` follows the text where the table has it.
    """
    columns = docs.columns
    found = remove_repeats(docs, F.struct(*columns), kept_text=True).filter("n_removed = 0 OR n_removed < n_words")
    new = F.coalesce("kept_text", "carried.text")
    changed = {"text": new, "n_chars": F.when(F.col("kept_text").isNull(), F.col("carried.n_chars")).otherwise(F.length(new)) if "n_chars" in columns else None}
    return found.select(*((changed.get(c) if changed.get(c) is not None else F.col("carried")[c]).alias(c) for c in columns))
