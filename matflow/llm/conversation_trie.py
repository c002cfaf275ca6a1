"""The prefix trie of conversations: which turns conversations share from their start, and what sharing saves.

Turns are dictionary-encoded: a table gives every different (role, text) a number, so a conversation is a list of
numbers. Equal conversations are counted first. The different lists are dealt to shards by range, so that lists with
a common prefix lie side by side. A shard builds a ternary search tree of its lists, the middle one first and then
the middles of both halves, which keeps the trees of siblings balanced whatever the order of the numbers; the part of
a list that no other shares stays a tail and is never split up. One pass from the youngest node to the oldest, without
recursion, accumulates members, leaves and savings.

Only nodes on the paths of a shard's first and last list can lie in other shards too. They leave the shard as
boundary nodes with a digest of their path. Their members and children are merged by digest. For sums over subtrees,
a merged node belongs to one of the paths through it; sums along each path from its end, added up by node, give every
node what its descendants have.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matflow.llm.blocks import give_back_memory
from matflow.llm.storage import stored

#: Conversations of one block of numbers share the first turns of the block's first one.
BLOCK = 20
#: The head that a conversation takes over has fewer turns than this.
HEADS = 4
#: Turns of a tree, and rows of a batch that leaves a task.
TREE_TURNS, PIECE = 1 << 18, 1 << 15
WORD = r"[^\x20\x09-\x0D]+"
ROOT = bytes(32)

_NODE = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "saved_tokens bigint, ends_sha256 string, parent_key binary, key binary, words bigint, spine bigint"
)
_NAMES = [column.split()[0] for column in _NODE.split(", ")]
_TYPES = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
_SCHEMA = pa.schema([(c.split()[0], _TYPES[c.split()[1]]) for c in _NODE.split(", ")])
RESULT = _NAMES[:8]


# --- conversations as lists of numbers ----------------------------------------------------------


def encoded_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, turn_key, id, words) of every row with a conv_id: ``id`` numbers the different (role, text)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        "turn",
        F.unhex(F.sha2(whole.cast("binary"), 256)).alias("turn_key"),
        F.regexp_count(text, F.lit(WORD)).alias("words"),
    )
    turns = stored(turns, "turns")
    numbers = turns.groupBy("turn_key").agg(F.max("words").alias("words"))
    dictionary = stored(numbers.withColumn("id", F.monotonically_increasing_id()), "turn-numbers")
    return turns.drop("words").join(dictionary, "turn_key")


def _head_turns(conv_id: int) -> int:
    return zlib.crc32(str(conv_id).encode()) % HEADS


def _rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, key, ids, words) of each conversation of rows in order of base, conversation and turn."""
    base = head = current = None
    pieces: list[tuple[np.ndarray, np.ndarray]] = []

    def finished() -> pa.RecordBatch:
        nonlocal head
        own = [np.concatenate(columns) for columns in zip(*pieces)]
        if current == base:
            head = [column[: HEADS - 1].copy() for column in own]
        taken = _head_turns(current)
        start = [column[:taken] for column in head] if head else [column[:0] for column in own]
        ids, words = (np.concatenate([a, b[taken:]]) for a, b in zip(start, own))
        key = hashlib.sha256(ids.astype("<i8").tobytes()).digest()
        end = pa.array([0, len(ids)], pa.int32())
        lists = [pa.ListArray.from_arrays(end, pa.array(column, pa.int64())) for column in (ids, words)]
        return pa.RecordBatch.from_arrays([pa.array([current], pa.int64()), pa.array([key], pa.binary()), *lists], _LISTS)

    done: list[pa.RecordBatch] = []
    held = 0

    def flushed() -> Iterator[pa.RecordBatch]:
        nonlocal held
        if done:
            yield from pa.Table.from_batches(done).combine_chunks().to_batches()
            done.clear()
            held = 0

    for batch in batches:
        conv, bases, ids, words = (batch.column(n).to_numpy() for n in range(4))
        edges = np.concatenate([[0], np.flatnonzero(conv[1:] != conv[:-1]) + 1, [len(conv)]]) if len(conv) else [0]
        for begin, end in zip(edges[:-1], edges[1:]):
            if pieces and current != conv[begin]:
                done.append(finished())
                held += done[-1].nbytes
                pieces = []
                if held > 1 << 22:
                    yield from flushed()
            if base != bases[begin]:
                base, head = int(bases[begin]), None
            current = int(conv[begin])
            pieces.append((ids[begin:end].astype(np.int64), words[begin:end].astype(np.int64)))
    if pieces:
        done.append(finished())
    yield from flushed()
    give_back_memory()


_LISTS = ["conv_id", "key", "ids", "words"]


def rebuilt_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, key, ids, words) of every conversation: its head from the first of its block, then its own turns.

    A conversation's turns are streamed in order; rows of one turn are ordered by the digest of role and text.
    """
    conv = F.col("conv_id")
    based = turns.select(conv, (conv - conv % BLOCK).alias("base"), "id", "words", "turn", "turn_key")
    order = [F.col("base"), conv != F.col("base"), conv, F.col("turn").asc_nulls_first(), F.col("turn_key")]
    ordered = based.repartition("base").sortWithinPartitions(*order).select("conv_id", "base", "id", "words")
    lists = ordered.mapInArrow(_rebuilt, "conv_id bigint, key binary, ids array<bigint>, words array<bigint>")
    return stored(lists, "conversations")


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(first, n, ends_sha256) of each key of rows in order of key and conversation: a digest that grows row by row."""
    key, first, count, digest = None, 0, 0, hashlib.sha256()
    found: list[tuple[int, int, str]] = []
    for batch in batches:
        keys, convs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for own, conv in zip(keys, convs):
            if own != key:
                if count:
                    found.append((first, count, digest.hexdigest()))
                key, first, count, digest = own, conv, 1, hashlib.sha256(str(conv).encode())
            else:
                digest.update(b",%d" % conv)
                count += 1
        if len(found) >= PIECE:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*found))), ["first", "n", "ends_sha256"])
            found = []
    if count:
        found.append((first, count, digest.hexdigest()))
        yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*found))), ["first", "n", "ends_sha256"])


def distinct_lists(lists: DataFrame) -> DataFrame:
    """(ids, words, first, n, ends_sha256) of every different list: its least conversation and its conversations.

    The digest of all conversation numbers can only be made in their order; it is streamed, not gathered.
    """
    members = lists.select("key", "conv_id").repartition("key").sortWithinPartitions("key", "conv_id")
    ends = members.mapInArrow(_ends, "first bigint, n bigint, ends_sha256 string")
    found = lists.select("conv_id", "ids", "words").join(ends, F.col("conv_id") == F.col("first"))
    return stored(found.drop("conv_id"), "different-conversations")


# --- trees of a shard ----------------------------------------------------------------------------


class _Tree:
    """A ternary search tree of lists in ascending order; node 0 is the root.

    ``less``, ``more`` and ``down`` are links to siblings and to the children's tree. A node with a ``tail`` stands
    for the whole rest of that list.
    """

    def __init__(self, lists: list[list[int]], words: list[np.ndarray]):
        self.lists, self.words = lists, words
        self.number, self.less, self.more, self.down = [-1], [-1], [-1], [-1]
        self.parent, self.depth, self.last_words, self.tail, self.end = [-1], [0], [0], [-1], [-1]
        halves = [(0, len(lists))]
        while halves:
            low, high = halves.pop()
            if low < high:
                middle = (low + high) // 2
                self._insert(middle)
                halves += [(middle + 1, high), (low, middle)]

    def _new(self, parent: int, at: int) -> int:
        """A node for the next turn of list ``at`` below ``parent``, and its tail."""
        depth = self.depth[parent]
        self.number.append(self.lists[at][depth])
        self.last_words.append(int(self.words[at][depth]))
        for links in (self.less, self.more, self.down, self.end):
            links.append(-1)
        self.parent.append(parent)
        self.depth.append(depth + 1)
        self.tail.append(at)
        return len(self.number) - 1

    def _insert(self, at: int) -> None:
        own, node = self.lists[at], 0
        while True:
            depth = self.depth[node]
            if depth == len(own):
                self.end[node] = at
                return
            if self.down[node] < 0:
                self.down[node] = self._new(node, at)
                return
            number, child = own[depth], self.down[node]
            while number != self.number[child]:
                links = self.less if number < self.number[child] else self.more
                if links[child] < 0:
                    links[child] = self._new(node, at)
                    return
                child = links[child]
            other = self.tail[child]
            if other >= 0:  # the tail is shared from here on: one more node of it becomes explicit
                self.tail[child] = -1
                if len(self.lists[other]) == depth + 1:
                    self.end[child] = other
                else:
                    self.down[child] = self._new(child, other)
            node = child

    def path(self, at: int) -> list[int]:
        """The explicit nodes of list ``at``, from the root on."""
        own, found = self.lists[at], [0]
        while self.depth[found[-1]] < len(own) and self.tail[found[-1]] < 0:
            child, number = self.down[found[-1]], own[self.depth[found[-1]]]
            while self.number[child] != number:
                child = self.less[child] if number < self.number[child] else self.more[child]
            found.append(child)
        return found


def _batch(columns: dict) -> pa.RecordBatch:
    size = max(len(c) for c in columns.values() if not np.isscalar(c) and not isinstance(c, bytes) and c is not None)

    def whole(name: str, kind: pa.DataType) -> pa.Array:
        value = columns.get(name)
        if value is None or np.isscalar(value) or isinstance(value, bytes):
            return pa.nulls(size, kind) if value is None else pa.array([value] * size, kind)
        return pa.array(value, kind)

    return pa.RecordBatch.from_arrays([whole(f.name, f.type) for f in _SCHEMA], schema=_SCHEMA)


def _nodes(
    lists: list[list[int]], words: list[np.ndarray], first: list[int], n: list[int], ends: list[str], shard: int
) -> Iterator[pa.RecordBatch]:
    """All nodes of a shard's lists: those inside are whole, those on its two boundary paths (``spine``) are parts.

    Of a boundary node ``n_convs`` and ``conv_id`` are the shard's members; ``n_children``, ``n_leaves`` and
    ``saved_tokens`` are those of the nodes inside below it, without other boundary nodes.
    """
    tree = _Tree(lists, words)
    size, last = len(tree.number), len(lists) - 1
    spines = [tree.path(0), tree.path(last)] if last else [tree.path(0)]
    outer = [False] * size
    for spine in spines:
        for node in spine:
            outer[node] = True
    members, least = [0] * size, [None] * size
    children, leaves, saved = [0] * size, [0] * size, [0] * size
    # A node is younger than its parent, so the reverse order of age meets children first.
    for node in range(size - 1, -1, -1):
        at = tree.tail[node] if tree.tail[node] >= 0 else tree.end[node]
        if at >= 0:
            members[node] += n[at]
            least[node] = first[at] if least[node] is None else min(least[node], first[at])
        if not outer[node]:
            if tree.tail[node] >= 0:
                rest = int(words[at][tree.depth[node] - 1 :].sum())
                children[node] = int(len(lists[at]) > tree.depth[node])
            else:
                rest = tree.last_words[node]
            leaves[node] += tree.tail[node] >= 0 or not children[node]
            saved[node] += (members[node] - 1) * rest
        parent = tree.parent[node]
        if parent >= 0:
            members[parent] += members[node]
            least[parent] = least[node] if least[parent] is None else min(least[parent], least[node])
            if not outer[node]:
                children[parent] += 1
                leaves[parent] += leaves[node]
                saved[parent] += saved[node]

    keys: dict[int, bytes] = {}
    for number, spine in enumerate(spines):
        at = number * last
        yield from _spine(tree, at, spine, keys, 2 * shard + number, members, least, children, leaves, saved, n, first, ends)

    inside = [node for node in range(size) if not outer[node]]
    plain = [node for node in inside if tree.tail[node] < 0]
    for begin in range(0, len(plain), PIECE):
        some = plain[begin : begin + PIECE]
        parents = [tree.parent[node] for node in some]
        yield _batch(
            {
                "conv_id": [least[node] for node in some],
                "depth": [tree.depth[node] for node in some],
                "parent_conv_id": [None if outer[p] else least[p] for p in parents],
                "parent_key": [keys[p] if outer[p] else None for p in parents],
                "n_convs": [members[node] for node in some],
                "n_children": [children[node] for node in some],
                "n_leaves": [leaves[node] for node in some],
                "saved_tokens": [saved[node] for node in some],
                "ends_sha256": [ends[tree.end[node]] if tree.end[node] >= 0 else None for node in some],
            }
        )
    for node in inside:
        if tree.tail[node] >= 0:
            yield from _tail(tree, node, outer, keys, least, n, first, ends)


def _spine(tree, at, spine, keys, name, members, least, children, leaves, saved, n, first, ends) -> Iterator[pa.RecordBatch]:
    """The boundary nodes of list ``at``; nodes that the other path has told of count nothing here."""
    rows: list[tuple] = []

    def row(depth: int, node: int | None, words: int, key: bytes, parent_key: bytes | None) -> tuple:
        told = node is not None and node in keys
        if told:
            return (None, depth, None, 0, 0, 0, 0, None, parent_key, key, words, name)
        if node is None:
            end = ends[at] if depth == len(tree.lists[at]) else None
            return (first[at], depth, None, n[at], 0, 0, 0, end, parent_key, key, words, name)
        end = tree.tail[node] if tree.tail[node] >= 0 and depth == len(tree.lists[at]) else tree.end[node]
        end = ends[end] if end >= 0 else None
        return (least[node], depth, None, members[node], children[node], leaves[node], saved[node], end, parent_key, key, words, name)

    def flushed() -> pa.RecordBatch:
        return _batch(dict(zip(_NAMES, map(list, zip(*rows)))))

    key, parent_key = ROOT, None
    for depth in range(len(tree.lists[at]) + 1):
        if depth:
            number = tree.lists[at][depth - 1]
            key, parent_key = hashlib.sha256(key + number.to_bytes(8, "little", signed=True)).digest(), key
        node = spine[depth] if depth < len(spine) else None
        rows.append(row(depth, node, int(tree.words[at][depth - 1]) if depth else 0, key, parent_key))
        if node is not None:
            keys.setdefault(node, key)
        if len(rows) == PIECE:
            yield flushed()
            rows.clear()
    if rows:
        yield flushed()


def _tail(tree, node, outer, keys, least, n, first, ends) -> Iterator[pa.RecordBatch]:
    """The nodes of a tail: a chain without branches."""
    at, top, parent = tree.tail[node], tree.depth[node], tree.parent[node]
    rest = np.cumsum(tree.words[at][top - 1 :][::-1])[::-1] * (n[at] - 1)
    for begin in range(0, len(rest), PIECE):
        part = rest[begin : begin + PIECE]
        size = len(part)
        below = np.ones(size, np.int64)
        parents, parent_keys, end = [first[at]] * size, [None] * size, [None] * size
        if not begin:
            parents[0] = None if outer[parent] else least[parent]
            parent_keys[0] = keys[parent] if outer[parent] else None
        if begin + size == len(rest):
            below[-1] = 0
            end[-1] = ends[at]
        yield _batch(
            {
                "conv_id": first[at],
                "depth": np.arange(top + begin, top + begin + size),
                "parent_conv_id": parents,
                "parent_key": parent_keys,
                "n_convs": n[at],
                "n_children": below,
                "n_leaves": 1,
                "saved_tokens": part,
                "ends_sha256": end,
            }
        )


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Small batches put together."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= PIECE:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, rows = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of lists that come in ascending order, a tree of about ``TREE_TURNS`` turns at a time."""
    shard = TaskContext.get().partitionId() << 24
    columns: tuple[list, ...] = ([], [], [], [], [])
    turns = 0

    def made() -> Iterator[pa.RecordBatch]:
        lists, words, first, n, ends = columns
        return _joined(_nodes(lists, words, first, n, ends, shard))

    for batch in batches:
        values = [batch.column(at).to_pylist() for at in range(5)]
        for ids, words, first, n, ends in zip(*values):
            for column, value in zip(columns, (ids, np.array(words, np.int64), first, n, ends)):
                column.append(value)
            turns += len(ids)
            if turns >= TREE_TURNS:
                yield from made()
                columns, turns, shard = ([], [], [], [], []), 0, shard + 1
    if columns[0]:
        yield from made()
    give_back_memory()


# --- the whole trie ------------------------------------------------------------------------------


def _merged_boundary(parts: DataFrame) -> DataFrame:
    """(*RESULT, key) of the boundary nodes, from the parts that the shards have of them."""
    merged = parts.groupBy("key").agg(
        F.max("parent_key").alias("parent_key"),
        F.max("depth").alias("depth"),
        F.max("words").alias("words"),
        F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("inner_children"),
        F.sum("n_leaves").alias("inner_leaves"),
        F.sum("saved_tokens").alias("inner_saved"),
        F.max("ends_sha256").alias("ends_sha256"),
        F.min("spine").alias("owner"),
    )
    merged = stored(merged, "boundary-nodes")
    outer = merged.groupBy(F.col("parent_key").alias("key")).agg(F.count(F.lit(1)).alias("outer_children"))
    count = F.col("inner_children") + F.coalesce("outer_children", F.lit(0))
    own = merged.join(outer, "key", "left").withColumn("n_children", count)
    own = own.withColumn("own_leaves", F.col("inner_leaves") + (F.col("n_children") == 0).cast("bigint"))
    own = own.withColumn("own_saved", F.col("inner_saved") + (F.col("n_convs") - 1) * F.col("words"))
    # Each node counts on one path; from a path's end on, the sums are those of what it owns below a node.
    paths = parts.select("spine", "key", "depth").join(own.select("key", "owner", "own_leaves", "own_saved"), "key")
    along = Window.partitionBy("spine").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    owned = lambda name: F.sum(F.when(F.col("spine") == F.col("owner"), F.col(name)).otherwise(0)).over(along)
    sums = paths.select("key", owned("own_leaves").alias("leaves"), owned("own_saved").alias("saved"))
    sums = sums.groupBy("key").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    parents = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    return own.join(sums, "key").join(parents, "parent_key", "left").select(*RESULT, "key")


def trie_nodes(distinct: DataFrame) -> DataFrame:
    """The nodes of the trie of ``distinct_lists``."""
    columns = ["ids", "words", "first", "n", "ends_sha256"]
    shards = distinct.select(*columns).repartitionByRange("ids").sortWithinPartitions("ids")
    nodes = stored(shards.mapInArrow(_trees, _NODE), "trie-nodes")
    boundary = stored(_merged_boundary(nodes.filter("spine IS NOT NULL")), "boundary")
    inside = nodes.filter("spine IS NULL")
    tops = boundary.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("__parent"))
    below = inside.filter("parent_key IS NOT NULL").join(tops, "parent_key").withColumn("parent_conv_id", F.col("__parent"))
    whole = inside.filter("parent_key IS NULL").select(*RESULT).unionByName(below.select(*RESULT))
    whole = whole.unionByName(boundary.select(*RESULT))
    nothing = hashlib.sha256(b"").hexdigest()
    return whole.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(nothing)))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every node.

    Conversations are rebuilt first: the first turns come from the first conversation of the block of ``BLOCK``
    numbers, as many as the conversation's checksum says. Rows without conv_id belong to no conversation and are left
    out; missing turns come first, missing roles and texts are empty, rows of one turn are ordered by the SHA-256 of
    role and text, and repeated rows are turns of their own. Very long texts are only digested and counted. A
    conversation's numbers (16 bytes a turn) have to fit a task. Other columns are ignored. Without conversations
    there is no node, not even the root.
    """
    return trie_nodes(distinct_lists(rebuilt_conversations(encoded_turns(conversations))))
