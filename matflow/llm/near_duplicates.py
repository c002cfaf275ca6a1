"""Near duplicates by DartMinHash signatures of weighted word shingles and a banded join.

The elements of a text are its shingles of five words, each weighted by how often it occurs. A shingle of weight w
owns the region [0, w), cut into unit cells. Every cell throws darts: a Poisson process of arrival ranks, made from
hashes of the cell alone, so equal cells of different texts throw equal darts. A text keeps the darts up to a rank
that its weight sets, about ``DARTS`` in all, and of each coordinate the earliest dart. Two texts agree in a
coordinate with a probability equal to their weighted Jaccard similarity. The cost is cells + darts, not cells x
coordinates.

Texts that agree in a band of coordinates become candidates. First each one meets one leader, the leader of most of
its buckets, so a round has fewer edges than texts; a few rounds with other leaders join most of what belongs
together. What they leave open is then compared whole: every pair of a bucket whose groups still differ, in blocks
against blocks. All candidates are checked on the exact similarity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matflow.llm.blocks import Block, Words, chain, give_back_memory, mix, parts, runs, slices, text_bytes, window_hashes
from matflow.llm.components import connected_components
from matflow.llm.storage import stored

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 32
ROWS = 5
COORDINATES = BANDS * ROWS
#: Expected darts of a text: enough to leave a coordinate empty once in a hundred texts, which then throws more.
DARTS = int(COORDINATES * (np.log(COORDINATES) + 4))
#: Rounds of leaders; they only save work for the comparison of all pairs that follows.
MOST_ROUNDS = 2
#: Buckets of up to so many texts are small: about ``PACK`` of their rows are compared in a task, each text loaded once.
SMALL, PACK = 64, 2048
#: Cells and texts of a block: two of them are what one task compares at a time.
BLOCK_CELLS, BLOCK_TEXTS = 400_000, 2048
PAIR = ("a", "b", "a_component", "b_component")

_SIGNATURE = "weight int, bands array<bigint>"
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def _cells(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The unit cells of all texts, in order of the text: a hash of (shingle, occurrence), and the text.

    A text of one to four words is one shingle.
    """
    words = Words(Block(texts))
    hashes = words.hashes()
    whole = np.flatnonzero(words.whole(SHINGLE))
    shingles, text = window_hashes(hashes, SHINGLE)[whole], words.text[whole]
    short = np.flatnonzero((words.counts > 0) & (words.counts < SHINGLE))
    if len(short):
        joined = hashes[words.first[short]]
        for step in range(1, SHINGLE - 1):
            longer = words.counts[short] > step
            joined[longer] = chain(joined[longer], hashes[words.first[short][longer] + step])
        shingles, text = np.concatenate([shingles, joined]), np.concatenate([text, short])
    order = np.lexsort((shingles, text))
    shingles, text = shingles[order], text[order]
    changed = np.zeros(len(text), bool)
    changed[runs(shingles)] = changed[runs(text)] = True
    first = np.flatnonzero(changed)
    occurrence = np.arange(len(text)) - np.repeat(first, np.diff(np.append(first, len(text))))
    return mix(shingles + occurrence.astype(np.uint64) * np.uint64(0xA24BAED4963EE407)), text


def _throw(cells: np.ndarray, text: np.ndarray, until: np.ndarray, kept: np.ndarray) -> None:
    """Adds the darts of the cells up to the rank ``until`` of their texts to ``kept`` (texts x coordinates).

    A kept dart is its rank (the bits of a positive float32, which sort as the rank does) above 32 bits of hash.
    """
    rank, state = np.zeros(len(cells)), cells
    flat = kept.reshape(-1)
    while len(state):
        state = mix(state + np.uint64(0x9E3779B97F4A7C15))
        rank = rank - np.log1p(-((state >> np.uint64(11)).astype(np.float64) * 2.0**-53))
        inside = rank <= until[text]
        rank, state, text = rank[inside], state[inside], text[inside]
        drawn = mix(state ^ np.uint64(0x5851F42D4C957F2D))
        coordinate = ((drawn >> np.uint64(32)) * np.uint64(kept.shape[1])) >> np.uint64(32)
        dart = (rank.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32)) | (drawn & np.uint64(0xFFFFFFFF))
        np.minimum.at(flat, text * kept.shape[1] + coordinate.astype(np.int64), dart)


def signatures(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The weight of each text and its earliest dart by coordinate; texts without words have weight 0."""
    cells, text = _cells(texts)
    weight = np.bincount(text, minlength=len(texts))
    kept = np.full((len(texts), COORDINATES), _EMPTY)
    until = DARTS / np.maximum(weight, 1)
    throwing = np.ones(len(texts), bool)
    while len(cells):
        _throw(cells, text, until, kept)
        throwing = (kept == _EMPTY).any(axis=1)
        again = throwing[text]
        cells, text, until = cells[again], text[again], until * 2
    return weight, kept


def _bands(kept: np.ndarray) -> np.ndarray:
    """A hash of each band of coordinates and its number."""
    parts = kept.reshape(len(kept), BANDS, ROWS)
    joined = np.broadcast_to(mix(np.arange(1, BANDS + 1, dtype=np.uint64)), parts.shape[:2])
    for row in range(ROWS):
        joined = chain(joined, parts[:, :, row])
    return joined.view(np.int64)


def signature(text: str = "text") -> Column:
    """A struct (weight, bands)."""

    def signed(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            weights, bands = [], []
            for _, _, texts in parts(column):
                weight, kept = signatures(texts)
                some = weight > 0
                weights.extend(weight.tolist())
                bands.append((_bands(kept)[some].reshape(-1), np.where(some, BANDS, 0)))
            sizes = np.concatenate([np.zeros(1, np.int64), *(size for _, size in bands)])
            values = np.concatenate([np.zeros(0, np.int64), *(value for value, _ in bands)])
            lists = pa.ListArray.from_arrays(np.cumsum(sizes).astype(np.int32), pa.array(values))
            yield pa.StructArray.from_arrays([pa.array(weights, pa.int32()), lists], ["weight", "bands"])

    signed.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(signed, _SIGNATURE)(F.col(text))


def similarities(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """The weighted Jaccard similarity of each pair of texts on their cells; 0 where one has no words."""
    cells, text = _cells(left + right)
    pair = text % max(len(left), 1)
    order = np.lexsort((cells, pair))
    cells, pair = cells[order], pair[order]
    both = np.zeros(len(cells), bool)
    both[1:] = (cells[1:] == cells[:-1]) & (pair[1:] == pair[:-1])
    shared = np.bincount(pair[both], minlength=len(left))
    union = np.bincount(pair, minlength=len(left)) - shared
    return shared / np.maximum(union, 1)


def _similarity(left: str, right: str) -> Column:
    def exact(left: pa.Array, right: pa.Array) -> pa.Array:
        first, second = text_bytes(left), text_bytes(right)
        found = [np.zeros(0)]
        for begin, end in slices([a + b for a, b in zip(first, second)]):
            found.append(similarities(first[begin:end], second[begin:end]))
        give_back_memory()
        return pa.array(np.concatenate(found))

    exact.__annotations__ = {"left": pa.Array, "right": pa.Array, "return": pa.Array}
    return F.arrow_udf(exact, "double")(left, right)


def text_key(text: str = "text") -> Column:
    """128 bits that tell texts apart; null for a missing text."""
    return F.unhex(F.md5(F.col(text).cast("binary")))


def _label(nodes: DataFrame, column: str, components: DataFrame | None, name: str) -> DataFrame:
    """``nodes`` with the component of ``column`` as ``name``; a node without links is its own component."""
    if components is None:
        return nodes.withColumn(name, F.col(column))
    known = components.select(F.col("node").alias(column), F.col("component").alias("__component"))
    return nodes.join(known, column, "left").withColumn(name, F.coalesce("__component", column)).drop("__component")


def _candidates(shared: DataFrame, components: DataFrame | None, number: int, similarity: float) -> DataFrame:
    """(a, b, a_component, b_component): every member of an open bucket with one leader of another component.

    Buckets whose members are of one component are done. The leader of a bucket is the member of the least hash, which
    is the same in all buckets of a round, so large groups gather around few leaders. A member meets the leader that
    it shares the most buckets with, if their numbers of cells don't rule a link out.
    """
    labelled = _label(shared, "id", components, "component")
    member = F.struct(F.xxhash64("id", F.lit(number)).alias("draw"), "id", "component", "weight")
    leaders = labelled.groupBy("bucket").agg(
        F.min(member).alias("leader"), (F.min("component") != F.max("component")).alias("open")
    )
    met = labelled.join(leaders.filter("open").drop("open"), "bucket").filter(F.col("component") != F.col("leader.component"))
    fewer, more = F.least("weight", "leader.weight"), F.greatest("weight", "leader.weight")
    possible = met.filter(fewer >= similarity * more)
    chosen = possible.groupBy("id", "component").agg(F.mode("leader", deterministic=True).alias("leader"))
    return chosen.select(
        F.col("id").alias("a"),
        F.col("leader.id").alias("b"),
        F.col("component").alias("a_component"),
        F.col("leader.component").alias("b_component"),
    )


def _merged(components: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, component) after links between components; each component is a node of itself."""
    joined = connected_components(links.select(F.col("a_component").alias("a"), F.col("b_component").alias("b")))
    if components is None:
        return joined
    renamed = joined.select(F.col("node").alias("component"), F.col("component").alias("__new"))
    moved = components.join(renamed, "component", "left").select("node", F.coalesce("__new", "component").alias("component"))
    return stored(moved.union(joined.join(components, "node", "left_anti")), "components")


def _with_both(edges: DataFrame, table: DataFrame, column: str) -> DataFrame:
    left = table.select(F.col("id").alias("a"), F.col(column).alias("left"))
    right = table.select(F.col("id").alias("b"), F.col(column).alias("right"))
    return edges.join(left, "a").join(right, "b")


def _links(edges: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The edges whose texts are similar."""
    exact = _with_both(edges, texts, "text").select(*PAIR, _similarity("left", "right").alias("similarity"))
    return stored(exact.filter(F.col("similarity") >= similarity), "links")


class _Compared:
    """Texts of a task with their cells, and links between their components: enough to join what is linked."""

    def __init__(self, table: pa.Table, similarity: float):
        give_back_memory()
        self.similarity = similarity
        self.component = table.column("component").to_numpy()
        cells, text = _cells(text_bytes(table.column("text")))
        self.weight = np.bincount(text, minlength=len(self.component))
        self.bound = np.concatenate([np.zeros(1, np.int64), np.cumsum(self.weight)])
        _, self.cells = np.unique(cells, return_inverse=True)
        self.marked = np.zeros(len(cells) and self.cells.max() + 1, np.int32)
        #: The same number for texts that are joined.
        self.joined = self.component.copy()
        self.links: list[tuple[int, int]] = []

    def compare(self, at: int, others: np.ndarray) -> None:
        """Text ``at`` with those of the others that aren't joined with it yet and whose cells may be enough."""
        fewer, more = np.minimum(self.weight[others], self.weight[at]), np.maximum(self.weight[others], self.weight[at])
        others = others[(self.joined[others] != self.joined[at]) & (fewer >= self.similarity * more)]
        if not len(others):
            return
        own = self.cells[self.bound[at] : self.bound[at + 1]]
        size = self.weight[others]
        ends = np.cumsum(size)
        members = self.cells[np.arange(ends[-1]) + np.repeat(self.bound[others] - ends + size, size)]
        self.marked[own] = 1
        total = np.concatenate([np.zeros(1, np.int64), np.cumsum(self.marked[members])])
        self.marked[own] = 0
        shared = total[ends] - total[ends - size]
        similar = others[shared / np.maximum(self.weight[at] + size - shared, 1) >= self.similarity]
        for other in similar.tolist():
            if self.joined[other] != self.joined[at]:
                self.links.append((int(self.component[at]), int(self.component[other])))
                self.joined[self.joined == self.joined[other]] = self.joined[at]

    def table(self) -> pa.Table:
        """The links; the worker, which goes on to other tasks, hands back what the comparison took."""
        self.cells = self.marked = self.joined = np.zeros(0, np.int64)
        give_back_memory()
        return pa.table([pa.array([x[n] for x in self.links], pa.int64()) for n in (0, 1)], ["a_component", "b_component"])


def _block_links(table: pa.Table, similarity: float) -> pa.Table:
    """(a_component, b_component) of links between two blocks of a bucket, or within one."""
    compared, block = _Compared(table, similarity), table.column("block").to_numpy()
    first = np.flatnonzero(block == block.min())
    if block.min() != block.max():
        second = np.flatnonzero(block != block.min())
        for at in first.tolist():
            compared.compare(at, second)
    elif table.column("lo")[0].as_py() == table.column("hi")[0].as_py():  # else the other block is empty
        for place, at in enumerate(first.tolist()):
            compared.compare(at, first[place + 1 :])
    return compared.table()


def _pack_links(table: pa.Table, similarity: float) -> pa.Table:
    """(a_component, b_component) of links within the small buckets of a pack."""
    compared = _Compared(table, similarity)
    lists = table.column("buckets").combine_chunks()
    rows = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
    buckets = lists.flatten().to_numpy()
    order = np.lexsort((rows, buckets))
    rows, buckets = rows[order], buckets[order]
    # Equal sets of texts, as near copies have in many buckets, are compared once.
    for members in {part.tobytes() for part in np.split(rows, runs(buckets)[1:])}:
        members = np.frombuffer(members, rows.dtype)
        for place, at in enumerate(members.tolist()[:-1]):
            compared.compare(at, members[place + 1 :])
    return compared.table()


def _blocks(members: DataFrame) -> DataFrame:
    """(bucket, lo, hi, block, id, component): members of each bucket in blocks, for every two blocks that meet.

    Members of a bucket's largest component have blocks of their own, which meet those of the other members but not
    each other.
    """
    each = members.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("cells"))
    part = F.struct("n", "component", "cells")
    split = each.groupBy("bucket").agg(F.max(part).alias("main"), F.sum("n").alias("n"), F.sum("cells").alias("cells"))
    count = lambda n, cells: F.greatest(F.ceil(n / BLOCK_TEXTS), F.ceil(cells / BLOCK_CELLS), F.lit(1))
    split = split.select(
        "bucket",
        F.col("main.component").alias("main"),
        count(F.col("main.n"), F.col("main.cells")).alias("mains"),
        count(F.col("n") - F.col("main.n"), F.col("cells") - F.col("main.cells")).alias("others"),
    )
    draw, is_main = F.xxhash64("id", "bucket"), F.col("component") == F.col("main")
    own = F.when(is_main, F.col("others") + F.pmod(draw, "mains")).otherwise(F.pmod(draw, "others"))
    last = F.when(is_main, F.col("others")).otherwise(F.col("others") + F.col("mains")) - 1
    dealt = members.join(split, "bucket").select("bucket", "id", "component", own.alias("block"), last.alias("last"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), "last")))
    return met.select("bucket", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "id", "component")


def _open_links(shared: DataFrame, components: DataFrame | None, texts: DataFrame, similarity: float) -> DataFrame:
    """(a_component, b_component): links among all pairs of a bucket whose components differ after the leader rounds."""
    labelled = _label(shared, "id", components, "component")
    size = labelled.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), (F.min("component") != F.max("component")).alias("open")
    )
    members = stored(labelled.join(size.filter("open").select("bucket", "n"), "bucket"), "open")
    found = "a_component bigint, b_component bigint"
    small = members.filter(F.col("n") <= SMALL)
    packs = max(1, small.count() // PACK)
    # Buckets with the same least text go together: they tend to hold the same texts.
    least = F.min("id").over(Window.partitionBy("bucket"))
    packed = small.withColumn("pack", F.pmod(F.xxhash64(least), F.lit(packs)))
    packed = packed.groupBy("pack", "id", "component").agg(F.collect_list("bucket").alias("buckets"))
    small_links = packed.join(texts, "id").groupBy("pack").applyInArrow(lambda table: _pack_links(table, similarity), found)
    blocks = _blocks(members.filter(F.col("n") > SMALL)).join(texts, "id")
    large_links = blocks.groupBy("bucket", "lo", "hi").applyInArrow(lambda table: _block_links(table, similarity), found)
    return stored(small_links.union(large_links).distinct(), "links")


def near_duplicate_groups(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(key, group) of every different text with words: texts linked by chains of similar pairs share a group.

    ``key`` is that of ``text_key``. Pairs of a similarity of at least ``similarity`` (weighted Jaccard of their
    shingles) are links. A pair at 0.8 shares no band once in 300,000 pairs and is then not seen; all others are.
    """
    keyed = docs.select("text", text_key().alias("key"))
    signed = keyed.select("key", signature().alias("s")).filter("s.weight > 0")
    reps = signed.select("key", "s.weight", "s.bands").dropDuplicates(["key"])
    reps = stored(reps.withColumn("id", F.monotonically_increasing_id()), "signatures")
    buckets = reps.select("id", "weight", F.explode("bands").alias("bucket"))
    crowded = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("bucket")
    shared = stored(buckets.join(crowded, "bucket", "left_semi"), "buckets")
    met = reps.join(shared.select("id").distinct(), "id", "left_semi").select("id", "key")
    texts = stored(keyed.join(met, "key").dropDuplicates(["key"]).select("id", "text"), "texts")

    components = None
    for number in range(MOST_ROUNDS):
        found = _links(_candidates(shared, components, number, similarity), texts, similarity)
        if not found.isEmpty():
            components = _merged(components, found)
        elif number:
            break
    found = _open_links(shared, components, texts, similarity)
    if not found.isEmpty():
        components = _merged(components, found)
    return _label(reps.select("key", "id"), "id", components, "group").select("key", "group")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id) of every document: the least doc_id of its group of near copies.

    Equal texts are of one class. A document without text or without words is of no class but its own: its
    class_id is its doc_id. Repeated rows give repeated results; a missing doc_id never names a class that has
    another one.
    """
    groups = near_duplicate_groups(docs)
    rows = docs.select("doc_id", text_key().alias("key")).join(groups, "key", "left").select("doc_id", "group")
    names = rows.filter("group IS NOT NULL").groupBy("group").agg(F.min("doc_id").alias("name"))
    named = rows.join(names, "group", "left")
    return named.select("doc_id", F.when(F.col("group").isNull(), F.col("doc_id")).otherwise(F.col("name")).alias("class_id"))


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The document of the least doc_id of each group of near copies, and all documents without words.

    Of several rows with that doc_id the one of the least text key stays; equal rows count once. Columns are those
    of ``docs``.
    """
    groups = near_duplicate_groups(docs)
    keyed = docs.withColumn("__key", text_key())
    rows = keyed.select("doc_id", F.col("__key").alias("key")).join(groups, "key")
    # A missing doc_id sorts last.
    order = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "key")
    kept = rows.groupBy("group").agg(F.min(order).alias("kept"))
    chosen = kept.select(F.col("kept.doc_id").alias("__kept_id"), F.col("kept.key").alias("__key"))
    first = keyed.join(chosen, "__key").filter(F.col("doc_id").eqNullSafe(F.col("__kept_id")))
    first = first.dropDuplicates(["__key"]).select(*docs.columns)
    wordless = docs.filter(~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)))
    return first.unionByName(wordless)
