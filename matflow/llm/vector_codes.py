"""Vector compression: each part of a vector becomes the number of its nearest codebook entry.

Components are whole numbers, so distances, ties and means are exact. Codebooks are trained by passes over all
vectors: a task assigns its vectors, sums them by entry, and Spark adds the sums up; only the codebooks, whose size
doesn't depend on the data, go through the driver.

The nearest entry is found in a GNAT (geometric near-neighbour access tree) over the entries. A node has split points,
and for every split point i and subtree j the range of distances from i to the entries of j. A query that is at
distance d from i can't be closer to an entry of j than the gap between d and that range, so a subtree is dropped
where some gap is larger than the best distance so far. Distances are rounded against dropping, a subtree that could
hold a tie is searched, and candidates are compared by their whole squared distances, then by their number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matflow.llm.blocks import give_back_memory
from matflow.llm.storage import stored

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Split points of a node, entries of a leaf, vectors that are searched at once.
ARITY, LEAF, BLOCK = 8, 12, 4096
_EXACT = 2.0**53


def _squares(points: np.ndarray, entries: np.ndarray, exact: bool) -> np.ndarray:
    """Whole squared distances of every point to every entry; ``exact`` says that doubles hold them."""
    if exact:
        a, b = points.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)).astype(np.int64)
    found = np.zeros((len(points), len(entries)), np.int64)
    for at in range(points.shape[1]):
        found += (points[:, at, None] - entries[None, :, at]) ** 2
    return found


def _below(values: np.ndarray) -> np.ndarray:
    return np.nextafter(values, -np.inf)


def _above(values: np.ndarray) -> np.ndarray:
    return np.nextafter(values, np.inf)


class _Node:
    """Split points with their subtrees, or the members of a leaf."""

    def __init__(self, entries: np.ndarray, members: np.ndarray, exact: bool):
        self.members, self.children = members, []
        if len(members) <= LEAF:
            return
        squares = _squares(entries[members], entries[members], exact)
        # Each split point is the member farthest from those before it.
        splits, nearest = [0], squares[0].copy()
        while len(splits) < ARITY:
            splits.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, squares[splits[-1]])
        rest = np.setdiff1d(np.arange(len(members)), splits)
        home = squares[splits][:, rest].argmin(axis=0)
        groups = [rest[home == j] for j in range(ARITY)]
        self.low, self.high = np.full((ARITY, ARITY), np.inf), np.full((ARITY, ARITY), -np.inf)
        for j, group in enumerate(groups):
            if len(group):
                distances = np.sqrt(squares[splits][:, group].astype(np.float64))
                self.low[:, j], self.high[:, j] = _below(distances.min(axis=1)), _above(distances.max(axis=1))
        self.children = [_Node(entries, members[group], exact) if len(group) else None for group in groups]
        self.members = members[splits]


class Gnat:
    """The nearest of a set of entries, rows of whole numbers; of entries at one distance the first counts."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.most = int(np.abs(entries).max(initial=0))
        # Of equal entries only the first can be an answer.
        first = np.unique(entries, axis=0, return_index=True)[1] if entries.size else np.arange(min(len(entries), 1))
        self.exact = self._fits(0)
        self.root = _Node(entries, np.sort(first), self.exact)
        self.looked = 0

    def _fits(self, most: int) -> bool:
        return self.entries.shape[1] * float(self.most + max(most, self.most)) ** 2 < _EXACT

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of the nearest entry of each point, and the squared distance."""
        number = np.full(len(points), len(self.entries), np.int64)
        square = np.full(len(points), np.iinfo(np.int64).max, np.int64)
        exact = self._fits(int(np.abs(points).max(initial=0)))
        self._search(self.root, points, np.arange(len(points)), number, square, exact)
        return number, square

    def _search(
        self, node: _Node, points: np.ndarray, rows: np.ndarray, number: np.ndarray, square: np.ndarray, exact: bool
    ) -> None:
        squares = _squares(points[rows], self.entries[node.members], exact)
        self.looked += squares.size
        # The first of the least, or of members out of order the one of the least number.
        least = squares.min(axis=1)
        found = np.where(squares == least[:, None], node.members, len(self.entries)).min(axis=1)
        better = (least < square[rows]) | ((least == square[rows]) & (found < number[rows]))
        square[rows[better]], number[rows[better]] = least[better], found[better]
        if not node.children:
            return
        distance = np.sqrt(squares.astype(np.float64))
        low, high = _below(distance), _above(distance)
        home = squares.argmin(axis=1)
        for at_home in (True, False):  # a query's own subtree first: it shortens the radius for the others
            for j, child in enumerate(node.children):
                if child is None:
                    continue
                mine = np.flatnonzero((home == j) == at_home)
                gap = np.maximum(low[mine] - node.high[:, j], node.low[:, j] - high[mine]).max(axis=1)
                radius = _above(np.sqrt(square[rows[mine]].astype(np.float64)))
                mine = mine[_below(gap) <= radius]
                if len(mine):
                    self._search(child, points, rows[mine], number, square, exact)


@dataclass(frozen=True)
class Codebooks:
    """The entries by part, entry and position within the part."""

    entries: np.ndarray

    @property
    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()

    def assigner(self):
        """A function from vectors to (codes, squared distances), both by part."""
        trees = [Gnat(entries) for entries in self.entries]
        parts, _, width = self.entries.shape

        def assign(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            cut = vectors.reshape(len(vectors), parts, width)
            found = [tree.nearest(cut[:, part]) for part, tree in enumerate(trees)]
            return np.stack([codes for codes, _ in found], axis=1), np.stack([square for _, square in found], axis=1)

        return assign


def _blocks(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, vectors) of the batch, a block at a time."""
    column = batch.column(batch.schema.get_field_index("vector"))
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(len(column), width)
    for begin in range(0, len(flat), BLOCK):
        yield begin, flat[begin : begin + BLOCK]


def whole_vectors(table: DataFrame, vector: str = "embedding", carry: tuple[str, ...] = ("vec_id", "label")) -> DataFrame:
    """(*carry, vector) with whole components, floor(``SCALE`` * x), written once.

    Rows whose vector is missing or holds a missing or non-finite component are left out.
    """
    value = F.col(vector)
    strange = F.exists(value, lambda x: x.isNull() | F.isnan(x) | F.abs(x).isin(float("inf")))
    whole = F.transform(value, lambda x: F.floor(x.cast("double") * SCALE))
    return stored(table.filter(value.isNotNull() & ~strange).select(*carry, whole.alias("vector")), "whole-vectors")


def width_of(vectors: DataFrame, parts: int = PARTS) -> int:
    """The components of every vector. Vectors that can't be cut or compared alike are an error."""
    most = F.array_max(F.transform("vector", F.abs))
    found = vectors.agg(F.min(F.size("vector")), F.max(F.size("vector")), F.max(most)).first()
    least, width, largest = (value or 0 for value in found)
    if least != width or width % parts:
        raise ValueError(f"vectors need one number of components, a multiple of {parts}; found {least} to {width}")
    if width * (2 * largest) ** 2 >= 2**63:
        raise ValueError(f"a component of {largest} / {SCALE} is too large: squared distances would not fit a long")
    return width


def train(vectors: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks of ``whole_vectors``: at first the parts of the least vec_ids, then the floors of their parts' means.

    A missing vec_id comes last; rows of one vec_id are ordered by their vectors. An entry that no part has stays.
    """
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    start = np.array([row["vector"] for row in first], np.int64).reshape(len(first), parts, width // parts)
    books = Codebooks(np.ascontiguousarray(start.transpose(1, 0, 2)))
    for _ in range(rounds if len(first) else 0):
        books = _improved(vectors, books, width)
    return books


def _improved(vectors: DataFrame, books: Codebooks, width: int) -> Codebooks:
    shape = books.entries.shape
    sums = [f"s{n}" for n in range(shape[2])]

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assign, total, count = books.assigner(), np.zeros(shape, np.int64), np.zeros(shape[:2], np.int64)
        for batch in batches:
            for _, block in _blocks(batch, width):
                codes, _ = assign(block)
                for part in range(shape[0]):
                    np.add.at(total[part], codes[:, part], block.reshape(len(block), shape[0], shape[2])[:, part])
                    count[part] += np.bincount(codes[:, part], minlength=shape[1])
        part, entry = np.nonzero(count)
        columns = [part.astype(np.int32), entry.astype(np.int32), count[part, entry], *total[part, entry].T]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["part", "entry", "n", *sums])

    kinds = ", ".join(f"{name} bigint" for name in ("n", *sums))
    tasks = vectors.select("vector").mapInArrow(added, f"part int, entry int, {kinds}")
    table = tasks.groupBy("part", "entry").agg(*(F.sum(name).alias(name) for name in ("n", *sums)))
    entries = books.entries.copy()
    for row in table.collect():  # at most one row an entry
        entries[row["part"], row["entry"]] = np.array(row[3:], np.int64) // row["n"]
    return Codebooks(entries)


def encode(vectors: DataFrame, books: Codebooks, width: int) -> DataFrame:
    """The columns of ``vectors`` but the vector, and (code, error): two hex digits a part, the squared distance."""
    kept = [name for name in vectors.columns if name != "vector"]
    kinds = ", ".join(f"`{name}` {kind}" for name, kind in vectors.dtypes if name != "vector")

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assign = books.assigner()
        for batch in batches:
            codes, errors = [], []
            for _, block in _blocks(batch, width):
                found, square = assign(block)
                text = found.astype(np.uint8).tobytes().hex()
                digits = 2 * found.shape[1]
                codes += [text[at : at + digits] for at in range(0, len(text), digits)]
                errors.append(square.sum(axis=1))
            columns = [batch.column(batch.schema.get_field_index(name)) for name in kept]
            columns += [pa.array(codes, pa.string()), pa.array(np.concatenate([np.zeros(0, np.int64), *errors]))]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "code", "error"])
        give_back_memory()

    return vectors.mapInArrow(encoded, f"{kinds}, code string, error bigint")


def decode(codes: DataFrame, books: Codebooks) -> DataFrame:
    """``codes`` with the column ``vector``: the entries that the code names, as components of the original scale."""
    values = F.array(*(F.array(*(F.array(*map(F.lit, e)) for e in part)) for part in (books.entries / SCALE).tolist()))
    entry = lambda part: F.conv(F.substring("code", 2 * part + 1, 2), 16, 10).cast("int") + 1
    pieces = [F.element_at(F.element_at(values, part + 1), entry(part)) for part in range(len(books.entries))]
    return codes.withColumn("vector", F.concat(*pieces))


def compress(table: DataFrame) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every row with a usable vector.

    Rows whose vector is missing or holds a missing or non-finite component are left out. A missing vec_id comes last
    where the first codebooks are chosen, missing labels count as one label, and repeated rows give repeated results.
    Of fewer than 256 vectors each is an entry. An empty table gives no rows. Vectors of different lengths, of a length
    that the parts don't divide, or so large that distances don't fit a long are an error. Other columns are ignored.
    """
    vectors = whole_vectors(table)
    width = width_of(vectors)
    books = train(vectors, width)
    codes = stored(encode(vectors, books, width), "vector-codes")
    labels = codes.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "__label")
    found = codes.join(labels, codes["label"].eqNullSafe(labels["__label"]))
    return found.select("vec_id", "code", "error", "label_error", F.lit(books.sha256).alias("codebooks_sha256"))
