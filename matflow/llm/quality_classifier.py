"""Quality by nearest-neighbour voting among labelled latent-semantic vectors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matflow.llm.blocks import Block, Words, parts, runs, text_bytes

#: Hashed terms of a text: trigrams of character shapes, words, and marks of repetition.
SHAPE_TERMS, WORD_TERMS = 1 << 12, 1 << 13
REPEAT_TERMS = 2
TERMS = SHAPE_TERMS + WORD_TERMS + REPEAT_TERMS
DIMENSIONS = 64
#: Labelled documents of each label that the vectors are fitted on and compared with (a bound on the broadcast:
#: 2 x EXAMPLES x DIMENSIONS x 4 bytes, beside TERMS x DIMENSIONS x 4 bytes of projection).
EXAMPLES = 1500
NEIGHBOURS = 25
#: Texts whose similarities to all examples are held at once.
ROWS_A_BLOCK = 1024
#: Texts whose counts of shapes are a dense matrix.
DENSE_TEXTS = 512
THRESHOLD = 0.3

_COUNTS = "term int, n bigint"


def _shapes() -> np.ndarray:
    """Each byte's shape: one for lower case and all that is not ASCII, for upper case, digits and blanks; others stand for themselves."""
    shape = np.arange(256, dtype=np.uint32)
    for low, high, kind in ((97, 123, 97), (128, 256, 97), (65, 91, 65), (48, 58, 48)):
        shape[low:high] = kind
    shape[list(b"\t\v\f\r ")] = 32
    return shape


def term_counts(texts: list[bytes], shapes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, count) of the different terms of all texts, in order of text and term."""
    block = Block(texts)
    shape = shapes[block.data]
    triple = (shape[:-2] * np.uint32(0x9E3779B1) + shape[1:-1]) * np.uint32(0x85EBCA77) + shape[2:]
    shape_term = ((triple ^ (triple >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - 12)
    ends = np.append(block.start[1:], len(block.data))
    parts = []
    for begin in range(0, block.count, DENSE_TEXTS):
        low, high = (edge[begin : begin + DENSE_TEXTS].tolist() for edge in (block.start, ends - 3))
        by_shape = np.zeros((len(low), SHAPE_TERMS), np.int64)
        for text, (first, last) in enumerate(zip(low, high)):
            if last > first:
                by_shape[text] = np.bincount(shape_term[first:last], minlength=SHAPE_TERMS)
        text, found = np.nonzero(by_shape)
        parts.append((begin + text, found, by_shape[text, found]))

    words = Words(block)
    hashes = words.hashes()
    word_term = (hashes & np.uint64(WORD_TERMS - 1)).astype(np.int64)
    adjacent = np.flatnonzero((words.text[1:] == words.text[:-1]) & (hashes[1:] == hashes[:-1])) + 1
    keys = np.sort(words.text * WORD_TERMS + word_term)
    first = runs(keys)
    number = np.diff(np.append(first, len(keys)))
    # Words beyond the first of their bucket count as repeated.
    repeats = np.bincount(words.text[adjacent], minlength=block.count), np.bincount(keys[first] // WORD_TERMS, number - 1, block.count)
    parts.append((keys[first] // WORD_TERMS, SHAPE_TERMS + keys[first] % WORD_TERMS, number))
    for at, count in enumerate(repeats):
        some = np.flatnonzero(count)
        parts.append((some, np.full(len(some), TERMS - REPEAT_TERMS + at), count[some].astype(np.int64)))
    text, term, count = (np.concatenate(column) for column in zip(*parts))
    order = np.argsort(text, kind="stable")
    return text[order], term[order], count[order]


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many of the task's texts each term occurs; the number of texts under term -1."""
    shapes, total, texts_seen = _shapes(), np.zeros(TERMS, np.int64), 0
    for batch in batches:
        texts_seen += batch.num_rows
        for _, _, texts in parts(batch.column(0)):
            total += np.bincount(term_counts(texts, shapes)[1], minlength=TERMS)
    found = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(found, -1).astype(np.int32)), pa.array(np.append(total[found], texts_seen))], ["term", "n"]
    )


def _weighted(text: np.ndarray, term: np.ndarray, count: np.ndarray, inverse: np.ndarray) -> np.ndarray:
    """Weights (1 + log count) x inverse document frequency, of length 1 in each text."""
    weight = (1 + np.log(count)) * inverse[term]
    first = runs(text)
    if not len(first):
        return weight
    length = np.sqrt(np.add.reduceat(weight * weight, first))
    return weight / np.repeat(np.maximum(length, 1e-12), np.diff(np.append(first, len(text))))


def _project(text: np.ndarray, term: np.ndarray, weight: np.ndarray, projection: np.ndarray, count: int) -> np.ndarray:
    """Rows of the projection added up by text with their weights, each of length 1; zeros for a text without terms."""
    vectors = np.zeros((count, projection.shape[1]), np.float32)
    first = runs(text)
    bounds = np.append(first, len(text))
    for low in range(0, len(first), 256):
        part = slice(bounds[low], bounds[min(low + 256, len(first))])
        rows = projection[term[part]] * weight[part, None].astype(np.float32)
        vectors[text[first[low : low + 256]]] = np.add.reduceat(rows, first[low : low + 256] - bounds[low], axis=0)
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.maximum(length, 1e-12)


@dataclass(frozen=True)
class NeighbourModel:
    """``projection`` maps weighted terms to latent vectors; ``vectors`` and ``labels`` are those of the examples."""

    inverse: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def score(self, column: pa.Array, shapes: np.ndarray) -> np.ndarray:
        """The share of label 1 among the nearest examples, weighted by similarity; the prior where none is similar."""
        scores = np.full(len(column), self.prior)
        if not len(self.labels):
            return scores
        near = min(NEIGHBOURS, len(self.labels))
        for begin, end, texts in parts(column):
            text, term, count = term_counts(texts, shapes)
            weight = _weighted(text, term, count, self.inverse)
            own = _project(text, term, weight, self.projection, end - begin)
            for low in range(0, end - begin, ROWS_A_BLOCK):
                cosine = own[low : low + ROWS_A_BLOCK] @ self.vectors.T
                top = np.argpartition(cosine, -near, axis=1)[:, -near:]
                vote = np.maximum(np.take_along_axis(cosine, top, axis=1), 0).astype(np.float64) ** 4
                total = vote.sum(axis=1)
                share = (vote * self.labels[top]).sum(axis=1) / np.maximum(total, 1e-12)
                at = slice(begin + low, begin + low + len(cosine))
                scores[at] = np.where(total > 1e-9, np.clip(share, 0, 1), self.prior)
        return scores


def held_out(id_column: str = "doc_id", folds: int = 5, fold: int = 0) -> Column:
    """Whether the crc32 of the id as text falls into the fold that is not learned from; never null."""
    crc = F.crc32(F.col(id_column).cast("string").cast("binary"))
    return F.coalesce(crc % folds == fold, F.lit(False))


def _latent_axes(text: np.ndarray, term: np.ndarray, weight: np.ndarray, rows: int) -> np.ndarray:
    """The leading right singular vectors (terms x dimensions) of the examples' weights, by subspace iteration."""

    def blocks() -> Iterator[tuple[slice, np.ndarray]]:
        for low in range(0, rows, 256):
            high = min(low + 256, rows)
            part = slice(*np.searchsorted(text, [low, high]))
            dense = np.zeros((high - low, TERMS), np.float32)
            dense[text[part] - low, term[part]] = weight[part]
            yield slice(low, high), dense

    def times(right: np.ndarray) -> np.ndarray:
        return np.concatenate([dense @ right for _, dense in blocks()])

    def transposed_times(left: np.ndarray) -> np.ndarray:
        return sum(dense.T @ left[at] for at, dense in blocks())

    size = min(DIMENSIONS + 16, rows)
    start = np.random.default_rng(0).standard_normal((TERMS, size)).astype(np.float32)
    left = np.linalg.qr(times(start))[0]
    for _ in range(3):
        left = np.linalg.qr(times(transposed_times(left)))[0]
    reduced = transposed_times(left).astype(np.float64)
    values, turn = np.linalg.eigh(reduced.T @ reduced)
    largest = np.argsort(-values)[:DIMENSIONS]
    largest = largest[values[largest] > 1e-9 * values.max()]
    return (reduced @ turn[:, largest] / np.sqrt(values[largest])).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", examples: int = EXAMPLES) -> NeighbourModel:
    """Document frequencies of all documents, and vectors of at most ``examples`` labelled documents of each label.

    The examples are those of the least hash of their id, among labelled documents that are not held out. Of an id
    with several labels the largest counts. The driver gets the examples' term counts (TERMS numbers each at most).
    """
    counted = docs.select("text").mapInArrow(_document_counts, _COUNTS).groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    term, n = counted.column("term").to_numpy(), counted.column("n").to_numpy()
    frequency, documents = np.zeros(TERMS), max(int(n[term < 0].sum()), 1)
    frequency[term[term >= 0]] = n[term >= 0]
    inverse = np.log((1 + documents) / (1 + frequency)) + 0.1
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out())
    known = known.groupBy("doc_id").agg(F.max(label).alias("label"))
    sizes = {row["label"]: row["count"] for row in known.groupBy("label").count().collect()}
    prior = sizes.get(1, 0) / max(sum(sizes.values()), 1) if sizes else 0.5
    order = [F.xxhash64("doc_id", F.lit("example")), F.col("doc_id")]
    chosen = [known.filter(F.col("label") == value).orderBy(*order).limit(examples) for value in (0, 1)]
    # At most 2 x examples ids.
    picked = docs.select("doc_id", "text").join(F.broadcast(chosen[0].union(chosen[1])), "doc_id")

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes = _shapes()
        for batch in batches:
            for row, text in enumerate(text_bytes(batch.column("text"))):
                _, terms, number = term_counts([text], shapes)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(row, 1),
                        batch.column("label").slice(row, 1),
                        pa.array([terms.astype(np.int32)], pa.list_(pa.int32())),
                        pa.array([number.astype(np.int32)], pa.list_(pa.int32())),
                    ],
                    ["doc_id", "label", "terms", "counts"],
                )

    schema = "doc_id bigint, label int, terms array<int>, counts array<int>"
    typed = picked.select(F.col("doc_id").cast("bigint"), F.col("label").cast("int"), "text")
    # One row of each id, in a fixed order.
    table = typed.mapInArrow(counts, schema).dropDuplicates(["doc_id"]).orderBy("doc_id").toArrow()
    rows = [np.array(x, np.int64) for x in table.column("terms").to_pylist()]
    text = np.repeat(np.arange(len(rows)), [len(x) for x in rows])
    if not len(text):
        return NeighbourModel(inverse, np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0), prior)
    terms = np.concatenate(rows)
    number = np.concatenate([np.array(x, np.int64) for x in table.column("counts").to_pylist()])
    weight = _weighted(text, terms, number, inverse)
    projection = _latent_axes(text, terms, weight, len(rows))
    vectors = _project(text, terms, weight, projection, len(rows))
    some = np.linalg.norm(vectors, axis=1) > 0
    label_of = table.column("label").to_numpy().astype(np.float64)
    return NeighbourModel(inverse, projection, vectors[some], label_of[some], prior)


def score(docs: DataFrame, model: NeighbourModel, text: str = "text") -> Column:
    fields = (model.inverse, model.projection, model.vectors, model.labels, model.prior)
    shared = docs.sparkSession.sparkContext.broadcast(fields)

    def scored(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        learned, shapes = NeighbourModel(*shared.value), _shapes()
        for column in columns:
            yield pa.array(learned.score(column, shapes), pa.float64())

    scored.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(scored, "double")(F.col(text))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document: 1 from a score of 0.3 on, else 0.

    A text without terms, a missing one among them, scores the share of label 1 in the training rows (0.5 without
    any). Repeated rows give repeated results.
    """
    model = fit(docs, labels)
    scored = docs.select("doc_id", held_out().alias("held_out"), score(docs, model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
