"""Benchmark decontamination with a positional inverted index that is dealt by document.

The index is stored in segments: runs of whole documents with, for each term, the list of its positions in the
segment. As a segment holds all terms of its documents, lists are intersected where they lie and no term's list is
ever brought together, however common the term is. Only terms of the test items are stored.

A phrase is looked up from its rarest term: the positions of that term, less its place in the phrase, are the first
candidates, and the lists of the other terms, in order of their length and each moved by its own place, thin them
out. Positions of different documents are further apart than any match reaches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matflow.llm.blocks import NOT_ALPHANUMERIC, covered, parts, ranges, text_bytes
from matflow.llm.storage import stored

WINDOW = 13
#: An item is near a passage that has its rarest NEAR_TERMS terms within NEAR_WORDS words of the rarest one. Terms that
#: no document has don't count; of fewer than NEAR_TERMS all are needed, and at least LEAST_TERMS.
NEAR_TERMS, NEAR_WORDS, LEAST_TERMS = 4, 20, 2
#: Test items, in bytes of text, that are broadcast at once; more of them are looked up in several passes.
PASS_BYTES = 8 << 20
#: Bytes of text of a segment.
SEGMENT_BYTES = 4 << 20
#: Phrase candidates checked at once.
CANDIDATES = 2_000_000

_GAP = WINDOW + NEAR_WORDS + 1
_LOWER = bytes(b + 32 if 65 <= b <= 90 else 32 if b in NOT_ALPHANUMERIC else b for b in range(256))

_SEGMENT = (
    "ids array<bigint>, keys array<bigint>, n_words array<int>, n_terms int, terms binary, lengths binary, positions binary"
)
_RESULT = "doc_id bigint, row_key bigint, n_words bigint, hit_at array<int>, items array<string>, near array<string>"


def tokens(text: bytes) -> list[bytes]:
    """Runs of letters, digits and all that is not ASCII, with A-Z in lower case."""
    return text.translate(_LOWER).split()


@dataclass(frozen=True)
class TestItems:
    """Test items as lists of term numbers, end to end; ``first`` has where each one begins."""

    names: tuple[str, ...]
    vocabulary: dict[bytes, int]
    terms: np.ndarray
    first: np.ndarray

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each phrase its item, where it begins and its length: 13 words, or all of a shorter item."""
        sizes = np.diff(self.first)
        counts = np.where(sizes > 0, np.maximum(sizes - WINDOW + 1, 1), 0)
        item = np.repeat(np.arange(len(sizes)), counts)
        place = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
        return item, self.first[item] + place, np.minimum(sizes[item], WINDOW)


def _items(rows: pa.Table) -> TestItems:
    names, vocabulary, terms, first = [], {}, [], [0]
    for name, text in zip(rows.column(0).to_pylist(), text_bytes(rows.column(1))):
        if name is not None:
            names.append(name)
            terms.extend(vocabulary.setdefault(term, len(vocabulary)) for term in tokens(text))
            first.append(len(terms))
    return TestItems(tuple(names), vocabulary, np.array(terms, np.int32), np.array(first, np.int64))


def _passes(benchmark: DataFrame) -> Iterator[TestItems]:
    """The test items in parts of bounded size; equal rows count once, those without an id not at all.

    Rows are dealt by id and text, so those of one id can go to several parts. There are more parts as long as one of
    them has twice the bytes it should have and more than one row.
    """
    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), "text").filter("item IS NOT NULL").distinct()
    passes = 1
    while True:
        part = F.pmod(F.xxhash64("item", "text"), F.lit(passes))
        sizes = rows.groupBy(part.alias("part")).agg(F.sum(F.octet_length("text")).alias("bytes"), F.count(F.lit(1)).alias("n"))
        large = sizes.filter(f"n > 1 AND bytes > {PASS_BYTES if passes == 1 else 2 * PASS_BYTES}")
        most = large.agg(F.max("bytes")).first()[0]
        if not most:
            break
        passes = max(2 * passes, -(-most // PASS_BYTES))
    for at in range(passes):
        yield _items(rows.filter(part == at).orderBy("item", "text").toArrow())


def _pack(values: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(values, np.int32).tobytes(), codec="zstd", asbytes=True)


def _unpack(data: bytes, count: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, decompressed_size=4 * count, codec="zstd", asbytes=True), np.int32)


def _segments(batches: Iterator[pa.RecordBatch], vocabulary: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for begin, end, texts in parts(batch.column(2), SEGMENT_BYTES):
            words = [tokens(text) for text in texts]
            n_words = list(map(len, words))
            term = np.concatenate([np.fromiter(map(vocabulary.get, w, repeat(-1)), np.int32, len(w)) for w in words])
            place = np.arange(len(term)) + np.repeat(np.arange(1, len(words) + 1) * _GAP, n_words)
            known = np.flatnonzero(term >= 0)
            order = known[np.argsort(term[known], kind="stable")]
            terms, lengths = np.unique(term[order], return_counts=True)
            steps = np.diff(place[order], prepend=0)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([ids[begin:end]], pa.list_(pa.int64())),
                    pa.array([keys[begin:end]], pa.list_(pa.int64())),
                    pa.array([n_words], pa.list_(pa.int32())),
                    pa.array([len(terms)], pa.int32()),
                    *(pa.array([_pack(x)], pa.binary()) for x in (terms, lengths, steps)),
                ],
                ["ids", "keys", "n_words", "n_terms", "terms", "lengths", "positions"],
            )


def build_index(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """The stored segments of (doc_id, row_key, text); a missing text has no words."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    return stored(docs.mapInArrow(lambda batches: _segments(batches, shared.value), _SEGMENT), "postings")


class _Segment:
    def __init__(self, row: dict, vocabulary_size: int):
        self.n_words = np.array(row["n_words"], np.int64)
        self.first = np.cumsum(self.n_words) - self.n_words + np.arange(1, len(self.n_words) + 1) * _GAP
        self.size = int(self.first[-1] + self.n_words[-1]) + _GAP
        lengths = _unpack(row["lengths"], row["n_terms"])
        self.length = np.zeros(vocabulary_size, np.int64)
        self.length[_unpack(row["terms"], row["n_terms"])] = lengths
        self.begin = np.cumsum(self.length) - self.length
        self.positions = np.cumsum(_unpack(row["positions"], int(lengths.sum())))
        #: The lists turned over: the term at each position, which tells whether a term's list has a position.
        self.term_at = np.full(self.size, -1, np.int32)
        self.term_at[self.positions] = np.repeat(np.arange(vocabulary_size), self.length)

    def document(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, position, "right") - 1

    def expand(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each of ``terms`` all positions of its list, with the index of the term."""
        sizes = self.length[terms]
        owner = np.repeat(np.arange(len(terms)), sizes)
        within = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return owner, self.positions[self.begin[terms][owner] + within]

    def phrases(self, terms: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, position) of every exact occurrence."""
        places = np.arange(WINDOW)
        inside = places < size[:, None]
        term = terms[np.where(inside, begin[:, None] + places, begin[:, None])]
        length = np.where(inside, self.length[term], np.iinfo(np.int64).max)
        rank = np.argsort(length, axis=1, kind="stable")
        some = np.flatnonzero(np.take_along_axis(length, rank[:, :1], axis=1)[:, 0] > 0)
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        loads = length[some, rank[some, 0]]
        for low, high in ranges(loads.tolist(), CANDIDATES):
            phrase = some[low:high]
            rarest = rank[phrase, 0]
            owner, at = self.expand(term[phrase, rarest])
            phrase, at = phrase[owner], at - rarest[owner]
            for step in range(1, WINDOW):
                place = rank[phrase, step]
                checked = place >= size[phrase]
                target = np.where(checked, 0, at + place)
                holds = checked | (self.term_at[target] == term[phrase, place])
                phrase, at = phrase[holds], at[holds]
            found.append((phrase, at))
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def near(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, document) where an item's rarest terms, a row of ``chosen``, lie close to the first of them."""
        some = np.flatnonzero(chosen[:, 0] >= 0)
        span = np.int64(self.size + _GAP)
        listed = np.repeat(np.arange(len(self.length)), self.length) * span + self.positions
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for low, high in ranges(self.length[chosen[some, 0]].tolist(), CANDIDATES):
            owner, at = self.expand(chosen[some[low:high], 0])
            item = some[low:high][owner]
            for step in range(1, NEAR_TERMS):
                base = chosen[item, step] * span + at
                place = np.searchsorted(listed, base - NEAR_WORDS)
                holds = place < len(listed)
                holds[holds] = listed[place[holds]] <= base[holds] + NEAR_WORDS
                holds |= chosen[item, step] < 0
                item, at = item[holds], at[holds]
            found.append((item, self.document(at)))
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _lists(item: np.ndarray, document: np.ndarray, names: tuple[str, ...], count: int) -> list[list[str]]:
    found: list[list[str]] = [[] for _ in range(count)]
    for at, who in sorted(set(zip(document.tolist(), item.tolist()))):
        found[at].append(names[who])
    return found


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The length of each term's lists."""
    for batch in batches:
        for row in batch.to_pylist():
            columns = [pa.array(_unpack(row[name], row["n_terms"])) for name in ("terms", "lengths")]
            yield pa.RecordBatch.from_arrays(columns, ["term", "n"])


def _rarest_terms(index: DataFrame, items: TestItems) -> np.ndarray:
    """The NEAR_TERMS terms of each item that occur least in the whole index, equals in the order of their bytes.

    Terms that don't occur are passed over. -1 where there are no more, and for items with fewer than LEAST_TERMS. What
    is collected is a count for each term of the test items.
    """
    table = index.mapInArrow(_term_counts, "term int, n int").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    count = np.zeros(len(items.vocabulary), np.int64)
    count[table.column("term").to_numpy()] = table.column("n").to_numpy()
    by_bytes = np.empty(len(count), np.int64)
    by_bytes[[number for _, number in sorted(items.vocabulary.items())]] = np.arange(len(count))
    chosen = np.full((len(items.names), NEAR_TERMS), -1, np.int64)
    for item, (low, high) in enumerate(zip(items.first, items.first[1:])):
        own = np.unique(items.terms[low:high])
        own = own[count[own] > 0]
        own = own[np.lexsort((by_bytes[own], count[own]))][:NEAR_TERMS]
        if len(own) >= LEAST_TERMS:
            chosen[item, : len(own)] = own
    return chosen


def _look_up(batches: Iterator[pa.RecordBatch], items: TestItems, chosen: np.ndarray) -> Iterator[pa.RecordBatch]:
    item, begin, size = items.windows()
    for batch in batches:
        for row in batch.to_pylist():
            segment = _Segment(row, len(items.vocabulary))
            phrase, at = segment.phrases(items.terms, begin, size)
            hit = covered(at, size[phrase], segment.size)
            ends = segment.first + segment.n_words
            count = len(segment.n_words)
            marks = [np.flatnonzero(hit[a:b]) for a, b in zip(segment.first, ends)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["ids"], pa.int64()),
                    pa.array(row["keys"], pa.int64()),
                    pa.array(segment.n_words),
                    pa.array(marks, pa.list_(pa.int32())),
                    pa.array(_lists(item[phrase], segment.document(at), items.names, count), pa.list_(pa.string())),
                    pa.array(_lists(*segment.near(chosen), items.names, count), pa.list_(pa.string())),
                ],
                ["doc_id", "row_key", "n_words", "hit_at", "items", "near"],
            )


def find_test_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, row_key, n_words, hit_at, items, near) of every document.

    ``hit_at`` lists the words inside exact occurrences of a phrase of an item, ``items`` the items whose phrases
    occur and ``near`` those with a proximity match. ``row_key`` is a hash of doc_id and text. Items without id or
    words match nothing; an id that several items share counts once.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), row_key().alias("row_key"), "text")
    context, found, passes = docs.sparkSession.sparkContext, None, 0
    for items in _passes(benchmark):
        # Plain values: a broadcast is unpickled without this package.
        index = build_index(rows, items.vocabulary)
        shared = context.broadcast(((items.names, items.vocabulary, items.terms, items.first), _rarest_terms(index, items)))
        matches = index.mapInArrow(
            lambda batches, shared=shared: _look_up(batches, TestItems(*shared.value[0]), shared.value[1]), _RESULT
        )
        found, passes = (matches if found is None else found.unionByName(matches)), passes + 1
    if passes == 1:
        return found
    joined = {name: F.array_distinct(F.flatten(F.collect_set(name))).alias(name) for name in ("hit_at", "items", "near")}
    merged = found.groupBy("doc_id", "row_key").agg(F.max("n_words").alias("n_words"), *joined.values())
    same = merged.select(F.col("doc_id").alias("__id"), F.col("row_key").alias("__key"), "n_words", *joined)
    met = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("row_key") == F.col("__key"))
    return rows.drop("text").join(same, met).drop("__id", "__key")


def row_key() -> Column:
    return F.xxhash64("doc_id", "text")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near_items, row_key) of every document.

    A document is contaminated if at least a twentieth of its words lies inside phrases of 13 words of a test item,
    or inside a shorter item. A missing text has no words. Repeated rows give repeated results.
    """
    found = find_test_items(docs, benchmark)
    n_hit, items = F.size("hit_at").cast("bigint"), F.array_sort(F.array_distinct("items"))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
        F.size(F.array_distinct("near")).cast("bigint").alias("n_near_items"),
        "row_key",
    )


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated documents."""
    bad = contamination(docs, benchmark).filter("contaminated").select(F.col("row_key").alias("__bad")).distinct()
    keyed = docs.withColumn("__key", row_key())
    return keyed.join(bad, F.col("__key") == F.col("__bad"), "left_anti").select(*docs.columns)
