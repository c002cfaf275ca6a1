"""Byte-level BPE: encoding with a rank queue over a hierarchical bitmap, and decoding.

All pre-tokens of a block that have not been seen yet share one queue. It has a bucket of positions for each merge
rank, and a bitmap of the ranks that have any; the bitmap's first set bit is the next merge. The tokens form linked
lists, one for each pre-token, so a merge touches its two neighbours only and the length of a pre-token doesn't
matter. An entry whose pair has changed since it was queued is stale and skipped. As pre-tokens don't influence each
other, all pairs of the popped rank merge in one step.
"""

from __future__ import annotations

import base64
import hashlib
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matflow.llm.blocks import parts, runs

#: Pre-tokens whose ids a task remembers, and their bytes with those of their ids; beyond that it starts anew.
REMEMBERED, REMEMBERED_BYTES = 200_000, 32 << 20
#: Bytes of text whose new pre-tokens share a queue.
QUEUE_BYTES = 2 << 20

# The code points with the property White_Space.
_SPACES = [*range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# What follows the apostrophe in the contractions of the split pattern.
_SHORT, _LONG = "stmd", ("re", "ve", "ll")

_SPACE, _LETTER, _NUMBER, _OTHER, _BORDER = range(5)
_NONE = -1


@dataclass(frozen=True)
class Vocabulary:
    """Token bytes by rank, the sorted pairs of ranks that merge, and the rank each pair becomes.

    ``late`` marks ranks that are part of a pair of a lower rank.
    """

    tokens: tuple[bytes, ...]
    pairs: np.ndarray
    merged: np.ndarray
    late: np.ndarray


def read_vocabulary(path: str) -> Vocabulary:
    """A file of lines "base64 rank" with ranks from 0, all single bytes among them."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    if sorted(ranks.values()) != list(range(len(ranks))) or any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("ranks must run from 0 without gaps and hold every single byte")
    found = {}
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                found[(left << 32) | right] = rank
    pairs = np.array(sorted(found), np.int64)
    merged = np.array([found[pair] for pair in pairs.tolist()], np.int32)
    late = np.zeros(len(ranks), bool)
    for part in (pairs >> 32, pairs & 0xFFFFFFFF):
        late[part[merged < part]] = True
    return Vocabulary(tuple(sorted(ranks, key=ranks.get)), pairs, merged, late)


class RankBitmap:
    """A set of small integers with a quick minimum: each level has a bit for every non-empty word below."""

    def __init__(self, size: int):
        self.levels = []
        while True:
            size = (size + 63) >> 6
            self.levels.append([0] * size)
            if size == 1:
                break

    def add(self, value: int) -> None:
        for level in self.levels:
            word, bit = value >> 6, 1 << (value & 63)
            if level[word] & bit:
                return
            level[word] |= bit
            value = word

    def remove(self, value: int) -> None:
        for level in self.levels:
            word = value >> 6
            level[word] &= ~(1 << (value & 63))
            if level[word]:
                return
            value = word

    def first(self) -> int:
        """The least member, or -1."""
        if not self.levels[-1][0]:
            return -1
        word = 0
        for level in reversed(self.levels):
            bits = level[word]
            word = (word << 6) | ((bits & -bits).bit_length() - 1)
        return word


class RankQueue:
    """Positions of pairs by their rank."""

    def __init__(self, size: int):
        self.bitmap, self.buckets = RankBitmap(size), {}

    def push(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        known = ranks >= 0
        ranks, positions = ranks[known], positions[known]
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        first = runs(ranks)
        for rank, begin, end in zip(ranks[first].tolist(), first.tolist(), [*first[1:].tolist(), len(ranks)]):
            self.buckets.setdefault(rank, []).append(positions[begin:end])
            self.bitmap.add(rank)

    def pop(self) -> tuple[int, np.ndarray]:
        """The least rank and its positions in order, each once; -1 if there is none."""
        rank = self.bitmap.first()
        if rank < 0:
            return rank, np.empty(0, np.int64)
        self.bitmap.remove(rank)
        parts = self.buckets.pop(rank)
        return rank, np.unique(np.concatenate(parts)) if len(parts) > 1 else parts[0]


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.ranks = {token: rank for rank, token in enumerate(vocabulary.tokens)}
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.seen: dict[bytes, bytes] = {}
        self.held = 0
        self.kinds = np.full(0x10000, _OTHER, np.uint8)
        for code in range(0x10000):
            self.kinds[code] = _kind(code)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pairs = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.vocabulary.pairs, pairs), len(self.vocabulary.pairs) - 1)
        return np.where(self.vocabulary.pairs[at] == pairs, self.vocabulary.merged[at], _NONE)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece, as little-endian 32-bit integers."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        piece = np.repeat(np.arange(len(pieces)), sizes)
        token = self.single[np.frombuffer(b"".join(pieces), np.uint8)]
        count = len(token)
        position = np.arange(count)
        ends = np.cumsum(sizes)
        after, before = position + 1, position - 1
        after[ends - 1], before[ends - sizes] = _NONE, _NONE
        alive = np.ones(count, bool)
        rank = np.full(count, _NONE, np.int32)
        paired = np.flatnonzero(after >= 0)
        rank[paired] = self.pair_ranks(token[paired], token[paired + 1])
        queue = RankQueue(len(self.vocabulary.tokens))
        queue.push(rank, position)
        while True:
            least, at = queue.pop()
            if least < 0:
                break
            at = at[rank[at] == least]
            if not len(at):
                continue
            # Of overlapping pairs every other one merges, from the left.
            every = at
            overlaps = np.concatenate([[False], after[at[:-1]] == at[1:]])
            index = np.arange(len(at))
            at = at[(index - np.maximum.accumulate(np.where(overlaps, 0, index))) % 2 == 0]
            if self.vocabulary.late[least]:
                at, rest = self._until_lower(least, every, at, token, before, after, piece)
                queue.push(rank[rest], rest)
            gone = after[at]
            following = after[gone]
            token[at], after[at], alive[gone], rank[gone] = least, following, False, _NONE
            linked = following >= 0
            before[following[linked]] = at[linked]
            rank[at] = _NONE
            touched = np.concatenate([at[linked], before[at][before[at] >= 0]])
            rank[touched] = self.pair_ranks(token[touched], token[after[touched]])
            queue.push(rank[touched], touched)
        ids = token[alive].astype("<u4").tobytes()
        bounds = (4 * np.concatenate([[0], np.cumsum(np.bincount(piece[alive], minlength=len(pieces)))])).tolist()
        return [ids[begin:end] for begin, end in zip(bounds, bounds[1:])]

    def _until_lower(self, least: int, every: np.ndarray, at: np.ndarray, token, before, after, piece) -> tuple[np.ndarray, np.ndarray]:
        """The merges ``at`` that come next in each piece, and the positions of ``every`` that come later.

        One after another, merges of a piece go on until one makes a pair of a lower rank, which comes before the
        others. A merge's left neighbour is the merge before it where they touch; its right one is not merged yet.
        """
        left, right = before[at], after[after[at]]
        touches = np.concatenate([[False], right[:-1] == at[1:]])
        lower = np.zeros(len(at), bool)
        some = np.flatnonzero(left >= 0)
        own = np.full(len(at), least, token.dtype)
        made = self.pair_ranks(np.where(touches[some], least, token[left[some]]), own[some])
        lower[some] = (made >= 0) & (made < least)
        some = np.flatnonzero(right >= 0)
        made = self.pair_ranks(own[some], token[right[some]])
        lower[some] |= (made >= 0) & (made < least)
        first = runs(piece[at])
        index = np.arange(len(at))
        stop = np.minimum.reduceat(np.where(lower, index, len(at)), first)
        last = np.minimum(stop, np.append(first[1:], len(at)) - 1)
        now = index <= np.repeat(stop, np.diff(np.append(first, len(at))))
        # Later are those beyond the last merge of their piece.
        group = np.searchsorted(piece[at[first]], piece[every])
        return at[now], every[every > at[last][group]]

    def split(self, texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
        """The pre-tokens of all texts, and for each text where its first one is."""
        decoded = [text.decode("utf-8", "replace") for text in texts]
        codes = np.frombuffer(("\n" + "\n".join(decoded) + "\n").encode("utf-32-le"), np.uint32)
        sizes = np.fromiter(map(len, decoded), np.int64, len(decoded)) + 1
        borders = np.concatenate([[0], np.cumsum(sizes)])
        kind = self.kinds[np.minimum(codes, 0xFFFF)]
        for code in np.unique(codes[codes > 0xFFFF]).tolist():
            kind[codes == code] = _kind(code)
        kind[borders] = _BORDER
        begins = np.zeros(len(codes) + 1, bool)
        begins[1:-1] = kind[1:] != kind[:-1]
        begins[borders] = begins[borders + 1] = True
        # A last space goes to the word that follows; any other last white space stands alone.
        last = np.flatnonzero((kind[:-1] == _SPACE) & (kind[1:] != _SPACE) & (kind[1:] != _BORDER))
        begins[last] = True
        begins[last[codes[last] == 0x20] + 1] = False
        self._contractions(codes, kind, begins)
        width = 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000).astype(np.int32)
        offset = np.concatenate([np.zeros(1, np.int32), np.cumsum(width, dtype=np.int32)])
        begins[-1] = True
        starts = np.flatnonzero(begins)
        inner = kind[starts[:-1]] != _BORDER
        low, high = offset[starts[:-1]][inner].tolist(), offset[starts[1:]][inner].tolist()
        joined = ("\n" + "\n".join(decoded) + "\n").encode("utf-8")
        first = np.searchsorted(starts[:-1][inner], borders)
        return [joined[a:b] for a, b in zip(low, high)], first

    @staticmethod
    def _contractions(codes: np.ndarray, kind: np.ndarray, begins: np.ndarray) -> None:
        quotes = np.flatnonzero((codes[:-1] == ord("'")) & begins[:-2] & (kind[1:] == _LETTER))
        for at in quotes.tolist():
            one, two = chr(codes[at + 1]), "".join(map(chr, codes[at + 1 : at + 3]))
            size = 1 if one in _SHORT else 2 if two in _LONG else 0
            if size:
                begins[at + 1] = False
                begins[at + 1 + size] = True

    def encode(self, column: pa.Array) -> Iterator[bytes]:
        """The ids of each text, as little-endian 32-bit integers."""
        for _, _, texts in parts(column, QUEUE_BYTES):
            pieces, first = self.split(texts)
            if len(self.seen) > REMEMBERED or self.held > REMEMBERED_BYTES:
                self.seen.clear()
                self.held = 0
            new = []
            for piece in set(pieces).difference(self.seen):
                if (rank := self.ranks.get(piece)) is None:
                    new.append(piece)
                else:
                    self.seen[piece] = rank.to_bytes(4, "little")
            if new:
                merged = self.merge(new)
                self.held += sum(map(len, new)) + sum(map(len, merged))
                self.seen.update(zip(new, merged))
            ids = list(map(self.seen.__getitem__, pieces))
            for low, high in zip(first.tolist(), first[1:].tolist()):
                yield b"".join(ids[low:high])

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocabulary.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _kind(code: int) -> int:
    if code in _SPACES:
        return _SPACE
    return {"L": _LETTER, "N": _NUMBER}.get(unicodedata.category(chr(code))[0], _OTHER)


def _shared(spark: SparkSession, vocabulary: Vocabulary):
    return spark.sparkContext.broadcast((vocabulary.tokens, vocabulary.pairs, vocabulary.merged, vocabulary.late))


def _arrow(function, kind: str):
    function.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(function, kind)


def _id_lists(found: list[bytes]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(ids) // 4 for ids in found])]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(found), "<i4")))


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text") -> Column:
    """array<int> of the ids of each text; a missing or empty text has none."""
    shared = _shared(docs.sparkSession, vocabulary)

    def ids(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(Vocabulary(*shared.value))
        for column in columns:
            yield _id_lists(list(encoder.encode(column)))

    return _arrow(ids, "array<int>")(F.col(text))


def decode(docs: DataFrame, vocabulary: Vocabulary, ids: str = "ids") -> Column:
    """The bytes of each list of ids; a missing list has none."""
    shared = _shared(docs.sparkSession, vocabulary)

    def texts(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = shared.value[0]
        for column in columns:
            yield pa.array([b"".join(map(tokens.__getitem__, x or ())) for x in column.to_pylist()], pa.binary())

    return _arrow(texts, "binary")(F.col(ids))


def tokenize(docs: DataFrame, vocabulary: Vocabulary, carry: list[str], text: str = "text") -> DataFrame:
    """(carry, n_tokens, ids_sha256, decoded_sha256, ids) of every document; the ids are decoded again.

    The digests are of the ids as little-endian 32-bit integers and of the bytes they stand for. A missing text
    counts as an empty one, which has no ids. Bytes that are no UTF-8 count as U+FFFD.
    """
    shared = _shared(docs.sparkSession, vocabulary)

    def digests(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(Vocabulary(*shared.value))
        for column in columns:
            found, ids_hex, text_hex = [], [], []
            for ids in encoder.encode(column):
                found.append(ids)
                ids_hex.append(hashlib.sha256(ids).hexdigest())
                text_hex.append(hashlib.sha256(encoder.decode(ids)).hexdigest())
            sizes = np.array([len(ids) // 4 for ids in found], np.int64)
            yield pa.StructArray.from_arrays(
                [pa.array(sizes), pa.array(ids_hex, pa.string()), pa.array(text_hex, pa.string()), _id_lists(found)],
                ["n_tokens", "ids_sha256", "decoded_sha256", "ids"],
            )

    kind = "n_tokens bigint, ids_sha256 string, decoded_sha256 string, ids array<int>"
    rows = docs.select(F.struct(*carry).alias("carried"), _arrow(digests, kind)(F.col(text)).alias("found"))
    return rows.select("carried.*", "found.*")
