"""Many texts as one byte buffer: words, their hashes and n-grams with numpy, without a Python object a word."""

from __future__ import annotations

import contextlib
import ctypes
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 2 << 20
HASH_BYTES = 1 << 20
SHORT = 128

#: Bytes that end a word in the two word definitions of this package.
WHITE_SPACE = b"\t\n\v\f\r "
NOT_ALPHANUMERIC = bytes(b for b in range(128) if not chr(b).isalnum())

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_SEED = np.uint64(0xD1342543DE82EF95)
#: Masks that keep the first 0 to 8 bytes of eight.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def mix(values: np.ndarray) -> np.ndarray:
    """Every bit of a 64-bit value spread over all bits (the finaliser of splitmix64)."""
    z = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def chain(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A hash of an ordered pair of hashes."""
    return mix(left * _GOLDEN + (right ^ (right >> np.uint64(29))))


def give_back_memory() -> None:
    """Hands what this process has freed back to the system; a Python worker serves many tasks after one another."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # a C library without malloc_trim
        ctypes.CDLL(None).malloc_trim(0)


def byte_set(members: bytes) -> np.ndarray:
    found = np.zeros(256, bool)
    found[list(members)] = True
    return found


def text_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The UTF-8 bytes of each text; a missing text is an empty one."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def ranges(sizes: list[int], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs [from, to) of items whose sizes add up to about ``limit``; a larger item is a run of its own."""
    begin, total = 0, 0
    for at, size in enumerate(sizes):
        if at > begin and total + size > limit:
            yield begin, at
            begin, total = at, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)


def slices(texts: list[bytes], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    # 64 bytes a text bound the number of very short texts in a block.
    return ranges([len(text) + 64 for text in texts], limit)


def parts(column: pa.Array | pa.ChunkedArray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, list[bytes]]]:
    """(from, to, texts) of a column piece by piece, so that only one piece is copied at a time."""
    # 64 bytes a text bound the number of very short texts in a piece.
    sizes = pc.add(pc.fill_null(pc.binary_length(column), 0), 64)
    for begin, end in ranges(sizes.to_pylist(), limit):
        yield begin, end, text_bytes(column.slice(begin, end - begin))
    give_back_memory()


class Block:
    """Texts end to end, each followed by a line feed."""

    def __init__(self, texts: list[bytes], translate: bytes | None = None):
        joined = b"\n".join(texts) + b"\n"
        self.count = len(texts)
        self.data = np.frombuffer(joined.translate(translate) if translate else joined, np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.start = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])[:-1]

    def text_of(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.start, position, "right") - 1


class Words:
    """The words of a block: their byte ranges, texts and counts by text."""

    def __init__(self, block: Block, ends: bytes = WHITE_SPACE):
        inside = ~byte_set(ends)[block.data]
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if inside[0]:
            edges = np.concatenate([np.zeros(1, np.int64), edges])
        self.block = block
        self.start, self.end = edges[0::2], edges[1::2]
        self.text = block.text_of(self.start)
        self.counts = np.bincount(self.text, minlength=block.count)
        self.first = np.concatenate([np.zeros(1, np.int64), np.cumsum(self.counts)])

    def hashes(self) -> np.ndarray:
        return range_hashes(self.block.data, self.start, self.end)

    def whole(self, size: int) -> np.ndarray:
        """Whether ``size`` words from this one on are of the same text."""
        same = np.zeros(len(self.text), bool)
        if len(same) >= size:
            same[: len(same) - size + 1] = self.text[: len(same) - size + 1] == self.text[size - 1 :]
        return same


def range_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each range, eight at a time; what follows the first ``SHORT`` bytes by BLAKE2.

    Every step is a bijection of the state that no sum or product undoes, so there are no families of texts with equal
    hashes as a polynomial has. Ranges of one length of up to eight bytes never collide. Ranges are in order and do not
    overlap; the work goes in pieces, so memory stays bounded.
    """
    found = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        base = start[at]
        to = max(at + 1, int(np.searchsorted(end, base + HASH_BYTES, "right")))
        piece = np.concatenate([data[base : end[to - 1]], np.zeros(8, np.uint8)])
        eight = np.ndarray((len(piece) - 7,), np.uint64, buffer=piece, strides=(1,))
        low, length = start[at:to] - base, end[at:to] - start[at:to]
        state = mix(length.astype(np.uint64) * _GOLDEN + _SEED)
        rest = np.arange(len(low))
        for done in range(0, SHORT, 8):
            rest = rest[length[rest] > done]
            if not len(rest):
                break
            chunk = eight[low[rest] + done] & _FIRST[np.minimum(length[rest] - done, 8)]
            state[rest] = mix(state[rest] * _GOLDEN ^ chunk) + np.uint64(done)
        for one in rest[length[rest] > SHORT].tolist():
            tail = piece[low[one] + SHORT : low[one] + length[one]].tobytes()
            digest = np.frombuffer(hashlib.blake2b(tail, digest_size=8).digest(), np.uint64)
            state[one] = mix(state[one : one + 1] * _GOLDEN ^ digest)[0]
        found[at:to] = state
        at = to
    return found


def runs(ordered: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    if not len(ordered):
        return np.zeros(0, np.int64)
    return np.concatenate([np.zeros(1, np.int64), np.flatnonzero(ordered[1:] != ordered[:-1]) + 1])


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """At each position the hash of the ``size`` words from there; zero where too few follow.

    Windows of doubling length are joined, so a window of 13 words takes five steps.
    """
    found = np.zeros(len(words), np.uint64)
    if len(words) < size:
        return found
    last = len(words) - size + 1
    joined, covered, power, span = None, 0, words, 1
    remaining = size
    while remaining:
        if remaining & 1:
            part = power[covered : covered + last]
            joined = part if joined is None else chain(joined, part)
            covered += span
        remaining >>= 1
        if remaining:
            power = chain(power[:-span], power[span:])
            span *= 2
    found[:last] = joined
    return found


def covered(starts: np.ndarray, size: int | np.ndarray, count: int) -> np.ndarray:
    """Which of ``count`` positions lie in a window of ``size`` from one of ``starts``."""
    steps = np.zeros(count + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + size, -1)
    return np.cumsum(steps[:-1]) > 0
