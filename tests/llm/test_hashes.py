"""Hashes of words and lines: no families of texts that collide, and equal bytes where a result says equal."""

import random

import numpy as np
import pytest

from matflow.llm import near_duplicates, quality_rules
from matflow.llm.blocks import SHORT, Block, Words, range_hashes


def thue_morse(size):
    text = "".join("ab"[bin(n).count("1") % 2] for n in range(size))
    return text.encode(), text.translate(str.maketrans("ab", "ba")).encode()


def hashes(ranges):
    data = np.frombuffer(b"".join(ranges) + b" ", np.uint8)
    end = np.cumsum([len(r) for r in ranges])
    return range_hashes(data, end - [len(r) for r in ranges], end)


@pytest.mark.parametrize("size", [8, 64, 1024, 2048, 4096])
def test_thue_morse_pairs_differ(size):
    left, right = thue_morse(size)
    one, other = hashes([left, right])
    assert one != other
    assert quality_rules.base_counts([left + b"\n" + right])["n_dup_lines"].tolist() == [0]
    assert quality_rules.base_counts([left + b"\n" + left])["n_dup_lines"].tolist() == [1]


def test_similar_texts_of_such_words_are_different():
    left, right = thue_morse(1024)
    text = lambda word: b" ".join([word, b"b"] * 10)
    assert near_duplicates.similarities([text(left)], [text(right)])[0] == 0
    assert near_duplicates.similarities([text(left)], [text(left)])[0] == 1


def test_hashes_depend_on_the_bytes_alone():
    draw = random.Random(4)
    sizes = [0, 1, 7, 8, 9, 15, 16, 17, SHORT - 1, SHORT, SHORT + 1, SHORT + 9, 5000]
    texts = [bytes(draw.randrange(33, 127) for _ in range(draw.choice(sizes))) for _ in range(3000)]
    texts += [texts[n][:-1] + b"\x00" for n in range(200) if texts[n]]
    found = {}
    for text, value in zip(texts, hashes(texts).tolist()):
        assert found.setdefault(text, value) == value
    assert len(set(found.values())) == len(found)
    # Whatever stands around a word, and wherever pieces end.
    block = Block([b"x" * n + b" some word " + b"y" * (3 << 19) for n in range(3)])
    words = Words(block)
    assert len(set(words.hashes()[words.end - words.start == 4].tolist())) == 2


def test_lines_count_as_equal_by_their_bytes(monkeypatch):
    monkeypatch.setattr(quality_rules, "range_hashes", lambda data, start, end: np.zeros(len(start), np.uint64))
    counts = quality_rules.base_counts([b"one\ntwo\none\none\n", b"one\n"])
    assert counts["n_dup_lines"].tolist() == [2, 0]
