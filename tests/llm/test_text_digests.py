"""Operators whose result a few lines of Python give: substring dedup, decontamination, quality counts and BPE."""

import base64
import hashlib
import random
import re
import string
import time
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from matflow.llm import bpe, decontamination, quality_rules, substring_dedup
from matflow.llm.queries import VOCABULARY_FILE

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
TERMS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def removed_by_hand(rows):
    least, out = {}, []
    rank = lambda i: float("inf") if i is None else i
    split = [(i, WORDS.findall(t or "")) for i, t in rows]
    for i, words in split:
        for k in range(len(words) - 12):
            window = tuple(words[k : k + 13])
            least[window] = min(least.get(window, float("inf")), rank(i))
    for i, words in split:
        gone = [False] * len(words)
        for k in range(len(words) - 12):
            if least[tuple(words[k : k + 13])] < rank(i):
                gone[k : k + 13] = [True] * 13
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((i, len(words), sum(gone), sha(kept)))
    return Counter(out)


def found_by_hand(rows, items):
    windows = defaultdict(set)
    for item, text in items:
        terms = tuple(TERMS.findall((text or "").translate(LOWER)))
        for k in range(max(1, len(terms) - 12) if terms and item is not None else 0):
            windows[terms[k : k + 13]].add(str(item))
    sizes, out = {len(w) for w in windows}, []
    for i, text in rows:
        terms = tuple(TERMS.findall((text or "").translate(LOWER)))
        hit, names = [False] * len(terms), set()
        for size in sizes:
            for k in range(len(terms) - size + 1):
                if found := windows.get(terms[k : k + size]):
                    names |= found
                    hit[k : k + size] = [True] * size
        n = sum(hit)
        out.append((i, len(terms), n, len(names), sha(",".join(sorted(names))), n > 0 and 20 * n >= len(terms)))
    return Counter(out)


def counts_by_hand(text):
    text = text or ""
    words, seen, again = WORDS.findall(text), set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            again += line in seen
            seen.add(line)
    windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    marked = [False] * len(words)
    for k in range(len(words) - 2):
        if windows[tuple(words[k : k + 3])] > 1:
            marked[k : k + 3] = [True] * 3
    repeated = sum(marked)
    failed = len(words) < 50 or 100 * repeated > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, repeated, failed


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="module")
def benchmark_items(spark):
    return spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")


@pytest.mark.parametrize("table", ["documents", "odd_documents", "no_documents"])
@pytest.mark.parametrize("sizes", [(6 << 20, 2_000_000), (1 << 15, 500)])
def test_repeats(request, monkeypatch, table, sizes):
    df = request.getfixturevalue(table)
    monkeypatch.setattr(substring_dedup, "BLOCK_TEXT", sizes[0])
    monkeypatch.setattr(substring_dedup, "GROUP_SUFFIXES", sizes[1])
    got = Counter(map(tuple, substring_dedup.remove_repeats(df).collect()))
    assert got == removed_by_hand(rows_of(df))


def test_a_passage_that_half_of_the_documents_share(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, f"own{i} " * 5 + (passage if i % 2 else "") + f" tail{i}" * 20) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = Counter(map(tuple, substring_dedup.remove_repeats(df).collect()))
    assert got == removed_by_hand(rows)
    assert sum(n * (r[2] >= 60) for r, n in got.items()) == 199


def test_a_row_that_fills_half_of_the_table(spark):
    text = " ".join(f"p{i}" for i in range(40))
    rows = [(None, text, n) for n in range(300)] + [(7, text, n) for n in range(3)] + [(None, None, 0), (None, "", 1)]
    rows += [(i, f"own{i} " * 9 + text, 0) for i in range(5, 9)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n int")
    got = Counter(map(tuple, substring_dedup.remove_repeats(df).collect()))
    assert got == removed_by_hand(rows_of(df))
    dealt, _ = substring_dedup._dealt(df.select("doc_id", "text", F.col("n").alias("carried")), 4)
    assert dealt.count() == 7  # what all blocks together hold
    own = [(i, t + " " + "x y z " * 9, n) for i, t, n in rows if t]
    kept = substring_dedup.rewrite_documents(spark.createDataFrame(own[:303], df.schema))
    assert Counter((r["doc_id"], r["n"]) for r in kept.collect()) == Counter((7, n) for n in range(3))


def test_rewritten_documents_keep_their_columns(odd_documents):
    got = substring_dedup.rewrite_documents(odd_documents)
    assert got.columns == odd_documents.columns
    texts = {r["doc_id"]: r["text"] for r in got.collect() if r["doc_id"] in (1, 2, 8, 9)}
    assert texts.keys() == {1, 8, 9}  # all of 2 repeats 1
    assert texts[9] != texts[8] and texts[9].endswith("end")


@pytest.mark.parametrize("table", ["documents", "odd_documents", "no_documents"])
@pytest.mark.parametrize("size", [8 << 20, 3000])
def test_contamination(request, monkeypatch, benchmark_items, table, size):
    df = request.getfixturevalue(table)
    monkeypatch.setattr(decontamination, "PASS_BYTES", size)
    got = decontamination.contamination(df, benchmark_items).drop("n_near_items", "row_key")
    items = [tuple(r) for r in benchmark_items.select("item_id", "text").collect()]
    assert Counter(map(tuple, got.collect())) == found_by_hand(rows_of(df), items)


def test_short_items_and_items_without_words(spark, odd_documents):
    items = [(1, "Quick  BROWN fox!"), (2, ""), (3, None), (None, "lazy dog"), (4, "the of word1"), (4, "seule ligne"), (5, "日本語")]
    df = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontamination.contamination(odd_documents, df).drop("n_near_items", "row_key")
    assert Counter(map(tuple, got.collect())) == found_by_hand(rows_of(odd_documents), items)


def test_near_passages_with_terms_that_no_document_has(spark):
    """An edited copy of an item whose rare name was replaced, and an item of two terms."""
    items = [("edited", "the quick Zorblax river crossed seven bridges"), ("short", "alpha omega"), ("one", "alpha unknown")]
    docs = [
        (1, "the quick Smith river crossed over seven old bridges"),
        (2, "alpha and then at last omega"),
        (3, "alpha " + "x " * 30 + "omega"),
        (4, "river bridges"),
    ]
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    got = decontamination.find_test_items(spark.createDataFrame(docs, "doc_id bigint, text string"), benchmark)
    assert {r["doc_id"]: sorted(set(r["near"])) for r in got.collect()} == {1: ["edited"], 2: ["short"], 3: [], 4: []}


def test_near_passages(spark):
    words = list("abcdefghijklm")
    texts = [(1, " ".join(words)), (2, " ".join(reversed(words))), (3, " filler ".join(words) + " x" * 30), (4, "b c")]
    items = spark.createDataFrame([(7, " ".join(words))], "item_id bigint, text string")
    got = decontamination.contamination(spark.createDataFrame(texts, "doc_id bigint, text string"), items)
    assert {r["doc_id"]: (r["n_items"], r["n_near_items"]) for r in got.collect()} == {1: (1, 1), 2: (0, 1), 3: (0, 1), 4: (0, 0)}


@pytest.mark.parametrize("table", ["documents", "odd_documents", "no_documents"])
def test_base_counts(request, table):
    df = request.getfixturevalue(table)
    got = quality_rules.apply_rules(df).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter(map(tuple, got.collect())) == Counter((i, *counts_by_hand(t)) for i, t in rows_of(df))


def test_verdicts_follow_the_labels(spark):
    root = "/root/testdata/sf0.01"
    judged = quality_rules.apply_rules(spark.read.parquet(f"{root}/documents.parquet"))
    rows = judged.join(spark.read.parquet(f"{root}/labels.parquet"), "doc_id").filter("NOT base_failed").collect()
    good, bad = [r["kept"] for r in rows if r["quality"]], [r["kept"] for r in rows if not r["quality"]]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.2


def test_distance_of_equal_and_of_disjoint_histograms():
    reference = np.array([0.5, 0.5, 0.0])
    got = quality_rules.jensen_shannon(np.array([[2, 2, 0], [0, 0, 5], [0, 0, 0]]), reference)
    assert got.tolist() == pytest.approx([0, 1, 0])


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.read_vocabulary(public_tokenizers.path(VOCABULARY_FILE))


@pytest.fixture(scope="module")
def reference_encoding():
    lines = open(public_tokenizers.path(VOCABULARY_FILE), "rb").read().splitlines()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_of_odd_texts(vocabulary, reference_encoding):
    alphabet, draw = " \n\t'strevmlld aAéÜß漢字९²½Ⅷ😀\x1c\x85　_#!|0123́İ", random.Random(3)
    texts = ["".join(draw.choice(alphabet) for _ in range(draw.randint(0, 50))) for _ in range(3000)]
    texts += ["a" * 4000, "ab" * 3000, " " * 3000, "\n" * 99 + "x", "'" * 10 + "s", "", "!" * 9999, "x'll've", "<|endoftext|>"]
    encoder = bpe.Encoder(vocabulary)
    for text, ids in zip(texts, encoder.encode(pa.array(texts)), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == reference_encoding.encode_ordinary(text), repr(text)
        assert encoder.decode(ids) == text.encode()


@pytest.mark.parametrize("table", ["documents", "odd_documents", "no_documents"])
def test_tokens(request, vocabulary, reference_encoding, table):
    df = request.getfixturevalue(table)
    got = Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.tokenize(df, vocabulary, ["doc_id"]).collect())
    expected = []
    for i, text in rows_of(df):
        ids = reference_encoding.encode_ordinary(text or "")
        expected.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), sha(text or "")))
    assert got == Counter(expected)


def test_encode_and_decode_columns(documents, vocabulary):
    ids = documents.select("text", bpe.encode(documents, vocabulary).alias("ids"))
    back = ids.select("text", bpe.decode(ids, vocabulary).cast("string").alias("back"))
    assert back.filter("text <> back").isEmpty()


def test_bitmap_keeps_the_minimum():
    bitmap, held, draw = bpe.RankBitmap(50_000), set(), random.Random(5)
    for _ in range(5000):
        value = draw.randrange(50_000)
        if draw.random() < 0.6:
            bitmap.add(value)
            held.add(value)
        else:
            bitmap.remove(value)
            held.discard(value)
        assert bitmap.first() == (min(held) if held else -1)


def _reference():
    path = public_tokenizers.path(VOCABULARY_FILE)
    ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in open(path, "rb") if line.strip())}
    return tiktoken.Encoding("reference", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_pre_tokens_of_ranks_that_come_late():
    """Tokens that are part of a pair of a lower rank merge together only as long as no such pair arises."""
    vocabulary = bpe.read_vocabulary(public_tokenizers.path(VOCABULARY_FILE))
    reference, draw = _reference(), random.Random(7)
    late = [vocabulary.tokens[rank] for rank in np.flatnonzero(vocabulary.late)]
    pieces = [b"".join(draw.choice(late) for _ in range(draw.randrange(1, 40))) for _ in range(1500)]
    pieces += ["".join(draw.choice(some) for _ in range(draw.randrange(1, 90))).encode() for some in ["st", "aab", "er", "tion"] * 300]
    got = [np.frombuffer(ids, "<u4").tolist() for ids in bpe.Encoder(vocabulary).merge(pieces)]
    assert got == [reference._encode_single_piece(piece) for piece in pieces]


@pytest.mark.parametrize("piece", [b"st" * 500_000, b"a" * 400_000, b"tion" * 100_000])
def test_a_very_long_pre_token(piece):
    encoder = bpe.Encoder(bpe.read_vocabulary(public_tokenizers.path(VOCABULARY_FILE)))
    start = time.monotonic()
    ids = encoder.merge([piece])[0]
    assert time.monotonic() - start < 60
    assert np.frombuffer(ids, "<u4").tolist() == _reference()._encode_single_piece(piece)
    assert encoder.decode(ids) == piece


def test_what_is_remembered_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED_BYTES", 50_000)
    monkeypatch.setattr(bpe, "QUEUE_BYTES", 10_000)
    encoder = bpe.Encoder(bpe.read_vocabulary(public_tokenizers.path(VOCABULARY_FILE)))
    texts = [f"{'x' * 2000}{n} {'y' * 1000}" for n in range(100)]
    ids = list(encoder.encode(pa.array(texts)))
    assert [encoder.decode(i).decode() for i in ids] == texts
    assert encoder.held < 150_000
