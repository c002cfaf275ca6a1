"""Exact duplicates against a dictionary of texts, with weak digests, odd rows and more rounds than are needed."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from matflow.llm import exact_dedup

SPACE = re.compile(r"[\x20\x09-\x0D]")


def by_hand(rows):
    groups = defaultdict(list)
    for at, (i, text) in enumerate(rows):
        groups[SPACE.sub("", text or "")].append((-len(text or ""), i is None, i or 0, at, i))
    out = []
    for bare, members in groups.items():
        best = min(members)
        sha = hashlib.sha256(bare.encode()).hexdigest()
        out += [(m[4], best[4], len(members), m == best, sha) for m in members]
    return Counter(out)


def rows_of(df):
    return Counter(tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect())


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = rows_of(exact_dedup.exact_duplicates(docs))
    assert got == by_hand(pairs(docs))
    assert any(not kept for *_, kept, _ in got)


@pytest.mark.parametrize("rounds", [1, 2, 3])
def test_odd_rows(odd_documents, rounds):
    assert rows_of(exact_dedup.exact_duplicates(odd_documents, rounds=rounds)) == by_hand(pairs(odd_documents))


def test_no_rows(no_documents):
    got = exact_dedup.exact_duplicates(no_documents)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"] and not got.collect()


def test_a_digest_that_collides_joins_no_different_texts(spark):
    docs = spark.createDataFrame([(n, f"text {n % 7}" + " " * (n % 3)) for n in range(300)], "doc_id bigint, text string")
    weak = exact_dedup.exact_duplicates(docs.repartition(6), digest=lambda text: bytes([len(text) % 2]) * 32)
    columns = ["doc_id", "keep_id", "group_size", "kept"]
    strong = exact_dedup.exact_duplicates(docs)
    assert Counter(map(tuple, weak.select(*columns).collect())) == Counter(map(tuple, strong.select(*columns).collect()))


def test_one_text_in_a_third_of_many_small_runs(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "RUN_ENTRIES", 16)
    n = F.col("id")
    text = F.when(n % 3 == 0, F.lit("the same\tline")).otherwise(F.concat(F.lit("a"), (n % 500).cast("string")))
    docs = spark.range(0, 6000, 1, 12).select(n.alias("doc_id"), text.alias("text"))
    assert rows_of(exact_dedup.exact_duplicates(docs)) == by_hand(pairs(docs))


def test_kept_rows_have_all_columns(odd_documents):
    kept = exact_dedup.drop_exact_duplicates(odd_documents)
    assert kept.columns == odd_documents.columns
    hand = Counter(i for (i, _, _, stays, _), n in by_hand(pairs(odd_documents)).items() for _ in range(n * stays))
    assert Counter(r["doc_id"] for r in kept.collect()) == hand
    with pytest.raises(ValueError, match="kept"):
        exact_dedup.exact_duplicates(odd_documents.withColumn("kept", F.lit(1)), ["kept"])


def test_rounds_grow_with_the_rows():
    assert exact_dedup.merge_rounds(0) == exact_dedup.merge_rounds(4_000_000) == 2
    assert exact_dedup.merge_rounds(50_000_000_000) == 7
