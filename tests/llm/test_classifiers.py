"""Classifiers and near duplicates: held-out accuracy, brute force and odd rows."""

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from matflow.llm import language_id, near_duplicates, quality_classifier
from matflow.llm.components import connected_components

ROOT = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{ROOT}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{ROOT}/labels.parquet")


def test_languages_held_out(documents):
    got = language_id.identify_languages(documents).join(documents.select("doc_id", "lang"), "doc_id")
    rows = got.filter("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_languages_by_hand(spark):
    """The same n-grams counted with a dictionary give the same posterior."""
    taught = [(1, "aab", "x"), (2, "abb", "y"), (3, "ba", "y")]
    docs = spark.createDataFrame(taught, "doc_id bigint, text string, lang string")
    model = language_id.fit(docs)

    def grams(text):
        padded = f" {text} "
        return [g for i in range(1, len(text) + 1) for g in (padded[i], padded[i - 1 : i + 1], padded[i - 1 : i + 2])]

    counts, prior = {"x": Counter(), "y": Counter()}, Counter(lang for *_, lang in taught)
    for _, text, lang in taught:
        counts[lang].update(grams(text))
    total = {k: sum(c.values()) + language_id.SMOOTHING * language_id.BUCKETS for k, c in counts.items()}
    weight = {
        k: prior[k] * np.prod([(c[g] + language_id.SMOOTHING) / total[k] for g in grams("ab")]) for k, c in counts.items()
    }
    best = max(weight, key=weight.get)
    row = docs.limit(1).select(F.lit("ab").alias("text")).select(language_id.predict(docs, model).alias("p")).first()["p"]
    assert (row["lang_pred"], row["score"]) == (best, pytest.approx(weight[best] / sum(weight.values()), rel=1e-4))


def test_languages_of_odd_rows(odd_documents, no_documents):
    rows = language_id.identify_languages(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    unknown = Counter(r["doc_id"] for r in rows if r["lang_pred"] == "und")
    assert unknown == Counter([None, 3, 4, 5, 6])
    assert all(r["score"] == 0 for r in rows if r["lang_pred"] == "und")
    assert language_id.identify_languages(no_documents).collect() == []


def test_nothing_to_learn_from(odd_documents):
    untaught = odd_documents.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language_id.identify_languages(untaught).collect()} == {"und"}


def test_quality_held_out(documents, labels):
    rows = quality_classifier.classify(documents, labels).join(labels, "doc_id").filter("held_out").collect()
    good, bad = ([r["predicted"] for r in rows if r["quality"] == q] for q in (1, 0))
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.3
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)


def test_quality_votes_are_those_of_all_examples(documents, labels):
    """Blocked products pick the same neighbours as one plain product."""
    model = quality_classifier.fit(documents, labels)
    texts = [r["text"] for r in documents.orderBy("doc_id").limit(60).collect()]
    shapes = quality_classifier._shapes()
    got = model.score(pa.array(texts), shapes)
    for text, score in zip(texts, got):
        rows, terms, counts = quality_classifier.term_counts([text.encode()], shapes)
        weight = quality_classifier._weighted(rows, terms, counts, model.inverse)
        vector = (model.projection[terms].astype(float) * weight[:, None]).sum(axis=0)
        cosine = model.vectors @ vector / max(np.linalg.norm(vector), 1e-12)
        top = np.argsort(-cosine)[: quality_classifier.NEIGHBOURS]
        vote = np.maximum(cosine[top], 0) ** 4
        assert score == pytest.approx((vote * model.labels[top]).sum() / vote.sum(), abs=1e-3)


def test_quality_of_odd_rows(spark, odd_documents, no_documents, labels):
    taught = spark.createDataFrame(
        [(1, 1, 0), (2, 0, 0), (2, 1, 0), (None, 1, 1), (8, 1, 0), (99, 0, 0)], "doc_id bigint, quality int, toxic int"
    )
    rows = quality_classifier.classify(odd_documents, taught).collect()
    assert len(rows) == odd_documents.count()
    assert all(r["score"] is not None and 0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] is not None for r in rows)
    assert quality_classifier.classify(no_documents, labels).collect() == []
    untaught = quality_classifier.classify(odd_documents, taught.limit(0)).collect()
    assert {r["score"] for r in untaught} == {0.5}


def classes_by_hand(rows, least=0.8):
    cells = []
    for _, text in rows:
        words = (text or "").encode().split()
        shingles = Counter([tuple(words[k : k + 5]) for k in range(len(words) - 4)] or ([tuple(words)] if words else []))
        cells.append({(s, n) for s, count in shingles.items() for n in range(count)})
    parent, index, shared = list(range(len(rows))), defaultdict(list), Counter()

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for at, own in enumerate(cells):
        for cell in own:
            shared.update((other, at) for other in index[cell])
            index[cell].append(at)
    for (a, b), n in shared.items():
        if n / (len(cells[a]) + len(cells[b]) - n) >= least:
            parent[max(root(a), root(b))] = min(root(a), root(b))
    least_id = {}
    for at, (i, _) in enumerate(rows):
        if i is not None and cells[at]:
            least_id[root(at)] = min(least_id.get(root(at), i), i)
    return Counter((i, least_id.get(root(at)) if cells[at] else i) for at, (i, _) in enumerate(rows))


@pytest.mark.parametrize("table", ["documents", "odd_documents", "no_documents"])
def test_near_duplicates(request, table):
    df = request.getfixturevalue(table)
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    assert Counter(map(tuple, near_duplicates.near_duplicates(df).collect())) == classes_by_hand(rows)


def test_large_group_of_near_copies(spark):
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(500):
        words = list(base)
        words[rng.integers(200)] = f"x{i}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(f"u{i}_{k}" for k in range(50))) for i in range(100)]
    got = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert Counter(r["class_id"] for r in got if r["doc_id"] < 1000) == {0: 500}
    assert all(r["class_id"] == r["doc_id"] for r in got if r["doc_id"] >= 1000)


@pytest.mark.parametrize("sizes", [(16, 2048), (2, 40), (1000, 2048)])
def test_versions_that_only_resemble_their_original(spark, monkeypatch, sizes):
    monkeypatch.setattr(near_duplicates, "SMALL", sizes[0])
    monkeypatch.setattr(near_duplicates, "BLOCK_TEXTS", sizes[1])
    rng = np.random.default_rng(2)
    base = [f"w{i}" for i in range(200)]
    rows = [(0, " ".join(base))]
    for i in range(1, 301):
        words = list(base)
        for part in range(4):
            words[50 * part + 5 + rng.integers(40)] = f"x{i}_{part}"
        rows.append((i, " ".join(words)))
    texts = [text.encode() for _, text in rows]
    assert 0.8 <= near_duplicates.similarities(texts[:1] * 300, texts[1:]).min() <= 0.85
    assert np.median(near_duplicates.similarities(texts[1:-1], texts[2:])) < 0.7
    got = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert Counter(r["class_id"] for r in got) == {0: 301}


def test_one_of_each_stays(odd_documents):
    got = near_duplicates.keep_one_of_each(odd_documents)
    assert got.columns == odd_documents.columns
    assert Counter(r["doc_id"] for r in got.collect()) == Counter([1, None, 3, 4, 5, 6, 7, 8, 10, 11, 11, 12])


def test_signatures_estimate_weighted_similarity():
    left = " ".join(f"a{i}" for i in range(300)).encode()
    right = " ".join([f"a{i}" for i in range(240)] + [f"b{i}" for i in range(60)]).encode()
    exact = near_duplicates.similarities([left], [right])[0]
    weight, kept = near_duplicates.signatures([left, right, b""])
    assert weight.tolist() == [296, 296, 0]
    assert abs((kept[0] == kept[1]).mean() - exact) < 0.15
    assert not (kept[:2] == near_duplicates._EMPTY).any()


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(200, 260)]
    edges = spark.createDataFrame(chain + star + [(5, 5)], "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    assert {got[i] for i in range(100, 161)} == {100}
    assert {got[i] for i in range(200, 260)} | {got[7]} == {7}
