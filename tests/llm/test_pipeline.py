"""The pipeline against what each stage should keep, found by hand on the documents that reach it."""

import hashlib
from collections import defaultdict

import numpy as np

import corpus_pipeline
from matflow.llm import language_id
from tests.llm.test_classifiers import classes_by_hand
from tests.llm.test_text_digests import WORDS, _reference, found_by_hand

ROOT = "/root/testdata/sf0.001"


def rows_of(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def without_repeats(rows):
    """Texts without the words of 13-word windows that start in a document of a smaller id, too."""
    least = {}
    words = {i: WORDS.findall(text or "") for i, text in rows.items()}
    for i, own in words.items():
        for k in range(len(own) - 12):
            window = tuple(own[k : k + 13])
            least[window] = min(least.get(window, i), i)
    out = {}
    for i, own in words.items():
        gone = np.zeros(len(own), bool)
        for k in range(len(own) - 12):
            if least[tuple(own[k : k + 13])] < i:
                gone[k : k + 13] = True
        if not gone.any():
            out[i] = rows[i]
        elif not gone.all():
            out[i] = " ".join(np.array(own, object)[~gone])
    return out


def test_every_stage_keeps_what_it_should(spark):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    benchmark = [tuple(r) for r in spark.read.parquet(f"{ROOT}/benchmark.parquet").select("item_id", "text").collect()]
    expected = rows_of(docs)
    counts = [len(expected)]

    found = docs.select("doc_id", language_id.predict(docs, language_id.fit(docs)).alias("p")).collect()
    known = {r["doc_id"] for r in found if r["p"]["lang_pred"] != "und" and r["p"]["score"] >= 0.5}
    lettered = {i for i, text in expected.items() if any(map(str.isalpha, text or ""))}
    assert known <= lettered
    expected = {i: text for i, text in expected.items() if i in known}
    stages = [expected]

    classes = defaultdict(set)
    for (i, name), _ in classes_by_hand(list(expected.items())).items():
        classes[name].add(i)
    expected = {i: text for i, text in expected.items() if i in classes}
    stages.append(expected)

    expected = without_repeats(expected)
    stages.append(expected)

    bad = {i for i, *_, contaminated in found_by_hand(list(expected.items()), benchmark) if contaminated}
    expected = {i: text for i, text in expected.items() if i not in bad}
    stages.append(expected)

    for (name, stage), want in zip(corpus_pipeline.STAGES, stages):
        docs = corpus_pipeline.stored(stage(spark, docs, ROOT), "by-hand")
        assert rows_of(docs) == want, name
        counts.append(len(want))
    assert counts[0] > counts[-1] and len(set(counts)) > 2

    reference = _reference()
    for row in corpus_pipeline.run(spark, ROOT).collect():
        text = expected.pop(row["doc_id"])
        ids = reference.encode(text, disallowed_special=())
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert not expected
