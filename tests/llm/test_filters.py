"""Licences, URLs, shards and the pipeline."""

import math
import zlib
from collections import Counter
from hashlib import md5

import pytest

import corpus_pipeline
from matflow.llm import license_scan, sharding, url_filter
from matflow.llm.license_texts import TEMPLATES
from matflow.llm.queries import QUERIES, RULES
from matflow.llm.url_filter import ALLOW, BLOCK, Rule

PAGES = "page_id bigint, url string, html string, host string, `__best` int"


def judged(spark, rows, rules=RULES, edges=None):
    pages = spark.createDataFrame([(n, url, html, "clash", 1) for n, (url, html) in enumerate(rows)], PAGES)
    links = spark.createDataFrame(edges, "a string, b string") if edges else None
    return {r["page_id"]: r for r in url_filter.judge_pages(pages, rules, links).collect()}


def test_hosts_paths_and_rules(spark):
    rows = [
        ("HTTP://A.Example.NET/en/x?y#z", None),
        ("http://a.net?q=/fr/", ""),
        ("https://b.org/fr/1", "<p>"),
        ("x://example.com/de/", None),
        ("notexample.com/de/", None),
        ("http://notexample.com/de/", None),
        (None, None),
        ("http://", None),
        ("http://c.net/", None),
        ("http://ÄB.Net/Ä", None),
    ]
    got = judged(spark, rows)
    assert [(got[n]["host"], got[n]["path"], got[n]["rule"], got[n]["verdict"]) for n in range(len(rows))] == [
        ("a.example.net", "/en/x", "example.net/en/", ALLOW),
        ("a.net", "", None, ALLOW),
        ("b.org", "/fr/1", "org/fr/", ALLOW),
        ("example.com", "/de/", "example.com/de/", BLOCK),
        ("", "", None, ALLOW),
        ("notexample.com", "/de/", None, ALLOW),
        ("", "", None, ALLOW),
        ("", "", None, ALLOW),
        ("c.net", "/", "net/", BLOCK),
        ("Äb.net", "/Ä", "net/", BLOCK),
    ]


def test_blocks_follow_redirects_and_canonical_links(spark):
    rows = [
        ("http://a.info/1", '<link rel="canonical" href="http://b.info/1">'),
        ("https://b.info/1#top", "<META http-equiv=refresh content='0; url=http://bad.net/x'>"),
        ("http://b.info/2", '<link href="//a.info/3" rel=canonical>'),
        ("http://c.info/3", '<link rel=canonical href="/4"><link rel=stylesheet href="http://bad.net/x">'),
        ("http://c.info/4", ""),
        ("http://d.info/", '<link rel=canonical href="http://e.net/x">'),
        ("http://f.org/fr/", '<link rel=canonical href="http://e.net/x">'),
        ("http://g.info/", ""),
    ]
    got = judged(spark, rows, edges=[("http://g.info/", "http://bad.net/x"), (None, "http://bad.net/x")])
    verdicts = {n: (r["verdict"], r["by_alias"]) for n, r in got.items()}
    assert verdicts == {
        0: (BLOCK, True),
        1: (BLOCK, True),
        2: (ALLOW, False),
        3: (ALLOW, False),
        4: (ALLOW, False),
        5: (ALLOW, True),  # an alias of it is explicitly allowed
        6: (ALLOW, False),
        7: (BLOCK, True),
    }


def test_rule_ties_and_no_pages(spark):
    tie = [Rule(BLOCK, "a.net", "/xy"), Rule(ALLOW, "a.net", "/xy"), Rule(BLOCK, "net", "/")]
    assert judged(spark, [("http://a.net/xyz", None)], tie)[0]["verdict"] == ALLOW
    assert judged(spark, [("http://a.net/xyz", None)], [])[0]["verdict"] == ALLOW
    assert url_filter.judge_pages(spark.createDataFrame([], PAGES), RULES).collect() == []


def descend_by_hand(key, shards):
    path, level = "", [("region", lambda s: str(s.region)), ("rack", lambda s: f"{s.region}.{s.rack}")]
    for step in range(3):
        weights = {}
        for s in shards:
            parents = ["", f"{s.region}", f"{s.region}.{s.rack}"]
            if parents[step] == path:
                child = (s.region, s.rack, s.number)[step]
                weights[child] = weights.get(child, 0) + s.weight
        draw = lambda c: (int(md5(f"{key}/{path}.{c}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        best = min((c for c in weights if weights[c] > 0), key=lambda c: -math.log(draw(c)) / weights[c])
        path = (f"{best}", f"{path}.{best}", best)[step]
    return path


def test_shards(odd_documents, no_documents):
    got = sharding.shard_documents(odd_documents, 40).collect()
    texts = Counter((r["doc_id"], r["text"]) for r in odd_documents.collect())
    expected = Counter()
    for (i, text), n in texts.items():
        data, key = (text or "").encode(), "null" if i is None else str(i)
        shards = [descend_by_hand(key, sharding.even_tree(count)) for count in (40, 41)]
        expected[(i, len(data) + 16, zlib.crc32(data), "key", *shards)] += n
    assert Counter((r["doc_id"], r["size"], r["text_crc32"], r["law"], r["shard"], r["grown_shard"]) for r in got) == expected
    for shard in {r["shard"] for r in got}:
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in got)))
    assert sharding.shard_documents(no_documents, 40).collect() == []


def test_shares_follow_weights_and_movement_stays_in_its_subtree(spark):
    def placed(shards):
        keys = spark.range(20_000).selectExpr("cast(id as string) as key")
        return {r["key"]: r["s"] for r in sharding.place(keys, shards, keys["key"], "s").collect()}

    tree = [sharding.Shard(i, i // 4, i % 4 // 2, 1.0 + (i == 5)) for i in range(8)]
    before = placed(tree)
    share = Counter(before.values())
    assert share[5] / 20_000 == pytest.approx(2 / 9, abs=0.02) and share[0] / 20_000 == pytest.approx(1 / 9, abs=0.02)
    swapped = [sharding.Shard(s.number, s.region, s.rack, {4: 2.0, 5: 1.0}.get(s.number, s.weight)) for s in tree]
    moved = [(before[k], v) for k, v in placed(swapped).items() if before[k] != v]
    assert moved and {x for pair in moved for x in pair} == {4, 5}  # their rack weighs what it did
    grown = placed(tree + [sharding.Shard(8, 2, 0)])
    assert {v for k, v in grown.items() if v != before[k]} == {8}
    with pytest.raises(ValueError):
        sharding.place(spark.range(1), [], spark.range(1)["id"], "s")


def passages_by_hand(text, templates, least):
    """Every run of bigrams against every template."""
    import re

    grams = lambda t: [tuple(w) for w in zip(*(lambda x: (x, x[1:]))(re.findall(r"[0-9a-z\x80-\U0010ffff]+", t.lower())))]
    own, best = grams(text), None
    for at, (name, template) in enumerate(templates):
        wanted = Counter(grams(template))
        for a in range(len(own)):
            for b in range(a + 1, len(own) + 1):
                dice = 2 * (Counter(own[a:b]) & wanted).total() / (b - a + wanted.total())
                if dice >= least and (best is None or (-dice, -(b - a), at, a) < best[0]):
                    best = ((-dice, -(b - a), at, a), name, dice)
    return best[1:] if best else (None, None)


def test_best_passage():
    templates = [TEMPLATES[1], TEMPLATES[10], ("Other", "released under the other license of the mit license")]
    texts = [
        "Code. Released under the MIT License! More.",
        "released under mit license",
        "it was Licensed under the Apache License, Version 2.0. and released under the the mit license",
        "released under the released under the mit license of the mit license",
        "nothing here",
        "",
    ]
    for least in (0.6, 0.85):
        _, found = license_scan.scan([t.encode() for t in texts], license_scan.prepare(templates), least)
        got = [(f[0]["license"], f[0]["dice"]) if f else (None, None) for f in found]
        assert got == [pytest.approx(passages_by_hand(t, templates, least)) if t and passages_by_hand(t, templates, least)[0] is None else passages_by_hand(t, templates, least) for t in texts]


def test_every_template_is_found_in_a_text(spark, odd_documents, no_documents):
    rows = [(n, f"Some words. {text.upper()} -- and others") for n, (_, text) in enumerate(TEMPLATES)]
    got = license_scan.license_report(spark.createDataFrame(rows, "doc_id bigint, text string"), TEMPLATES).collect()
    assert {r["doc_id"]: r["license"] for r in got} == {n: name for n, (name, _) in enumerate(TEMPLATES)}
    assert all(r["dice"] == 1 for r in got)
    odd = license_scan.license_report(odd_documents, TEMPLATES).collect()
    assert len(odd) == odd_documents.count() and {r["license"] for r in odd} == {None} and {r["n_matches"] for r in odd} == {0}
    assert license_scan.license_report(no_documents, TEMPLATES).collect() == []
    assert {r["license"] for r in license_scan.license_report(odd_documents, []).collect()} == {None}


def test_pipeline(spark):
    root = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{root}/documents.parquet")
    result = corpus_pipeline.run(spark, root).collect()
    ids = {r["doc_id"] for r in result}
    assert len(ids) == len(result) and ids < {r["doc_id"] for r in docs.select("doc_id").collect()}
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.stored(stage(spark, before, root), "test")
        assert after.columns == docs.columns, name
        assert after.count() <= before.count()
        before = after
    assert {r["doc_id"] for r in before.select("doc_id").collect()} == ids


def test_pipeline_of_odd_rows(spark, odd_documents, no_documents):
    root = "/root/testdata/sf0.001"
    for table in (odd_documents, no_documents):
        docs = table
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = corpus_pipeline.stored(stage(spark, docs, root), "odd")
            assert docs.columns == table.columns, name
        last = corpus_pipeline.STAGES[-1][1](spark, docs, root)
        assert last.count() == docs.count()


def test_queries_read_whole_tables(spark):
    """One row for each row of the table, or of 13 a root with every conversation."""
    root = "/root/testdata/sf0.001"
    tables = {"op2": "pages", "op11": "embeddings"}
    for name, query in QUERIES.items():
        found = query(spark, root)
        if name.startswith("op13_"):
            convs = spark.read.parquet(f"{root}/conversations.parquet").select("conv_id").distinct().count()
            assert [r["n_convs"] for r in found.filter("depth = 0").collect()] == [convs]
            continue
        table = tables.get(name.split("_")[0], "documents")
        assert found.count() == spark.read.parquet(f"{root}/{table}.parquet").count(), name
