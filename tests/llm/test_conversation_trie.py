"""The conversation trie against a dictionary of all prefixes, also in many tiny trees."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from matflow.llm import conversation_trie as ct

SCHEMA = "conv_id bigint, turn bigint, role string, text string, n_convs string, depth int"


def by_hand(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = role or "", text or ""
        key = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, key, role, text))
    own = {c: [t[3:] for t in sorted(rows)] for c, rows in turns.items()}
    members, ends = defaultdict(set), defaultdict(list)
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        whole = tuple(own.get(base, [])[:h] + mine[h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].add(c)
        ends[whole].append(c)
    children = Counter(node[:-1] for node in members if node)
    leaves, saved = Counter(), Counter()
    for node, own_members in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(own_members) - 1) * words
    out = []
    for node, own_members in members.items():
        parent = min(members[node[:-1]]) if node else None
        sha = hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()
        out.append((min(own_members), len(node), parent, len(own_members), children[node], leaves[node], saved[node], sha))
    return Counter(out)


def rows_of(df):
    return Counter(tuple(r) for r in df.select(*ct.RESULT).collect())


def pairs(df):
    return [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]


def family(seed, convs=300, texts=3):
    """Conversations that share much: few texts, so trees are deep and branch everywhere."""
    draw = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(draw.choice([1, 2, 3, 5, 8])):
            rows.append((c * 7, t, draw.choice(["user", "assistant"]), "word " * draw.randrange(texts), "clash", 1))
    return rows


@pytest.mark.parametrize("turns", [1, 2, 5, 40, 1 << 18])
def test_trees_of_any_size(spark, monkeypatch, turns):
    """Small trees make nearly every node a boundary node."""
    monkeypatch.setattr(ct, "TREE_TURNS", turns)
    monkeypatch.setattr(ct, "PIECE", 3 if turns < 40 else 1 << 15)
    df = spark.createDataFrame(family(turns), SCHEMA).repartition(4)
    assert rows_of(ct.conversation_trie(df)) == by_hand(pairs(df))


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    got = ct.conversation_trie(df)
    assert got.columns == ct.RESULT
    assert rows_of(got) == by_hand(pairs(df))


def test_odd_rows(spark, monkeypatch):
    long_text = "word of the day \t " * 200_000
    rows = [
        (0, 1, "user", "hello"),
        (0, None, None, "first of all"),
        (0, 2, "user", None),
        (0, 2, "user", "a tie"),
        (1, 0, "user", "x"),
        (1, 0, "user", "x"),
        (2, 0, "user", long_text),
        (3, 0, "user", long_text),
        (3, 1, "user", ""),
        (-1, 0, "user", "hello"),
        (-19, 5, "user", "hello"),
        (-25, 5, "user", "hello"),
        (45, 1, "no base", "x"),
        (None, 1, "user", "hello"),
        (2**62, 1, "user", "hello"),
    ]
    rows += [(c, t, "user", f"turn {t}") for c in (100, 101, 102, 107) for t in range(700)]
    df = spark.createDataFrame([(*row, "clash", 9) for row in rows], SCHEMA)
    for piece in (100, 1 << 15):
        monkeypatch.setattr(ct, "PIECE", piece)
        assert rows_of(ct.conversation_trie(df)) == by_hand(pairs(df))


def test_equal_conversations(spark):
    """Most conversations are one and the same."""
    n = F.col("id")
    same = F.when(n % 9 == 0, F.concat(F.lit("own "), n.cast("string"))).otherwise(F.lit("the same"))
    df = spark.range(2000).select(n.alias("conv_id"), F.explode(F.array(*map(F.lit, range(4)))).alias("turn"), same.alias("text"))
    df = df.withColumn("role", F.lit("user"))
    assert rows_of(ct.conversation_trie(df)) == by_hand(pairs(df))


def test_no_rows(spark):
    got = ct.conversation_trie(spark.createDataFrame([], SCHEMA))
    assert got.columns == ct.RESULT and not got.collect()


def test_median_insertion_keeps_siblings_balanced():
    tree = ct._Tree([[n] for n in range(1023)], [ct.np.ones(1, int)] * 1023)
    depth, level = 0, [tree.down[0]]
    while level:
        level = [x for node in level for x in (tree.less[node], tree.more[node]) if x >= 0]
        depth += 1
    assert depth == 10
