"""Vector codes against plain arithmetic on whole numbers; the GNAT against all distances."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from matflow.llm import vector_codes as vc

SCHEMA = "vec_id bigint, embedding array<float>, label int, code string"


def by_hand(rows):
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    whole = [[int(np.floor(float(np.float32(x)) * 1024)) for x in v] for _, v, _ in kept]
    width = len(whole[0]) // 4
    cut = [[v[p * width : (p + 1) * width] for p in range(4)] for v in whole]
    order = sorted(range(len(kept)), key=lambda n: (kept[n][0] is None, kept[n][0] or 0, whole[n]))[:256]
    books = [[cut[n][p] for n in order] for p in range(4)]

    def nearest(part, piece):
        return min((sum((a - b) ** 2 for a, b in zip(piece, e)), k) for k, e in enumerate(books[part]))

    for _ in range(4):
        for p in range(4):
            groups = {}
            for pieces in cut:
                groups.setdefault(nearest(p, pieces[p])[1], []).append(pieces[p])
            for k, members in groups.items():
                books[p][k] = [sum(column) // len(members) for column in zip(*members)]
    found = [[nearest(p, pieces[p]) for p in range(4)] for pieces in cut]
    errors = [sum(d for d, _ in f) for f in found]
    labels = Counter()
    for (_, _, label), error in zip(kept, errors):
        labels[label] += error
    sha = hashlib.sha256(",".join(str(x) for part in books for e in part for x in e).encode()).hexdigest()
    return Counter(
        (i, "".join(f"{k:02x}" for _, k in f), error, labels[label], sha)
        for (i, _, label), f, error in zip(kept, found, errors)
    )


def rows_of(df):
    return Counter(tuple(r) for r in df.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect())


@pytest.mark.parametrize(("size", "width", "spread"), [(256, 16, 700), (256, 1, 5), (256, 16, 3), (90, 8, 2**27), (3, 4, 9), (256, 2, 40)])
def test_gnat_finds_what_all_distances_give(size, width, spread):
    """Also with many ties, equal entries and numbers that doubles don't hold."""
    draw = np.random.default_rng(size + width + spread)
    entries = draw.integers(-spread, spread, (size, width))
    entries[size // 2] = entries[0]
    points = np.concatenate([draw.integers(-spread, spread, (500, width)), entries])
    squares = np.array([[sum((int(a) - int(b)) ** 2 for a, b in zip(p, e)) for e in entries] for p in points[::7]])
    number, square = vc.Gnat(entries).nearest(points)
    assert number[::7].tolist() == squares.argmin(axis=1).tolist()
    assert square[::7].tolist() == squares.min(axis=1).tolist()


def test_gnat_drops_subtrees():
    draw = np.random.default_rng(3)
    centres = draw.integers(-100_000, 100_000, (8, 16))
    entries = (centres[:, None] + draw.integers(-50, 50, (8, 32, 16))).reshape(-1, 16)
    tree = vc.Gnat(entries)
    tree.nearest(entries)
    assert tree.looked < len(entries) ** 2 / 3


def test_small_vectors_by_hand(spark):
    draw = np.random.default_rng(5)
    rows = [(int(n), [float(np.float32(x)) for x in draw.integers(-9, 9, 8) / 300], int(n % 3)) for n in range(400)]
    df = spark.createDataFrame([(*row, "clash") for row in rows], SCHEMA).repartition(5)
    assert rows_of(vc.compress(df)) == by_hand(rows)


def test_odd_rows(spark):
    rows = [
        (1, [0.1, 0.2, -0.3, 4.0], 1),
        (1, [0.1, 0.2, -0.3, 4.0], 1),
        (1, [-0.1, 0.2, 0.3, 4.5], None),
        (None, [0.5, -0.5, 0.0, -0.0001], None),
        (3, None, 1),
        (4, [], 2),
        (5, [0.1, None, 0.2, 0.3], 2),
        (6, [0.1, float("nan"), 0.2, 0.3], 2),
        (7, [float("inf"), 1.0, 0.2, 0.3], 2),
        (8, [float("-inf"), 1.0, 0.2, 0.3], None),
    ]
    df = spark.createDataFrame([(*row, "clash") for row in rows if row[1] != []], SCHEMA)
    assert rows_of(vc.compress(df)) == by_hand([row for row in rows if row[1] != []])
    empty = vc.compress(df.limit(0))
    assert empty.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and not empty.collect()
    assert not vc.compress(df.filter("embedding IS NULL")).collect()
    with pytest.raises(ValueError, match="multiple of 4"):
        vc.compress(spark.createDataFrame([(*row, "x") for row in rows], SCHEMA))
    with pytest.raises(ValueError, match="too large"):
        vc.compress(spark.createDataFrame([(1, [1e30, 0.0, 0.0, 0.0], 1, "x")], SCHEMA))


def test_codes_name_entries(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    vectors = vc.whole_vectors(df)
    width = vc.width_of(vectors)
    books = vc.train(vectors, width, rounds=1)
    codes = vc.encode(vectors, books, width)
    both = vc.decode(codes, books).join(vectors.withColumnRenamed("vector", "own"), "vec_id")
    gap = F.zip_with("own", "vector", lambda a, b: (a - b * vc.SCALE) * (a - b * vc.SCALE))
    total = F.aggregate(gap, F.lit(0.0), lambda a, b: a + b)
    assert both.filter(total != F.col("error")).count() == 0 and both.count() == vectors.count() > 0
