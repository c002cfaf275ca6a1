"""Very long texts and many languages under a memory limit, each in a process of its own."""

import os
import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest

from matflow.llm import language_id

SCORE = """
import resource
import numpy as np, pyarrow as pa
from matflow.llm import language_id as li
letters = li._letter_table()
model = li.LanguageModel(("a", "b", "c", "d"), np.log(np.full(4, 0.25)), np.full((li.BUCKETS, 4), -5, np.float32))
column = pa.array(["some words of a long text " * 2_000_000])
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
langs, scores = model.score(column, letters)
print(langs[0], resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before)
"""

COUNT = """
import resource
import pyarrow as pa
from matflow.llm import language_id as li
rows = pa.table({"text": [f"text number {n}" for n in range(20_000)], "lang": [f"junk {n % 5000}" for n in range(20_000)]})
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
total = documents = 0
for batch in li._count_batches(iter(rows.to_batches(max_chunksize=2000)), li.BUCKETS):
    for bucket, n in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
        total, documents = total + (n if bucket >= 0 else 0), documents + (n if bucket < 0 else 0)
print(total, documents, resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before)
"""


def run(script):
    env = os.environ | {"PYTHONPATH": os.pathsep.join(sys.path), "OMP_NUM_THREADS": "1"}
    return subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, check=True, env=env).stdout.split()


def test_a_text_of_50_megabytes_is_scored_in_slices():
    lang, more = run(SCORE)
    assert lang == "a" and int(more) < 600_000  # kilobytes, of which the text itself takes some copies


def test_counters_of_many_languages_stay_small():
    total, documents, more = map(int, run(COUNT))
    assert documents == 20_000 and total == 20_000 * 3 * len("textnumber")
    assert more < 300_000


@pytest.mark.parametrize("size", [1, 7, 100])
def test_slices_don_t_show(monkeypatch, size):
    draw, letters = np.random.default_rng(1), language_id._letter_table()
    logs = np.log(draw.random((language_id.BUCKETS, 3))).astype(np.float32)
    model = language_id.LanguageModel(("a", "b", "c"), np.log(np.full(3, 1 / 3)), logs)
    texts = pa.array(["", None, "été déjà vu", "12 !!", "x", "ΑΣ İ ß " * 30, "word " * 50, " a"])
    whole = model.score(texts, letters)
    monkeypatch.setattr(language_id, "SLICE", size)
    cut = model.score(texts, letters)
    assert cut[0] == whole[0] and np.allclose(cut[1], whole[1])
