"""Cleaning of the documents: each stage works on what the one before it has kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from matflow.llm import bpe, language_id
from matflow.llm.decontamination import keep_uncontaminated
from matflow.llm.near_duplicates import keep_one_of_each
from matflow.llm.queries import VOCABULARY_FILE
from matflow.llm.storage import stored
from matflow.llm.substring_dedup import rewrite_documents

#: The posterior probability from which a document's language counts as known.
LEAST_LANGUAGE_SCORE = 0.5


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, without text or of no clear language go."""
    model = language_id.fit(docs)
    found = language_id.predict(docs, model)
    known = (found["lang_pred"] != language_id.UNKNOWN) & (found["score"] >= LEAST_LANGUAGE_SCORE)
    return docs.filter(known)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the least doc_id stays."""
    return keep_one_of_each(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 13 words or more stay in the document with the least doc_id only."""
    return rewrite_documents(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with passages of the benchmark go."""
    return keep_uncontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, ids_sha256, decoded_sha256, ids) of every document."""
    return bpe.tokenize(docs, bpe.read_vocabulary(public_tokenizers.path(VOCABULARY_FILE)), ["doc_id", "lang", "source"])


STAGES = [
    ("language_id", keep_known_language),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("decontamination", drop_contaminated),
    ("tokenize", tokenize),
]

#: SQL can express neither the classifier nor the signatures and merges of the other stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written before the next stage reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
