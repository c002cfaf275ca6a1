"""The driver's queries: each numbered operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from matflow.llm import bpe
from matflow.llm.conversation_trie import conversation_trie
from matflow.llm.decontamination import contamination
from matflow.llm.exact_dedup import exact_duplicates
from matflow.llm.language_id import identify_languages
from matflow.llm.license_scan import license_report
from matflow.llm.license_texts import TEMPLATES
from matflow.llm.near_duplicates import near_duplicates
from matflow.llm.quality_classifier import classify
from matflow.llm.quality_rules import apply_rules
from matflow.llm.sharding import shard_documents
from matflow.llm.substring_dedup import remove_repeats
from matflow.llm.url_filter import ALLOW, BLOCK, Rule, judge_pages
from matflow.llm.vector_codes import compress

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


RULES = (
    Rule(BLOCK, "net", "/"),
    Rule(ALLOW, "example.net", "/en/"),
    Rule(BLOCK, "example.com", "/de/"),
    Rule(ALLOW, "org", "/fr/"),
)
SHARDS = 40
VOCABULARY_FILE = "byte_bpe_multi_50k.tiktoken"


@query
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_report(_table(spark, sf_dir, "documents"), TEMPLATES)


@query
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_pages(_table(spark, sf_dir, "pages"), RULES)


@query
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(_table(spark, sf_dir, "documents"), SHARDS)


@query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(_table(spark, sf_dir, "documents"))


@query
def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("row_key")


@query
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_table(spark, sf_dir, "documents"))


@query
def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


@query
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(_table(spark, sf_dir, "documents"))


@query
def op10_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe.read_vocabulary(public_tokenizers.path(VOCABULARY_FILE))
    return bpe.tokenize(_table(spark, sf_dir, "documents"), vocabulary, ["doc_id"]).drop("ids")


@query
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(_table(spark, sf_dir, "embeddings"))


@query
def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(_table(spark, sf_dir, "documents"))


@query
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(_table(spark, sf_dir, "conversations"))
