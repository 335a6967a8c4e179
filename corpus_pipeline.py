"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakestrata.llm import decontam, language, mixing, rans, simhash
from lakestrata.llm.common import shared_path
from lakestrata.llm.queries import END_ID, learned_model, tokenizer_path
from lakestrata.session import table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; those that the calibrated model rejects go."""
    return language.identify(docs, learned_model(docs)).where("not rejected").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: words in shingles of five, a similarity of 0.8 or more.

    SimHash in Gray order makes units, MinHash bands join those further apart, and the shingles decide each pair.
    """
    return simhash.deduplicate(docs).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs).select(*COLUMNS)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All token ids in files, and per document what the files hold of it."""
    path = shared_path(spark, "token-files")
    rans.write_tokens(docs, path, tokenizer_path(), END_ID)
    return rans.read_tokens(spark, path)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixture", mixture),
    ("token_output", token_output),
]

#: Hashes, a fitted model and a tokenizer have no SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
