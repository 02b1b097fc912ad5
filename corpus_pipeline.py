"""The corpus pipeline: from raw documents to token files.

Each stage takes what the stage before it kept, written as Parquet and read again, and returns the columns of
``documents``; the last one returns what the token files hold.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sensorloom.llm import mixing, orc_tokens, resampling, simhash, winnowing
from sensorloom.llm.queries import END_ID, tokenizer_file
from sensorloom.llm.tables import table
from sensorloom.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents that the draw by importance leaves out go."""
    return resampling.kept_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2 by similarity: of each group of texts with 5-word shingles 0.8 alike the document with the least id stays."""
    return simhash.one_of_each_similar_group(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents with a benchmark window go."""
    return winnowing.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: each document as often as the mix takes it, whole."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: token files, and per document in them where its ids start, how many there are, and their checksum."""
    path = scratch_path(spark, "pipeline-tokens")
    orc_tokens.write_tokens(docs, path, tokenizer_file(), END_ID)
    return orc_tokens.token_digests(spark, path)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing sources", mix),
    ("token output", tokens),
]

#: SimHash and the tokenizer are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = scratch_path(spark, f"pipeline-{k}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
