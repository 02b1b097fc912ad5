"""One query per operator of this subpackage, with production parameters over its whole table, and the SQL beside it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.llm import cascade, extraction, lattice, licences, mixing, oracle, orc_tokens, phrases, resampling, simhash, suffixes, warc, whitening, winnowing
from sensorloom.llm.tables import table
from sensorloom.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
END_ID = 2


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("copies")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.without_repeats(table(spark, sf_dir, "documents"))


def op7_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("text_hash")


def op8_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op9_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    orc_tokens.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_file(), END_ID)
    return orc_tokens.token_digests(spark, path)


def op10_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cascade.screen(table(spark, sf_dir, "documents")).drop("rejected_by")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return rows.withColumn("deviation", F.col("deviation").try_cast("long"))


def op12_lattice_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = lattice.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    return lattice.score(table(spark, sf_dir, "documents"), pieces)


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


OPERATORS = [op1_mix_sources, op2_simhash, op3_warc, op4_html_text, op5_decontaminate, op6_suffix_dedup, op7_quality_resampling, op8_licence_scan, op9_orc_tokens, op10_quality_cascade, op11_whitening, op12_lattice_score, op13_phrases]
QUERIES: dict[str, Query] = {f.__name__: f for f in OPERATORS}
ORACLE: dict[str, str] = {"op1_mix_sources": oracle.MIX, "op5_decontaminate": oracle.DECONTAMINATE, "op8_licence_scan": licences.sql(), "op10_quality_cascade": oracle.QUALITY, "op13_phrases": oracle.PHRASES}
