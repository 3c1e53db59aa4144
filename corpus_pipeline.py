"""The corpus pipeline: quality rules, line dedup, near-duplicates, mixing, packing, one stage after the other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepkit.llm import line_dedup, mixing, packing, quality, simhash
from prepkit.llm.queries import byte_bpe
from prepkit.llm.shared import table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and their language's perplexity bands accept."""
    return quality.kept_documents(docs)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that an earlier one holds; n_chars follows the text."""
    done = line_dedup.dedup_lines(docs)
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast(docs.schema["n_chars"].dataType)}
    return done.withColumns(new).select(*docs.columns)


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens, without the ids themselves."""
    cut = packing.pieces(docs, byte_bpe())
    return cut.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", drop_shared_lines),
    ("SimHash near-dedup", one_per_group),
    ("mixing", mix_sources),
    ("packing", pack),
]

ORACLE_SQL = None
"""Perplexity, SimHash, Newton steps and token ids are beyond SQL; the tests check each stage."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
