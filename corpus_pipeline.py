"""A corpus pipeline: filter, deduplicate, mix and tokenize documents, each stage written before the next reads it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from crawlweave.llm import bpe, jaccard_join, line_dedup, mixing, quality
from crawlweave.llm.queries import TOKENIZER
from crawlweave.llm.shared import unused_prefix, written
from crawlweave.session import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; trusted are those labelled good and not toxic."""
    judged = quality.with_quality(docs, quality.trusted_ids(table(spark, sf_dir, "labels")))
    return judged.where("kept").select(docs.columns)


def shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that at least three documents hold, but for the one with the largest id."""
    kept = line_dedup.drop_shared_lines(docs)
    changed = F.col("n_dropped") > 0
    return kept.withColumn("n_chars", F.when(changed, F.char_length("text")).otherwise(F.col("n_chars"))).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard_join.one_of_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mixed(docs)


def bpe_codec(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids, little-endian unsigned 32-bit integers, and whether these decode to the text."""
    decoded = unused_prefix(docs) + "decoded"
    coded = bpe.decode(bpe.encode(docs, TOKENIZER), TOKENIZER, text=decoded)
    return coded.withColumn("round_trip", F.col(decoded) == F.coalesce("text", F.lit(""))).drop(decoded)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", shared_lines),
    ("jaccard_join", near_duplicates),
    ("source_mix", source_mix),
    ("bpe_codec", bpe_codec),
]

#: hashed features, random rounding and a tokenizer are not expressed in SQL
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
