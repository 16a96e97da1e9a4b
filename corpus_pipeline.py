"""From raw documents to packed training sequences: five stages, each stored and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import mixing, packing, quality, simhash, suffixes
from millrace.llm.common import unlike
from millrace.llm.queries import table
from millrace.session import cut_lineage

QUALITY = 0.7


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores at 0.7 or more; it learns from ``labels``."""
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    score = unlike(docs, "_quality")
    scored = quality.score_quality(docs, model, out=score)
    return scored.filter(F.col(score) >= QUALITY).select(*docs.columns)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with linked fingerprints, the one with the smallest id."""
    return simhash.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 50 bytes that a document with a smaller id has."""
    return suffixes.without_repeats(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_rows(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences in padded batches: doc_id, part, length, padded, batch, place."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", keep_good),
    ("simhash_near_dedup", one_of_near_duplicates),
    ("suffix_array_dedup", cut_repeats),
    ("source_mix", mix_sources),
    ("length_buckets", pack_sequences),
]

# Trained models and XXH64 fingerprints are beyond DuckDB's SQL; the tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
