"""The registered queries of this subpackage, each beside its DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    bpe, licenses, mixing, negatives, ngrams, packing, phrases, pivots, quality, rules, simhash, sql, suffixes, toxicity,
)
from millrace.llm.labels import held_out

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(check: str | None = None):
    """Register ``f(spark, folder)`` under its name."""
    def add(f):
        QUERIES[f.__name__] = f
        if check is not None:
            CHECKS[f.__name__] = check
        return f

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@query()
def op1_length_buckets(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


@query()
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.fit_toxicity(docs, table(spark, folder, "labels"))
    return toxicity.score_toxicity(docs, model).select(
        "doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query(sql.TOP_K_SQL)
def op3_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return pivots.top_k(table(spark, folder, "embeddings"))


@query()
def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality.fit_quality(docs, table(spark, folder, "labels"))
    return quality.score_quality(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query()
def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query()
def op6_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, folder, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query()
def op7_backoff_scores(spark: SparkSession, folder: str) -> DataFrame:
    return ngrams.backoff_scores(table(spark, folder, "documents"))


@query(sql.LICENSE_SQL)
def op8_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.find_licenses(table(spark, folder, "documents"))


@query(sql.RULES_SQL)
def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules.judge(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
    )


@query(sql.MIX_SQL)
def op10_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


@query(sql.NEGATIVES_SQL)
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, folder, "embeddings"), label=moved)


@query(sql.PHRASES_SQL)
def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))


@query()
def op13_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers as tokenizers

    vocabulary = bpe.read_ranks(tokenizers.path("byte_bpe_50k.tiktoken"))
    encoded = bpe.encode(table(spark, folder, "documents"), vocabulary, tokenizers.PATTERN)
    return bpe.decode(encoded, vocabulary, keep_ids=True).select(
        "doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"))
