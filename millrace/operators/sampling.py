"""Seeded samples and splits that depend on the row's key only.

A row falls on the same side after repartitioning, after more data is added, and when a lost task
runs again, which ``DataFrame.sample`` and ``randomSplit`` do not promise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.ranks import running_total


def row_hash(key: str | Sequence[str], seed: int) -> Column:
    """Hex digest of seed and key."""
    names = [key] if isinstance(key, str) else list(key)
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in names]))


def _limit(fraction: float) -> str:
    return format(min(int(fraction * 2**32), 2**32 - 1), "08x")


def hash_sample(df: DataFrame, key: str | Sequence[str], fraction: float, seed: int = 3) -> DataFrame:
    """About ``fraction`` of the rows, without replacement."""
    return df.filter(F.substring(row_hash(key, seed), 1, 8) < _limit(fraction))


def random_sample(df: DataFrame, fraction: float, seed: int = 3) -> DataFrame:
    """Spark's own sampling, for data without a key."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def fixed_sample(df: DataFrame, key: str | Sequence[str], n: int, seed: int = 3) -> DataFrame:
    """Exactly ``n`` rows (all, if there are fewer), chosen by hash. Each task keeps ``n`` at most."""
    return df.orderBy(row_hash(key, seed), *([key] if isinstance(key, str) else key)).limit(n)


def hash_split(
    df: DataFrame, key: str | Sequence[str], train_fraction: float = 0.75, seed: int = 123
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows, by hash of the key."""
    in_train = F.substring(row_hash(key, seed), 1, 8) < _limit(train_fraction)
    return df.filter(in_train), df.filter(~in_train)


def stratified_split(
    df: DataFrame, key: str, label: str, train_fraction: float = 0.75, seed: int = 123, name: str = "is_train",
) -> DataFrame:
    """Mark the first ceil(fraction * n) rows of each label, in hash order, as training rows.

    The share is exact per label. Rows are ranked in hash buckets of their label, and the bucket
    totals give each bucket its start, so neither a frequent label nor many labels meet in one task.
    """
    hashed = df.withColumn("__hash", row_hash(key, seed)).withColumn("__rank", F.lit(1).cast("long"))
    ranked = running_total(
        hashed.withColumn("__bucket", F.substring("__hash", 1, 4)), ["__rank"], bucket="__bucket",
        order=[F.col("__hash"), F.col(key)], within=[label], grand_total=True,
    )
    is_train = F.col("__rank") <= F.ceil(F.col("__rank_total") * train_fraction)
    return ranked.select(*df.columns, is_train.cast("int").alias(name))
