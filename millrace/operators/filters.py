"""Filters and projections that are more than one DataFrame call."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F


def time_range(
    df: DataFrame, ts: str | None, start: Column | datetime | str | None = None,
    end: Column | datetime | str | None = None,
) -> DataFrame:
    """Rows with ``start <= ts < end``; either bound may be left out.

    The bounds are cast to the column's own type, so that the comparison reaches the file scan.
    """
    if not ts:
        return df
    kind = df.schema[ts].dataType
    if start is not None:
        df = df.filter(F.col(ts) >= F.lit(start).cast(kind))
    if end is not None:
        df = df.filter(F.col(ts) < F.lit(end).cast(kind))
    return df


def complete_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null in any of the columns (all of them by default)."""
    return df.na.drop("any", subset=list(columns) if columns else None)


def score_if_any(rules: Sequence[Column], hit: int, miss: int, base: int = 0) -> Column:
    """``base + hit`` when at least one rule is true, else ``base + miss``. A null rule is not true."""
    any_true = F.lit(False)
    for rule in rules:
        any_true = any_true | F.coalesce(rule, F.lit(False))
    return F.lit(base) + F.when(any_true, hit).otherwise(miss)


def present(
    df: DataFrame, columns: Sequence[str], rename: Mapping[str, str] | None = None,
    round_to: Mapping[str, int] | None = None,
) -> DataFrame:
    """Reorder, round and rename columns for reading."""
    rename, round_to = rename or {}, round_to or {}
    return df.select(*[
        (F.round(c, round_to[c]) if c in round_to else F.col(c)).alias(rename.get(c, c)) for c in columns
    ])
