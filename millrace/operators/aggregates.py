"""Aggregations that the library names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T


def average_all(df: DataFrame, group: str, skip: Sequence[str] = ()) -> DataFrame:
    """The mean of every numeric column by group, as ``avg_<column>``."""
    numeric = [
        f.name for f in df.schema
        if isinstance(f.dataType, T.NumericType) and f.name not in (group, *skip)
    ]
    return df.groupBy(group).agg(*[F.avg(c).alias(f"avg_{c}") for c in numeric])


def value_counts_only(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """How often each value occurs, without the value; nulls count 0 in a row of their own."""
    return df.groupBy(column).agg(F.count(column).alias(name)).select(name)


def first_by(value: str, order: Column | str, *ties: Column | str) -> Column:
    """The value of the earliest row in the group. Unlike ``first``, the answer is always the same.

    Rows whose order is null, as a date that did not parse, come after all others.
    """
    order = F.col(order) if isinstance(order, str) else order
    return F.min_by(value, F.struct(order.isNull(), order, *ties))


def aggregate(df: DataFrame, keys: Sequence[str], spec: Mapping[str, tuple[str, str]]) -> DataFrame:
    """``{"name": ("function", "column")}`` aggregates with explicit output names; ``*`` counts rows."""
    calls = {"sum": F.sum, "count": F.count, "mean": F.avg, "min": F.min, "max": F.max, "first": F.first,
             "count_distinct": F.countDistinct}
    return df.groupBy(*keys).agg(*[
        calls[fn](F.lit(1) if column == "*" else F.col(column)).alias(name)
        for name, (fn, column) in spec.items()
    ])


def top_groups(
    df: DataFrame, group: str, aggs: Sequence[Column], by: str, k: int
) -> DataFrame:
    """The ``k`` groups with the largest aggregate ``by``; ties go by group. Each task keeps ``k``."""
    return df.groupBy(group).agg(*aggs).orderBy(F.desc(by), F.asc(group)).limit(k)


def sorted_rows(df: DataFrame, *order: Column | str) -> DataFrame:
    """A global sort that a frequent value cannot put into one task.

    Spark sorts by ranges of the sort key and cannot divide rows that are equal in it. A row
    number as the last sort column makes all rows differ.
    """
    numbered = df.withColumn("__row", F.monotonically_increasing_id())
    return numbered.sort(*order, "__row").drop("__row")


def latest_row(df: DataFrame, column: str, name: str, order: str, *ties: str) -> DataFrame:
    """The newest row for one name."""
    return df.filter(F.col(column) == name).orderBy(F.desc(order), *[F.desc(t) for t in ties]).limit(1)


def highest(df: DataFrame, column: str, name: str, value: str) -> DataFrame:
    """The largest ``value`` (a version, say) among rows of one name."""
    return df.filter(F.col(column) == name).agg(F.max(value).alias(value))


def best_run(
    runs: DataFrame, metric: str, status: str = "status", finished: str = "FINISHED", tie: str | None = None
) -> DataFrame:
    """The finished run with the highest metric; runs without the metric come last."""
    order = [F.desc_nulls_last(metric)] + ([F.asc(tie)] if tie else [])
    return runs.filter(F.col(status) == finished).orderBy(*order).limit(1)
