"""Registration of queries, each with the SQL that checks it where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


class Tables:
    """The test tables of one folder, opened by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        # Called for names not set yet; keeping the DataFrame reads each file footer once.
        df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, df)
        return df


def query(sql: str | None = None):
    """Register ``f(tables)`` under its name."""
    def add(f: Callable[[Tables], DataFrame]):
        QUERIES[f.__name__] = lambda spark, folder: f(Tables(spark, folder))
        if sql is not None:
            CHECKS[f.__name__] = sql
        return f

    return add
