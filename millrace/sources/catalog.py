"""Catalog questions and DDL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.texts import name_like
from millrace.sources.files import is_empty


def tables_like(spark: SparkSession, pattern: str, limit: int | None = None) -> DataFrame:
    """Tables of the current database whose upper-cased name is LIKE ``pattern``."""
    found = spark.sql("SHOW TABLES").filter(name_like("tableName", pattern))
    return found.limit(limit) if limit else found


def databases(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES")


def current_catalog(spark: SparkSession) -> DataFrame:
    return spark.sql("SELECT current_catalog() AS catalog")


def catalog_exists(spark: SparkSession, name: str) -> bool:
    return any(c.name == name for c in spark.catalog.listCatalogs())


def create_database(spark: SparkSession, name: str, location: str | None = None, use: bool = False) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")
    if use:
        spark.sql(f"USE {name}")


def drop_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def needs_rebuild(spark: SparkSession, tables: list[str] = (), folders: list[str] = ()) -> bool:
    """True when any of the tables is missing or any of the folders is missing or empty."""
    return any(not spark.catalog.tableExists(t) for t in tables) or any(
        is_empty(spark, f) for f in folders
    )


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """One row per named DataFrame with its row count."""
    result = None
    for name, df in frames.items():
        one = df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("name"), "row_count")
        result = one if result is None else result.unionByName(one)
    return result
