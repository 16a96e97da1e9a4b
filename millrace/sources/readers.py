"""Batch readers. Schemas are stated where the data has a fixed one, so no inference pass runs."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# The record layout of the device readings.
DEVICE_SCHEMA = T.StructType([
    T.StructField("battery_level", T.LongType()),
    T.StructField("c02_level", T.LongType()),
    T.StructField("cca2", T.StringType()),
    T.StructField("cca3", T.StringType()),
    T.StructField("cn", T.StringType()),
    T.StructField("device_id", T.LongType()),
    T.StructField("device_name", T.StringType()),
    T.StructField("humidity", T.LongType()),
    T.StructField("ip", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("lcd", T.StringType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("scale", T.StringType()),
    T.StructField("temp", T.LongType()),
    T.StructField("timestamp", T.LongType()),
])


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON lines, by a stated record schema or an inferred one."""
    reader = spark.read
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_devices(spark: SparkSession, path: str) -> DataFrame:
    return read_json(spark, path, DEVICE_SCHEMA)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, spread: int | None = None
) -> DataFrame:
    """CSV with a header row, plain or gzip; all text unless a schema is given.

    A gzip file cannot be split and is read by one task; ``spread`` deals its rows out again.
    """
    reader = spark.read.option("header", True)
    df = (reader.schema(schema) if schema is not None else reader).csv(path)
    return df.repartition(spread) if spread else df


def read_path(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """A table stored in a folder. ``fmt`` may name any table format on the class path."""
    return spark.read.format(fmt).options(**options).load(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_numbers(
    spark: SparkSession, start: int, end: int, step: int = 1, partitions: int | None = None
) -> DataFrame:
    """Generated ids, made on the executors."""
    return spark.range(start, end, step, partitions) if partitions else spark.range(start, end, step)


def read_rows(spark: SparkSession, rows: Iterable, schema: T.StructType | str) -> DataFrame:
    """A handful of local rows, such as run metadata. Data of any size belongs in a file."""
    return spark.createDataFrame(list(rows), schema)


def run_sql(spark: SparkSession, text: str, args: Mapping | None = None, variables: Mapping | None = None) -> DataFrame:
    """SQL with named parameters (``:name``); ``variables`` stand for ``${name}`` in this text only."""
    before = {key: spark.conf.get(key, None) for key in variables or {}}
    try:
        for key, value in (variables or {}).items():
            spark.conf.set(key, str(value))
        return spark.sql(text, args=dict(args)) if args else spark.sql(text)
    finally:
        # The text has been read by now; the session is left as it was.
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Name a DataFrame for SQL."""
    df.createOrReplaceTempView(name)
    return df


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Keep just the required columns, in that order; other input columns are ignored."""
    wanted = list(columns)
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing from input: {missing}")
    return df.select(*[F.col(f"`{c}`") for c in wanted])
