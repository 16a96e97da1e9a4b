"""Batch sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from millrace.session import cut_lineage


def save_table(
    df: DataFrame, name: str, fmt: str = "parquet", partition_by: list[str] | None = None, path: str | None = None
) -> DataFrame:
    """Replace a catalog table, schema included. With ``path`` the files are kept there."""
    writer = df.write.format(fmt).mode("overwrite").option("overwriteSchema", "true")
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def append_evolving(df: DataFrame, path: str) -> DataFrame:
    """Append files that may bring new columns; rows from before have null in those."""
    df.write.mode("append").parquet(path)
    return df.sparkSession.read.option("mergeSchema", "true").parquet(path)


def append_evolving_table(df: DataFrame, name: str) -> DataFrame:
    """Append to a catalog table, adding the columns that it lacks first.

    Columns missing from ``df`` are written as null. No existing row is rewritten.
    """
    spark = df.sparkSession
    known = spark.table(name).schema
    fresh = [f for f in df.schema if f.name not in known.names]
    if fresh:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fresh)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
        known = spark.table(name).schema
    df.select(*[
        (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in known
    ]).write.insertInto(name)
    return spark.table(name)


def save_json(df: DataFrame, path: str, files: int | None = None) -> None:
    (df.repartition(files) if files else df).write.mode("overwrite").json(path)


def save_csv(df: DataFrame, path: str, files: int | None = None) -> None:
    (df.repartition(files) if files else df).write.mode("overwrite").option("header", True).csv(path)


def create_empty_table(spark: SparkSession, name: str, schema: T.StructType | str) -> DataFrame:
    """An empty table with the given columns, unless it is there already."""
    if not spark.catalog.tableExists(name):
        spark.createDataFrame([], schema).write.format("parquet").saveAsTable(name)
    return spark.table(name)


def keep_unless(df: DataFrame, condition: Column) -> DataFrame:
    """The rows a DELETE with this condition would leave: those where it is false or null."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def delete_rows(spark: SparkSession, name: str, condition: Column) -> DataFrame:
    """Delete from a parquet table; its location, partitioning and definition stay.

    The rows that remain are written to the shared scratch folder first, because a table cannot be
    overwritten while it is read, and a lost task must not lose rows. Of a partitioned table only
    the partitions that lose rows are written again.
    """
    table = spark.table(name)
    parts = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    if not parts:
        kept = _stored(keep_unless(table, condition))
        kept.write.insertInto(name, overwrite=True)
        return spark.table(name)
    # One row for each partition that loses rows, and whether it keeps any.
    hit = F.coalesce(condition, F.lit(False))
    touched = _stored(table.groupBy(*parts).agg(F.bool_or(hit).alias("__hit"), F.bool_and(hit).alias("__gone")).filter("__hit"))
    same = lambda t: [table[p].eqNullSafe(t[p]) for p in parts]
    some = touched.filter("NOT __gone")
    kept = _stored(keep_unless(table.join(some, same(some), "left_semi"), condition))
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        kept.select(*table.columns).write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    nothing = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()})" for f in table.schema if f.name not in parts)
    for row in touched.filter("__gone").select(*parts).collect():  # partitions that are emptied
        where = ", ".join(
            f"`{p}` = " + ("NULL" if row[p] is None else "'" + str(row[p]).replace("'", "\\'") + "'") for p in parts)
        spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({where}) SELECT {nothing} WHERE false")
    return spark.table(name)


def _stored(df: DataFrame) -> DataFrame:
    return cut_lineage(df, "delete")
