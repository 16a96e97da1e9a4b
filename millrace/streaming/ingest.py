"""Incremental ingestion of a folder of raw files into a bronze table.

Each file's column types are found once and kept in a table; the schema is merged from them, kept in a
file, and given to the stream, which therefore never infers. Later runs look at files they have not seen
and add what is new to the kept schema. What a run finds beyond its schema is rescued as text and read as a column later. The checkpoint remembers which files were taken, and the sink's commit log which
output files count, so a restarted run neither loses nor doubles rows.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.session import cut_lineage
from millrace.sources import files
from millrace.streaming import inference, nested

RESCUED = "_rescued_data"
_BATCH = "ingest_batch"


@dataclass(frozen=True)
class IngestState:
    """Where one table keeps its schema, checkpoint and data."""

    root: str
    table: str

    @property
    def schema_file(self) -> str:
        return f"{self.root}/schema/{self.table}.json"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/checkpoint/{self.table}"

    @property
    def data(self) -> str:
        return f"{self.root}/data/{self.table}"

    @property
    def types(self) -> str:
        """Folder of the types found in each file."""
        return f"{self.root}/types/{self.table}"


def merge_schemas(old: T.StructType, new: T.StructType) -> T.StructType:
    """All fields of both; where the types differ, the narrowest type for the values of both."""
    fields = {f.name: f.dataType for f in old}
    for f in new:
        fields[f.name] = inference.widened(fields.get(f.name, f.dataType), f.dataType)
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


def resolve_schema(
    spark: SparkSession, state: IngestState, folder: str, fmt: str,
    hints: Mapping[str, str] | None = None, max_files: int | None = None,
) -> T.StructType:
    """The kept schema, extended by what new files bring. Types in ``hints`` win over inference.

    Files must be JSON lines or CSV with a header. Each is summarised once, whenever it says it was
    written. A column keeps the type it first had: files already written hold that type. Structs may gain
    fields, at any depth. Values of new files that do not fit go to the rescued-data column.
    """
    kept, after, done = None, None, -1
    if files.exists(spark, state.schema_file):
        saved = json.loads(files.read_text(spark, state.schema_file))
        kept, done = T.StructType.fromJson(saved["schema"]), saved.get("batches", -1)
        # Tables from before files were summarised know only when they last looked.
        after = saved.get("inferred_at")
    inference.summarise_new(spark, folder, fmt, state.types, f"{state.checkpoint}_types", max_files)
    last = inference.last_batch(spark, state.types)
    found = T.StructType([])
    if last > done:
        summaries = inference.read_summaries(spark, state.types, done)
        if after:
            summaries = summaries.filter(F.col("modified") > F.lit(after).cast("timestamp"))
        found = inference.merged_schema(summaries)
    elif kept is None:
        raise ValueError(f"no files to infer a schema from in {folder}")
    kept_names = set(kept.names) if kept else set()
    schema = nested.extended(kept, found) if kept else found
    typed = {n: T._parse_datatype_string(t) for n, t in (hints or {}).items()}
    schema = T.StructType([
        T.StructField(f.name, typed.get(f.name, f.dataType) if f.name not in kept_names else f.dataType, True)
        for f in schema
    ])
    files.write_text(
        spark, state.schema_file, json.dumps({"schema": schema.jsonValue(), "batches": last}), overwrite=True)
    return schema


def open_lines(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Lines of new files as a stream (column ``value``), however old the files say they are."""
    reader = spark.readStream.format("text").option("maxFileAge", inference.ANY_AGE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)


def rescue_unknown(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """From a stream of JSON text lines (column ``value``): typed fields, and the rest as text.

    ``_rescued_data`` holds the line when it is malformed or a field does not fit its type, and
    otherwise an object of the fields that the schema does not have; null when nothing is left over.
    """
    with_corrupt = T.StructType([*schema.fields, T.StructField("__bad", T.StringType(), True)])
    known = F.array(*[F.lit(n) for n in schema.names]).cast("array<string>")
    # Only lines with other fields are read as a map as well.
    other = F.array_except(F.json_object_keys("value"), known)
    parsed = raw.select(
        F.from_json("value", with_corrupt, {"columnNameOfCorruptRecord": "__bad"}).alias("r"),
        F.from_json(F.when(F.size(other) > 0, F.col("value")), "map<string,string>").alias("all"),
    )
    extra = F.map_filter("all", lambda k, _: ~F.array_contains(known, k))
    return parsed.select(
        *[F.col(f"r.{n}").alias(n) for n in schema.names],
        F.when(F.col("r.__bad").isNotNull(), F.col("r.__bad"))
        .when(F.size(extra) > 0, F.to_json(extra))
        .alias(RESCUED),
    )


def promote_rescued(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Give rescued fields to columns that the schema has by now, where their values fit.

    What is given to a column leaves ``_rescued_data``; the rest of it stays.
    """
    rescued = F.from_json(F.when(F.json_object_keys(RESCUED).isNotNull(), F.col(RESCUED)), "map<string,string>")
    atomic = [f for f in schema if isinstance(f.dataType, T.AtomicType)]
    df = df.withColumn("__all", rescued)
    fits = {
        f.name: F.when(F.col(f"`{f.name}`").isNull(), F.col("__all")[f.name].try_cast(f.dataType)) for f in atomic
    }
    moved = F.array_compact(F.array(*[F.when(v.isNotNull(), F.lit(n)) for n, v in fits.items()])) if fits else F.array().cast("array<string>")
    left = F.map_filter("__all", lambda k, _: ~F.array_contains("__moved", k))
    return df.withColumn("__moved", moved).select(
        *[F.coalesce(F.col(f"`{f.name}`"), fits[f.name]).alias(f.name) if f.name in fits else F.col(f"`{f.name}`") for f in schema],
        F.when(F.coalesce(F.size("__moved"), F.lit(0)) == 0, F.col(RESCUED))
        .when(F.size(left) > 0, F.to_json(left)).alias(RESCUED),
    )


def _write_csv_batches(lines: DataFrame, state: IngestState, schema: T.StructType, once: bool) -> StreamingQuery:
    """Each batch goes to a folder of its own, which is left alone if the batch is run again."""
    spark = lines.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        folder = f"{state.data}/{_BATCH}={number}"
        if files.exists(spark, f"{folder}/_SUCCESS"):
            return
        heads = cut_lineage(inference.csv_heads(batch, schema), "csv-heads")
        width = heads.agg(F.max(F.size("names"))).first()[0]
        if width:
            inference.csv_rows(batch, heads, width, schema, RESCUED).write.mode("overwrite").parquet(folder)

    writer = lines.writeStream.foreachBatch(write).queryName(f"{state.table}_bronze_ingest").option(
        "checkpointLocation", state.checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def ingest_folder(
    spark: SparkSession, folder: str, fmt: str, table: str, root: str, *,
    hints: Mapping[str, str] | None = None, once: bool = True, max_files: int | None = 10_000,
) -> StreamingQuery:
    """Start taking new files of ``folder`` into the bronze table; returns the running query.

    No value is lost: what the kept schema does not have, and what does not fit it, is kept in
    ``_rescued_data``, and reading the table hands it to the column once the schema knows it. CSV
    columns are read by name, as the header of each file says. A large backlog is taken in batches
    of ``max_files``, each of which is done once and for all.
    """
    state = IngestState(root.rstrip("/"), table)
    schema = resolve_schema(spark, state, folder, fmt, hints, max_files)
    if fmt == "csv":
        lines = inference.located(spark.readStream.format("text").option("maxFileAge", inference.ANY_AGE), folder, max_files)
        return _write_csv_batches(lines, state, schema, once)
    lines = open_lines(spark, folder, max_files)
    rescue = nested.rescue_nested if nested.is_nested(schema) else rescue_unknown
    writer = (
        rescue(lines, schema).writeStream.format("parquet").outputMode("append")
        .queryName(f"{table}_bronze_ingest").option("checkpointLocation", state.checkpoint).option("path", state.data)
    )
    return (writer.trigger(availableNow=True) if once else writer).start()


def bronze_schema(spark: SparkSession, root: str, table: str) -> T.StructType:
    saved = json.loads(files.read_text(spark, IngestState(root.rstrip("/"), table).schema_file))
    fields = T.StructType.fromJson(saved["schema"]).fields
    return T.StructType([*fields, T.StructField(RESCUED, T.StringType(), True)])


def _promoted(raw: DataFrame, schema: T.StructType) -> DataFrame:
    known = T.StructType(schema.fields[:-1])
    return (nested.promote_nested if nested.is_nested(known) else promote_rescued)(raw, known)


def read_bronze(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The bronze table as a batch; columns that came later hold what was rescued from older rows."""
    schema = bronze_schema(spark, root, table)
    raw = spark.read.schema(schema).parquet(IngestState(root.rstrip("/"), table).data)
    return _promoted(raw, schema)


def stream_bronze(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The bronze table as a stream, otherwise as ``read_bronze``."""
    schema = bronze_schema(spark, root, table)
    raw = spark.readStream.schema(schema).option("maxFileAge", inference.ANY_AGE).parquet(IngestState(root.rstrip("/"), table).data)
    return _promoted(raw, schema)


def stream_to_table(
    df: DataFrame, name: str, checkpoint: str, once: bool = True, path: str | None = None
) -> StreamingQuery:
    """Append a stream to a catalog table, made on first use; ``path`` says where its files go."""
    writer = df.writeStream.outputMode("append").queryName(f"{name}_sink").option("checkpointLocation", checkpoint)
    if path:
        writer = writer.option("path", path)
    return (writer.trigger(availableNow=True) if once else writer).toTable(name)


def stream_to_path(df: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append a stream to a folder of parquet files."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.option("path", path)
    return (writer.trigger(availableNow=True) if once else writer).start()


def table_stream(spark: SparkSession, name: str) -> DataFrame:
    """Rows appended to a file-backed catalog table, as a stream."""
    return spark.readStream.table(name)
