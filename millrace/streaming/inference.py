"""Column types of raw files, found once for each file and merged when a schema is needed.

A stream of its own takes the files it has not taken yet, however old they say they are, and appends one
row for each file and column to a table of summaries. A summary is a type; types of two files are merged
by ``widened``, in any order, so that a schema is a fold over the table: first inside tasks, then by
column. The driver sees one row for each column, and neither file names nor headers.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from millrace.session import cut_lineage
from millrace.sources import files

# Longer than any file's age: Spark would leave out files more than 7 days older than the newest one.
ANY_AGE = "36500d"
SUMMARY = "path string, modified timestamp, position int, name string, type string"
_BATCH = "types_batch"
# After a comma put before the line: a cell in quotes, with \ or "" before a quote inside, or a plain one.
_CELL = r',("[^"\\]*+(?:(?:\\.|"")[^"\\]*+)*+"|[^,]*)'


# -- merging of types ----------------------------------------------------------------------------

def widened(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type for the values of both; string where nothing narrower holds them.

    The order of merging does not matter, but for the order of the fields in a struct.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        other = {f.name: f.dataType for f in b}
        return T.StructType([
            *[T.StructField(f.name, widened(f.dataType, other.get(f.name, f.dataType))) for f in a],
            *[f for f in b if f.name not in a.names]])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widened(a.elementType, b.elementType))
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        digits = [_whole_digits(t) for t in (a, b)]
        if None in digits:
            return T.DoubleType()
        return T.LongType() if max(digits) < 20 and not isinstance(a, T.DecimalType) and not isinstance(b, T.DecimalType) \
            else T.DecimalType(max(digits), 0)
    if {type(a), type(b)} == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    return T.StringType()


def _whole_digits(t: T.DataType) -> int | None:
    """Digits that hold every value of a type of whole numbers; None for other numbers."""
    if isinstance(t, T.DecimalType):
        return t.precision if t.scale == 0 else None
    return {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}.get(type(t))


def settled(t: T.DataType) -> T.DataType | None:
    """The type as a table can hold it: string where only nulls were seen; None for an object without fields."""
    if isinstance(t, T.NullType):
        return T.StringType()
    if isinstance(t, T.ArrayType):
        element = settled(t.elementType)
        return element and T.ArrayType(element)
    if isinstance(t, T.StructType):
        fields = sorted(((f.name, settled(f.dataType)) for f in t), key=lambda f: f[0])
        fields = [T.StructField(n, k) for n, k in fields if k]
        return T.StructType(fields) if fields else None
    return t


def _to_text(t: T.DataType) -> str:
    return json.dumps(t.jsonValue())


def _from_text(text: str) -> T.DataType:
    field = {"name": "x", "type": json.loads(text), "nullable": True, "metadata": {}}
    return T.StructType.fromJson({"type": "struct", "fields": [field]})[0].dataType


def _fold(rows: pd.DataFrame) -> pd.DataFrame:
    """One row for each name, with its types merged and its first place."""
    held: dict[str, tuple[T.DataType, int]] = {}
    for name, text, position in zip(rows["name"], rows["type"], rows["position"], strict=True):
        kind, place = held.get(name, (T.NullType(), position))
        held[name] = widened(kind, _from_text(text)), min(place, position)
    return pd.DataFrame(
        [(n, _to_text(k), p) for n, (k, p) in held.items()], columns=["name", "type", "position"]).astype({"position": "int32"})


def merged_schema(summaries: DataFrame) -> T.StructType:
    """One schema for all summaries; columns by their first place in a file, then by name."""
    shape = "name string, type string, position int"
    kinds = summaries.groupBy("name", "type").agg(F.min("position").alias("position"))

    def in_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            held = _fold(batch if held is None else pd.concat([held, batch]))
        if held is not None:
            yield held

    rows = kinds.mapInPandas(in_task, shape).groupBy("name").applyInPandas(_fold, shape).collect()
    typed = [(r["name"], settled(_from_text(r["type"]))) for r in sorted(rows, key=lambda r: (r["position"], r["name"]))]
    return T.StructType([T.StructField(n, t, True) for n, t in typed if t])


# -- CSV -----------------------------------------------------------------------------------------

def csv_cells(line: Column) -> Column:
    """Cells of a CSV line as they stand, quotes included."""
    return F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_CELL), F.lit(1))


def _unquoted(cell: Column) -> Column:
    inside = F.regexp_replace(F.regexp_extract(cell, r'(?s)^"(.*)"$', 1), r'\\"|""', '"')
    return F.when(cell.startswith('"') & cell.endswith('"') & (F.length(cell) > 1), inside).otherwise(cell)


def numbered_names(names: Sequence[str]) -> list[str]:
    """Column names of a header; one that is empty or was there before gets the number of its place."""
    out: list[str] = []
    used: set[str] = set()
    for i, n in enumerate(names):
        n = f"{n}_c{i}" if not n or n.lower() in used else n
        out.append(n)
        used.add(n.lower())
    return out


@F.pandas_udf(T.ArrayType(T.StringType()))
def _numbered(headers: pd.Series) -> pd.Series:
    return headers.map(lambda names: numbered_names(list(names)))


def _numbered_lines(lines: DataFrame) -> DataFrame:
    """Lines that are not blank, with a number that rises inside a file's piece."""
    return lines.withColumn("line", F.monotonically_increasing_id()).filter(F.col("value").rlike(r"\S"))


def _first_lines(lines: DataFrame, *by: str) -> DataFrame:
    """``by``, ``line`` and ``value`` of the first of the numbered lines of each group.

    The lines are read twice. Only numbers are compared in the first pass, which a hash table can hold; with the text
    beside the number, Spark would sort all lines.
    """
    first = cut_lineage(lines.groupBy(*by).agg(F.min("line").alias("line")), "first-lines")
    return lines.join(first, [*by, "line"]).select(*by, "line", "value")


def _whole(cell: Column) -> Column:
    return cell.rlike(r"^[+-]?\d{1,38}$")


def _tests(cell: Column, whole: Column) -> dict[str, Column]:
    """What a cell that is not empty may be read as, the narrowest first. Casts come last in a test: a failed one is slow."""
    dated = ~whole & cell.rlike(r"^\d{4}-\d{2}-\d{2}$")
    return {
        "integer": whole & cell.try_cast("int").isNotNull(),
        "long": whole & cell.try_cast("bigint").isNotNull(),
        "decimal": whole,
        "double": whole | (~dated & ~cell.contains(":") & cell.try_cast("double").isNotNull()),
        "date": dated & cell.try_cast("date").isNotNull(),
        "timestamp": (cell.contains("-") | cell.contains(":")) & cell.try_cast("timestamp").isNotNull(),
        "boolean": ~whole & (F.length(cell) <= 5) & F.lower(cell).isin("true", "false"),
    }


def csv_summaries(lines: DataFrame) -> DataFrame:
    """Summaries of CSV files with a header, from lines with ``path``, ``start`` of the piece and ``modified``.

    The header's cells are counted with the others and taken off afterwards, since only the task that has
    the beginning of a file knows its header. Cells past the header have no column.
    """
    lines = _numbered_lines(lines)
    titles = _first_lines(lines.filter(F.col("start") == 0), "path").select(
        "path", F.posexplode(csv_cells(F.col("value"))).alias("position", "title"),
    ).withColumn("title", _unquoted(F.col("title")))
    each = lines.select(
        "path", "modified", F.posexplode(csv_cells(F.col("value"))).alias("position", "cell"),
    ).withColumn("cell", _unquoted(F.col("cell"))).withColumn("whole", _whole(F.col("cell")))

    def counted(test: Column, cell: Column) -> Column:
        return F.when((cell != "") & test, 1).otherwise(0)

    # Numbers only, for the rows of a hash table: texts would have all cells sorted.
    tests = _tests(F.col("cell"), F.col("whole"))
    found = each.groupBy("path", "position").agg(
        F.max("modified").alias("modified"),
        F.sum(counted(F.lit(True), F.col("cell"))).alias("n"),
        *[F.sum(counted(test, F.col("cell"))).alias(f"n_{k}") for k, test in tests.items()],
        F.max(F.when(tests["decimal"], F.length(F.regexp_replace("cell", "[+-]", "")))).alias("digits"),
    ).join(titles, ["path", "position"])
    n = F.col("n") - counted(F.lit(True), F.col("title"))
    kind = F.when(n == 0, "void")
    for k, test in _tests(F.col("title"), _whole(F.col("title"))).items():
        name = F.concat(F.lit("decimal("), F.col("digits"), F.lit(",0)")) if k == "decimal" else F.lit(k)
        kind = kind.when(F.col(f"n_{k}") - counted(test, F.col("title")) == n, name)
    column = F.struct("position", "title", F.concat(F.lit('"'), kind.otherwise("string"), F.lit('"')).alias("type"))
    by_file = found.groupBy("path").agg(F.max("modified").alias("modified"), F.sort_array(F.collect_list(column)).alias("c"))
    named = by_file.select("path", "modified", F.posexplode(F.arrays_zip(_numbered("c.title").alias("name"), F.col("c.type").alias("type"))))
    return named.select("path", "modified", F.col("pos").alias("position"), "col.name", "col.type")


def csv_heads(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """One row for each piece of a CSV file: path, start, ``head`` (number of the header's line), names, and
    ``places`` (for each column of ``schema`` its place among the names, from 1; 0 where it has none)."""
    pieces = _first_lines(_numbered_lines(lines), "path", "start").withColumnsRenamed({"line": "head", "value": "header"})
    ordered = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    titles = F.transform(csv_cells(F.first("header").over(ordered)), _unquoted)
    pieces = pieces.select("path", "start", F.first("head").over(ordered).alias("head"), titles.alias("titles"))
    pieces = pieces.select("path", "start", "head", _numbered("titles").alias("names"))
    places = F.array(*[F.array_position("names", n).cast("int") for n in schema.names]) if schema.names else F.array().cast("array<int>")
    return pieces.withColumn("places", places)


def csv_rows(lines: DataFrame, heads: DataFrame, width: int, schema: T.StructType, rescued: str) -> DataFrame:
    """Typed rows of CSV lines, each by the names in the header of its file, in one plan for all headers.

    ``heads`` is the stored result of ``csv_heads`` and ``width`` the size of its widest header. The join with it is by
    piece of a file, so one long file is not one group. Columns the schema lacks and values that do not
    fit go to ``rescued`` as an object, lines that do not have the header's number of cells go there whole.
    """
    rows = _numbered_lines(lines).join(heads, ["path", "start"]).filter(F.col("line") != F.col("head"))
    text = ", ".join(f"c{i} string" for i in range(width))
    rows = rows.withColumn("__row", F.from_csv("value", F.lit(text)))
    rows = rows.withColumn("__cells", F.slice(F.array(*[F.col(f"__row.c{i}") for i in range(width)]), 1, F.size("names")))
    raw = [F.get("__cells", F.get("places", F.lit(i)) - 1) for i in range(len(schema))]
    value = [r.try_cast(f.dataType) for r, f in zip(raw, schema, strict=True)]
    known = F.array(*[F.lit(n) for n in schema.names]).cast("array<string>")
    misfit = F.array_compact(F.array(*[
        F.when(r.isNotNull() & v.isNull(), F.lit(f.name)) for r, v, f in zip(raw, value, schema, strict=True)]).cast("array<string>"))
    rows = rows.withColumn("__misfit", misfit).withColumn("__other", F.array_except("names", known))
    left = F.map_filter(
        F.map_from_arrays("names", "__cells"),
        lambda k, v: v.isNotNull() & (F.array_contains("__misfit", k) | F.array_contains("__other", k)))
    rows = rows.withColumn("__left", F.when((F.size("__misfit") > 0) | (F.size("__other") > 0), left))
    commas = F.length("value") - F.length(F.replace("value", F.lit(",")))
    cells = F.when(F.col("value").contains('"'), F.size(csv_cells(F.col("value")))).otherwise(commas + 1)
    broken = (cells != F.size("names")) | (F.col("value").contains('"') & (F.regexp_count("value", F.lit(r'(?<!\\)"')) % 2 == 1))
    return rows.select(
        *[v.alias(f.name) for v, f in zip(value, schema, strict=True)],
        F.when(broken, F.col("value")).when(F.size("__left") > 0, F.to_json("__left")).alias(rescued),
    )


# -- JSON ----------------------------------------------------------------------------------------

_NAME = re.compile(r"`((?:[^`]|``)*)`: |([^:`]+): ")
_PLAIN = re.compile(r"([A-Z_]+)(?:\((\d+),\s?(\d+)\))?")
_PLAIN_TYPES = {"BIGINT": T.LongType(), "DOUBLE": T.DoubleType(), "FLOAT": T.DoubleType(), "BOOLEAN": T.BooleanType(), "VOID": T.NullType()}


def variant_type(text: str, large: bool) -> T.DataType:
    """The type that Spark's ``schema_of_variant`` writes as ``text``; values of several kinds are strings.

    Decimals are doubles, but whole ones beyond 64 bits where the file has such numbers (``large``).
    """
    def read(at: int) -> tuple[T.DataType, int]:
        if text.startswith("ARRAY<", at):
            element, at = read(at + 6)
            return T.ArrayType(element), at + 1
        if text.startswith("OBJECT<", at):
            at, fields = at + 7, []
            while text[at] != ">":
                name = _NAME.match(text, at)
                kind, at = read(name.end())
                fields.append(T.StructField(name[2] or name[1].replace("``", "`"), kind))
                at += 2 if text[at] == "," else 0
            return T.StructType(fields), at + 1
        plain = _PLAIN.match(text, at)
        if plain[2]:
            whole = large and int(plain[2]) > 18 and plain[3] == "0"
            return (T.DecimalType(int(plain[2]), 0) if whole else T.DoubleType()), plain.end()
        return _PLAIN_TYPES.get(plain[1], T.StringType()), plain.end()

    return read(0)[0]


def _json_fields(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [
            (path, modified, 0, f.name, _to_text(f.dataType))
            for path, modified, kind, large in zip(batch["path"], batch["modified"], batch["kind"], batch["large"], strict=True)
            for f in variant_type(kind, large)]
        out = pd.DataFrame(rows, columns=["path", "modified", "position", "name", "type"])
        yield out.astype({"position": "int32", "modified": batch["modified"].dtype})


def json_summaries(lines: DataFrame) -> DataFrame:
    """Summaries of files of JSON objects, one a line; lines that do not parse have no say.

    They are null values that the sums pass over: with a filter on the value, Spark would parse every line twice.
    """
    large = F.col("value").rlike(r"[:\[,]\s*-?\d{19,}\s*[,}\]]")
    objects = lines.filter(F.col("value").rlike(r"^\s*\{")).withColumn("v", F.try_parse_json("value"))
    parsed = F.col("v").isNotNull()
    found = objects.groupBy("path").agg(
        F.max("modified").alias("modified"), F.schema_of_variant_agg("v").alias("kind"), F.max(parsed & large).alias("large"),
        F.max(parsed).alias("parsed")).filter("parsed").drop("parsed")
    return found.mapInPandas(_json_fields, SUMMARY)


# -- the table of summaries ------------------------------------------------------------------------

def summarise_new(spark: SparkSession, folder: str, fmt: str, table: str, checkpoint: str, max_files: int | None = None) -> None:
    """Append the summaries of files that are new since the last call to the table in folder ``table``.

    Each batch of files has a folder of its own, which is left alone if the batch is run again.
    """
    summaries = {"csv": csv_summaries, "json": json_summaries}[fmt]

    def write(batch: DataFrame, number: int) -> None:
        place = f"{table}/{_BATCH}={number}"
        if not files.exists(spark, f"{place}/_SUCCESS"):
            summaries(batch).write.mode("overwrite").parquet(place)

    stream = located(spark.readStream.format("text").option("maxFileAge", ANY_AGE), folder, max_files)
    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def located(reader, folder: str, max_files: int | None = None) -> DataFrame:
    """Lines with the path of their file, the start of the piece they were read in, and the file's time."""
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    meta = {"path": "file_path", "start": "file_block_start", "modified": "file_modification_time"}
    return reader.load(folder).select("value", *[F.col(f"_metadata.{c}").alias(n) for n, c in meta.items()])


def last_batch(spark: SparkSession, table: str) -> int:
    """Number of the last finished batch of summaries; -1 where there is none."""
    numbers = [int(n.split("=")[1]) for n in files.list_names(spark, table) if n.startswith(f"{_BATCH}=")]
    return max(numbers, default=-1)


def read_summaries(spark: SparkSession, table: str, after: int = -1) -> DataFrame:
    """Summaries of the batches after a number, with the column ``types_batch``."""
    return spark.read.schema(f"{SUMMARY}, {_BATCH} long").parquet(table).filter(F.col(_BATCH) > after)
