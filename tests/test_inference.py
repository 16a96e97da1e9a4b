"""Types of raw files: kinds of cells, merging, many headers in one plan, old files, JSON against Spark's reader."""

import itertools
import json
import os

import pytest
from pyspark.sql import functions as F, types as T

from millrace.streaming import control, inference, ingest

CELLS = [
    "1", "-7", "1.0", "1e3", "NaN", "abc", "2024-01-02", "2024-01-02 03:04:05", "2024-01-02T03:04:05Z", "01-02-2024", "true", "FALSE",
    "99999999999", "99999999999999999999", '"q, ""x"', '"5"', "",
]


def located(spark, folder):
    return inference.located(spark.read.format("text"), str(folder))


def types_of(spark, folder, fmt="csv"):
    lines = located(spark, folder)
    return inference.merged_schema({"csv": inference.csv_summaries, "json": inference.json_summaries}[fmt](lines))


def test_cells_have_the_types_that_the_reader_finds(spark, tmp_path):
    pairs = list(itertools.combinations(CELLS, 2))[:60]
    columns = [[c] for c in CELLS] + [list(p) for p in pairs]
    height = 2
    rows = [[c[i] if i < len(c) else "" for c in columns] for i in range(height)]
    text = "\n".join(",".join(r) for r in [[f"c{i}" for i in range(len(columns))], *rows]) + "\n\n"
    (tmp_path / "a.csv").write_text(text)
    want = spark.read.option("header", True).option("inferSchema", True).csv(str(tmp_path)).schema
    got = types_of(spark, tmp_path)
    assert got.names == want.names
    different = {tuple(columns[i]): (g.dataType, w.dataType) for i, (g, w) in enumerate(zip(got, want)) if g.dataType != w.dataType}
    # Mixtures of large whole numbers with fractions, or of dates with words, may be read more narrowly.
    assert not different, different


def test_widened_in_any_order():
    kinds = [T.NullType(), T.IntegerType(), T.LongType(), T.DecimalType(20, 0), T.DoubleType(), T.DateType(), T.TimestampType(), T.BooleanType(),
             T.StringType(), T.ArrayType(T.LongType()), T.ArrayType(T.NullType())]
    for a, b in itertools.product(kinds, kinds):
        assert inference.widened(a, b) == inference.widened(b, a)
    for a, b, c in itertools.product(kinds[:5], repeat=3):
        assert inference.widened(inference.widened(a, b), c) == inference.widened(a, inference.widened(b, c))


JSON_FILES = [
    ['{"a":1}', '{"a":2.0}'], ['{"a":10.0}'], ['{"a":1}', '{"a":18446744073709551615}'], ['{"a":1e3}', '{"a":1}'], ['{"a":1}', '{"a":"x"}'],
    ['{"a":null,"b":[],"c":{}}'], ['{"a b":{"x-y":[1,2.5],"t`u":1},"z":true}', '{"z":{"q":1}}'], ['{"a":[{"b":1},{"c":null}]}'],
    ['{"o":{"p":{"q":[[1],[null]]},"e":{}}}', '{"o":{"p":{"r":"s"}}}'], ['{"BIGINT":{"OBJECT<":1},"VOID":"x"}'],
]


@pytest.mark.parametrize("lines", JSON_FILES)
@pytest.mark.parametrize("split", [False, True])
def test_json_types_are_those_of_the_reader(spark, tmp_path, lines, split):
    for i, part in enumerate([[x] for x in lines] if split else [lines]):
        (tmp_path / f"{i}.json").write_text("\n".join(part) + "\n")
    assert types_of(spark, tmp_path, "json") == spark.read.json(str(tmp_path)).schema


def test_json_lines_without_objects_have_no_say(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a":1}\n5\n[{"b":1}]\n{bad\n\n')
    assert types_of(spark, tmp_path, "json").simpleString() == "struct<a:bigint>"
    (tmp_path / "a.json").write_text("{bad\n")
    assert types_of(spark, tmp_path, "json").fields == []


def many_files(folder, headers, count):
    """``count`` files; the i-th has ``headers`` kinds of headers in turn, in two orders of columns."""
    folder.mkdir()
    for i in range(count):
        kind = i % headers
        names = ["id", f"x{kind}"] if i % 2 else [f"x{kind}", "id"]
        cells = [str(i), str(i / 2)] if i % 2 else [str(i / 2), str(i)]
        (folder / f"{i}.csv").write_text(f"{','.join(names)}\n{','.join(cells)}\n")


def test_many_headers_make_one_plan(spark, tmp_path):
    schema = T.StructType.fromDDL("id int, x0 double")
    sizes = {}
    for headers, count in ((1, 4), (60, 300)):
        folder = tmp_path / f"h{headers}"
        many_files(folder, headers, count)
        lines = located(spark, folder)
        heads = inference.csv_heads(lines, schema)
        heads.write.parquet(str(tmp_path / f"heads{headers}"))
        heads = spark.read.parquet(str(tmp_path / f"heads{headers}"))
        rows = inference.csv_rows(lines, heads, 2, schema, "rest")
        sizes[headers] = rows._jdf.queryExecution().optimizedPlan().toString().count("\n")
        got = {r.id: (r.x0, r.rest) for r in rows.collect()}
        assert len(got) == count
        want = {i: (i / 2, None) if i % headers == 0 else (None, json.dumps({f"x{i % headers}": str(i / 2)}, separators=(",", ":"))) for i in range(count)}
        assert got == want
    assert sizes[1] == sizes[60]


def ingested(spark, folder, root, fmt="csv", **options):
    control.wait_all([ingest.ingest_folder(spark, str(folder), fmt, "t", str(root), **options)], 120)
    return ingest.read_bronze(spark, str(root), "t")


def test_old_files_in_small_batches(spark, tmp_path):
    folder, root = tmp_path / "in", tmp_path / "lake"
    many_files(folder, 3, 12)
    first = ingested(spark, folder, root, max_files=5)
    assert sorted(first.columns) == ["_rescued_data", "id", "x0", "x1", "x2"] and first.count() == 12
    assert first.filter("_rescued_data IS NOT NULL OR id IS NULL").count() == 0
    (folder / "old.csv").write_text("id,late\n100,2024-01-02\n")
    os.utime(folder / "old.csv", (1_500_000_000, 1_500_000_000))
    again = ingested(spark, folder, root)
    assert dict(again.dtypes)["late"] == "date" and again.count() == 13
    seen = inference.read_summaries(spark, f"{root}/types/t")
    assert seen.count() == 2 * 13 and seen.select("path").distinct().count() == 13


def test_awkward_csv_lines(spark, tmp_path):
    folder, root = tmp_path / "in", tmp_path / "lake"
    folder.mkdir()
    (folder / "a.csv").write_text('\n"id",name,,name\n1,"a, ""b""",x,y\n\n2,only\n3,a,b,c,d\n4,"open,b,c\n5,"",,\n')
    (folder / "empty.csv").write_text("")
    (folder / "blank.csv").write_text("\n \n")
    (folder / "head.csv").write_text("id,more\n")
    rows = {r.id: r for r in ingested(spark, folder, root).collect()}
    assert sorted(rows) == [1, 2, 3, 4, 5]
    assert (rows[1]["_c2"], rows[1]["name_c3"], rows[1]["more"], rows[1]["_rescued_data"]) == ("x", "y", None, None)
    assert [rows[i]["_rescued_data"] for i in (2, 3, 4, 5)] == ["2,only", "3,a,b,c,d", '4,"open,b,c', None]


def test_a_folder_without_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    with pytest.raises(ValueError, match="no files"):
        ingest.ingest_folder(spark, str(tmp_path / "in"), "json", "t", str(tmp_path / "lake"))


def test_rescued_before_a_schema_knows_the_column(spark, tmp_path):
    """A file that arrives after the types were found: its new field is rescued, and a column later."""
    folder, root = tmp_path / "in", tmp_path / "lake"
    folder.mkdir()
    (folder / "a.csv").write_text("id\n1\n")
    ingested(spark, folder, root)
    (folder / "b.csv").write_text("id,extra\n2,7\n")
    state = ingest.IngestState(str(root), "t")
    schema = ingest.bronze_schema(spark, str(root), "t")
    lines = inference.located(spark.readStream.format("text"), str(folder))
    control.wait_all([ingest._write_csv_batches(lines, state, T.StructType(schema.fields[:-1]), True)], 120)
    assert {r.id: r["_rescued_data"] for r in ingest.read_bronze(spark, str(root), "t").collect()} == {1: None, 2: '{"extra":"7"}'}
    assert {r.id: (r.extra, r["_rescued_data"]) for r in ingested(spark, folder, root).collect()} == {1: (None, None), 2: (7, None)}


def test_lines_of_csv_files_are_not_sorted(spark, tmp_path):
    """Types and headers are found with hash tables of numbers; a sort of all cells grows with a file's piece."""
    (tmp_path / "a.csv").write_text('\n"id",when\n' + "".join(f"{i},2024-01-0{i % 9 + 1}\n" for i in range(50)))
    lines = inference.located(spark.read.format("text"), str(tmp_path))
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in (
        inference.csv_summaries(lines), inference.csv_heads(lines, T.StructType.fromDDL("id int")))]
    assert not any("SortAggregate" in p for p in plans)


def test_what_cells_may_be(spark):
    """Each test alone, without the short cuts."""
    cells = ["1", "-5", "+07", "-2024", "2147483648", "9" * 19, "9" * 38, "9" * 39, "1.5", "-1e-5", "1d", "0x1p3", "0x1p-3", " 7 ", "NaN", "-inf",
             "2024-01-02", "2024-13-02", "2024-1-2", "2024-01-02 10:20:30", "10:20", "01-02-2024 10:20:30", "TRUE", "false", "truely", "x", "-", ":", "é"]
    cell, whole = F.col("cell"), F.col("cell").rlike(r"^[+-]?\d{1,38}$")
    want = {
        "integer": whole & cell.try_cast("int").isNotNull(), "long": whole & cell.try_cast("bigint").isNotNull(), "decimal": whole,
        "double": cell.try_cast("double").isNotNull(), "date": cell.rlike(r"^\d{4}-\d{2}-\d{2}$") & cell.try_cast("date").isNotNull(),
        "timestamp": cell.rlike("[-:]") & cell.try_cast("timestamp").isNotNull(), "boolean": F.lower(cell).isin("true", "false")}
    got = inference._tests(cell, inference._whole(cell))
    rows = spark.createDataFrame([(c,) for c in cells], "cell string").select(
        "cell", F.struct(*[t.alias(k) for k, t in got.items()]).alias("got"), F.struct(*[t.alias(k) for k, t in want.items()]).alias("want"))
    assert [r.cell for r in rows.collect() if r.got != r.want] == []


def test_json_lines_are_parsed_once(spark, tmp_path):
    """Odd lines have no say, files of nothing else no row; no second parse stands in a filter before the sums."""
    for name, lines in {"a": ['{"x":1}', "bad", '{"x":12345678901234567890', "", "[1]", "null"], "b": ["{bad", "{"], "c": ["{}"]}.items():
        (tmp_path / f"{name}.json").write_text("\n".join(lines))
    found = inference.json_summaries(located(spark, tmp_path))
    assert [(r["path"][-6:], r["name"], r["type"]) for r in found.collect()] == [("a.json", "x", '"long"')]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("parseJson(") == 1


def test_only_lines_with_other_fields_are_read_as_maps(spark):
    lines = ['{"a":1,"b":"x"}', "bad", '{"a":2,"c":[1]}', '{"a":"x","c":null}', '{"a":1,"a":2,"c":3}', "[1]", "{}", '{"A":1}', '{"a":1,"c":']
    rows = ingest.rescue_unknown(
        spark.createDataFrame([(n,) for n in lines], "value string"), T.StructType.fromDDL("a long, b string"))
    assert [tuple(r) for r in rows.collect()] == [
        (1, "x", None), (None, None, "bad"), (2, None, '{"c":"[1]"}'), (None, None, '{"a":"x","c":null}'), (2, None, '{"c":"3"}'),
        (None, None, "[1]"), (None, None, None), (None, None, '{"A":"1"}'), (None, None, '{"a":1,"c":')]
    assert "array_except(static_invoke(JsonExpressionUtils.jsonObjectKeys" in rows._jdf.queryExecution().optimizedPlan().toString()
