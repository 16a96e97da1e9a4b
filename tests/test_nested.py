"""Rescued data inside structs and lists, and its way into columns that come later."""

import json
import os
import time

import pytest
from pyspark.sql import types as T

from millrace.streaming import control, ingest, nested

KNOWN = "id bigint, buyer struct<name: string, age: int>, parts array<struct<n: bigint>>, tags map<string, double>"

LINES = [
    ('{"id":1,"buyer":{"name":"a","age":5},"parts":[{"n":1}],"tags":{"x":1.5}}', None),
    ('{"id":2,"buyer":{"name":"b","vip":{"since":2020}},"more":[1,2]}', {"buyer": {"vip": {"since": 2020}}, "more": [1, 2]}),
    ('{"id":3,"parts":[{"n":1},{"n":"x","m":2},{"n":3}]}', {"parts": {"1": {"n": "x", "m": 2}}}),
    ('{"id":1.5,"buyer":{"age":"old"},"tags":{"x":"y","z":2}}', {"id": 1.5, "buyer": {"age": "old"}, "tags": {"x": "y"}}),
    ('{"id":4,"buyer":"b","parts":{"n":1},"tags":[1]}', {"buyer": "b", "parts": {"n": 1}, "tags": [1]}),
    ('{"id":5,"buyer":null,"parts":[null,{"n":null}],"what":null}', None),
    ('{"id":9007199254740993,"buyer":{},"parts":[]}', None),
]
TEXTS = ["{broken", "[1,2]", "7", '{"id":1,"id":2}', ""]


def test_rescue_by_path(spark):
    rows = spark.createDataFrame([(line,) for line, _ in LINES] + [(t,) for t in TEXTS] + [(None,)], "value string").coalesce(1)
    found = nested.rescue_nested(rows, T.StructType.fromDDL(KNOWN)).collect()
    for got, (_, wanted) in zip(found, LINES, strict=False):
        assert (json.loads(got["_rescued_data"]) if got["_rescued_data"] else None) == wanted
    assert [r["_rescued_data"] for r in found[len(LINES):]] == [*TEXTS, None]
    assert all(r["id"] is None for r in found[len(LINES):])
    assert found[0].asDict(True) == {
        "id": 1, "buyer": {"name": "a", "age": 5}, "parts": [{"n": 1}], "tags": {"x": 1.5}, "_rescued_data": None}
    assert [p and p["n"] for p in found[2]["parts"]] == [1, None, 3] and found[3]["id"] is None and found[3]["tags"] == {"x": None, "z": 2.0}
    assert found[4]["buyer"] is None and found[4]["parts"] is None and found[5]["parts"][0] is None
    assert found[6]["id"] == 9007199254740993 and found[6]["parts"] == []


def test_promoted_at_any_depth(spark):
    rows = spark.createDataFrame([(line,) for line, _ in LINES] + [(t,) for t in TEXTS], "value string").coalesce(1)
    later = T.StructType.fromDDL(
        "id bigint, buyer struct<name: string, age: int, vip: struct<since: int>>, parts array<struct<n: bigint, m: int>>,"
        " tags map<string, double>, more array<bigint>")
    table = nested.rescue_nested(rows, T.StructType.fromDDL(KNOWN))
    old = table.selectExpr(
        "id", "from_json(to_json(buyer), 'name string, age int, vip struct<since: int>') as buyer",
        "from_json(to_json(parts), 'array<struct<n: bigint, m: int>>') as parts", "tags", "cast(null as array<bigint>) as more", "_rescued_data")
    found = nested.promote_nested(old, later).collect()
    left = [json.loads(r["_rescued_data"]) if r["_rescued_data"] and i < len(LINES) else None for i, r in enumerate(found)]
    assert left[1] is None and found[1]["buyer"]["vip"]["since"] == 2020 and found[1]["more"] == [1, 2]
    assert left[2] == {"parts": {"1": {"n": "x"}}} and [p["m"] for p in found[2]["parts"]] == [None, 2, None]
    assert left[3] == LINES[3][1] and left[4] == LINES[4][1]
    assert [r["_rescued_data"] for r in found[len(LINES):]] == TEXTS


def test_extended_types(spark):
    kept, found = T.StructType.fromDDL("a int, s struct<x: int>, l array<struct<y: int>>"), T.StructType.fromDDL(
        "b string, s struct<x: string, z: struct<q: int>>, l array<struct<w: double>>, a string")
    assert nested.extended(kept, found) == T.StructType.fromDDL(
        "a int, s struct<x: int, z: struct<q: int>>, l array<struct<y: int, w: double>>, b string")


@pytest.mark.parametrize("runs", [1, 2])
def test_ingested_nested_lines(spark, tmp_path, runs):
    folder = tmp_path / "landing"
    folder.mkdir()

    def run():
        control.wait_all([ingest.ingest_folder(spark, f"file://{folder}", "json", "t", f"file://{tmp_path}/lake")])
        return ingest.read_bronze(spark, f"file://{tmp_path}/lake", "t")

    (folder / "1.json").write_text('{"id":1,"buyer":{"name":"a"}}\n')
    for _ in range(runs):
        first = run()
    assert first.collect()[0].asDict(True) == {"buyer": {"name": "a"}, "id": 1, "_rescued_data": None}
    (folder / "2.json").write_text('{"id":2,"buyer":{"name":"b","vip":true}}\n{"id":"x","buyer":{"name":3}}\n')
    time.sleep(2.1)
    os.utime(folder / "2.json")
    found = {r["buyer"]["name"]: r.asDict(True) for r in run().collect()}
    assert found["a"]["buyer"] == {"name": "a", "vip": None} and found["b"]["buyer"] == {"name": "b", "vip": True}
    assert found["3"]["id"] is None and json.loads(found["3"]["_rescued_data"]) == {"id": "x"}
