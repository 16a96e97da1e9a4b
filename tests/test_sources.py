"""Readers, writers, catalog helpers, session."""

import gzip

import pytest
from pyspark.sql import functions as F

from millrace.session import cut_lineage, scratch_path, size_shuffles
from millrace.sources import catalog, files, readers, writers


def test_device_records(spark, tmp_path):
    path = tmp_path / "d.json"
    path.write_text('{"device_id": 1, "temp": 31, "humidity": 80, "cn": "Norway", "new": 1}\n{"device_id": 2, "latitude": 1.5}\n')
    df = readers.read_devices(spark, str(path))
    assert df.schema == readers.DEVICE_SCHEMA and len(df.columns) == 15
    assert sorted((r["device_id"], r["temp"], r["latitude"]) for r in df.collect()) == [(1, 31, None), (2, None, 1.5)]
    assert "new" in readers.read_json(spark, str(path)).columns


def test_gzip_csv_is_text_and_can_be_spread(spark, tmp_path):
    with gzip.open(tmp_path / "t.csv.gz", "wt") as f:
        f.write("a,b\n" + "".join(f"{i},x{i}\n" for i in range(100)))
    df = readers.read_csv(spark, str(tmp_path / "t.csv.gz"), spread=4)
    assert df.dtypes == [("a", "string"), ("b", "string")] and df.count() == 100


def test_paths_tables_views_and_sql(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(5).write.parquet(path)
    assert readers.read_path(spark, path).count() == 5
    writers.save_table(spark.range(3), "t_numbers")
    assert readers.read_table(spark, "t_numbers").count() == 3
    readers.as_view(spark.range(4), "v_numbers")
    assert readers.run_sql(spark, "SELECT * FROM v_numbers WHERE id >= :low", {"low": 2}).count() == 2
    made = readers.run_sql(
        spark, "SELECT * FROM RANGE(0, ${demo.nrows}, 1, ${demo.parts})", variables={"demo.nrows": 1000, "demo.parts": 16}
    )
    assert made.count() == 1000 and made.rdd.getNumPartitions() == 16
    assert readers.read_numbers(spark, 0, 10, 2, 3).count() == 5
    assert readers.read_rows(spark, [("a", "2024")], "name string, date string").count() == 1
    catalog.drop_table(spark, "t_numbers")


def test_required_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["a", "b", "c"])
    assert readers.require_columns(df, ["c", "a"]).columns == ["c", "a"]
    with pytest.raises(ValueError, match="missing"):
        readers.require_columns(df, ["a", "z"])


def test_overwrite_replaces_the_schema(spark):
    writers.save_table(spark.createDataFrame([(1,)], "a int"), "t_over")
    got = writers.save_table(spark.createDataFrame([("x", 2.0)], "b string, c double"), "t_over")
    assert got.columns == ["b", "c"] and got.count() == 1
    catalog.drop_table(spark, "t_over")


def test_append_with_new_columns(spark, tmp_path):
    path = str(tmp_path / "runs")
    spark.createDataFrame([("a", "d1")], "name string, date string").write.parquet(path)
    got = writers.append_evolving(spark.createDataFrame([("b", "d2", "e1")], "name string, date string, experiment string"), path)
    assert sorted(map(tuple, got.select("name", "date", "experiment").collect())) == [("a", "d1", None), ("b", "d2", "e1")]


def test_append_with_new_columns_to_a_table(spark):
    catalog.drop_table(spark, "t_runs")
    writers.create_empty_table(spark, "t_runs", "name string, date string")
    assert writers.create_empty_table(spark, "t_runs", "name string, date string").count() == 0
    writers.append_evolving_table(spark.createDataFrame([("a", "d1")], "name string, date string"), "t_runs")
    got = writers.append_evolving_table(spark.createDataFrame([("e1", "b")], "experiment_id string, name string"), "t_runs")
    assert got.columns == ["name", "date", "experiment_id"]
    assert sorted(map(tuple, got.collect()), key=str) == [("a", "d1", None), ("b", None, "e1")]
    left = writers.delete_rows(spark, "t_runs", F.col("date") == "d1")
    assert [tuple(r) for r in left.collect()] == [("b", None, "e1")]
    catalog.drop_table(spark, "t_runs")


def test_json_and_csv_sinks(spark, tmp_path):
    writers.save_json(spark.range(10), str(tmp_path / "j"), files=2)
    assert readers.read_json(spark, str(tmp_path / "j"), "id long").count() == 10
    assert len(list((tmp_path / "j").glob("*.json"))) == 2
    writers.save_csv(spark.range(10), str(tmp_path / "c"))
    assert readers.read_csv(spark, str(tmp_path / "c")).columns == ["id"]


def test_catalog_questions(spark, tmp_path):
    catalog.create_database(spark, "mill_db", location=str(tmp_path / "db"))
    assert "mill_db" in {r[0] for r in catalog.databases(spark).collect()}
    catalog.create_database(spark, "mill_db", use=True)
    writers.save_table(spark.range(1), "big_table")
    writers.save_table(spark.range(1), "small")
    assert [r["tableName"] for r in catalog.tables_like(spark, "%G%", limit=10).collect()] == ["big_table"]
    assert catalog.current_catalog(spark).first()["catalog"] == "spark_catalog"
    assert catalog.catalog_exists(spark, "spark_catalog") and not catalog.catalog_exists(spark, "nope")
    assert not catalog.needs_rebuild(spark, ["big_table"], [str(tmp_path)])
    assert catalog.needs_rebuild(spark, ["gone"]) and catalog.needs_rebuild(spark, [], [str(tmp_path / "gone")])
    spark.sql("USE default")
    catalog.drop_database(spark, "mill_db")


def test_files(spark, tmp_path):
    path = str(tmp_path / "x" / "a.json")
    files.write_text(spark, path, "é1")
    assert files.read_text(spark, path) == "é1" and files.exists(spark, path)
    with pytest.raises(FileExistsError):
        files.write_text(spark, path, "2")
    files.write_text(spark, path, "2", overwrite=True)
    assert files.read_text(spark, path) == "2" and files.list_names(spark, str(tmp_path / "x")) == ["a.json"]
    assert files.is_empty(spark, str(tmp_path / "none"))


def test_scratch_is_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(shared)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    df = cut_lineage(spark.range(5))
    assert df.count() == 5 and shared in df.inputFiles()[0]


def test_shuffles_follow_the_data(spark, tmp_path):
    spark.range(200_000).write.parquet(str(tmp_path / "p"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffles(spark, str(tmp_path / "p"), partition_bytes=10_000) > 50
        assert spark.conf.get("spark.sql.shuffle.partitions") != before
        assert size_shuffles(spark, str(tmp_path / "p")) == spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
