"""Feature tables: keys, versions, upsert, replay; training sets and scoring from them."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F, types as T

from millrace.operators import store
from millrace.operators.learn import fare_regressor
from millrace.operators.store import FeatureTable, upserted
from millrace.operators.training import (
    FeatureLookup, TrainingSet, save_model, save_spec, score_batch, score_saved,
)
from millrace.sources import files

DAY = datetime(2024, 1, 1)
SCHEMA = "zip int, ts timestamp, n int"


def frame(spark, rows):
    return spark.createDataFrame([(z, DAY + timedelta(hours=h), n) for z, h, n in rows], SCHEMA)


def content(df):
    return sorted((r["zip"], int((r["ts"] - DAY).total_seconds() // 3600), r["n"]) for r in df.collect())


@pytest.fixture
def table(spark, tmp_path):
    return FeatureTable.create(
        spark, str(tmp_path / "t"), ["zip"], df=frame(spark, [(1, 0, 1), (1, 30, 2), (2, 50, 3)]),
        timestamp_key="ts", description="trips",
    )


def test_create_and_open(spark, table):
    again = FeatureTable.open(spark, table.path)
    assert (again.keys, again.timestamp_key, again.description) == (["zip"], "ts", "trips")
    assert content(again.read()) == [(1, 0, 1), (1, 30, 2), (2, 50, 3)]
    with pytest.raises(FileExistsError):
        FeatureTable.create(spark, table.path, "zip", df=table.read())


def test_create_rules(spark, tmp_path):
    schema = T.StructType.fromDDL("k string, ts string, d date, v int")

    def make(name, *args, **kw):
        return FeatureTable.create(spark, str(tmp_path / name), *args, schema=schema, **kw)

    with pytest.raises(ValueError, match="missing"):
        make("a", "gone")
    with pytest.raises(TypeError):
        make("b", "k", timestamp_key="ts")
    with pytest.raises(ValueError, match="both"):
        make("c", ["k", "d"], timestamp_key="d")
    empty = make("d", "k", timestamp_key="d")
    assert empty.read().count() == 0 and empty.versions() == []
    with pytest.raises(ValueError):
        FeatureTable.create(spark, str(tmp_path / "e"), "k")


def test_upsert_disjoint_partial_and_full(spark, table):
    table.upsert(frame(spark, [(3, 1, 9)]))
    table.upsert(frame(spark, [(1, 30, 20), (1, 31, 21)]))
    assert content(table.read()) == [(1, 0, 1), (1, 30, 20), (1, 31, 21), (2, 50, 3), (3, 1, 9)]
    table.upsert(table.read().withColumn("n", F.lit(0)))
    assert {n for _, _, n in content(table.read())} == {0}
    assert content(table.read(version=1)) == [(1, 0, 1), (1, 30, 2), (2, 50, 3)]


def test_upsert_rewrites_only_days_with_replaced_rows(spark, table):
    table.upsert(frame(spark, [(1, 31, 5)]))
    snapshot = FeatureTable.open(spark, table.path)._snapshot()["parts"]
    made = {p: [int(f[:8]) for f in held] for p, held in snapshot.items()}
    assert made == {"2024-01-01": [1], "2024-01-02": [2, 1], "2024-01-03": [1]}  # no row replaced
    assert content(table.read()) == [(1, 0, 1), (1, 30, 2), (1, 31, 5), (2, 50, 3)]
    table.upsert(frame(spark, [(1, 30, 6), (1, 31, 6)]))
    assert len(table._snapshot()["parts"]["2024-01-02"]) == 1


def test_new_keys_in_an_old_day_leave_its_files_alone(spark, table):
    first = table._snapshot()["parts"]["2024-01-02"]
    for n in range(3):
        table.upsert(frame(spark, [(10 + n, 30, n)]))
    held = table._snapshot()["parts"]["2024-01-02"]
    assert len(held) == 4 and held[-1:] == first
    table.upsert(frame(spark, [(11, 30, 50)]))
    assert len(table._snapshot()["parts"]["2024-01-02"]) == 2
    assert content(table.read()) == [(1, 0, 1), (1, 30, 2), (2, 50, 3), (10, 30, 0), (11, 30, 50), (12, 30, 2)]


def test_many_small_batches_are_put_together(spark, table, monkeypatch):
    monkeypatch.setattr(store, "_MAX_FOLDERS", 3)
    for n in range(5):
        table.upsert(frame(spark, [(10 + n, 30, n)]))
        assert len(table._snapshot()["parts"]["2024-01-02"]) <= 3
    assert table.read().count() == 8


def test_replayed_batch_changes_nothing(spark, table):
    batch = frame(spark, [(1, 0, 100)])
    assert table.upsert(batch, batch_id="b1") == 2
    table.upsert(frame(spark, [(1, 0, 200)]), batch_id="b2")
    assert table.upsert(batch, batch_id="b1") == 3
    assert (1, 0, 200) in content(table.read())


def test_bad_batches_leave_the_table_as_it_was(spark, table):
    before = content(table.read())
    with pytest.raises(ValueError, match="duplicate"):
        table.upsert(frame(spark, [(1, 0, 1), (1, 0, 2)]))
    with pytest.raises(ValueError, match="null"):
        table.upsert(frame(spark, [(None, 0, 1)]))
    with pytest.raises(ValueError, match="unknown"):
        table.upsert(frame(spark, [(1, 0, 1)]).withColumn("x", F.lit(1)))
    assert content(table.read()) == before and table.versions() == [1]
    table.upsert(frame(spark, []))
    assert content(table.read()) == before


def test_overwrite_and_ranged_read(spark, table):
    table.write(frame(spark, [(5, h, h) for h in (0, 23, 24, 25, 49, 100, 125)]), mode="overwrite")
    ranged = table.read(start=DAY + timedelta(hours=23), end=DAY + timedelta(hours=25))
    assert content(ranged) == [(5, 23, 23), (5, 24, 24)]
    assert len(ranged.inputFiles()) == 3
    assert table.read(start="2024-01-03").count() == 3


def test_static_table(spark, tmp_path):
    people = spark.createDataFrame([(i, f"p{i}") for i in range(50)], "id long, name string")
    table = FeatureTable.create(spark, str(tmp_path / "p"), "id", df=people, buckets=4)
    table.upsert(spark.createDataFrame([(7, "new"), (99, "more")], "id long, name string"))
    got = {r["id"]: r["name"] for r in table.read().collect()}
    assert len(got) == 51 and got[7] == "new" and got[99] == "more" and got[8] == "p8"


def test_parts_do_not_depend_on_the_zone(spark, table):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        table.upsert(table.read().withColumn("n", F.lit(9)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [n for _, _, n in content(table.read())] == [9, 9, 9]


def test_forget_and_drop(spark, table, tmp_path):
    for n in range(4):
        table.upsert(frame(spark, [(1, 0, n)]), batch_id=f"b{n}")
    table.forget(keep=2)
    assert table.versions() == [4, 5] and content(table.read(version=4)) == [(1, 0, 2), (1, 30, 2), (2, 50, 3)]
    assert [n[:8] for n in files.list_names(spark, f"{table.path}/data")] == ["00000001", "00000004", "00000005"]
    assert table.upsert(frame(spark, [(1, 0, 7)]), batch_id="b1") == 5
    FeatureTable.drop(spark, table.path)
    assert not files.exists(spark, table.path)
    FeatureTable.drop(spark, table.path)
    files.write_text(spark, str(tmp_path / "other" / "x"), "keep")
    with pytest.raises(ValueError):
        FeatureTable.drop(spark, str(tmp_path / "other"))


def test_a_failed_create_leaves_the_name_free(spark, tmp_path):
    path = str(tmp_path / "again")
    with pytest.raises(ValueError, match="duplicate"):
        FeatureTable.create(spark, path, "zip", df=frame(spark, [(1, 0, 1), (1, 0, 2)]), timestamp_key="ts")
    made = FeatureTable.create(spark, path, "zip", df=frame(spark, [(1, 0, 1)]), timestamp_key="ts")
    assert content(made.read()) == [(1, 0, 1)] and made.versions() == [1]


def test_replay_of_a_slow_stream_beside_a_fast_one(spark, table):
    table.upsert(frame(spark, [(1, 0, 1)]), batch_id="slow#0")
    snapshot = table._snapshot()
    # As after very many versions of another stream.
    table._publish(table._next_version(), snapshot["parts"], "fast#5000")
    table.upsert(frame(spark, [(1, 0, 2)]), batch_id="fast#5001")
    version = table._snapshot()["version"]
    assert table.upsert(frame(spark, [(1, 0, 1)]), batch_id="slow#0") == version
    assert table.upsert(frame(spark, [(1, 0, 9)]), batch_id="fast#17") == version
    assert (1, 0, 2) in content(table.read())


def test_second_writer_of_a_version_fails(spark, table):
    other = FeatureTable.open(spark, table.path)
    assert other._next_version() == 2
    table.upsert(frame(spark, [(8, 0, 1)]))
    with pytest.raises(FileExistsError):
        other._publish(2, {}, None)


def test_upserted_is_idempotent(spark):
    old, new = frame(spark, [(1, 0, 1), (2, 0, 2)]), frame(spark, [(2, 0, 5), (3, 0, 6)])
    once = upserted(old, new, ["zip", "ts"])
    assert content(once) == content(upserted(once, new, ["zip", "ts"])) == [(1, 0, 1), (2, 0, 5), (3, 0, 6)]


def test_stream_into_table(spark, table, tmp_path):
    landing, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    frame(spark, [(1, 0, 50), (6, 3, 1)]).write.parquet(landing)
    stream = spark.readStream.schema(SCHEMA).parquet(landing)
    for _ in range(2):
        table.write(stream, checkpoint=checkpoint).awaitTermination()
    assert content(table.read()) == [(1, 0, 50), (1, 30, 2), (2, 50, 3), (6, 3, 1)]
    with pytest.raises(ValueError):
        table.write(stream, mode="overwrite", checkpoint=checkpoint)


# -- training sets -----------------------------------------------------------------------------

@pytest.fixture
def lookups(spark, table, tmp_path):
    drop = FeatureTable.create(
        spark, str(tmp_path / "drop"), "zip",
        df=frame(spark, [(4, 1, 40), (4, 2, 41)]).withColumnRenamed("n", "m"), timestamp_key="ts",
    )
    names = FeatureTable.create(
        spark, str(tmp_path / "names"), "z", df=spark.createDataFrame([(1, "one")], "z int, name string")
    )
    return [
        FeatureLookup(table.path, ["n"], ["pickup_zip"], "pickup_at"),
        FeatureLookup(names.path, ["name"], "pickup_zip"),
        FeatureLookup(drop.path, ["m"], ["dropoff_zip"], "dropoff_at"),
    ]


def rides(spark):
    rows = [(0, 1, 4, DAY + timedelta(hours=31), DAY + timedelta(hours=2), 7.0), (1, 9, None, DAY, DAY, 8.0)]
    return spark.createDataFrame(
        rows, "ride int, pickup_zip int, dropoff_zip int, pickup_at timestamp, dropoff_at timestamp, fare double"
    )


def test_training_set(spark, lookups):
    made = TrainingSet(rides(spark), lookups, label="fare", exclude=["pickup_at", "dropoff_at"]).to_df()
    assert made.columns == ["ride", "pickup_zip", "dropoff_zip", "fare", "n", "name", "m"]
    assert sorted(map(tuple, made.collect())) == [(0, 1, 4, 7.0, 2, "one", 40), (1, 9, None, 8.0, None, None, None)]
    same = TrainingSet(rides(spark), lookups, label="fare").to_df(max_group_rows=1, bin_seconds=3600)
    assert sorted((r["ride"], r["n"], r["name"], r["m"]) for r in same.collect()) == [(0, 2, "one", 40), (1, None, None, None)]
    with pytest.raises(ValueError, match="label"):
        TrainingSet(rides(spark), lookups, label="gone").to_df()
    with pytest.raises(ValueError, match="timestamp lookup key"):
        TrainingSet(rides(spark), [FeatureLookup(lookups[0].table, ["n"], ["pickup_zip"])]).to_df()


def test_scoring_repeats_the_lookups(spark, lookups, tmp_path):
    training = TrainingSet(rides(spark), lookups, label="fare", exclude=["pickup_at"])
    path = str(tmp_path / "model" / "features.json")
    save_spec(spark, training, path)
    spec = files.read_text(spark, path)
    assert json.loads(spec)["times"] == {"pickup_at": "timestamp", "dropoff_at": "timestamp"}
    new = rides(spark).drop("fare")
    scored = score_batch(new, spec, lambda df: df.withColumn("prediction", F.col("n") * 2), result_type="string")
    assert dict(scored.dtypes)["prediction"] == "string"
    assert {r["ride"]: (r["n"], r["prediction"]) for r in scored.collect()} == {0: (2, "4"), 1: (None, None)}
    with pytest.raises(TypeError, match="pickup_at"):
        score_batch(new.withColumn("pickup_at", F.col("pickup_at").cast("date")), spec, lambda df: df)
    with pytest.raises(TypeError, match="missing"):
        score_batch(new.drop("dropoff_at"), spec, lambda df: df)


def test_model_saved_with_its_lookups(spark, lookups, tmp_path):
    training = TrainingSet(rides(spark), lookups, label="fare", exclude=["pickup_at", "dropoff_at"])
    model = fare_regressor(training.to_df(), "fare", ["n", "m"], rounds=2, depth=2)
    path = str(tmp_path / "saved")
    save_model(model, training, path)
    save_model(model, training, path)
    scored = score_saved(rides(spark).drop("fare"), path)
    assert scored.columns == ["ride", "pickup_zip", "dropoff_zip", "pickup_at", "dropoff_at", "n", "name", "m", "prediction"]
    direct = model.transform(training.to_df())
    assert sorted(map(tuple, scored.select("ride", "prediction").collect())) == sorted(
        map(tuple, direct.select("ride", "prediction").collect())
    )
