"""Ingestion runs, evolution, rescued data, silver tables and query control."""

import json

import pytest
from pyspark.sql import functions as F

from millrace.streaming import control, ingest, silver
from millrace.plans.customers import customer_360
from millrace.streaming.customers import CustomerStates
from millrace.streaming.features import WindowStates, watermarked


def put(folder, name, *records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in records))


def run(spark, tmp_path, **options):
    control.wait_all([ingest.ingest_folder(spark, str(tmp_path / "in"), "json", "orders", str(tmp_path / "lake"), **options)], 120)
    return ingest.read_bronze(spark, str(tmp_path / "lake"), "orders")


def test_second_run_adds_nothing_and_new_files_arrive_once(spark, tmp_path):
    put(tmp_path / "in", "a.json", {"id": "1", "amount": 1.5}, {"id": "2", "amount": 2})
    assert run(spark, tmp_path).count() == 2
    assert run(spark, tmp_path).count() == 2
    put(tmp_path / "in", "b.json", {"id": "3", "amount": 4.0, "canal": "WEBAPP"})
    df = run(spark, tmp_path)
    assert df.columns == ["amount", "id", "canal", "_rescued_data"]
    assert sorted((r["id"], r["amount"], r["canal"]) for r in df.collect()) == [
        ("1", 1.5, None), ("2", 2.0, None), ("3", 4.0, "WEBAPP"),
    ]


def test_malformed_lines_are_kept(spark, tmp_path):
    put(tmp_path / "in", "a.json", {"id": "1", "amount": 1.5}, "{broken")
    df = run(spark, tmp_path)
    assert sorted((r["id"], r["_rescued_data"]) for r in df.collect() if r["id"]) == [("1", None)]
    assert [r["_rescued_data"] for r in df.collect() if r["id"] is None] == ["{broken"]


def test_rescue_keeps_unknown_fields_and_misfits(spark, tmp_path):
    put(tmp_path / "in", "a.json", {"id": "1", "amount": 1.5})
    run(spark, tmp_path)
    saved = json.loads((tmp_path / "lake" / "schema" / "orders.json").read_text())
    fields = [f for f in saved["schema"]["fields"] if f["name"] in ("id", "amount")]
    schema_file = tmp_path / "lake" / "schema" / "orders.json"
    schema_file.write_text(json.dumps({"schema": {"type": "struct", "fields": fields}, "inferred_at": "2999-01-01T00:00:00"}))
    (tmp_path / "lake" / "schema" / ".orders.json.crc").unlink(missing_ok=True)
    put(tmp_path / "in", "b.json", {"id": "2", "amount": 3.0, "extra": "x"}, {"id": "3", "amount": "many"}, "{bad")
    df = run(spark, tmp_path)
    got = {r["id"]: (r["amount"], r["_rescued_data"]) for r in df.collect()}
    assert got["1"] == (1.5, None) and got["2"] == (3.0, '{"extra":"x"}')
    assert got["3"] == (None, '{"id": "3", "amount": "many"}') and got[None] == (None, "{bad")


def test_hints_and_csv(spark, tmp_path):
    put(tmp_path / "in", "a.csv", "user_id,amount,day", "007,1.5,2024-01-01", "8,,2024-01-02")
    query = ingest.ingest_folder(
        spark, str(tmp_path / "in"), "csv", "events", str(tmp_path / "lake"), hints={"user_id": "string"}
    )
    control.wait_all([query], 120)
    df = ingest.read_bronze(spark, str(tmp_path / "lake"), "events")
    assert dict(df.dtypes)["user_id"] == "string" and dict(df.dtypes)["amount"] == "double"
    assert sorted(r["user_id"] for r in df.collect()) == ["007", "8"]


def test_schema_merge():
    from pyspark.sql.types import StructType

    a, b = StructType.fromDDL("x int, y string"), StructType.fromDDL("x double, y date, z long")
    assert ingest.merge_schemas(a, b).simpleString() == "struct<x:double,y:string,z:bigint>"


def test_table_sink_and_table_stream(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS t_bronze")
    spark.sql("DROP TABLE IF EXISTS t_silver")
    put(tmp_path / "in", "a.json", {"user_id": "u", "id": "1", "amount": "9.9", "item_count": 2.0})
    schema = "user_id string, id string, amount string, item_count double"
    for _ in range(2):
        stream = spark.readStream.schema(schema).json(str(tmp_path / "in"))
        bronze = ingest.stream_to_table(stream, "t_bronze", str(tmp_path / "cp1"))
        control.wait_all([bronze], 120)
        clean = silver.silver_orders(ingest.table_stream(spark, "t_bronze"))
        control.wait_all([ingest.stream_to_table(clean, "t_silver", str(tmp_path / "cp2"))], 120)
    assert [r.asDict() for r in spark.table("t_silver").collect()] == [
        {"user_id": "u", "order_id": "1", "amount": 9, "item_count": 2}
    ]
    spark.sql("DROP TABLE t_bronze")
    spark.sql("DROP TABLE t_silver")


def test_silver_users(spark):
    raw = spark.createDataFrame(
        [("u1", "ANN", "lee", "a@b.example", "01-31-2024 5:06:07", "02-01-2024 00:00:00", 1.0, 7.0, True, None),
         (None, None, None, None, "bad", None, None, None, None, "x")],
        "id string, firstname string, lastname string, email string, creation_date string, last_activity_date string, "
        "gender double, age_group double, churn boolean, _rescued_data string",
    )
    got = silver.silver_users(raw)
    assert "_rescued_data" not in got.columns
    a, b = got.collect()
    assert (a["user_id"], a["firstname"], a["lastname"], a["gender"], a["age_group"], a["churn"]) == ("u1", "Ann", "Lee", 1, 7, 1)
    assert len(a["email"]) == 40 and a["last_activity_date"].day == 1 and a["creation_date"].hour == 5
    assert b["creation_date"] is None and b["churn"] is None


def test_control(spark, tmp_path):
    rate = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    names = ["mill_a", "mill_b", "other"]
    for n in names:
        rate.writeStream.format("noop").queryName(n).option("checkpointLocation", str(tmp_path / n)).start()
    assert sorted(q.name for q in control.active(spark, "mill_")) == ["mill_a", "mill_b"]
    with pytest.raises(TimeoutError):
        control.wait_for_prefix(spark, "other", timeout=1)
    assert control.stop_all(spark, "mill_") == 2
    assert [q.name for q in control.active(spark)] == ["other"]
    assert control.stop_all(spark) == 1
    control.wait_for_prefix(spark)


def test_watermark_needs_a_zone(spark, tmp_path):
    spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:00:00' AS ts").write.parquet(str(tmp_path / "p"))
    stream = spark.readStream.schema("ts timestamp_ntz").parquet(str(tmp_path / "p"))
    assert dict(watermarked(stream, "ts", "1 hour").dtypes)["ts"] == "timestamp"


def test_window_states(spark, tmp_path):
    def rows(*values):
        return spark.createDataFrame([(k, t and f"2024-01-01 {t}", v) for k, t, v in values], "k string, at string, v double").select(
            "k", F.to_timestamp("at").alias("at"), "v")

    states = WindowStates.create(
        spark, str(tmp_path / "s"), "k", "string", "at", "15 minutes", {"n": (F.count("*"), "long"), "total": (F.sum("v"), "double")},
        delay="30 minutes")
    assert states.windows(2).collect() == [] and states.late_rows().first().asDict() == {"n_rows": 0, "n_late": 0, "n_undated": 0}
    states.add(rows(("a", "10:00:00", 1.0), ("a", "10:14:59", 2.0), ("a", "10:15:00", 4.0), ("b", "12:00:00", 8.0)), "s#0")
    states.add(rows(("a", "10:01:00", 16.0), ("b", "11:45:00", None), ("c", None, 1.0), (None, "12:10:00", 1.0)), "s#1")
    states.add(rows(("a", "10:01:00", 16.0)), "s#1")  # a replay changes nothing
    states.add(rows(), "s#2")
    got = {(r["k"], r["window_end"].strftime("%H:%M")): (r["n"], r["total"]) for r in states.windows(2).collect()}
    assert got == {
        ("a", "10:15"): (3, 19.0), ("a", "10:30"): (4, 23.0), ("a", "10:45"): (1, 4.0),
        ("b", "12:00"): (1, None), ("b", "12:15"): (2, 8.0), ("b", "12:30"): (1, 8.0),
    }
    assert states.late_rows().first().asDict() == {"n_rows": 8, "n_late": 1, "n_undated": 1}


def test_customer_states(spark, tmp_path):
    users = spark.createDataFrame(
        [(u, "2024-01-01 00:00:00", "2024-01-02 00:00:00") for u in ("a", "b", "c", None)], "user_id string, c string, l string").select(
        "user_id", F.to_timestamp("c").alias("creation_date"), F.to_timestamp("l").alias("last_activity_date"))
    orders = [("a", 3, 1), ("a", 4, 2), ("b", 5, None), (None, 9, 9), ("a", 7, 1), ("c", 1, 1)]
    events = [
        ("a", "s1", 2, "ios", "01-05-2024 00:00:00"), ("a", "s2", 1, "web", "bad"), ("b", None, 3, "web", None),
        (None, "s1", 4, "ios", None), ("a", "s1", 5, "android", "01-04-2024 00:00:00"), ("a", "s1", 6, None, "01-06-2024 00:00:00"),
        ("c", "s9", 7, "ios", "01-04-2024 00:00:00"), ("a", "s2", 8, "web", "01-04-2024 00:00:00"),
    ]
    order_rows = lambda part: spark.createDataFrame(part, "user_id string, amount int, item_count int")
    event_rows = lambda part: spark.createDataFrame(part, "user_id string, session_id string, event_id long, platform string, date string")
    day = F.lit("2024-02-01").cast("date")
    whole = customer_360(users, order_rows(orders), event_rows(events), day)

    states = CustomerStates.create(spark, str(tmp_path / "s"), users.schema)
    assert states.read(day).collect() == []
    states.add_users(users, "u#0")
    states.add_orders(order_rows(orders[:5]), "o#0")
    states.add_events(event_rows(events[:4]), "e#0")
    before = states.orders._snapshot()["parts"]
    states.add_orders(order_rows(orders[5:]), "o#1")
    after = states.orders._snapshot()["parts"]
    # Every old folder is still there as it was, and the new one has the rows of the one user named.
    assert all(set(held) <= set(after[part]) for part, held in before.items())
    new = {part: set(held) - set(before.get(part, [])) for part, held in after.items()}
    assert sum(map(len, new.values())) == 1
    states.add_events(event_rows(events[4:]), "e#1")
    states.add_events(event_rows(events[4:]), "e#1")  # a replay
    same = lambda: sorted(map(str, states.read(day).select(*whole.columns).collect())) == sorted(map(str, whole.collect()))
    assert same()
    states.compact()
    states.add_orders(order_rows(orders[5:]), "o#1")
    assert same()
    assert sorted(map(str, CustomerStates.open(spark, str(tmp_path / "s")).read(day).collect())) == sorted(map(str, states.read(day).collect()))
