"""Registered queries: files to bronze to silver as streams, and streamed window features."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import functions as F, types as T

from millrace.operators.store import FeatureTable
from millrace.plans.customer_queries import (
    CUSTOMER_360_SQL, RAW_USERS_SQL, SILVER_USERS_SQL, app_events, plain_times, raw_orders, raw_users,
)
from millrace.plans.feature_queries import PICKUP_EVENTS
from millrace.plans.features import pickup_features
from millrace.plans.registry import query
from millrace.session import scratch_path, size_shuffles
from millrace.sources import files
from millrace.streaming import control, inference, ingest, nested, silver
from millrace.streaming.customers import CustomerStates
from millrace.streaming.features import WindowStates, each_batch, stream_features


def _landing(t, rows, fmt: str) -> str:
    """Write rows as raw files, the way an upstream system would deliver them."""
    folder = scratch_path(t.spark, "landing")
    rows.write.format(fmt).option("header", True).save(folder)
    return folder


def _through_silver(t, folder: str, fmt: str, clean, **options):
    """Ingest the folder twice (the second run must find nothing new), clean as a stream, read."""
    root = scratch_path(t.spark, "lake")
    for _ in range(2):
        control.wait_all([ingest.ingest_folder(t.spark, folder, fmt, "bronze", root, **options)])
    out = f"{root}/silver"
    stream = clean(ingest.stream_bronze(t.spark, root, "bronze"))
    control.wait_all([ingest.stream_to_path(stream, out, f"{root}/checkpoint/silver")])
    return t.spark.read.schema(stream.schema).parquet(out)


@query(f"WITH {RAW_USERS_SQL}, {SILVER_USERS_SQL} SELECT * FROM silver_users")
def streamed_silver_users(t):
    folder = _landing(t, raw_users(t), "json")
    return plain_times(_through_silver(t, folder, "json", silver.silver_users))


@query("""
SELECT CAST(o_custkey AS VARCHAR) AS user_id, CAST(o_orderkey AS VARCHAR) AS order_id,
       strftime(o_orderdate, '%m-%d-%Y %H:%M:%S') AS transaction_date,
       CAST(o_orderkey % 3 + 1 AS INTEGER) AS item_count, CAST(trunc(o_totalprice) AS INTEGER) AS amount
FROM orders""")
def streamed_silver_orders(t):
    folder = _landing(t, raw_orders(t), "csv")
    hints = {"user_id": "string", "id": "string"}
    return _through_silver(t, folder, "csv", silver.silver_orders, hints=hints)


@query("""
SELECT CAST(o_custkey AS VARCHAR) AS user_id, o_totalprice AS amount,
       CASE WHEN o_orderkey % 4 = 0 THEN '{"status":"' || o_orderstatus || '"}' END AS _rescued_data FROM orders""")
def rescued_fields(t):
    """Every fourth line has a field that the table's schema does not know."""
    status = F.when(F.col("o_orderkey") % 4 == 0, F.col("o_orderstatus"))
    rows = t.orders.select(
        F.col("o_custkey").cast("string").alias("user_id"), F.col("o_totalprice").alias("amount"), status.alias("status")
    )
    lines = t.spark.readStream.text(_landing(t, rows, "json"))
    known = T.StructType.fromDDL("user_id string, amount double")
    out = scratch_path(t.spark, "rescued")
    stream = ingest.rescue_unknown(lines, known)
    control.wait_all([ingest.stream_to_path(stream, out, f"{out}-checkpoint")])
    return t.spark.read.schema(stream.schema).parquet(out)


@query("""
SELECT o_orderkey AS order_id, o_custkey AS buyer_id, CASE WHEN o_orderkey % 2 = 0 THEN 1 END AS first_part,
       CASE WHEN o_orderkey % 2 = 1 THEN '{"buyer":{"status":"' || o_orderstatus || '"},"parts":{"0":{"n":"x' || o_orderkey || '"}}}'
            ELSE '{"buyer":{"status":"' || o_orderstatus || '"}}' END AS _rescued_data FROM orders""")
def rescued_nested_fields(t):
    """An unknown field inside a struct in every line, and inside a list a value that does not fit in every other one."""
    part = F.when(F.col("o_orderkey") % 2 == 0, F.lit('{"n":1}')).otherwise(F.format_string('{"n":"x%d"}', "o_orderkey"))
    lines = t.orders.select(F.format_string(
        '{"order_id":%d,"buyer":{"id":%d,"status":"%s"},"parts":[%s]}', "o_orderkey", "o_custkey", "o_orderstatus", part).alias("value"))
    folder = scratch_path(t.spark, "landing")
    lines.write.text(folder)
    known = T.StructType.fromDDL("order_id bigint, buyer struct<id: bigint>, parts array<struct<n: int>>")
    out = scratch_path(t.spark, "rescued")
    stream = nested.rescue_nested(ingest.open_lines(t.spark, folder), known)
    control.wait_all([ingest.stream_to_path(stream, out, f"{out}-checkpoint")])
    rows = t.spark.read.schema(stream.schema).parquet(out)
    return rows.select("order_id", F.col("buyer.id").alias("buyer_id"), F.col("parts")[0]["n"].alias("first_part"), ingest.RESCUED)


DAY_MS = 86_400_000


def _ingested(t, root: str, folder: str, fmt: str, **options):
    control.wait_all([ingest.ingest_folder(t.spark, folder, fmt, "bronze", root, **options)])
    return ingest.read_bronze(t.spark, root, "bronze")


def _order_rows(t):
    return t.orders.select(
        F.col("o_custkey").alias("user_id"), F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("amount"),
        F.col("o_orderpriority").alias("priority"),
    )


@query("""
SELECT o_custkey AS user_id, o_orderkey AS order_id, o_totalprice AS amount, o_orderpriority AS priority,
       CAST(NULL AS VARCHAR) AS _rescued_data FROM orders""")
def ingested_late_files(t):
    """Files that are weeks older than others, in the first run and in a later one, arrive all the same."""
    folder, root = scratch_path(t.spark, "landing"), scratch_path(t.spark, "lake")
    for turn in range(3):
        part = _order_rows(t).filter(F.pmod("order_id", F.lit(3)) == turn)
        staged = _landing(t, part, "json")
        files.set_modified(t.spark, staged, (int(time.time()) - 40 * 86_400 * turn) * 1000)
        files.move_into(t.spark, staged, folder, f"{turn}-")
        if turn:
            found = _ingested(t, root, folder, "json")
    return found


@query("""
SELECT o_custkey AS user_id, o_orderkey AS order_id, o_totalprice AS amount,
       CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority END AS priority,
       CAST(NULL AS VARCHAR) AS _rescued_data FROM orders""")
def ingested_new_field(t):
    """A field that comes later, first in files that look older than the last run: a column from the second run on."""
    folder, root = scratch_path(t.spark, "landing"), scratch_path(t.spark, "lake")
    for turn in range(3):
        part = _order_rows(t).filter(F.pmod("order_id", F.lit(3)) == turn)
        staged = _landing(t, part if turn else part.drop("priority"), "json")
        if turn == 1:
            files.set_modified(t.spark, staged, int(time.time() * 1000) - DAY_MS)
        files.move_into(t.spark, staged, folder, f"{turn}-")
        found = _ingested(t, root, folder, "json")
    return found.select("user_id", "order_id", "amount", "priority", ingest.RESCUED)


@query("""
SELECT o_custkey AS user_id, o_orderkey AS order_id, o_totalprice AS amount,
       CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority END AS priority,
       CASE WHEN o_orderkey % 3 = 2 THEN '{"amount":"n/a ' || o_orderkey || '"}' END AS _rescued_data
FROM (SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE o_totalprice END AS o_totalprice) FROM orders)""")
def ingested_mixed_csv(t):
    """CSV files with three headers: other columns, another order, and values that do not fit, over two runs."""
    folder, root = scratch_path(t.spark, "landing"), scratch_path(t.spark, "lake")
    rows = _order_rows(t)
    misfit = F.concat(F.lit("n/a "), F.col("order_id"))
    shapes = [
        rows.drop("priority"), rows.select("priority", "amount", "order_id", "user_id"),
        rows.select("order_id", "user_id", misfit.alias("amount"), "priority"),
    ]
    hints = {"user_id": "bigint", "order_id": "bigint", "amount": "double"}
    for turn, shape in enumerate(shapes):
        files.move_into(t.spark, _landing(t, shape.filter(F.pmod("order_id", F.lit(3)) == turn), "csv"), folder, f"{turn}-")
        if turn:
            found = _ingested(t, root, folder, "csv", hints=hints)
    return found.select("user_id", "order_id", "amount", "priority", ingest.RESCUED)


@query("""
SELECT c_nationkey AS nation, 'customer' AS name, '"integer"' AS type FROM customer GROUP BY c_nationkey
UNION ALL
SELECT c_nationkey, 'value', CASE WHEN c_nationkey % 3 = 0 THEN '"integer"'
         WHEN c_nationkey % 3 = 2 AND bool_or(c_custkey % 5 = 0) THEN '"string"' ELSE '"double"' END
FROM customer GROUP BY c_nationkey""")
def types_of_files(t):
    """The table of types that ingestion keeps, one file for each nation: whole numbers, fractions, or some words among them."""
    segment = F.when((F.col("c_nationkey") % 3 == 2) & (F.col("c_custkey") % 5 == 0), F.col("c_mktsegment"))
    whole = F.when(F.col("c_nationkey") % 3 == 0, F.col("c_acctbal").cast("int").cast("string"))
    rows = t.customer.select(
        F.col("c_nationkey").alias("nation"), F.col("c_custkey").alias("customer"),
        F.coalesce(segment, whole, F.col("c_acctbal").cast("string")).alias("value"),
    )
    folder, kept = scratch_path(t.spark, "landing"), scratch_path(t.spark, "types")
    rows.repartition("nation").write.partitionBy("nation").option("header", True).csv(folder)
    for _ in range(2):
        inference.summarise_new(t.spark, folder, "csv", kept, f"{kept}-checkpoint")
    nation = F.regexp_extract("path", r"nation=(\d+)", 1).cast(t.customer.schema["c_nationkey"].dataType)
    return inference.read_summaries(t.spark, kept).select(nation.alias("nation"), "name", "type")


@query(f"""
WITH {PICKUP_EVENTS}
SELECT * FROM pickup WHERE ts <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL '1 hour' FROM events)""")
def streamed_features(t):
    """Window features of events read as a stream, upserted into a feature table as windows close."""
    landing = scratch_path(t.spark, "events")
    t.events.select("user_id", "ts", "value").write.parquet(landing)
    # The number of state partitions is fixed by the first run, so the stream gets a session of its
    # own, with shuffles sized to its input.
    session = t.spark.newSession()
    size_shuffles(session, landing)
    stream = session.readStream.schema("user_id long, ts timestamp_ntz, value double").parquet(landing)

    def compute(df):
        found = pickup_features(df, None, key="user_id", value="value", suffix="user", time_column="ts")
        return found.withColumn("mean_fare_window_1h_user", F.col("mean_fare_window_1h_user").cast("double"))

    path = scratch_path(t.spark, "streamed")
    schema = T.StructType.fromDDL(
        "zip long, ts timestamp, mean_fare_window_1h_user double, count_trips_window_1h_user int"
    )
    table = FeatureTable.create(t.spark, path, "zip", schema=schema, timestamp_key="ts")
    control.wait_all([stream_features(stream, "ts", "1 hour", compute, table, f"{path}-checkpoint")])
    return plain_times(table.read()).withColumnsRenamed({
        "mean_fare_window_1h_user": "mean_fare_window_1h", "count_trips_window_1h_user": "count_trips_window_1h",
    })


def _window_states(t) -> WindowStates:
    """Events in three runs of a stream: early ones, later ones, and every tenth of the early ones, which come late."""
    landing, path = scratch_path(t.spark, "events"), scratch_path(t.spark, "states")
    events = t.events.select("event_id", "user_id", "ts", "value")
    early, tenth = F.col("ts") <= F.lit("2024-01-20").cast("timestamp_ntz"), F.pmod("event_id", F.lit(10)) == 0
    states = WindowStates.create(
        t.spark, path, "user_id", "long", "ts", "15 minutes",
        {"n": (F.count("*"), "long"), "n_value": (F.count("value"), "long"), "total": (F.sum("value"), "double")}, delay="1 hour")
    for turn, part in enumerate([events.filter(early & ~tenth), events.filter(~early), events.filter(early & tenth)]):
        staged = scratch_path(t.spark, "staged")
        part.write.parquet(staged)
        files.move_into(t.spark, staged, landing, f"{turn}-")
        stream = t.spark.readStream.schema(events.schema).parquet(landing)
        control.wait_all([states.write_stream(stream, f"{path}-checkpoint")])
    return states


@query(f"WITH {PICKUP_EVENTS} SELECT * FROM pickup")
def streamed_features_complete(t):
    """All sliding windows of a stream, open ones and those of late rows too, from states kept by pane."""
    found = _window_states(t).windows(4)
    return plain_times(found.select(
        F.col("user_id").alias("zip"), F.col("window_end").alias("ts"),
        F.try_divide("total", "n_value").cast("float").cast("double").alias("mean_fare_window_1h"),
        F.col("n").cast("int").alias("count_trips_window_1h")))


@query("""
SELECT CAST(count(*) AS BIGINT) AS n_rows,
       CAST(count(*) FILTER (WHERE ts <= TIMESTAMP '2024-01-20' AND event_id % 10 = 0 AND ts < latest - INTERVAL 1 HOUR) AS BIGINT) AS n_late,
       CAST(count(*) FILTER (WHERE ts IS NULL) AS BIGINT) AS n_undated
FROM events, (SELECT max(ts) AS latest FROM events)""")
def streamed_late_rows(t):
    """Rows of the same stream, and those that came after the delay; they are counted in their windows all the same."""
    return _window_states(t).late_rows()


@query(CUSTOMER_360_SQL)
def customer_360_incremental(t):
    """Raw files of users, orders and events in two deliveries, through bronze and silver streams, to states by user."""
    root = scratch_path(t.spark, "customers")
    sources = {
        "users": (raw_users(t), "json", "id", {"id": "string"}, silver.silver_users),
        "orders": (raw_orders(t), "json", "id", {"user_id": "string", "id": "string"}, silver.silver_orders),
        "events": (app_events(t).drop("ts"), "csv", "event_id", {"user_id": "string", "event_id": "bigint"}, lambda df: df.drop(ingest.RESCUED)),
    }
    states = None
    for turn in range(2):
        running = []
        for name, (rows, fmt, id_column, hints, clean) in sources.items():
            # The second delivery has every fifth row, of all times.
            part = rows.filter((F.pmod(F.xxhash64(id_column), F.lit(5)) == 0) == F.lit(turn == 1))
            files.move_into(t.spark, _landing(t, part, fmt), f"{root}/landing/{name}", f"{turn}-")
            control.wait_all([ingest.ingest_folder(t.spark, f"{root}/landing/{name}", fmt, name, root, hints=hints)])
            stream = clean(ingest.stream_bronze(t.spark, root, name))
            if states is None:
                states = CustomerStates.create(t.spark, f"{root}/states", stream.schema)
            running.append(each_batch(stream, getattr(states, f"add_{name}"), f"{root}/checkpoint/states-{name}"))
        control.wait_all(running)
    return plain_times(states.read(F.lit("2024-02-01").cast("date")))


@query("""
SELECT CAST(o_custkey AS VARCHAR) AS user_id, CAST(o_orderkey AS VARCHAR) AS order_id,
       strftime(o_orderdate, '%m-%d-%Y %H:%M:%S') AS transaction_date,
       CAST(o_orderkey % 3 + 1 AS INTEGER) AS item_count, CAST(trunc(o_totalprice) AS INTEGER) AS amount
FROM orders""")
def streamed_tables(t):
    """Two streams at once: files to one catalog table, and users to another; then table to table."""
    root, mark = scratch_path(t.spark, "tables"), uuid.uuid4().hex[:8]
    orders, users = raw_orders(t), raw_users(t)
    names = {n: f"millrace_{n}_{mark}" for n in ("orders", "users", "silver")}
    streams = [
        t.spark.readStream.schema(rows.schema).json(_landing(t, rows, "json")) for rows in (orders, users)
    ]
    control.wait_all([
        ingest.stream_to_table(stream, names[n], f"{root}/checkpoint/{n}", path=f"{root}/{n}")
        for stream, n in zip(streams, ("orders", "users"))
    ])
    clean = silver.silver_orders(ingest.table_stream(t.spark, names["orders"]))
    control.wait_all([ingest.stream_to_table(clean, names["silver"], f"{root}/checkpoint/silver", path=f"{root}/silver")])
    made = t.spark.table(names["silver"])
    for name in names.values():
        t.spark.sql(f"DROP TABLE {name}")
    return made
