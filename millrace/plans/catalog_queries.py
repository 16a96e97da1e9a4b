"""Registered queries: catalog work, small local inputs, names, sinks and stream control."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import functions as F, types as T

from millrace.functions import names
from millrace.functions.times import days_between
from millrace.operators import quality
from millrace.plans.registry import query
from millrace.session import scratch_path
from millrace.sources import catalog, files, readers, writers
from millrace.streaming import control, ingest


def _mark() -> str:
    return uuid.uuid4().hex[:8]


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 100000 AND o_orderpriority = '1-URGENT'")
def sql_with_variables(t):
    """SQL over a view with a ``${...}`` variable, which does not stay in the session, and a parameter."""
    view = f"orders_{_mark()}"
    readers.as_view(t.orders, view)
    text = "SELECT o_orderkey, o_totalprice FROM " + view + " WHERE o_totalprice > ${least_price} AND o_orderpriority = :p"
    found = readers.run_sql(t.spark, text, args={"p": "1-URGENT"}, variables={"least_price": 100000})
    t.spark.catalog.dropTempView(view)
    return found


@query("""
SELECT CAST(level AS INTEGER) AS level, count(*) AS orders FROM orders
JOIN (VALUES ('1-URGENT', 1), ('2-HIGH', 2), ('3-MEDIUM', 3)) AS p(priority, level) ON o_orderpriority = priority GROUP BY level""")
def local_rows(t):
    """A few local rows as a DataFrame, joined to a table."""
    levels = readers.read_rows(t.spark, [("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 3)], "priority string, level int")
    counts = t.orders.groupBy(F.col("o_orderpriority").alias("priority")).agg(F.count("*").alias("orders"))
    return counts.join(levels, "priority").select("level", "orders")


@query("SELECT 2 * n_nationkey + 1 AS id, n_name FROM nation")
def stepped_ids(t):
    """Generated ids with a step, in a stated number of partitions, joined to a table."""
    ids = readers.read_numbers(t.spark, 1, 1000, step=2, partitions=5)
    assert ids.rdd.getNumPartitions() == 5
    return ids.join(t.nation, ids["id"] == 2 * F.col("n_nationkey") + 1).select(
        F.col("id").cast("int").alias("id"), "n_name")


@query("""
SELECT 'nation' AS name, true AS listed, 'spark_catalog' AS catalog, true AS known, count(*) AS row_count FROM nation
UNION ALL SELECT 'region', true, 'spark_catalog', true, count(*) FROM region""")
def catalog_listing(t):
    """Tables found in the listing by pattern, with the current catalog and their rows."""
    mark = _mark()
    tables = {n: f"listed_{mark}_{n}" for n in ("nation", "region")}
    for n, name in tables.items():
        writers.save_table(getattr(t, n), name, path=scratch_path(t.spark, "tables"))
    found = {r["tableName"] for r in catalog.tables_like(t.spark, f"LISTED_{mark.upper()}%").collect()}
    counts = catalog.row_counts({n: readers.read_table(t.spark, name) for n, name in tables.items()})
    listed = F.col("name").isin([n for n, name in tables.items() if name in found])
    known = F.lit(catalog.catalog_exists(t.spark, "spark_catalog"))
    for name in tables.values():
        catalog.drop_table(t.spark, name)
    return counts.join(catalog.current_catalog(t.spark).hint("broadcast")).select(
        "name", listed.alias("listed"), "catalog", known.alias("known"), "row_count")


@query("""
SELECT step, rebuild, (SELECT count(*) FROM region) AS row_count
FROM (VALUES ('before', true), ('after', false), ('dropped', true)) AS s(step, rebuild)""")
def rebuild_test(t):
    """Whether a table or its folder is missing, before it is made, after, and when it is dropped."""
    name, folder = f"rebuilt_{_mark()}", scratch_path(t.spark, "tables")
    need = lambda: catalog.needs_rebuild(t.spark, [name], [folder])
    steps = [("before", need())]
    writers.save_table(t.region, name, path=folder)
    steps.append(("after", need()))
    catalog.drop_table(t.spark, name)
    steps.append(("dropped", need()))
    return readers.read_rows(t.spark, steps, "step string, rebuild boolean").join(
        t.region.agg(F.count("*").alias("row_count")).hint("broadcast"))


@query("SELECT n_regionkey, count(*) AS nations, true AS made, false AS left_over FROM nation GROUP BY n_regionkey")
def table_in_own_database(t):
    """A database made, used and dropped with the table in it."""
    name, before = f"db_{_mark()}", t.spark.catalog.currentDatabase()
    folder = scratch_path(t.spark, "database")
    catalog.create_database(t.spark, name, location=folder, use=True)
    try:
        made = name in {r[0] for r in catalog.databases(t.spark).collect()}
        rows = writers.save_table(t.nation, "nations", path=scratch_path(t.spark, "tables"))
        found = rows.groupBy("n_regionkey").agg(F.count("*").alias("nations"))
    finally:
        t.spark.catalog.setCurrentDatabase(before)
        catalog.drop_database(t.spark, name)
    left = name in {r[0] for r in catalog.databases(t.spark).collect()}
    return found.withColumns({"made": F.lit(made), "left_over": F.lit(left)})


@query("SELECT r_regionkey, r_name, CAST(0 AS BIGINT) AS rows_at_first FROM region")
def table_made_empty(t):
    """An empty table from a schema; making it again changes nothing; then rows are appended."""
    name = f"empty_{_mark()}"
    at_first = writers.create_empty_table(t.spark, name, "r_regionkey int, r_name string").count()
    rows = t.region.select(F.col("r_regionkey").cast("int").alias("r_regionkey"), "r_name")
    rows.write.insertInto(name)
    kept = writers._stored(writers.create_empty_table(t.spark, name, "r_regionkey int, r_name string"))
    catalog.drop_table(t.spark, name)
    return kept.select("r_regionkey", "r_name", F.lit(at_first).cast("long").alias("rows_at_first"))


@query("""
SELECT n_name, n_regionkey, true AS same_place, 'n_regionkey' AS partitions FROM nation
WHERE n_regionkey <> 1 AND NOT (n_regionkey = 2 AND n_nationkey % 2 = 0)""")
def deleted_rows(t):
    """Rows deleted from a partitioned table kept at its own place: one partition whole, one in part."""
    name, folder = f"deleted_{_mark()}", scratch_path(t.spark, "tables")
    writers.save_table(t.nation, name, partition_by=["n_regionkey"], path=folder)
    gone = (F.col("n_regionkey") == 1) | ((F.col("n_regionkey") == 2) & (F.col("n_nationkey") % 2 == 0))
    left = writers.delete_rows(t.spark, name, gone)
    place = t.spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").first()["data_type"]
    parts = ",".join(c.name for c in t.spark.catalog.listColumns(name) if c.isPartition)
    kept = writers._stored(left)
    catalog.drop_table(t.spark, name)
    return kept.select("n_name", "n_regionkey", F.lit(place.endswith(folder.rpartition("/")[2])).alias("same_place"), F.lit(parts).alias("partitions"))


@query("""
SELECT c_custkey AS customer_id, c_name AS streaming_tv, c_acctbal AS monthly_charges, c_mktsegment AS paperless_billing FROM customer""")
def cleaned_names(t):
    """camelCase names, names with blanks, and two that need a repair."""
    raw = t.customer.select(
        F.col("c_custkey").alias("customerID"), F.col("c_name").alias("StreamingTV"), F.col("c_acctbal").alias("monthly charges"),
        F.col("c_mktsegment").alias("paperlessBilling"))
    return names.clean_columns(raw, names.bronze_name)


@query("""
SELECT count(*) AS users, bool_and(date_diff('day', CAST(TIMESTAMP '1990-01-01' AS DATE), CAST(o_orderdate AS DATE)) >= 0) AS after_1990,
       true AS days_agree FROM orders""")
def days_until_now(t):
    """Days since a date, counted to the current time by default."""
    days = t.orders.select(
        days_between("o_orderdate").alias("now"), F.datediff(F.current_timestamp(), "o_orderdate").alias("same"), "o_orderdate")
    return days.agg(
        F.count("*").alias("users"), F.bool_and(F.col("o_orderdate") >= F.lit("1990-01-01").cast("date")).alias("after_1990"),
        F.bool_and(F.col("now") == F.col("same")).alias("days_agree"))


@query("""
SELECT * FROM (VALUES ('c_custkey', 1, 'bigint'), ('c_name', 0, 'string, expected double'), ('tenure', 0, 'missing')) AS r("check", passed, detail)""")
def input_schema(t):
    """What a model's input must have, against what a table has."""
    expected = T.StructType.fromDDL("c_custkey bigint, c_name double, tenure int")
    return quality.schema_report(t.customer, expected)


@query("SELECT CAST(3 AS BIGINT) AS json_files, CAST(2 AS BIGINT) AS csv_files, n_nationkey, n_name FROM nation")
def written_in_so_many_files(t):
    """JSON and CSV sinks with a stated number of files, read back."""
    places = {f: scratch_path(t.spark, f) for f in ("json", "csv")}
    writers.save_json(t.nation, places["json"], files=3)
    writers.save_csv(t.nation, places["csv"], files=2)
    numbers = {f: sum(n.startswith("part-") for n in files.list_names(t.spark, p)) for f, p in places.items()}
    a = t.spark.read.schema("n_nationkey int, n_name string").json(places["json"])
    b = t.spark.read.option("header", True).csv(places["csv"]).select(F.col("n_nationkey").cast("int").alias("n_nationkey"), "n_name")
    return a.intersect(b).select(
        F.lit(numbers["json"]).cast("long").alias("json_files"), F.lit(numbers["csv"]).cast("long").alias("csv_files"), "n_nationkey", "n_name")


@query("""
SELECT 'customer' AS stream, count(*) AS row_count, true AS ran, false AS runs FROM customer
UNION ALL SELECT 'nation', count(*), true, false FROM nation""")
def controlled_streams(t):
    """Two endless streams found by the prefix of their names, waited for, and stopped."""
    mark, root = _mark(), scratch_path(t.spark, "streams")
    places = {}
    for n in ("customer", "nation"):
        landing = scratch_path(t.spark, "landing")
        getattr(t, n).write.parquet(landing)
        stream = t.spark.readStream.schema(getattr(t, n).schema).parquet(landing)
        places[n] = f"{root}/{n}"
        q = ingest.stream_to_path(stream, places[n], f"{root}/checkpoint/{n}", once=False)
        q.processAllAvailable()
        assert q.isActive
    ids = {q.id for q in control.active(t.spark)}
    named = t.spark.readStream.schema(t.nation.schema).parquet(landing).writeStream.queryName(f"{mark}_noop").format("noop")
    named.option("checkpointLocation", f"{root}/checkpoint/noop").start()
    ran = len(control.active(t.spark, f"{mark}_")) == 1 and len(ids) >= 2
    stopped = control.stop_all(t.spark, f"{mark}_")
    for q in control.active(t.spark):
        if q.id in ids:
            q.stop()
    time.sleep(0.1)
    runs = bool(control.active(t.spark, f"{mark}_"))
    read = {n: t.spark.read.schema(getattr(t, n).schema).parquet(p) for n, p in places.items()}
    return catalog.row_counts(read).select(
        F.col("name").alias("stream"), "row_count", F.lit(ran and stopped == 1).alias("ran"), F.lit(runs).alias("runs"))
