"""Registered queries: filters, joins, aggregates, sorts, samples and scalar functions."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from millrace.functions import (
    days_between, epoch_millis, fare_band, formatted, initial_caps, label_to_int, lenient_double,
    lenient_int, name_like, parse_timestamp, pseudonym, random_id, swap_url_host, unit_of,
    weekend_flag, whole_second,
)
from millrace.operators import aggregates, filters, sampling
from millrace.plans import devices
from millrace.plans.registry import Tables, query
from millrace.session import scratch_path
from millrace.sources import catalog, readers, writers

# -- device readings, with line items standing in for them ------------------------------------

DEVICES_SQL = """
devices AS (
  SELECT l_orderkey % 10 AS battery_level, l_partkey % 800 + 800 AS c02_level,
         l_returnflag || l_linestatus AS cca3, l_orderkey * 10 + l_linenumber AS device_id,
         'sensor-' || l_orderkey AS device_name, l_suppkey % 60 + 40 AS humidity,
         CAST(l_quantity AS BIGINT) AS temp
  FROM lineitem)"""


def device_rows(t: Tables):
    return t.lineitem.select(
        (F.col("l_orderkey") % 10).alias("battery_level"),
        (F.col("l_partkey") % 800 + 800).alias("c02_level"),
        F.concat("l_returnflag", "l_linestatus").alias("cca3"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("device_id"),
        F.concat(F.lit("sensor-"), F.col("l_orderkey")).alias("device_name"),
        (F.col("l_suppkey") % 60 + 40).alias("humidity"),
        F.col("l_quantity").cast("long").alias("temp"),
    )


@query("""
SELECT 'orders' AS name, count(*) AS row_count FROM orders
UNION ALL SELECT 'lineitem', count(*) FROM lineitem
UNION ALL SELECT 'events', count(*) FROM events""")
def row_counts(t):
    return catalog.row_counts({"orders": t.orders, "lineitem": t.lineitem, "events": t.events})


@query(f"WITH {DEVICES_SQL} SELECT * FROM devices WHERE temp > 30 AND humidity > 70")
def hot_and_humid(t):
    return devices.hot_and_humid(device_rows(t))


@query(f"WITH {DEVICES_SQL} SELECT temp, device_name, device_id, cca3 FROM devices WHERE temp > 25")
def warm_readings(t):
    return devices.warm_readings(device_rows(t))


@query(f"""WITH {DEVICES_SQL}
SELECT battery_level, c02_level, device_name FROM devices WHERE battery_level > 6 ORDER BY c02_level""")
def charged_by_co2(t):
    return devices.charged_by_co2(device_rows(t))


@query(f"""WITH {DEVICES_SQL}
SELECT cca3, avg(temp) AS avg_temp, avg(humidity) AS avg_humidity FROM devices GROUP BY cca3""")
def country_averages(t):
    return devices.country_averages(device_rows(t))


@query(f"""WITH {DEVICES_SQL}
SELECT cca3, avg(temp) AS avg_temp, avg(humidity) AS avg_humidity FROM devices WHERE temp > 25 GROUP BY cca3""")
def warm_country_averages(t):
    return devices.country_averages(device_rows(t), warm_only=True)


@query(f"""WITH {DEVICES_SQL}
SELECT cca3, count(device_id) AS number, avg(humidity) AS avg_humidity, avg(temp) AS avg_temp
FROM devices WHERE temp > 30 AND humidity > 70
GROUP BY cca3 ORDER BY number DESC, cca3 LIMIT 20""")
def busiest_countries(t):
    return devices.busiest_countries(devices.hot_and_humid(device_rows(t)))


@query(f"WITH {DEVICES_SQL} SELECT cca3, c02_level FROM devices WHERE c02_level > 1400 ORDER BY c02_level DESC")
def high_co2(t):
    return devices.high_co2(device_rows(t))


@query(f"""WITH {DEVICES_SQL}
SELECT cca3, count(DISTINCT device_id) AS devices FROM devices WHERE battery_level = 0
GROUP BY cca3 ORDER BY devices DESC, cca3 LIMIT 100""")
def empty_batteries(t):
    return devices.empty_batteries(device_rows(t))


@query(f"""WITH {DEVICES_SQL}
SELECT cca3, count(*) AS n, max(temp) AS max_temp FROM devices WHERE temp > 30 AND humidity > 70 GROUP BY cca3""")
def view_sql(t):
    readers.as_view(devices.hot_and_humid(device_rows(t)), "millrace_devices")
    return readers.run_sql(
        t.spark, "SELECT cca3, count(*) AS n, max(temp) AS max_temp FROM millrace_devices GROUP BY cca3"
    )


@query("SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_quantity > 25 GROUP BY l_returnflag")
def sql_with_parameters(t):
    readers.as_view(t.lineitem, "millrace_lineitem")
    return readers.run_sql(
        t.spark,
        "SELECT l_returnflag, count(*) AS n FROM millrace_lineitem WHERE l_quantity > :least GROUP BY l_returnflag",
        args={"least": 25},
    )


# -- projections, grouping, sorting ------------------------------------------------------------

@query("SELECT DISTINCT p_brand, p_type FROM part")
def distinct_pairs(t):
    return t.part.select("p_brand", "p_type").distinct()


@query("SELECT count(p_size) AS n FROM part GROUP BY p_size")
def count_by_value(t):
    return aggregates.value_counts_only(t.part, "p_size")


@query("""
SELECT l_returnflag, avg(l_linenumber) AS avg_l_linenumber, avg(q) AS avg_q, avg(cents) AS avg_cents
FROM (SELECT l_returnflag, l_linenumber, CAST(l_quantity AS BIGINT) AS q,
             CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem)
GROUP BY l_returnflag""")
def average_every_column(t):
    rows = t.lineitem.select(
        "l_returnflag", "l_linenumber", F.col("l_quantity").cast("long").alias("q"),
        F.round(F.col("l_extendedprice") * 100).cast("long").alias("cents"),
    )
    return aggregates.average_all(rows, "l_returnflag")


@query("SELECT least(20, count(*)) AS n FROM lineitem")
def plain_limit(t):
    return t.lineitem.limit(20).agg(F.count("*").alias("n"))


@query("""
SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS net_price, l_quantity AS quantity
FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_shipdate < TIMESTAMP '1999-01-01'""")
def presented_prices(t):
    rows = filters.time_range(t.lineitem, "l_shipdate", "1998-01-01", "1999-01-01")
    priced = rows.withColumn("net", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    return filters.present(
        priced, ["l_orderkey", "l_linenumber", "net", "l_quantity"],
        rename={"net": "net_price", "l_quantity": "quantity"}, round_to={"net": 4},
    )


@query("""
SELECT n_name, count(*) AS customers, count(DISTINCT c_mktsegment) AS segments, max(c_acctbal) AS best
FROM customer JOIN nation ON c_nationkey = n_nationkey
GROUP BY n_name ORDER BY customers DESC, n_name LIMIT 10""")
def top_nations(t):
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return aggregates.top_groups(
        joined, "n_name",
        [F.count("*").alias("customers"), F.countDistinct("c_mktsegment").alias("segments"),
         F.max("c_acctbal").alias("best")],
        by="customers", k=10,
    )


@query("""
SELECT o_custkey, CAST(sum(l_linenumber) AS BIGINT) AS items, count(*) AS lines
FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_custkey""")
def named_aggregates(t):
    lines = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey").join(t.orders, ["o_orderkey"])
    return aggregates.aggregate(
        lines, ["o_custkey"], {"items": ("sum", "l_linenumber"), "lines": ("count", "*")}
    )


@query("""
SELECT user_id, c_mktsegment, o_orderkey FROM
  (SELECT c_custkey AS user_id, c_mktsegment FROM customer)
  INNER JOIN (SELECT o_custkey AS user_id, o_orderkey FROM orders) USING (user_id)""")
def join_using(t):
    users = t.customer.select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    orders = t.orders.select(F.col("o_custkey").alias("user_id"), "o_orderkey")
    return users.join(orders, ["user_id"], "inner")


@query("SELECT s_name, n_name, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def join_on_expression(t):
    joined = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    joined = joined.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.drop("s_nationkey", "n_nationkey", "n_regionkey", "r_regionkey", "s_suppkey", "s_acctbal")


@query("""
SELECT 'customer' AS kind, c_custkey AS id, c_acctbal AS balance FROM customer
UNION ALL SELECT 'supplier', s_suppkey, s_acctbal FROM supplier""")
def union_by_name(t):
    customers = t.customer.select(
        F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance")
    )
    suppliers = t.supplier.select(
        F.col("s_acctbal").alias("balance"), F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id")
    )
    return customers.unionByName(suppliers)


@query("""
SELECT id FROM range(0, (SELECT max(o_orderkey) * 2 FROM orders)) r(id)
WHERE id NOT IN (SELECT o_orderkey FROM orders)""")
def generated_ids_without_order(t):
    top = t.orders.agg(F.max("o_orderkey").alias("top")).first()["top"]
    ids = readers.read_numbers(t.spark, 0, (top or 0) * 2)
    return ids.join(t.orders.select(F.col("o_orderkey").alias("id")), ["id"], "left_anti")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus IS NULL OR o_orderstatus <> 'F'")
def rows_left_by_delete(t):
    return writers.keep_unless(t.orders, F.col("o_orderstatus") == "F").select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )


@query("""
SELECT c_custkey, c_name, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal FROM customer WHERE c_acctbal >= 0""")
def complete_rows(t):
    rows = t.customer.select(
        "c_custkey", "c_name", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal")
    )
    return filters.complete_rows(rows)


@query("SELECT c_mktsegment, c_custkey FROM customer")
def required_columns(t):
    return readers.require_columns(t.customer, ["c_mktsegment", "c_custkey"])


# -- samples and splits ------------------------------------------------------------------------

@query("SELECT event_id, user_id FROM events WHERE substr(md5('3|' || event_id), 1, 8) < '4ccccccc'")
def hash_sample(t):
    return sampling.hash_sample(t.events, "event_id", 0.3, seed=3).select("event_id", "user_id")


@query("SELECT event_id FROM events ORDER BY md5('3|' || event_id), event_id LIMIT 100")
def fixed_sample(t):
    return sampling.fixed_sample(t.events.select("event_id"), "event_id", 100, seed=3)


@query("""
SELECT o_orderkey, CAST(substr(md5('123|' || o_orderkey), 1, 8) < 'c0000000' AS INTEGER) AS is_train FROM orders""")
def hash_split(t):
    train, test = sampling.hash_split(t.orders.select("o_orderkey"), "o_orderkey", 0.75, seed=123)
    return train.withColumn("is_train", F.lit(1)).unionByName(test.withColumn("is_train", F.lit(0)))


@query("""
WITH ranked AS (
  SELECT o_orderkey, o_orderstatus,
         row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5('123|' || o_orderkey), o_orderkey) AS rn,
         count(*) OVER (PARTITION BY o_orderstatus) AS size FROM orders)
SELECT o_orderkey, o_orderstatus, CAST(rn <= ceil(size * 0.75) AS INTEGER) AS is_train FROM ranked""")
def stratified_split(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    return sampling.stratified_split(rows, "o_orderkey", "o_orderstatus", 0.75, seed=123)


# -- scalar functions --------------------------------------------------------------------------

@query("""
SELECT event_id, CASE WHEN value < 10 THEN '$0 - $9.99' WHEN value < 20 THEN '$10 - $19.99'
                      WHEN value IS NOT NULL THEN ' > $20' END AS fare_band FROM events""")
def fare_bands(t):
    return t.events.select("event_id", fare_band("value").alias("fare_band"))


@query("""
SELECT o_orderkey, CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS INTEGER) AS done FROM orders""")
def label_numbers(t):
    return t.orders.select("o_orderkey", label_to_int("o_orderstatus", {"F": 1, "O": 0}).alias("done"))


@query("SELECT c_custkey, c_name FROM customer WHERE upper(c_mktsegment) LIKE '%G%'")
def names_like(t):
    return t.customer.filter(name_like("c_mktsegment", "%G%")).select("c_custkey", "c_name")


@query("""
SELECT page_id, regexp_replace(url, '^https?://[^/]*/', 'https://shop.example.com/') AS url FROM pages""")
def moved_urls(t):
    return t.pages.select("page_id", swap_url_host("url").alias("url"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'not a date'
                        ELSE strftime(o_orderdate, '%m-%d-%Y %H:%M:%S') END AS raw,
       CASE WHEN o_orderkey % 10 <> 0 THEN o_orderdate END AS parsed,
       CASE WHEN o_orderkey % 10 <> 0 THEN CAST(date_diff('day', o_orderdate, TIMESTAMP '2002-01-01') AS INTEGER) END AS age_days
FROM orders""")
def text_dates(t):
    raw = F.when(F.col("o_orderkey") % 10 == 0, "not a date").otherwise(formatted("o_orderdate"))
    parsed = t.orders.select("o_orderkey", raw.alias("raw")).withColumn("parsed", parse_timestamp("raw"))
    return parsed.select(
        "o_orderkey", "raw", F.col("parsed").cast("timestamp_ntz").alias("parsed"),
        days_between("parsed", F.lit("2002-01-01").cast("date")).alias("age_days"),
    )


@query("""
SELECT event_id, date_trunc('second', ts) AS second,
       date_trunc('milliseconds', ts) AS from_millis,
       CAST(isodow((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York') >= 6 AS INTEGER) AS is_weekend
FROM events""")
def event_times(t):
    zoned = F.col("ts").cast("timestamp")
    return t.events.select(
        "event_id",
        whole_second("ts").cast("timestamp_ntz").alias("second"),
        epoch_millis(F.unix_millis(zoned)).cast("timestamp_ntz").alias("from_millis"),
        weekend_flag("ts", source_zone="UTC").alias("is_weekend"),
    )


@query("""
SELECT c_custkey, sha1(lower(c_name) || '@mail.example.com') AS email,
       list_aggregate(list_transform(string_split(lower(c_mktsegment) || ' customer', ' '),
                                     lambda w: upper(w[1]) || w[2:]), 'string_agg', ' ') AS title,
       upper(c_name) AS loud,
       substr(md5('7|short|' || c_custkey), 1, 10) AS short_id,
       CASE WHEN CAST('0x' || substr(md5('7|null|' || c_custkey), 1, 8) AS BIGINT) / 4294967296.0 < 0.98
            THEN md5('7|id|' || c_custkey) END AS long_id
FROM customer""")
def text_functions(t):
    return t.customer.select(
        "c_custkey",
        pseudonym(F.concat(F.lower("c_name"), F.lit("@mail.example.com"))).alias("email"),
        initial_caps(F.concat(F.lower("c_mktsegment"), F.lit(" customer"))).alias("title"),
        F.upper("c_name").alias("loud"),
        random_id(7, "short", "c_custkey", length=10).alias("short_id"),
        F.when(unit_of(7, "null", "c_custkey") < 0.98, random_id(7, "id", "c_custkey")).alias("long_id"),
    )


@query("""
WITH dirty AS (SELECT l_orderkey, l_linenumber,
  CASE WHEN l_partkey % 7 = 0 THEN ' ' ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || '.5' END AS txt FROM lineitem)
SELECT l_orderkey, l_linenumber, TRY_CAST(txt AS DOUBLE) AS number, CAST(trunc(TRY_CAST(txt AS DOUBLE)) AS INTEGER) AS whole
FROM dirty""")
def dirty_numbers(t):
    text = F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(".5"))
    dirty = t.lineitem.select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_partkey") % 7 == 0, " ").otherwise(text).alias("txt")
    )
    return dirty.select(
        "l_orderkey", "l_linenumber", lenient_double("txt").alias("number"), lenient_int("txt").alias("whole")
    )


# -- files -------------------------------------------------------------------------------------

@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def json_round_trip(t):
    path = scratch_path(t.spark, "json")
    writers.save_json(t.customer, path)
    return readers.read_json(t.spark, path, t.customer.schema)


@query("""
SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey FROM supplier""")
def csv_gzip_round_trip(t):
    path = scratch_path(t.spark, "csv")
    rows = t.supplier.select("s_suppkey", "s_name", "s_nationkey")
    rows.write.option("header", True).option("compression", "gzip").csv(path)
    return readers.read_csv(t.spark, path, spread=t.spark.sparkContext.defaultParallelism)


@query("""
SELECT n_nationkey AS id, n_name AS name, CAST(NULL AS DOUBLE) AS balance FROM nation
UNION ALL SELECT CAST(s_suppkey AS INTEGER), s_name, s_acctbal FROM supplier""")
def append_with_new_column(t):
    path = scratch_path(t.spark, "append")
    t.nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")).write.parquet(path)
    more = t.supplier.select(
        F.col("s_suppkey").cast("int").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")
    )
    return writers.append_evolving(more, path)


@query("""
SELECT o_custkey AS user_id, count(*) AS order_count, max(o_totalprice) AS largest FROM orders GROUP BY o_custkey""")
def table_from_select(t):
    """A catalog table made from a query, over the table of an earlier run, and read back."""
    name = "millrace_stats_" + uuid.uuid4().hex[:8]
    path = scratch_path(t.spark, "tables")
    rows = t.orders.groupBy(F.col("o_custkey").alias("user_id"))
    writers.save_table(rows.agg(F.count("*").alias("order_count")), name, path=path)
    made = writers.save_table(
        rows.agg(F.count("*").alias("order_count"), F.max("o_totalprice").alias("largest")), name, path=path
    )
    catalog.drop_table(t.spark, name)  # the files stay, and the DataFrame has their folder already
    return made


@query("""
SELECT n_name AS name, CAST(n_nationkey AS VARCHAR) AS date, CAST(NULL AS INTEGER) AS region FROM nation
WHERE n_name <> 'NATION_3' UNION ALL SELECT s_name, NULL, s_nationkey FROM supplier""")
def evolving_table(t):
    """A run table: made empty, appended to, given a new column, and one name deleted."""
    name = "millrace_runs_" + uuid.uuid4().hex[:8]
    path = scratch_path(t.spark, "tables")
    empty = t.spark.createDataFrame([], "name string, date string")
    writers.save_table(empty, name, path=path)
    writers.append_evolving_table(
        t.nation.select(F.col("n_name").alias("name"), F.col("n_nationkey").cast("string").alias("date")), name
    )
    writers.append_evolving_table(t.supplier.select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("region")), name)
    left = writers.delete_rows(t.spark, name, F.col("name") == "NATION_3")
    catalog.drop_table(t.spark, name)
    return left
