"""Registered queries: silver tables, customer-360, churn labels and generated data."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import formatted
from millrace.operators import synth
from millrace.operators.aggregates import first_by
from millrace.operators.quality import null_key_report
from millrace.plans.customers import customer_360 as customer_360_of
from millrace.plans.registry import Tables, query
from millrace.streaming import silver

RAW_USERS_SQL = """
raw_users AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, lower(c_mktsegment) || ' user' AS firstname, upper(c_name) AS lastname,
         lower(c_name) || '@mail.example.com' AS email,
         CASE WHEN c_custkey % 50 = 7 THEN 'unknown'
              ELSE strftime(TIMESTAMP '2020-01-01' + to_days(CAST(c_custkey % 1000 AS INTEGER)), '%m-%d-%Y %H:%M:%S') END AS creation_date,
         strftime(TIMESTAMP '2024-01-01 10:20:30' + to_days(CAST(c_custkey % 30 AS INTEGER)), '%m-%d-%Y %H:%M:%S') AS last_activity_date,
         CAST(c_nationkey AS DOUBLE) AS age_group, CAST(c_custkey % 2 AS DOUBLE) AS gender, c_acctbal < 0 AS churn
  FROM customer)"""

SILVER_USERS_SQL = """
silver_users AS (
  SELECT id AS user_id,
         list_aggregate(list_transform(string_split(firstname, ' '), lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', ' ') AS firstname,
         list_aggregate(list_transform(string_split(lastname, ' '), lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', ' ') AS lastname,
         sha1(email) AS email, try_strptime(creation_date, '%m-%d-%Y %H:%M:%S') AS creation_date,
         try_strptime(last_activity_date, '%m-%d-%Y %H:%M:%S') AS last_activity_date,
         CAST(age_group AS INTEGER) AS age_group, CAST(gender AS INTEGER) AS gender, CAST(churn AS INTEGER) AS churn
  FROM raw_users)"""


def raw_users(t: Tables):
    """Customers in the form of raw user records: dates as text (some bad), numbers as double."""
    def day(start, modulus):
        days = (F.col("c_custkey") % modulus).cast("int")
        return formatted(F.lit(start).cast("timestamp_ntz") + F.make_dt_interval(days))

    return t.customer.select(
        F.col("c_custkey").cast("string").alias("id"),
        F.concat(F.lower("c_mktsegment"), F.lit(" user")).alias("firstname"),
        F.upper("c_name").alias("lastname"),
        F.concat(F.lower("c_name"), F.lit("@mail.example.com")).alias("email"),
        F.when(F.col("c_custkey") % 50 == 7, "unknown").otherwise(day("2020-01-01", 1000)).alias("creation_date"),
        day("2024-01-01 10:20:30", 30).alias("last_activity_date"),
        F.col("c_nationkey").cast("double").alias("age_group"),
        (F.col("c_custkey") % 2).cast("double").alias("gender"),
        (F.col("c_acctbal") < 0).alias("churn"),
    )


def raw_orders(t: Tables):
    return t.orders.select(
        F.col("o_custkey").cast("string").alias("user_id"), F.col("o_orderkey").cast("string").alias("id"),
        formatted("o_orderdate").alias("transaction_date"),
        (F.col("o_orderkey") % 3 + 1).cast("double").alias("item_count"), F.col("o_totalprice").alias("amount"),
    )


def app_events(t: Tables):
    return t.events.select(
        F.col("user_id").cast("string").alias("user_id"), "event_id", F.col("event_type").alias("platform"),
        F.when(F.col("event_id") % 7 == 3, "unknown").otherwise(formatted("ts")).alias("date"), F.concat_ws("-", "user_id", F.dayofmonth("ts")).alias("session_id"), "ts",
    )


def plain_times(df):
    """Zoned timestamps as plain ones, as DuckDB has them."""
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n, kind in df.dtypes if kind == "timestamp"})


@query(f"WITH {RAW_USERS_SQL}, {SILVER_USERS_SQL} SELECT * FROM silver_users")
def silver_users(t):
    return plain_times(silver.silver_users(raw_users(t)))


@query("""
SELECT CAST(o_custkey AS VARCHAR) AS user_id, CAST(o_orderkey AS VARCHAR) AS order_id,
       strftime(o_orderdate, '%m-%d-%Y %H:%M:%S') AS transaction_date,
       CAST(o_orderkey % 3 + 1 AS INTEGER) AS item_count, CAST(trunc(o_totalprice) AS INTEGER) AS amount
FROM orders""")
def silver_orders(t):
    return silver.silver_orders(raw_orders(t))


CUSTOMER_360_SQL = f"""
WITH {RAW_USERS_SQL}, {SILVER_USERS_SQL},
order_stats AS (
  SELECT CAST(o_custkey AS VARCHAR) AS user_id, count(*) AS order_count,
         CAST(sum(CAST(trunc(o_totalprice) AS INTEGER)) AS BIGINT) AS total_amount,
         CAST(sum(o_orderkey % 3 + 1) AS BIGINT) AS total_item
  FROM orders GROUP BY ALL),
event_stats AS (
  SELECT CAST(user_id AS VARCHAR) AS user_id,
         arg_min(event_type, (coalesce(known, TIMESTAMP '9999-01-01'), event_id)) AS platform,
         count(*) AS event_count, count(DISTINCT user_id || '-' || day(ts)) AS session_count, max(known) AS last_event
  FROM (SELECT *, CASE WHEN event_id % 7 <> 3 THEN date_trunc('second', ts) END AS known FROM events) GROUP BY ALL)
SELECT *, CAST(date_diff('day', creation_date, TIMESTAMP '2024-02-01') AS INTEGER) AS days_since_creation,
       CAST(date_diff('day', last_activity_date, TIMESTAMP '2024-02-01') AS INTEGER) AS days_since_last_activity,
       CAST(date_diff('day', last_event, TIMESTAMP '2024-02-01') AS INTEGER) AS days_last_event
FROM silver_users JOIN order_stats USING (user_id) JOIN event_stats USING (user_id)"""


@query(CUSTOMER_360_SQL)
def customer_360(t):
    users = silver.silver_users(raw_users(t))
    orders = silver.silver_orders(raw_orders(t))
    return plain_times(
        customer_360_of(users, orders, app_events(t).drop("ts"), as_of=F.lit("2024-02-01").cast("date"))
    )


@query("""
WITH o AS (SELECT o_custkey AS user_id, count(*) AS orders, CAST(sum(o_orderkey % 3 + 1) AS BIGINT) AS items FROM orders GROUP BY ALL),
     e AS (SELECT user_id, count(*) AS event_count, arg_min(event_type, (ts, event_id)) AS first_type FROM events GROUP BY ALL)
SELECT user_id, orders, items, event_count, first_type,
       CAST(5 + CASE WHEN (orders >= 5 AND first_type = 'view') OR (orders = 3 AND gender = 0)
         OR (orders = 2 AND gender = 1 AND age_group <= 3) OR (items <= 1 AND first_type = 'click')
         OR (items >= 10 AND first_type = 'view') OR event_count >= 60 OR segment = 'BUILDING'
         OR days >= 900 OR (age_group >= 7 AND gender = 0) OR (age_group <= 2 AND gender = 1)
       THEN 80 ELSE 20 END AS INTEGER) AS chance
FROM o JOIN e USING (user_id)
JOIN (SELECT c_custkey, c_custkey % 2 AS gender, c_nationkey % 11 AS age_group, c_mktsegment AS segment,
             c_custkey % 1000 AS days FROM customer) c ON user_id = c_custkey""")
def churn_rules(t):
    """The churn rules on stand-in columns, scaled so that the thresholds fit the tables' counts."""
    o = t.orders.groupBy(F.col("o_custkey").alias("user_id")).agg(
        F.count("*").alias("orders"), F.sum(F.col("o_orderkey") % 3 + 1).alias("items")
    )
    e = t.events.groupBy("user_id").agg(
        F.count("*").alias("event_count"), first_by("event_type", "ts", "event_id").alias("first_type")
    )
    c = t.customer.select(
        "c_custkey", (F.col("c_custkey") % 2).alias("gender"), (F.col("c_nationkey") % 11).alias("age_group"),
        F.when(F.col("c_mktsegment") == "BUILDING", "USA").otherwise("FR").alias("country"),
        F.floor(F.col("c_custkey") % 1000 / 10).alias("days"),
    )
    joined = o.join(e, ["user_id"]).join(c, F.col("user_id") == F.col("c_custkey")).withColumns({
        "platform": F.when(F.col("first_type") == "view", "ios").when(F.col("first_type") == "click", "android"),
        "actions": F.floor(F.col("event_count") / 15),
    })
    return joined.select("user_id", "orders", "items", "event_count", "first_type", synth.churn_chance().alias("chance"))


@query("""
SELECT 'customers' AS name, count(*) AS row_count, count(*) FILTER (c_acctbal < 0) AS null_keys FROM customer
UNION ALL SELECT 'orders', count(*), 0 FROM orders""")
def null_keys(t):
    unkeyed = t.customer.select(F.when(F.col("c_acctbal") >= 0, F.col("c_custkey")).alias("user_id"))
    return null_key_report({"customers": (unkeyed, "user_id"), "orders": (t.orders, "o_custkey")})


# -- generated data, one user per customer row -------------------------------------------------

def _unit(field: str, key: str) -> str:
    return f"(CAST('0x' || substr(md5('0|{field}|' || {key}), 1, 8) AS BIGINT) / 4294967296.0)"


def _weighted(values, field: str, key: str) -> str:
    total, reached, arms = sum(w for _, w in values), 0.0, []
    for value, weight in values[:-1]:
        reached += weight / total
        arms.append(f"WHEN {_unit(field, key)} < {reached!r} THEN '{value}'")
    return f"CASE {' '.join(arms)} END"


def _picked(values, field: str, key: str) -> str:
    items = ", ".join(f"'{v}'" for v in values)
    return f"[{items}][CAST(floor({_unit(field, key)} * {len(values)}) AS INTEGER) + 1]"


def _day_in(start: str, days: int, field: str, key: str) -> str:
    """A second within so many days of a SQL timestamp, as text."""
    return f"strftime({start} + to_seconds(CAST(floor({_unit(field, key)} * {days * 86400}) AS BIGINT)), '%m-%d-%Y %H:%M:%S')"


MADE_ORDERS_SQL = f"""
made_orders AS (
  SELECT user_id, md5('0|order|' || user_id || '|' || nr) AS id,
         {_day_in("TIMESTAMP '2024-01-02'", 30, 'date', "user_id || '|' || nr")} AS transaction_date,
         floor({_unit('items', "user_id || '|' || nr")} * 2 + 0.5) + 1 AS item_count,
         (floor({_unit('items', "user_id || '|' || nr")} * 2 + 0.5) + 1)
           * floor({_unit('price', "user_id || '|' || nr")} * 30 + 10.5) AS amount
  FROM (SELECT c_custkey AS user_id, greatest(CAST(trunc(greatest(
               3.0 + 2.0 * sqrt(-2.0 * ln(1.0 - {_unit('orders:r', 'c_custkey')})) * cos(2 * pi() * {_unit('orders:a', 'c_custkey')}),
               0.0)) AS INTEGER) - 1, 0) AS n FROM customer) u, unnest(range(1, n + 1)) s(nr))"""


def made_orders(t: Tables):
    return synth.user_orders(t.customer.select("c_custkey"), "c_custkey")


@query(f"WITH {MADE_ORDERS_SQL} SELECT * FROM made_orders")
def generated_orders(t):
    return made_orders(t)


@query(f"""
WITH {MADE_ORDERS_SQL}, keyed AS (SELECT user_id, user_id || '|' || id || '|1' AS k FROM made_orders)
SELECT user_id, md5('0|event|' || k) AS event_id, {_weighted(synth.PLATFORMS, 'platform', 'k')} AS platform,
       {_day_in("TIMESTAMP '2024-01-02'", 30, 'event_date', 'k')} AS date,
       {_weighted(synth.ACTIONS, 'action', 'k')} AS action, md5('0|session|' || k) AS session_id,
       'https://shop.example.com/' || substr(md5('0|page|' || k), 1, 8) AS url
FROM keyed""")
def generated_events(t):
    return synth.user_events(made_orders(t))


def made_users(t: Tables):
    cohort = (F.col("c_custkey") % (synth.COHORTS + 1)).cast("int")
    return synth.user_columns(t.customer.select("c_custkey", cohort.alias("cohort")), "c_custkey", "2024-02-01")


_OPENED = "TIMESTAMP '2024-02-01' - to_days(CAST((24 - c_custkey % 24) * 30 AS INTEGER))"
MADE_USERS_SQL = f"""
made_users AS (
  SELECT CASE WHEN {_unit('null', 'c_custkey')} < 0.98 THEN md5('0|id|' || c_custkey) END AS id,
         {_picked(synth.FIRST_NAMES, 'first', 'c_custkey')} AS firstname, {_picked(synth.LAST_NAMES, 'last', 'c_custkey')} AS lastname,
         {_picked(synth.FIRST_NAMES, 'first', 'c_custkey')} || '.' || {_picked(synth.LAST_NAMES, 'last', 'c_custkey')}
           || '@mail.example.com' AS email,
         CAST(CAST(floor({_unit('house', 'c_custkey')} * 999) + 1 AS BIGINT) AS VARCHAR) || ' Mill Lane' AS address,
         {_weighted(synth.CANALS, 'canal', 'c_custkey')} AS canal, {_picked(synth.COUNTRIES, 'country', 'c_custkey')} AS country,
         CASE WHEN c_custkey % 24 = 0 THEN {_day_in("TIMESTAMP '2012-01-01'", 1460, 'old', 'c_custkey')}
              ELSE {_day_in(_OPENED, 30, 'created', 'c_custkey')} END AS creation_date,
         {_day_in("TIMESTAMP '2024-01-02'", 30, 'active', 'c_custkey')} AS last_activity_date,
         floor({_unit('gender', 'c_custkey')} + 0.2 + 0.5) AS gender, floor({_unit('age', 'c_custkey')} * 10 + 0.5) AS age_group
  FROM customer)"""


@query(f"WITH {MADE_USERS_SQL} SELECT * FROM made_users")
def generated_users(t):
    return made_users(t)


@query(f"""
WITH {MADE_USERS_SQL}, people AS (
  SELECT md5('0|id|' || c_custkey) AS id, {_picked(synth.COUNTRIES, 'country', 'c_custkey')} AS country,
         floor({_unit('gender', 'c_custkey')} + 0.7) AS gender, floor({_unit('age', 'c_custkey')} * 10 + 0.5) AS age_group,
         CASE WHEN c_custkey % 24 = 0 THEN TIMESTAMP '2012-01-01' + to_seconds(CAST(floor({_unit('old', 'c_custkey')} * 126144000) AS BIGINT))
              ELSE TIMESTAMP '2024-02-01' - to_days(CAST((24 - c_custkey % 24) * 30 AS INTEGER))
                   + to_seconds(CAST(floor({_unit('created', 'c_custkey')} * 2592000) AS BIGINT)) END AS created
  FROM customer WHERE {_unit('null', 'c_custkey')} < 0.98),
{MADE_ORDERS_SQL.replace('c_custkey AS user_id', 'id AS user_id').replace("c_custkey", "id").replace("FROM customer", "FROM people")},
o AS (SELECT user_id, CAST(sum(item_count) AS BIGINT) AS items, count(*) AS orders FROM made_orders GROUP BY ALL),
keyed AS (SELECT user_id, user_id || '|' || id || '|1' AS k FROM made_orders),
e AS (SELECT user_id, count(*) AS actions, arg_min_null(platform, (sec, event_id)) AS platform FROM (
        SELECT user_id, md5('0|event|' || k) AS event_id, {_weighted(synth.PLATFORMS, 'platform', 'k')} AS platform,
               floor({_unit('event_date', 'k')} * 2592000) AS sec FROM keyed) GROUP BY ALL)
SELECT made_users.*, churn FROM (SELECT id AS labelled,
       {_unit('churn', 'id')} * 100 < 5 + CASE WHEN {' OR '.join(f'coalesce({r}, false)' for r in synth.CHURN_RULES)} THEN 80 ELSE 20 END AS churn
FROM (SELECT *, date_diff('day', created, TIMESTAMP '2024-02-01') AS days FROM people) p
JOIN o ON p.id = o.user_id JOIN e ON p.id = e.user_id) JOIN made_users ON made_users.id = labelled""")
def generated_churn(t):
    """Labels for generated users, whose orders and events follow from their generated ids."""
    people = made_users(t)
    orders = synth.user_orders(people.filter(F.col("id").isNotNull()), "id")
    labelled = synth.label_churn(people, orders, synth.user_events(orders))
    return labelled


@query(f"""
SELECT c_custkey AS customer_id,
       upper({_picked(synth.FIRST_NAMES, 'crm_first', 'c_custkey')}[1]) || {_picked(synth.FIRST_NAMES, 'crm_first', 'c_custkey')}[2:] AS first_name,
       upper({_picked(synth.LAST_NAMES, 'crm_last', 'c_custkey')}[1]) || {_picked(synth.LAST_NAMES, 'crm_last', 'c_custkey')}[2:] AS last_name,
       {_picked(synth.FIRST_NAMES, 'crm_first', 'c_custkey')} || '.' || {_picked(synth.LAST_NAMES, 'crm_last', 'c_custkey')} || '@crm.example.com' AS email,
       '555-' || lpad(CAST(CAST(floor({_unit('crm_phone', 'c_custkey')} * 10000000) AS BIGINT) AS VARCHAR), 7, '0') AS phone
FROM customer""")
def generated_crm_customers(t):
    return synth.crm_customers(t.customer.select(F.col("c_custkey").alias("id")))


@query(f"""
SELECT o_orderkey AS order_id, CAST(floor({_unit('crm_order', 'o_orderkey')} * 1000) + 1 AS BIGINT) AS customer_id,
       DATE '2024-01-01' + CAST(floor({_unit('crm_order_date', 'o_orderkey')} * 365) AS INTEGER) AS order_date,
       CAST(floor({_unit('crm_amount', 'o_orderkey')} * 100000) AS BIGINT) AS amount FROM orders""")
def generated_crm_orders(t):
    return synth.crm_orders(t.orders.select(F.col("o_orderkey").alias("id")))


@query(f"""
SELECT event_id AS interaction_id, CAST(floor({_unit('crm_contact', 'event_id')} * 1000) + 1 AS BIGINT) AS customer_id,
       DATE '2024-01-01' + CAST(floor({_unit('crm_contact_date', 'event_id')} * 365) AS INTEGER) AS interaction_date,
       {_picked(synth.CHANNELS, 'crm_channel', 'event_id')} AS channel,
       concat_ws(' ', {', '.join(_picked(synth.WORDS, f'note{i}', 'event_id') for i in range(6))}) AS notes FROM events""")
def generated_crm_interactions(t):
    return synth.crm_interactions(t.events.select(F.col("event_id").alias("id")))
