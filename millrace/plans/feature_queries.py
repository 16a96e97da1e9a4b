"""Registered queries: window features, as-of joins, feature tables, training sets."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from millrace.functions import fare_band
from millrace.operators.asof import (
    MAX_GROUP_ROWS, Features, asof_join, asof_join_all, keyed_lookup,
)
from millrace.operators.keys import hot_groups
from millrace.operators.leafwise import LeafwiseTrees
from millrace.operators.onehot import one_hot
from millrace.operators.stages import Bands
from millrace.operators.store import FeatureTable, upserted
from millrace.operators.training import FeatureLookup, TrainingSet, save_model, score_batch, score_saved
from millrace.operators.windows import sliding_mean_count
from millrace.plans.features import churn_features, dropoff_features, pickup_features, weekend_totals
from millrace.plans.registry import Tables, query
from millrace.session import cut_lineage, scratch_path

PICKUP_SQL = """
pickup AS (
  SELECT user_id AS zip, time_bucket(INTERVAL '15 minutes', ts) + INTERVAL '15 minutes' * (step + 1) AS ts,
         CAST(CAST(avg(value) AS FLOAT) AS DOUBLE) AS mean_fare_window_1h,
         CAST(count(*) AS INTEGER) AS count_trips_window_1h
  FROM {source}, range(0, 4) steps(step) GROUP BY ALL)"""

DROPOFF_SQL = """
dropoff AS (
  SELECT zip, ts, count_trips_window_30m,
         CAST(isodow((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York') >= 6 AS INTEGER) AS is_weekend
  FROM (SELECT user_id AS zip, time_bucket(INTERVAL '30 minutes', ts) + INTERVAL '30 minutes' AS ts,
               CAST(count(*) AS INTEGER) AS count_trips_window_30m
        FROM {source} GROUP BY ALL))"""

PICKUP_EVENTS, DROPOFF_EVENTS = PICKUP_SQL.format(source="events"), DROPOFF_SQL.format(source="events")


def pickup(t: Tables, key: str = "user_id", **options):
    """Pickup features of the events; the mean as double, which DuckDB can be compared with."""
    found = pickup_features(t.events, options.pop("ts", None), key=key, value="value", time_column="ts", **options)
    return found.select(
        "zip", "ts",
        F.col("mean_fare_window_1h_pickup_zip").cast("double").alias("mean_fare_window_1h"),
        F.col("count_trips_window_1h_pickup_zip").alias("count_trips_window_1h"),
    )


def dropoff(t: Tables, **options):
    found = dropoff_features(t.events, options.pop("ts", None), key="user_id", time_column="ts", **options)
    return found.select(
        "zip", "ts", F.col("count_trips_window_30m_dropoff_zip").alias("count_trips_window_30m"),
        F.col("dropoff_is_weekend").alias("is_weekend"),
    )


def hot_users(t: Tables) -> list[tuple]:
    """Users with too many events for one task. A user has at most five feature rows per event, so
    this one column tells for all sides of the as-of join, before any window is computed."""
    return [row[:-1] for row in hot_groups([t.events], ["user_id"], MAX_GROUP_ROWS // 6)]


@query(f"WITH {PICKUP_EVENTS} SELECT * FROM pickup")
def sliding_features(t):
    return pickup(t)


@query("""
WITH panes AS (
  SELECT event_type, time_bucket(INTERVAL '15 minutes', ts) + INTERVAL '15 minutes' * (step + 1) AS ts, value
  FROM events, range(0, 4) steps(step))
SELECT event_type, ts, round(avg(value), 6) AS mean, CAST(count(*) AS INTEGER) AS n FROM panes GROUP BY ALL""")
def sliding_features_by_panes(t):
    return sliding_mean_count(t.events, "event_type", "ts", "value", 4, "15 minutes").select(
        "event_type", F.col("window_end").alias("ts"), F.round("mean", 6).alias("mean"),
        F.col("n").cast("int").alias("n"),
    )


@query(f"WITH {DROPOFF_EVENTS} SELECT * FROM dropoff")
def tumbling_weekend(t):
    return dropoff(t)


RANGE = "(SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20')"


@query(f"WITH {PICKUP_SQL.format(source=RANGE)} SELECT * FROM pickup")
def range_features(t):
    return pickup(t, ts="ts", start="2024-01-10", end="2024-01-20")


@query(f"""
WITH {PICKUP_EVENTS} SELECT * FROM pickup WHERE ts > TIMESTAMP '2024-01-10' AND ts <= TIMESTAMP '2024-01-20'""")
def whole_window_features(t):
    return pickup(t, ts="ts", start="2024-01-10", end="2024-01-20", whole_windows=True)


@query(f"""
WITH {DROPOFF_EVENTS}
SELECT is_weekend, CAST(sum(count_trips_window_30m) AS BIGINT) AS num_rides FROM dropoff
WHERE is_weekend IS NOT NULL GROUP BY is_weekend""")
def weekend_rides(t):
    return weekend_totals(dropoff(t), "count_trips_window_30m", "is_weekend")


# -- as-of joins -------------------------------------------------------------------------------

@query(f"""
WITH {PICKUP_EVENTS}, {DROPOFF_EVENTS}
SELECT e.event_id, e.user_id, e.value, p.mean_fare_window_1h, p.count_trips_window_1h,
       d.count_trips_window_30m, d.is_weekend
FROM events e
ASOF LEFT JOIN pickup p ON e.user_id = p.zip AND e.ts > p.ts
ASOF LEFT JOIN dropoff d ON e.user_id = d.zip AND e.ts > d.ts""")
def asof_training_set(t):
    rows = t.events.select("event_id", "user_id", "ts", "value")
    sides = [
        Features(pickup(t), ["zip"], "ts", ["mean_fare_window_1h", "count_trips_window_1h"]),
        Features(dropoff(t), ["zip"], "ts", ["count_trips_window_30m", "is_weekend"]),
    ]
    return asof_join_all(rows, sides, keys="user_id", left_ts="ts", hot_keys=hot_users(t)).drop("ts")


DAILY_SQL = """
daily AS (SELECT o_custkey, o_orderdate, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents,
                 count(*) AS n FROM orders GROUP BY ALL)"""


def daily_totals(t: Tables):
    return t.orders.groupBy("o_custkey", "o_orderdate").agg(
        F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("cents"), F.count("*").alias("n")
    )


def orders_with_daily(t: Tables, inclusive: bool):
    hot = [row[:-1] for row in hot_groups([t.orders], ["o_custkey"], MAX_GROUP_ROWS // 2)]
    return asof_join(
        t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), daily_totals(t), keys="o_custkey",
        left_ts="o_orderdate", right_ts="o_orderdate", values=["cents", "n"], inclusive=inclusive, hot_keys=hot,
    )


@query(f"""
WITH {DAILY_SQL}
SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, d.cents, d.n FROM orders o
ASOF LEFT JOIN daily d ON o.o_custkey = d.o_custkey AND o.o_orderdate > d.o_orderdate""")
def asof_strict_ties(t):
    return orders_with_daily(t, inclusive=False)


@query(f"""
WITH {DAILY_SQL}
SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, d.cents, d.n FROM orders o
ASOF LEFT JOIN daily d ON o.o_custkey = d.o_custkey AND o.o_orderdate >= d.o_orderdate""")
def asof_inclusive(t):
    return orders_with_daily(t, inclusive=True)


@query("""
WITH hourly AS (SELECT event_type, time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS ts, count(*) AS n
                FROM events GROUP BY ALL)
SELECT e.event_id, h.n AS last_hour FROM events e
ASOF LEFT JOIN hourly h ON e.event_type = h.event_type AND e.ts > h.ts""")
def asof_hot_keys(t):
    """Five keys hold everything here, so all of them are cut by week and the weeks are salted."""
    hourly = t.events.groupBy("event_type", F.window("ts", "1 hour").alias("w")).agg(
        F.count("*").alias("last_hour")
    ).select("event_type", F.col("w.end").alias("ts"), "last_hour")
    rows = t.events.select("event_id", "event_type", "ts")
    share = max(1, min(MAX_GROUP_ROWS, t.events.count() // 100))
    return asof_join(
        rows, hourly, keys="event_type", left_ts="ts", right_ts="ts", values=["last_hour"],
        max_group_rows=share, bin_seconds=7 * 86400,
    ).select("event_id", "last_hour")


@query("""
SELECT o_orderkey, o_custkey, c_mktsegment, c_acctbal FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def static_lookup(t):
    return keyed_lookup(
        t.orders.select("o_orderkey", "o_custkey"), t.customer, keys="o_custkey", right_keys="c_custkey",
        values=["c_mktsegment", "c_acctbal"],
    )


# -- feature tables ----------------------------------------------------------------------------

FIRST_HALF = "(SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-16')"
SECOND_HALF = "(SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-15')"
UPSERT_SQL = f"""
WITH {PICKUP_SQL.format(source=FIRST_HALF).replace("pickup AS", "old AS")},
     {PICKUP_SQL.format(source=SECOND_HALF).replace("pickup AS", "new AS")}
SELECT * FROM old WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.zip = old.zip AND new.ts = old.ts)
UNION ALL SELECT * FROM new"""


@query(UPSERT_SQL)
def upsert_features(t):
    old, new = pickup(t, ts="ts", end="2024-01-16"), pickup(t, ts="ts", start="2024-01-15")
    return upserted(old, cut_lineage(new, "new-features"), ["zip", "ts"])


@query(UPSERT_SQL)
def feature_table_merge(t):
    """The same through a stored table: create, merge a batch, replay the batch, read."""
    table = FeatureTable.create(
        t.spark, scratch_path(t.spark, "pickup"), ["zip"], df=pickup(t, ts="ts", end="2024-01-16"),
        timestamp_key="ts", description="events per user and hour",
    )
    batch = pickup(t, ts="ts", start="2024-01-15")
    table.upsert(batch, batch_id="second half")
    table.upsert(batch, batch_id="second half")
    return FeatureTable.open(t.spark, table.path).read()


@query(f"WITH {PICKUP_EVENTS} SELECT * FROM pickup WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-12'")
def feature_table_range(t):
    table = FeatureTable.create(
        t.spark, scratch_path(t.spark, "pickup"), "zip", schema=pickup(t).schema, timestamp_key="ts"
    )
    table.write(pickup(t), mode="overwrite")
    return table.read(start="2024-01-10", end="2024-01-12")


def stored_lookups(t: Tables) -> list[FeatureLookup]:
    """A time-series table and a static table, and the lookups into them."""
    trips = FeatureTable.create(
        t.spark, scratch_path(t.spark, "trips"), "zip", df=pickup(t), timestamp_key="ts"
    )
    people = FeatureTable.create(
        t.spark, scratch_path(t.spark, "people"), "c_custkey",
        df=t.customer.select("c_custkey", "c_mktsegment", "c_acctbal"),
    )
    return [
        FeatureLookup(trips.path, ["mean_fare_window_1h", "count_trips_window_1h"], ["user_id"], "ts"),
        FeatureLookup(people.path, ["c_mktsegment"], ["user_id"]),
    ]


@query(f"""
WITH {PICKUP_EVENTS}
SELECT e.event_id, e.user_id, e.value, p.mean_fare_window_1h, p.count_trips_window_1h, c.c_mktsegment
FROM events e ASOF LEFT JOIN pickup p ON e.user_id = p.zip AND e.ts > p.ts
LEFT JOIN customer c ON e.user_id = c.c_custkey""")
def stored_training_set(t):
    raw = t.events.select("event_id", "user_id", "ts", "value")
    return TrainingSet(raw, stored_lookups(t), label="value", exclude=["ts"]).to_df()


@query(f"""
WITH {PICKUP_EVENTS}
SELECT e.event_id, e.user_id, e.ts, p.mean_fare_window_1h, p.count_trips_window_1h, c.c_mktsegment,
       CASE WHEN p.mean_fare_window_1h < 10 THEN '$0 - $9.99' WHEN p.mean_fare_window_1h < 20 THEN '$10 - $19.99'
            WHEN p.mean_fare_window_1h IS NOT NULL THEN ' > $20' END AS prediction
FROM events e ASOF LEFT JOIN pickup p ON e.user_id = p.zip AND e.ts > p.ts
LEFT JOIN customer c ON e.user_id = c.c_custkey""")
def score_with_lookups(t):
    """Scoring from the saved lookups alone, with a rule for the model and a text result."""
    raw = t.events.select("event_id", "user_id", "ts")
    spec = TrainingSet(raw, stored_lookups(t)).spec()
    return score_batch(
        raw, spec, lambda df: df.withColumn("prediction", fare_band("mean_fare_window_1h")), result_type="string"
    )


@query(f"""
WITH {PICKUP_EVENTS}
SELECT e.event_id, e.user_id, e.ts, p.mean_fare_window_1h, p.count_trips_window_1h, c.c_mktsegment,
       CAST(coalesce(p.count_trips_window_1h, 0) * 2 AS VARCHAR) AS prediction
FROM events e ASOF LEFT JOIN pickup p ON e.user_id = p.zip AND e.ts > p.ts
LEFT JOIN customer c ON e.user_id = c.c_custkey""")
def score_saved_model(t):
    """A model and its lookups, saved in one folder, read back and applied to rows without features."""
    raw = t.events.select("event_id", "user_id", "ts")
    rule = SQLTransformer(statement="SELECT *, coalesce(count_trips_window_1h, 0) * 2 AS prediction FROM __THIS__")
    training = TrainingSet(raw, stored_lookups(t))
    path = scratch_path(t.spark, "model")
    save_model(Pipeline(stages=[rule]).fit(training.to_df()), training, path)
    return score_saved(raw, path, result_type="string")


@query(f"""
WITH {PICKUP_EVENTS}
SELECT e.event_id, e.user_id, e.ts, p.mean_fare_window_1h, p.count_trips_window_1h, c.c_mktsegment,
       CASE WHEN coalesce(p.count_trips_window_1h, 0) < 1 THEN 'none' WHEN p.count_trips_window_1h < 2 THEN 'one'
            WHEN p.count_trips_window_1h < 4 THEN 'some' ELSE 'many' END AS prediction
FROM events e ASOF LEFT JOIN pickup p ON e.user_id = p.zip AND e.ts > p.ts
LEFT JOIN customer c ON e.user_id = c.c_custkey""")
def score_trained_bands(t):
    """Trees trained on looked-up features and bands of what they say, saved, loaded again, and applied with the lookups.

    The label is twice the count of trips that a lookup gives, so the right band of each event is known.
    """
    raw = t.events.select("event_id", "user_id", "ts")
    lookups = stored_lookups(t)
    training = TrainingSet(raw, lookups)
    rows = cut_lineage(training.to_df().withColumn("label", F.coalesce("count_trips_window_1h", F.lit(0)) * 2.0), "training")
    stages = [
        LeafwiseTrees(inputCols=["count_trips_window_1h", "mean_fare_window_1h"], rounds=2, rate=1.0, leaves=32, leastRows=1),
        Bands("prediction", "prediction", [1.0, 3.0, 7.0], ["none", "one", "some", "many"]),
    ]
    path = scratch_path(t.spark, "model")
    save_model(Pipeline(stages=stages).fit(rows), training, path, trained=rows)
    return score_saved(raw, path)


# -- categories --------------------------------------------------------------------------------

STATUSES = ["F", "O", "P"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _flags(column: str, values: list[str], name=lambda n: n) -> str:
    return ", ".join(
        f"CAST(coalesce({column} = '{v}', false) AS BIGINT) AS \"{name(f'{column}_{v}')}\"" for v in values
    )


@query(f"""
SELECT o_orderkey, {_flags('o_orderstatus', STATUSES)}, {_flags('o_orderpriority', PRIORITIES)} FROM orders""")
def onehot_orders(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return one_hot(rows, ["o_orderstatus", "o_orderpriority"])


@query(f"""
WITH rows AS (SELECT o_orderkey, o_totalprice, o_orderpriority, o_orderstatus AS churn FROM orders)
SELECT o_orderkey, o_totalprice, CAST(CASE churn WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS INTEGER) AS churn,
       {_flags('o_orderpriority', PRIORITIES, lambda n: n.lower().replace('-', '_').replace(' ', '_'))}
FROM rows WHERE churn IN ('F', 'O')""")
def churn_frame(t):
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderpriority", F.col("o_orderstatus").alias("churn"))
    return churn_features(rows, ["o_orderpriority"], labels={"F": 1, "O": 0})


def _yes(condition: str) -> tuple[str, list[str]]:
    return f"CASE WHEN {condition} THEN 'Yes' ELSE 'No' END", ["No", "Yes"]


# Fifteen categories of an order as SQL that Spark and DuckDB share, and their values.
ORDER_CATEGORIES = {
    "priority": ("o_orderpriority", PRIORITIES),
    "segment": ("c_mktsegment", ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]),
    "region": ("r_name", ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]),
    "month": ("concat('m', month(o_orderdate))", sorted(f"m{m}" for m in range(1, 13))),
    "quarter": ("concat('q', quarter(o_orderdate))", ["q1", "q2", "q3", "q4"]),
    "third": ("CASE WHEN day(o_orderdate) <= 10 THEN 'first' WHEN day(o_orderdate) <= 20 THEN 'second' ELSE 'last' END", ["first", "last", "second"]),
    "price": ("CASE WHEN o_totalprice < 100000 THEN 'low' WHEN o_totalprice < 300000 THEN 'middle' ELSE 'high' END", ["high", "low", "middle"]),
    "balance": ("CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 5000 THEN 'some' ELSE 'much' END", ["debt", "much", "some"]),
    "urgent": _yes("o_orderpriority IN ('1-URGENT', '2-HIGH')"),
    "large": _yes("o_totalprice > 250000"),
    "indebted": _yes("c_acctbal < 0"),
    "american": _yes("r_name = 'AMERICA'"),
    "early": _yes("month(o_orderdate) <= 6"),
    "leap_year": _yes("year(o_orderdate) % 4 = 0"),
    "builder": _yes("c_mktsegment = 'BUILDING'"),
}
_CATEGORY_COLUMNS = ", ".join(f"{sql} AS {name}" for name, (sql, _) in ORDER_CATEGORIES.items())
_CATEGORY_FLAGS = ", ".join(
    _flags(name, values, lambda n: n.lower().replace("-", "_").replace(" ", "_")) for name, (_, values) in ORDER_CATEGORIES.items())


@query(f"""
WITH rows AS (
  SELECT o_orderkey, o_totalprice, o_orderstatus AS churn, {_CATEGORY_COLUMNS}
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT o_orderkey, o_totalprice, CAST(CASE churn WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS INTEGER) AS churn, {_CATEGORY_FLAGS}
FROM rows WHERE churn IN ('F', 'O')""")
def churn_frame_fifteen(t):
    """Fifteen categories at once: their values are found in one pass, and each becomes a column."""
    rows = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    categories = [F.expr(sql).alias(name) for name, (sql, _) in ORDER_CATEGORIES.items()]
    rows = rows.select("o_orderkey", "o_totalprice", F.col("o_orderstatus").alias("churn"), *categories)
    return churn_features(rows, list(ORDER_CATEGORIES), labels={"F": 1, "O": 0})
