"""Seeded test data, made on the executors from ids and hashes of them.

Each value depends on seed, field and row id only, so nothing is cached and no id list passes
through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.functions.hashing import normal_of, pick, pick_weighted, random_id, unit_of
from millrace.functions.times import days_between, formatted, parse_timestamp
from millrace.operators.aggregates import first_by
from millrace.operators.filters import score_if_any

# The categories and weights of the generated data. Weights are relative.
CANALS = (("WEBAPP", 0.5), ("MOBILE", 0.1), ("PHONE", 0.3), (None, 0.01))
PLATFORMS = (("ios", 0.5), ("android", 0.1), ("other", 0.3), (None, 0.01))
ACTIONS = (("view", 0.5), ("log", 0.1), ("click", 0.3), (None, 0.01))
COUNTRIES = ("FR", "USA", "SPAIN")
CHANNELS = ("Email", "Phone", "In Person", "Social Media")
OLD_USERS = 133
COHORTS = 23
COHORT_BASE, COHORT_STEP = 2000, 200

# Any one of these makes a user likely to leave. ``days`` counts from account creation.
CHURN_RULES = (
    "orders >= 5 AND platform = 'ios'",
    "orders = 3 AND gender = 0",
    "orders = 2 AND gender = 1 AND age_group <= 3",
    "items <= 1 AND platform = 'android'",
    "items >= 10 AND platform = 'ios'",
    "actions >= 4",
    "country = 'USA'",
    "days >= 90",
    "age_group >= 7 AND gender = 0",
    "age_group <= 2 AND gender = 1",
)
CHURN_BASE, CHURN_LIKELY, CHURN_UNLIKELY = 5, 80, 20

FIRST_NAMES = ("ada", "bo", "cleo", "dara", "eli", "fern", "gale", "hana", "ira", "juno", "kit", "lou")
LAST_NAMES = ("ames", "brook", "crane", "dale", "ellis", "frost", "grove", "hale", "irwin", "jarvis")
WORDS = ("call", "order", "late", "happy", "return", "price", "asked", "later", "again", "offer")


def cohort_size(cohort: int) -> int:
    """Users in a cohort: 0 is the old one, the others grow by a fixed step."""
    return OLD_USERS if cohort == 0 else COHORT_BASE + COHORT_STEP * cohort


def users_total() -> int:
    return sum(cohort_size(c) for c in range(COHORTS + 1))


def _between(start: Column, days: int, seed: int, field: str, *keys) -> Column:
    """A time within ``days`` days of ``start``, to the second."""
    seconds = F.floor(unit_of(seed, field, *keys) * (days * 86400)).cast("long")
    return F.timestamp_seconds(F.unix_seconds(start.cast("timestamp")) + seconds)


def users(
    spark: SparkSession, as_of: str = "2024-02-01", seed: int = 0, scale: int = 1, partitions: int | None = None
) -> DataFrame:
    """Users of 24 monthly cohorts, as one range with the cohort worked out per row.

    ``scale`` repeats the whole set of cohorts. Two in a hundred ids are null.
    """
    total = users_total() * scale
    base = spark.range(0, total, 1, partitions) if partitions else spark.range(total)
    place = F.pmod("id", F.lit(users_total()))
    cohort = F.lit(COHORTS)
    for c in reversed(range(COHORTS)):
        end = sum(cohort_size(i) for i in range(c + 1))
        cohort = F.when(place < end, c).otherwise(cohort)
    return user_columns(base.withColumn("row", F.col("id")).withColumn("cohort", cohort), "row", as_of, seed)


def user_columns(df: DataFrame, row: str, as_of: str, seed: int = 0) -> DataFrame:
    """The raw user record for each row id; ``cohort`` 0 has old creation dates."""
    now = F.lit(as_of).cast("timestamp")
    first, last = pick(FIRST_NAMES, seed, "first", row), pick(LAST_NAMES, seed, "last", row)
    months = COHORTS + 1 - F.col("cohort")
    opened = F.timestamp_seconds(F.unix_seconds(now) - months * 30 * 86400)
    old = _between(F.lit("2012-01-01"), 1460, seed, "old", row)
    return df.select(
        F.when(unit_of(seed, "null", row) < 0.98, random_id(seed, "id", row)).alias("id"),
        first.alias("firstname"),
        last.alias("lastname"),
        F.concat(first, F.lit("."), last, F.lit("@mail.example.com")).alias("email"),
        F.concat((F.floor(unit_of(seed, "house", row) * 999) + 1).cast("string"), F.lit(" Mill Lane")).alias("address"),
        pick_weighted(CANALS, seed, "canal", row).alias("canal"),
        pick(COUNTRIES, seed, "country", row).alias("country"),
        formatted(F.when(F.col("cohort") == 0, old).otherwise(_between(opened, 30, seed, "created", row))).alias("creation_date"),
        formatted(_between(F.date_sub(now, 30), 30, seed, "active", row)).alias("last_activity_date"),
        F.round(unit_of(seed, "gender", row) + 0.2).alias("gender"),
        F.round(unit_of(seed, "age", row) * 10).alias("age_group"),
    )


def orders_per_user(seed: int, user: str) -> Column:
    """Normal(3, 2) cut at 0 and to whole numbers, less one; never below 0."""
    drawn = F.greatest(normal_of(3.0, 2.0, seed, "orders", user), F.lit(0.0)).cast("int")
    return F.greatest(drawn - 1, F.lit(0))


def user_orders(ids: DataFrame, user: str, as_of: str = "2024-02-01", seed: int = 0) -> DataFrame:
    """Orders of each user. Rows are exploded where the user is; ids never leave the executors."""
    count = orders_per_user(seed, user)
    rows = ids.select(F.col(user).alias("user_id"), count.alias("n")).filter("n > 0").select(
        "user_id", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("nr")
    )
    items = F.round(unit_of(seed, "items", "user_id", "nr") * 2) + 1
    price = F.round(unit_of(seed, "price", "user_id", "nr") * 30 + 10)
    start = F.date_sub(F.lit(as_of).cast("date"), 30)
    return rows.select(
        "user_id",
        random_id(seed, "order", "user_id", "nr").alias("id"),
        formatted(_between(start, 30, seed, "date", "user_id", "nr")).alias("transaction_date"),
        items.alias("item_count"),
        (items * price).alias("amount"),
    )


def user_events(
    orders: DataFrame, as_of: str = "2024-02-01", seed: int = 0, events_per_order: int = 1
) -> DataFrame:
    """Site events for each order row: its user, platform, action, session and address."""
    rows = orders.select(
        "user_id", F.col("id").alias("order_id"),
        F.explode(F.sequence(F.lit(1), F.lit(events_per_order))).alias("nr"),
    )
    key = ("user_id", "order_id", "nr")
    start = F.date_sub(F.lit(as_of).cast("date"), 30)
    return rows.select(
        "user_id",
        random_id(seed, "event", *key).alias("event_id"),
        pick_weighted(PLATFORMS, seed, "platform", *key).alias("platform"),
        formatted(_between(start, 30, seed, "event_date", *key)).alias("date"),
        pick_weighted(ACTIONS, seed, "action", *key).alias("action"),
        random_id(seed, "session", *key).alias("session_id"),
        F.concat(F.lit("https://shop.example.com/"), random_id(seed, "page", *key, length=8)).alias("url"),
    )


def label_churn(
    users_df: DataFrame, orders_df: DataFrame, events_df: DataFrame, as_of: str = "2024-02-01", seed: int = 0
) -> DataFrame:
    """Raw users with a drawn ``churn`` flag. Users without id, orders or events drop out."""
    per_user_orders = orders_df.groupBy("user_id").agg(
        F.sum("item_count").alias("items"), F.count("*").alias("orders")
    )
    per_user_events = events_df.groupBy("user_id").agg(
        first_by("platform", parse_timestamp("date"), "event_id").alias("platform"), F.count("*").alias("actions")
    )
    joined = per_user_orders.join(per_user_events, ["user_id"]).join(
        users_df, F.col("user_id") == users_df["id"]
    )
    joined = joined.withColumn("days", days_between(parse_timestamp("creation_date"), F.lit(as_of).cast("date")))
    return joined.withColumn("churn", unit_of(seed, "churn", "id") * 100 < churn_chance()).select(
        *users_df.columns, "churn"
    )


def churn_chance() -> Column:
    """Percent chance of leaving, from the columns that ``CHURN_RULES`` name."""
    return score_if_any([F.expr(r) for r in CHURN_RULES], hit=CHURN_LIKELY, miss=CHURN_UNLIKELY, base=CHURN_BASE)


def crm_customers(ids: DataFrame, seed: int = 0) -> DataFrame:
    """A customer for each row of ``ids`` (column ``id``), such as ``spark.range(1, 1001)``."""
    first, last = pick(FIRST_NAMES, seed, "crm_first", "id"), pick(LAST_NAMES, seed, "crm_last", "id")
    digits = F.lpad(F.floor(unit_of(seed, "crm_phone", "id") * 10_000_000).cast("string"), 7, "0")
    return ids.select(
        F.col("id").alias("customer_id"),
        F.initcap(first).alias("first_name"),
        F.initcap(last).alias("last_name"),
        F.concat(first, F.lit("."), last, F.lit("@crm.example.com")).alias("email"),
        F.concat(F.lit("555-"), digits).alias("phone"),
    )


def _customer_ref(customers: int, seed: int, field: str) -> Column:
    return (F.floor(unit_of(seed, field, "id") * customers) + 1).cast("long")


def _day_of_year(year: int, seed: int, field: str) -> Column:
    return F.date_add(F.lit(f"{year}-01-01").cast("date"), F.floor(unit_of(seed, field, "id") * 365).cast("int"))


def crm_orders(ids: DataFrame, customers: int = 1000, year: int = 2024, seed: int = 0) -> DataFrame:
    """An order for each id, by one of the customers 1 to ``customers``."""
    return ids.select(
        F.col("id").alias("order_id"),
        _customer_ref(customers, seed, "crm_order").alias("customer_id"),
        _day_of_year(year, seed, "crm_order_date").alias("order_date"),
        F.floor(unit_of(seed, "crm_amount", "id") * 100_000).cast("long").alias("amount"),
    )


def crm_interactions(ids: DataFrame, customers: int = 1000, year: int = 2024, seed: int = 0) -> DataFrame:
    """A contact for each id, with one of the customers 1 to ``customers``."""
    notes = F.concat_ws(" ", *[pick(WORDS, seed, f"note{i}", "id") for i in range(6)])
    return ids.select(
        F.col("id").alias("interaction_id"),
        _customer_ref(customers, seed, "crm_contact").alias("customer_id"),
        _day_of_year(year, seed, "crm_contact_date").alias("interaction_date"),
        pick(CHANNELS, seed, "crm_channel", "id").alias("channel"),
        notes.alias("notes"),
    )
