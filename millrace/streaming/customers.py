"""Customer-360 kept up to date batch by batch."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from millrace.functions.times import days_between, parse_timestamp
from millrace.operators.store import FeatureTable

_FIRST = ("first_undated", "first_when", "first_event", "platform")


@dataclass
class CustomerStates:
    """What the rows of each batch add to each user, in three keyed tables.

    ``users`` holds the last record of each user. ``orders`` has a row of sums for each user and batch, ``sessions`` a row for
    each user, session and batch: its first event, the number of events and the time of the last. Rows of
    a batch are new keys, so they are written beside the old ones, and users that a batch does not name are left as
    they are. Counts, sums, earliest and latest merge in any order, so late batches count in full.
    """

    users: FeatureTable
    orders: FeatureTable
    sessions: FeatureTable

    @classmethod
    def create(cls, spark: SparkSession, path: str, users: T.StructType, event_id: str = "long") -> CustomerStates:
        """Empty states at ``path`` for silver users of this schema."""
        orders = "user_id string, batch string, order_count long, total_amount long, total_item long"
        sessions = (
            "user_id string, session string, batch string, first_undated boolean, first_when timestamp, "
            f"first_event {event_id}, platform string, event_count long, last_event timestamp")
        return cls(
            FeatureTable.create(spark, f"{path}/users", "user_id", schema=users),
            FeatureTable.create(spark, f"{path}/orders", ["user_id", "batch"], schema=T.StructType.fromDDL(orders)),
            FeatureTable.create(spark, f"{path}/sessions", ["user_id", "session", "batch"], schema=T.StructType.fromDDL(sessions)))

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> CustomerStates:
        return cls(*[FeatureTable.open(spark, f"{path}/{name}") for name in ("users", "orders", "sessions")])

    def add_users(self, batch: DataFrame, batch_id: str | None = None) -> None:
        """Silver users, one row each; they replace what is known of them. Rows without an id are left out."""
        self.users.upsert(batch.filter(F.col("user_id").isNotNull()), batch_id)

    def add_orders(self, batch: DataFrame, batch_id: str | None = None) -> None:
        """Silver orders. A batch whose id was added before changes nothing, here and for events."""
        batch_id = batch_id or uuid.uuid4().hex
        self.orders.upsert(batch.filter(F.col("user_id").isNotNull()).groupBy("user_id").agg(
            F.lit(batch_id).alias("batch"), F.count("*").alias("order_count"), F.sum("amount").alias("total_amount"),
            F.sum("item_count").alias("total_item")), batch_id)

    def add_events(self, batch: DataFrame, batch_id: str | None = None, when: Column | None = None) -> None:
        """Events with user_id, session_id, event_id, platform and date; those without a date that parses come last."""
        batch_id = batch_id or uuid.uuid4().hex
        timed = batch.filter(F.col("user_id").isNotNull()).select(
            "user_id", F.coalesce(F.concat(F.lit("="), F.col("session_id").cast("string")), F.lit("")).alias("session"),
            (parse_timestamp("date") if when is None else when).cast("timestamp").alias("first_when"),
            F.col("event_id").alias("first_event"), "platform")
        timed = timed.withColumn("first_undated", F.col("first_when").isNull())
        found = timed.groupBy("user_id", "session").agg(
            F.min(F.struct(*_FIRST)).alias("first"), F.count("*").alias("event_count"), F.max("first_when").alias("last_event"))
        self.sessions.upsert(found.select(
            "user_id", "session", F.lit(batch_id).alias("batch"), "first.*", "event_count", "last_event"), batch_id)

    def _order_sums(self) -> DataFrame:
        sums = ("order_count", "total_amount", "total_item")
        return self.orders.read().groupBy("user_id").agg(*[F.sum(c).alias(c) for c in sums])

    def _sessions(self) -> DataFrame:
        return self.sessions.read().groupBy("user_id", "session").agg(
            F.min(F.struct(*_FIRST)).alias("first"), F.sum("event_count").alias("event_count"),
            F.max("last_event").alias("last_event"))

    def read(self, as_of: Column | None = None) -> DataFrame:
        """One row for each user with orders and events, as ``customer_360`` gives it for all rows at once."""
        events = self._sessions().groupBy("user_id").agg(
            F.min("first")["platform"].alias("platform"), F.sum("event_count").alias("event_count"),
            F.count_if(F.col("session") != "").alias("session_count"), F.max("last_event").alias("last_event"))
        return self.users.read().join(self._order_sums(), ["user_id"]).join(events, ["user_id"]).withColumns({
            "days_since_creation": days_between("creation_date", as_of),
            "days_since_last_activity": days_between("last_activity_date", as_of),
            "days_last_event": days_between("last_event", as_of),
        })

    def compact(self) -> None:
        """Put the rows of all batches together, one for each user or session. Replayed batches are still known."""
        self.orders.overwrite(self._order_sums().withColumn("batch", F.lit("")))
        self.sessions.overwrite(self._sessions().select(
            "user_id", "session", F.lit("").alias("batch"), "first.*", "event_count", "last_event"))
