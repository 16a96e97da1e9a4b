"""Customer-360: one row per user with order and event aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.times import days_between, parse_timestamp


def order_stats(orders: DataFrame, key: str = "user_id") -> DataFrame:
    return orders.groupBy(key).agg(
        F.count("*").alias("order_count"), F.sum("amount").alias("total_amount"),
        F.sum("item_count").alias("total_item"),
    )


def event_stats(
    events: DataFrame, key: str = "user_id", when: Column | None = None, platform: str = "platform",
    session: str = "session_id", order: str = "date", tie: str = "event_id",
) -> DataFrame:
    """Platform of the first event, event and session counts, time of the last event, per key.

    Events without a key are left out; events whose date does not parse count, but come last. The
    events are summed up by session first, so one pass counts the sessions without a distinct.
    """
    timed = events.filter(F.col(key).isNotNull()).withColumn("__when", parse_timestamp(order) if when is None else when)
    first = F.struct(F.col("__when").isNull(), "__when", F.col(tie), F.col(platform).alias("platform"))
    sessions = timed.groupBy(key, session).agg(
        F.min(first).alias("__first"), F.count("*").alias("__n"), F.max("__when").alias("__last"))
    return sessions.groupBy(key).agg(
        F.min("__first")["platform"].alias("platform"), F.sum("__n").alias("event_count"),
        F.count(session).alias("session_count"), F.max("__last").alias("last_event"),
    )


def customer_360(
    users: DataFrame, orders: DataFrame, events: DataFrame, as_of: Column | None = None,
    event_time: Column | None = None,
) -> DataFrame:
    """Users joined to what they ordered and did; users without orders or events drop out.

    Orders and events are aggregated to one row per user before the joins, so a user with a large
    share of the rows is summed up in every task first and joins as one row.
    """
    joined = users.join(order_stats(orders), ["user_id"]).join(
        event_stats(events, when=event_time), ["user_id"]
    )
    return joined.withColumns({
        "days_since_creation": days_between("creation_date", as_of),
        "days_since_last_activity": days_between("last_activity_date", as_of),
        "days_last_event": days_between("last_event", as_of),
    })
