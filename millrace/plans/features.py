"""Window features of trips (or of any keyed events) and the churn feature frame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.names import clean_columns, feature_name
from millrace.functions.numbers import label_to_int
from millrace.functions.times import weekend_flag
from millrace.operators.filters import complete_rows, time_range
from millrace.operators.onehot import one_hot
from millrace.operators.windows import sliding_mean_count, windowed

# Window lengths of the two feature groups, and the churn categories and labels.
PICKUP_WINDOW, PICKUP_SLIDE = "1 hour", "15 minutes"
DROPOFF_WINDOW = "30 minutes"
CHURN_CATEGORIES = (
    "gender", "partner", "dependents", "phone_service", "multiple_lines", "internet_service",
    "online_security", "online_backup", "device_protection", "tech_support", "streaming_tv",
    "streaming_movies", "contract", "paperless_billing", "payment_method",
)
CHURN_LABELS = {"Yes": 1, "No": 0}

Bound = datetime | str | None


def _read_from(df: DataFrame, ts: str, start: Bound, length: str) -> Bound | Column:
    """One window length before ``start``: every window that ends after it is complete then."""
    if start is None:
        return None
    return F.lit(start).cast(df.schema[ts].dataType) - F.expr(f"INTERVAL {length}")


def _inside(features: DataFrame, start: Bound, end: Bound) -> DataFrame:
    """Windows that end in (start, end]."""
    kind = features.schema["ts"].dataType
    if start is not None:
        features = features.filter(F.col("ts") > F.lit(start).cast(kind))
    if end is not None:
        features = features.filter(F.col("ts") <= F.lit(end).cast(kind))
    return features


def pickup_features(
    df: DataFrame, ts: str | None = "tpep_pickup_datetime", start: Bound = None, end: Bound = None, *,
    key: str = "pickup_zip", value: str = "fare_amount", suffix: str = "pickup_zip", out_key: str = "zip",
    time_column: str | None = None, whole_windows: bool = False, panes: bool = False,
) -> DataFrame:
    """Mean fare and trip count per key over one hour, every 15 minutes; ``ts`` is the window end.

    The range filter comes before the windows, so windows at both edges of the range hold only the
    rows inside it. ``whole_windows`` reads back far enough for complete windows and leaves out
    those that reach past the end. ``panes`` aggregates through 15-minute panes (dense keys).
    """
    column = time_column or ts or "tpep_pickup_datetime"
    low = _read_from(df, ts, start, PICKUP_WINDOW) if whole_windows and ts else start
    df = time_range(df, ts, low, end)
    if panes:
        found = sliding_mean_count(df, key, column, value, 4, PICKUP_SLIDE).select(
            key, F.col("window_end").alias("ts"), "mean", "n"
        )
    else:
        found = windowed(
            df, key, column, PICKUP_WINDOW, [F.avg(value).alias("mean"), F.count("*").alias("n")],
            slide=PICKUP_SLIDE,
        ).select(key, F.col("window.end").alias("ts"), "mean", "n")
    features = found.select(
        F.col(key).alias(out_key),
        "ts",
        F.col("mean").cast("float").alias(f"mean_fare_window_1h_{suffix}"),
        F.col("n").cast("int").alias(f"count_trips_window_1h_{suffix}"),
    )
    return _inside(features, start, end) if whole_windows else features


def dropoff_features(
    df: DataFrame, ts: str | None = "tpep_dropoff_datetime", start: Bound = None, end: Bound = None, *,
    key: str = "dropoff_zip", suffix: str = "dropoff_zip", flag: str = "dropoff_is_weekend",
    out_key: str = "zip", time_column: str | None = None, whole_windows: bool = False,
    zone: str = "America/New_York",
) -> DataFrame:
    """Trip count per key over half an hour, and whether the window ends on a weekend there."""
    column = time_column or ts or "tpep_dropoff_datetime"
    low = _read_from(df, ts, start, DROPOFF_WINDOW) if whole_windows and ts else start
    df = time_range(df, ts, low, end)
    features = windowed(df, key, column, DROPOFF_WINDOW, [F.count("*").alias("n")]).select(
        F.col(key).alias(out_key),
        F.col("window.end").alias("ts"),
        F.col("n").cast("int").alias(f"count_trips_window_30m_{suffix}"),
        weekend_flag("window.end", zone).alias(flag),
    )
    return _inside(features, start, end) if whole_windows else features


def weekend_totals(features: DataFrame, count: str, flag: str) -> DataFrame:
    """Rides per weekend flag, without rows that have no flag."""
    return features.filter(F.col(flag).isNotNull()).groupBy(flag).agg(F.sum(count).alias("num_rides"))


def churn_features(
    df: DataFrame, categories: Sequence[str] = CHURN_CATEGORIES, label: str | None = "churn",
    values: Mapping[str, Sequence[str]] | None = None, labels: Mapping[str, int] = CHURN_LABELS,
    other: bool = False, most: int = 1000,
) -> DataFrame:
    """One-hot the categories, map the label, clean the names, drop incomplete rows.

    A label outside ``labels`` becomes null, so its row is dropped; count such rows with
    ``unmapped_labels`` before. Pass no label when scoring. ``other`` and ``most`` are those of ``one_hot``.
    """
    wide = one_hot(df, categories, values, other, most)
    if label is not None:
        wide = wide.withColumn(label, label_to_int(label, labels))
    return complete_rows(clean_columns(wide, feature_name, repairs={}))


def unmapped_labels(df: DataFrame, label: str = "churn", labels: Mapping[str, int] = CHURN_LABELS) -> DataFrame:
    """Labels that have no number, with their row counts."""
    return df.filter(label_to_int(label, labels).isNull()).groupBy(label).agg(F.count("*").alias("n"))
