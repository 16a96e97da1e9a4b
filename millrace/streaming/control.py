"""Looking after running queries."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery


def active(spark: SparkSession, prefix: str = "") -> list[StreamingQuery]:
    """Running queries whose name starts with ``prefix``; unnamed ones match no prefix but the empty."""
    return [q for q in spark.streams.active if not prefix or (q.name or "").startswith(prefix)]


def stop_all(spark: SparkSession, prefix: str = "") -> int:
    """Stop them; returns how many there were."""
    queries = active(spark, prefix)
    for q in queries:
        q.stop()
    return len(queries)


def wait_all(queries: Iterable[StreamingQuery], timeout: int | None = None) -> None:
    """Wait until all have ended. The first failure is raised; the queries were running side by side."""
    for q in queries:
        done = q.awaitTermination(timeout) if timeout else q.awaitTermination()
        if timeout and not done:
            raise TimeoutError(f"query {q.name or q.id} still runs after {timeout} s")


def wait_for_prefix(spark: SparkSession, prefix: str = "", timeout: int | None = None) -> None:
    wait_all(active(spark, prefix), timeout)
