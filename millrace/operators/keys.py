"""Finding keys that hold too many rows for one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# At most this many groups are treated as hot: the list is sent to every executor, so it needs a
# bound. A group past the end of the list holds less than 1/MAX_HOT_GROUPS of all rows.
MAX_HOT_GROUPS = 10_000


# A group is judged by about this many sampled rows, which tells its size to a few percent.
SAMPLED_ROWS = 1_000


def hot_groups(
    frames: Sequence[DataFrame], columns: Sequence[str], max_rows: int, limit: int = MAX_HOT_GROUPS
) -> list[tuple]:
    """Groups with more than ``max_rows`` rows in the frames together, as (values..., rows).

    Reads the named columns only. For a large ``max_rows`` the rows are counted on a sample, so
    that next to nothing is shuffled: the counts decide how work is cut up and never what comes
    out of it, and a group that is missed is close to ``max_rows``. The largest ``limit`` groups
    are returned, so the answer is bounded however large the data is.
    """
    fraction = min(1.0, SAMPLED_ROWS / max_rows)
    counts = []
    for f in frames:
        rows = f.select(*columns).na.drop("any")
        rows = rows.sample(fraction, seed=17) if fraction < 1 else rows
        counts.append(rows.groupBy(*columns).agg(F.count("*").alias("n")))
    total = reduce(DataFrame.unionByName, counts).groupBy(*columns).agg(F.sum("n").alias("n"))
    found = total.filter(F.col("n") > max_rows * fraction).orderBy(F.desc("n")).limit(limit)
    return [(*row[:-1], max(int(row[-1] / fraction), max_rows + 1)) for row in found.collect()]


def small_frame(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A broadcastable DataFrame from a list that ``hot_groups`` has bounded."""
    if len(rows) > MAX_HOT_GROUPS:
        raise ValueError(f"{len(rows)} rows are too many to broadcast")
    return F.broadcast(spark.createDataFrame(rows, schema))
