"""Ranks and running totals over all rows, without putting all rows in one task.

Rows are put in ordered buckets. Totals per bucket (a small table) give each bucket its starting
value, and the fine order is resolved inside the buckets, which are spread over the tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def running_total(
    df: DataFrame, totals: Sequence[str], *, bucket: str, order: Sequence[Column],
    within: Sequence[str] = (), grand_total: bool = False,
) -> DataFrame:
    """Replace each column of ``totals`` by its running total in ``order`` within each group.

    ``bucket`` must rise with ``order``. Only the bucket totals meet in one task per group, so the
    number of buckets has to be bounded; the rows of one bucket have to fit one task.
    ``grand_total`` adds a column ``<name>_total`` with the total of the whole group.

    Group and bucket are joined as one struct: a null group value equals itself there, and the join
    reuses the partitioning of the window, so the rows are shuffled once.
    """
    group = list(within)
    key = F.struct(*group, bucket).alias("__key")
    sums = df.groupBy(*group, bucket).agg(*[F.sum(c).alias(c) for c in totals])
    whole = Window.partitionBy(*group)
    before = whole.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        key,
        *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"__start_{c}") for c in totals],
        *[F.sum(c).over(whole).alias(f"{c}_total") for c in totals if grand_total],
    )
    inside = Window.partitionBy("__key").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    kept = [c for c in df.columns if c not in totals]
    return (
        df.select("*", key)
        .select(*kept, "__key", *[F.sum(c).over(inside).alias(c) for c in totals])
        .join(starts, "__key")
        .select(
            *kept,
            *[(F.col(c) + F.col(f"__start_{c}")).alias(c) for c in totals],
            *[f"{c}_total" for c in totals if grand_total],
        )
    )
