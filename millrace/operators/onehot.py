"""Indicator columns for categories."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window


def category_values(
    df: DataFrame, columns: Sequence[str], most: int = 1000
) -> dict[str, list[str]]:
    """The ``most`` most frequent non-null values of each column, ties by value, sorted; one pass for all columns.

    Rows are counted before the shuffle, and of each column's values a task hands on its first ones only. All values become columns, so their number is a parameter;
    ``one_hot(other=True)`` flags the values beyond it.
    """
    tagged = F.explode(F.array(*[
        F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns
    ]))
    counts = df.select(tagged.alias("pair")).select("pair.*").filter(F.col("value").isNotNull()).groupBy("name", "value").count()
    found: dict[str, list[str]] = {c: [] for c in columns}
    # Parts of a column's values first, so that a column with very many does not meet in one task whole.
    shards = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.desc("count"), F.col("value")]
    sharded = Window.partitionBy("name", F.pmod(F.xxhash64("value"), F.lit(shards)))
    first = counts.withColumn("rank", F.row_number().over(sharded.orderBy(*order))).filter(F.col("rank") <= most)
    best = first.withColumn("rank", F.row_number().over(Window.partitionBy("name").orderBy(*order)))
    for row in best.filter(F.col("rank") <= most).select("name", "value").collect():
        found[row["name"]].append(row["value"])
    return {c: sorted(v) for c, v in found.items()}


def one_hot(
    df: DataFrame, columns: Sequence[str], values: Mapping[str, Sequence[str]] | None = None, other: bool = False,
    most: int = 1000,
) -> DataFrame:
    """Replace each column by one long column per value, named ``column_value``, holding 1 or 0.

    Null and values outside the list give 0 everywhere; ``other`` adds a flag ``column_other_values``
    for the latter. Pass the ``values`` found at training time
    when scoring, so that both have the same columns; without them the data is searched. More than
    ``most`` values in a column are then an error unless ``other`` flags those beyond it.
    """
    if values is None:
        values = category_values(df, columns, most if other else most + 1)
        cut = [c for c in columns if not other and len(values[c]) > most]
        if cut:
            raise ValueError(f"more than {most} values in {cut}: pass the values, a larger number or other=True")
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    flags = [
        F.coalesce((F.col(c).cast("string") == v).cast("long"), F.lit(0).cast("long")).alias(f"{c}_{v}")
        for c in columns
        for v in values[c]
    ]
    if other:
        flags += [
            F.coalesce((~F.col(c).cast("string").isin(list(values[c]))).cast("long"), F.lit(0).cast("long"))
            .alias(f"{c}_other_values")
            for c in columns
        ]
    return df.select(*kept, *flags)
