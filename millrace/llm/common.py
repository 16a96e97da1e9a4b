"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# A word is a run of other characters than these six.
WORD_GAP = r"[\x20\x09-\x0D]+"


def whole(text: Column | str) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words_of(text: Column | str) -> Column:
    """The words of a text in order; none for null."""
    return F.array_remove(F.split(whole(text), WORD_GAP), "")


def word_count(text: Column | str) -> Column:
    return F.size(words_of(text)).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, even where ``body`` uses it in a lambda."""
    return F.transform(F.array(value), body)[0]


def unlike(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` is called so, in capitals or not."""
    used = {c.lower() for c in df.columns}
    while name.lower() in used:
        name += "_"
    return name


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def set_apart(docs: DataFrame, **roles: str) -> DataFrame:
    """The columns of ``roles`` (new name = name in ``docs``) and all others inside one struct ``others``.

    However a caller's columns are called, they cannot clash with those that an operator adds.
    """
    rest = [c for c in docs.columns if c not in roles.values()]
    others = F.struct(*[F.col(_quoted(c)).alias(f"c{i}") for i, c in enumerate(rest)]) if rest else F.lit(0)
    return docs.select(*[F.col(_quoted(c)).alias(name) for name, c in roles.items()], others.alias("others"))


def put_back(rows: DataFrame, docs: DataFrame, **roles: str) -> DataFrame:
    """The columns of ``docs`` in their order, from rows that ``set_apart`` made."""
    names = {c: name for name, c in roles.items()}
    rest = [c for c in docs.columns if c not in names]
    names |= {c: f"others.c{i}" for i, c in enumerate(rest)}
    return rows.select(*[F.col(names[c]).alias(c) for c in docs.columns])


def hash_order(*columns: Column | str) -> Column:
    """A hex string that orders rows as if shuffled, alike on every run and in any engine."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in columns]
    return F.md5(F.concat_ws("|", *parts))


def shard_digits(rows: int, rows_per_shard: int = 50_000) -> int:
    """How many leading hex digits of ``hash_order`` make shards of about that many rows; 3 at least."""
    digits = 3
    while 16 ** digits * rows_per_shard < rows:
        digits += 1
    return digits


def running_total(df: DataFrame, group: list[str], shard: str, order: list[str], value: Column, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the earlier rows of the group, in order of shard, then ``order``.

    A group is never in one task: each shard is summed on its own, the sums of the earlier shards
    are added. The shard sums are a small table, one row for each group and shard. ``df`` is read
    twice, so it should be a stored table.
    """
    sums = df.groupBy(*group, shard).agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*group).orderBy(shard).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*group, shard, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*group, shard).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.join(offsets.hint("shuffle_merge"), [*group, shard])
        .withColumn(out, F.col("_before") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .drop("_before")
    )


def tasks_for(spark: SparkSession, rows: int, rows_per_task: int) -> int:
    """Number of tasks for so many rows, at least what the session uses for a shuffle."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_per_task))
