"""Point-in-time (as-of) left join.

All sides go into one union and one shuffle on the key; within a key the last feature row before
each lookup row is carried down by a running ``last``. No pairs are formed, so the cost is that of
sorting the sides once. Several feature tables that are looked up by the same key and time share
the union, the shuffle and the sort.

A key that holds more rows than one task should take is cut into time bins. Within a bin the
running ``last`` works as before; what a bin needs from earlier bins is one row, its opening value,
found by the same running ``last`` over one closing row per bin. A bin in which one instant alone
has too many lookup rows is dealt out further: its lookups go to several salts, its feature rows
(at most one per instant) to all of them. Results are the same with and without the cuts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from millrace.functions.times import clock_seconds
from millrace.operators.keys import MAX_HOT_GROUPS, hot_groups, small_frame

_NULL_SPREAD = 4096
_MOST_PARTS = 1 << 20  # of one time bin
_BIN, _SALT, _TIME, _SIDE = "__bin", "__salt", "__time", "__side"

# Rows of one key, or of one key and time bin, that a single task takes at most.
MAX_GROUP_ROWS = 2_000_000


def _as_list(x: str | Sequence[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def _dealing_columns(schema: T.StructType, same: Sequence[str] = ()) -> list[str]:
    """Columns whose hash deals rows out: those of fixed width, which cost little to read, if any of them
    can differ between rows that are equal in ``same``; otherwise all that can be hashed.

    Rows are dealt by content and not by row number, so that a task that runs again sends each row
    to the same place.
    """
    fixed = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)
    names = [f.name for f in schema if isinstance(f.dataType, fixed)]
    if set(names) - set(same):
        return names
    return [f.name for f in schema if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]


@dataclass(frozen=True)
class Features:
    """A feature table to look up: its rows, key columns, time column and the wanted values."""

    frame: DataFrame
    keys: Sequence[str]
    ts: str
    values: Sequence[str]


def asof_join(
    left: DataFrame,
    right: DataFrame,
    *,
    keys: str | Sequence[str],
    left_ts: str,
    right_ts: str,
    values: Sequence[str],
    right_keys: str | Sequence[str] | None = None,
    **options,
) -> DataFrame:
    """``asof_join_all`` with one feature table."""
    side = Features(right, _as_list(right_keys if right_keys is not None else keys), right_ts, list(values))
    return asof_join_all(left, [side], keys=keys, left_ts=left_ts, **options)


def asof_join_all(
    left: DataFrame,
    sides: Sequence[Features],
    *,
    keys: str | Sequence[str],
    left_ts: str,
    inclusive: bool = False,
    hot_keys: Sequence[tuple] | None | str = "find",
    max_group_rows: int = MAX_GROUP_ROWS,
    bin_seconds: int = 3600,
) -> DataFrame:
    """For each left row and side, the row of the same key with the latest time before the left time.

    Strictly before, or at the same time too when ``inclusive``. Every left row is kept once; the
    values are null where there is no match. A null value in the matched row stays null and does
    not fall back to an older row. Feature rows with a null key or time never match. Each side is
    expected to have one row per key and time, as a feature table has.

    ``hot_keys``: "find" counts rows per key first (a pass over the key columns alone); a list of
    key tuples is taken as given; ``None`` cuts no key.
    """
    keys = _as_list(keys)
    left_schema = left.schema
    columns = left_schema.names
    wanted = [v for s in sides for v in s.values]
    clash = [v for v in wanted if v in columns or wanted.count(v) > 1]
    if clash:
        raise ValueError(f"feature columns are already in the input: {clash}")
    left_kind = left_schema[left_ts].dataType
    for s in sides:
        kind = s.frame.schema[s.ts].dataType
        if kind != left_kind:
            raise TypeError(f"{left_ts} is {left_kind.simpleString()} but {s.ts} is {kind.simpleString()}")

    hits = [f"__hit{i}" for i in range(len(sides))]
    features = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [
            s.frame.select(
                *[F.col(r).alias(k) for r, k in zip(s.keys, keys)],
                F.col(s.ts).alias(_TIME),
                F.struct(*s.values).alias(hit),
            ).na.drop("any", subset=[*keys, _TIME])
            for s, hit in zip(sides, hits)
        ],
    )
    lookups = left.withColumn(_TIME, F.col(left_ts))
    if hot_keys == "find":
        hot = [row[:-1] for row in hot_groups([lookups, features], keys, max_group_rows)]
    else:
        hot = [tuple(k) for k in hot_keys or []]

    unmatched = F.greatest(*[F.col(c).isNull().cast("int") for c in [*keys, _TIME]]) == 1
    dealt = _dealing_columns(left_schema, [*keys, left_ts])
    spread = -1 - F.pmod(F.xxhash64(*dealt), F.lit(_NULL_SPREAD)).cast("long")
    openings = None
    if hot:
        key_fields = [T.StructField(k, left_schema[k].dataType) for k in keys]
        lookups, features, openings = _cut(
            lookups, features, key_fields, hits, hot, max_group_rows, bin_seconds, dealt
        )
    else:
        whole = {_BIN: F.lit(0).cast("long"), _SALT: F.lit(0)}
        lookups, features = lookups.withColumns(whole), features.withColumns(whole)
    lookups = lookups.withColumn(_BIN, F.when(unmatched, spread).otherwise(F.col(_BIN)))

    lookup_side, feature_side = (1, 0) if inclusive else (0, 1)
    both = lookups.withColumn(_SIDE, F.lit(lookup_side)).unionByName(
        features.withColumn(_SIDE, F.lit(feature_side)), allowMissingColumns=True
    )
    if openings is not None:
        both = both.unionByName(openings.withColumn(_SIDE, F.lit(-1)), allowMissingColumns=True)
    before = (
        Window.partitionBy(*keys, _BIN, _SALT)
        .orderBy(F.col(_TIME).asc_nulls_first(), _SIDE)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    carried = both.withColumns({hit: F.last(hit, ignorenulls=True).over(before) for hit in hits})
    return carried.filter(F.col(_SIDE) == lookup_side).select(
        *[F.col(f"`{c}`") for c in columns],
        *[F.col(f"{hit}.{v}").alias(v) for s, hit in zip(sides, hits) for v in s.values],
    )


def _cut(
    lookups: DataFrame, features: DataFrame, key_fields: list[T.StructField], hits: list[str],
    hot: list[tuple], max_rows: int, bin_seconds: int, dealt: list[str],
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Give rows of hot keys a time bin and salt, and build the opening rows of their bins.

    A bin with too many lookups and features is cut into equal parts of its time, as many as its rows need. Parts that
    still have too many lookups, as those of one instant, are salted.
    """
    spark = lookups.sparkSession
    keys = [f.name for f in key_fields]
    hot_frame = small_frame(
        spark, [(*k, 1) for k in hot], T.StructType([*key_fields, T.StructField("__hot", T.IntegerType())])
    )
    time_bin = F.floor(clock_seconds(_TIME, lookups.schema[_TIME].dataType) / bin_seconds)
    binned = F.coalesce(F.when(F.col("__hot") == 1, time_bin), F.lit(0)).cast("long")
    lookups = lookups.join(hot_frame, keys, "left").withColumn(_BIN, binned)
    features = features.join(hot_frame, keys, "left").withColumn(_BIN, binned)

    def hot_rows(df: DataFrame) -> DataFrame:
        return df.filter((F.col("__hot") == 1) & F.col(_TIME).isNotNull()).select(*keys, _BIN)

    dense = hot_groups([hot_rows(lookups), hot_rows(features)], [*keys, _BIN], max_rows)
    parts = small_frame(
        spark, [(*row[:-1], min(-(-2 * row[-1] // max_rows), _MOST_PARTS)) for row in dense],
        T.StructType([*key_fields, T.StructField(_BIN, T.LongType()), T.StructField("__parts", T.LongType())]),
    )

    def refined(df: DataFrame) -> DataFrame:
        within = clock_seconds(_TIME, df.schema[_TIME].dataType) / bin_seconds - F.col(_BIN)
        part = F.floor(within * F.coalesce("__parts", F.lit(1)))
        label = F.when(F.col("__hot") == 1, F.col(_BIN) * _MOST_PARTS + F.coalesce(part, F.lit(0))).otherwise(F.lit(0))
        return df.join(parts, [*keys, _BIN], "left").withColumn(_BIN, label.cast("long")).drop("__parts")

    lookups, features = refined(lookups), refined(features)
    hot_lookups = hot_rows(lookups)
    crowded = hot_groups([hot_lookups], [*keys, _BIN], max_rows)
    salts = small_frame(
        spark,
        [(*row[:-1], -(-row[-1] // max_rows)) for row in crowded],
        T.StructType([*key_fields, T.StructField(_BIN, T.LongType()), T.StructField("__salts", T.LongType())]),
    )

    def salted(df: DataFrame) -> DataFrame:
        return df.join(salts, [*keys, _BIN], "left").withColumn("__salts", F.coalesce("__salts", F.lit(1)))

    every_salt = F.explode(F.sequence(F.lit(0), (F.col("__salts") - 1).cast("int")))
    closing = features.filter("__hot = 1").groupBy(*keys, _BIN).agg(*[
        F.max_by(h, F.when(F.col(h).isNotNull(), F.col(_TIME))).alias(h) for h in hits
    ])
    needed = hot_lookups.groupBy(*keys, _BIN).agg(F.lit(1).alias("__needed"))
    earlier = Window.partitionBy(*keys).orderBy(_BIN).rowsBetween(Window.unboundedPreceding, -1)
    openings = (
        closing.unionByName(needed, allowMissingColumns=True)
        .groupBy(*keys, _BIN)
        .agg(*[F.first(h, ignorenulls=True).alias(h) for h in hits], F.max("__needed").alias("__needed"))
        .withColumns({h: F.last(h, ignorenulls=True).over(earlier) for h in hits})
        .filter(F.col("__needed").isNotNull() & F.greatest(*[F.col(h).isNotNull().cast("int") for h in hits], F.lit(0)).cast("boolean"))
        .drop("__needed")
    )
    openings = salted(openings).withColumn(_SALT, every_salt).drop("__salts")
    features = salted(features).withColumn(_SALT, every_salt).drop("__salts", "__hot")
    salt = F.pmod(F.xxhash64(*dealt), F.col("__salts")).cast("int")
    lookups = salted(lookups).withColumn(_SALT, salt).drop("__salts", "__hot")
    return lookups, features, openings


def keyed_lookup(
    left: DataFrame, right: DataFrame, *, keys: str | Sequence[str], values: Sequence[str],
    right_keys: str | Sequence[str] | None = None, hot_keys: Sequence[tuple] | None | str = "find",
    max_group_rows: int = MAX_GROUP_ROWS, unique: bool = False,
) -> DataFrame:
    """Left join to a table with one row per key; no time involved.

    Left rows of hot keys are joined to the rows of those keys alone. These are as few as the hot
    keys, which are bounded, so they are broadcast and the hot rows are not shuffled. All other
    left rows, those with a null key too, take the usual join. ``hot_keys`` as in ``asof_join_all``.
    Several rows for one key of the table are an error, whatever its size; ``unique`` says that the
    table has been checked, as feature tables are on writing.
    """
    keys = _as_list(keys)
    right_keys = _as_list(right_keys) if right_keys is not None else keys
    schema = left.schema
    columns = schema.names
    clash = [v for v in values if v in columns]
    if clash:
        raise ValueError(f"feature columns are already in the input: {clash}")
    features = right.select(*[F.col(r).alias(k) for r, k in zip(right_keys, keys)], *values)
    known = F.greatest(*[F.col(k).isNull().cast("int") for k in keys], F.lit(0)) == 0
    if not unique and not features.filter(known).groupBy(*keys).count().filter("count > 1").isEmpty():
        raise ValueError(f"the table has several rows for one key {keys}")
    if hot_keys == "find":
        hot = [row[:-1] for row in hot_groups([left], keys, max_group_rows)]
    else:
        hot = [tuple(k) for k in hot_keys or []]
    if not hot:
        return left.join(features, keys, "left").select(*columns, *values)
    hot_frame = small_frame(left.sparkSession, hot, T.StructType([schema[k] for k in keys]))
    few = features.join(hot_frame, keys, "left_semi")
    cold = left.join(hot_frame, keys, "left_anti").join(features, keys, "left")
    dense = left.join(hot_frame, keys, "left_semi").join(F.broadcast(few), keys, "left")
    return cold.select(*columns, *values).unionByName(dense.select(*columns, *values))
