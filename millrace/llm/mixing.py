"""Mix sources to target weights by a low-discrepancy schedule of equal-token blocks.

Every slot of the schedule gets a golden-ratio point, which falls into the share of one source. The
r-th slot of a source takes the r-th block of that source's shuffled words; after its last word a
source starts over. The mix of a source ends where its target is reached.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import (
    hash_order, put_back, running_total, set_apart, shard_digits, tasks_for, whole, word_count,
)
from millrace.session import cut_lineage

# Odd number next to 2^31 / golden ratio: multiples of it modulo 2^31 are spread evenly.
GOLDEN, RING = 1327217885, 1 << 31


def source_targets(sizes: DataFrame, weights=(5, 2, 1), max_repeats: int = 3) -> DataFrame:
    """Target of each source: its share by weight of all words, at most ``max_repeats`` times its size.

    ``sizes`` has source_key, source, source_size, one row for each source. Sources by code point,
    null last, take the weights in turn. What lies above a limit is shared by weight among the
    others until none is above: all sources that stay below get the same words per unit of weight.
    That level follows from the sources sorted by the level at which each meets its limit.

    Adds number (from 0, in that order), weight, target, and low and high: the source's part of
    0..total in whole words.
    """
    listed = Window.orderBy(F.col("source").isNull(), F.col("source"))
    number = F.row_number().over(listed) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(number, F.lit(len(weights))) + 1).cast("int"))
    rows = sizes.withColumn("number", number).withColumn("weight", weight.cast("long"))
    every = Window.partitionBy()
    by_limit = Window.orderBy("meets", "number")
    limit = F.col("source_size") * max_repeats
    rows = rows.withColumn("total", F.sum("source_size").over(every)).withColumn("meets", limit / F.col("weight"))
    above = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    level = (
        (F.col("total") - F.coalesce(F.sum(limit).over(above), F.lit(0)))
        / F.sum("weight").over(by_limit.rowsBetween(0, Window.unboundedFollowing))
    )
    # The first source whose limit the level does not reach, were only those before it full.
    rows = rows.withColumn("level", level)
    found = F.min(F.when(F.col("level") <= F.col("meets"), F.struct("meets", "number", "level"))).over(every)["level"]
    target = F.least(limit.cast("double"), found * F.col("weight"))
    rows = rows.withColumn("target", target)
    ordered = Window.orderBy("number")
    high = F.sum(F.round("target").cast("long")).over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    return rows.select(
        "source_key", "source", "source_size", "number", "weight", "total", "target",
        (high - F.round("target").cast("long")).alias("low"), high.alias("high"),
    )


def slot_point(slot: Column, total: Column) -> Column:
    """Where the golden-ratio point of a slot lies in 0..total."""
    return F.pmod(F.pmod(slot, F.lit(RING)) * F.lit(GOLDEN), F.lit(RING)).cast("double") / F.lit(float(RING)) * total


def _place(slots: pd.DataFrame, shares: pd.DataFrame) -> pd.DataFrame:
    """Source of each slot of one cell: the share that its point lies in."""
    shares = shares.sort_values("low", kind="stable")
    at = shares["high"].searchsorted(slots["point"], side="right")
    inside = at < len(shares)
    out = slots.loc[inside, ["slot", "chunk"]]
    return out.assign(source_key=shares["source_key"].to_numpy()[at[inside]])[["source_key", "slot", "chunk"]]


def schedule(targets: DataFrame, total: int, block_words: int, spare: float = 0.05) -> DataFrame:
    """Slots of the mix: source_key, slot, rank (from 0 within the source).

    There are a few more slots than blocks, because the points are a little uneven. A source that still
    gets fewer slots than it has blocks, as a small one may, has its last ones after all others.
    """
    spark = targets.sparkSession
    count = -(-total // block_words)
    count += int(count * spare) + 256
    cells = tasks_for(spark, count, 200_000) * 4
    width = max(total, 1) / cells
    tasks = tasks_for(spark, count, 500_000)
    slots = spark.range(0, count, 1, tasks).select(
        F.col("id").alias("slot"), F.floor(F.col("id") / F.lit(4096)).alias("chunk"),
        slot_point(F.col("id"), F.lit(total)).alias("point"),
    ).withColumn("cell", F.floor(F.col("point") / F.lit(width)))
    shares = targets.filter("high > low").select(
        "source_key", "low", "high",
        F.explode(F.sequence(F.floor(F.col("low") / F.lit(width)), F.floor(F.col("high") / F.lit(width)))).alias("cell"),
    )
    placed = cut_lineage(
        slots.groupBy("cell").cogroup(shares.groupBy("cell"))
        .applyInPandas(_place, "source_key string, slot long, chunk long"), "mix-slots",
    )
    ranked = running_total(placed, ["source_key"], "chunk", ["slot"], F.lit(1), "rank").select("source_key", "slot", "rank")
    blocks = F.floor((F.col("high") - F.col("low") + F.lit(block_words - 1)) / F.lit(block_words))
    short = (
        targets.select("source_key", "number", blocks.alias("blocks"))
        .join(placed.groupBy("source_key").agg(F.count("*").alias("had")), "source_key", "left")
        .withColumn("had", F.coalesce("had", F.lit(0))).filter("blocks > had")
    )
    earlier = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    missing = short.withColumn("after", F.coalesce(F.sum(F.col("blocks") - F.col("had")).over(earlier), F.lit(0))).select(
        "source_key", "had", "after", F.explode(F.sequence(F.col("had"), F.col("blocks") - 1)).alias("rank"),
    )
    return ranked.unionByName(missing.select(
        "source_key", (F.lit(count) + F.col("after") + F.col("rank") - F.col("had")).alias("slot"), "rank"))


def mixed_pieces(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights=(5, 2, 1), max_repeats: int = 3, block_words: int = 256, keep: tuple[str, ...] = (),
) -> tuple[DataFrame, DataFrame]:
    """Sized rows, and the pieces of them that the mix takes.

    Sized rows: row (a number of the row), doc_id, size, source_size, target, and the columns
    ``keep``. Pieces: row, slot, repeat (0 at the first pass over the source), first_word, words.

    Null text has size 0, a null source is a source of its own and the last. Rows repeated in the
    input are rows of their own. An empty table gives empty results.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(text_col).alias("size"), *keep,
    ).withColumn("order", hash_order("doc_id"))
    rows = cut_lineage(rows, "mix-sizes")
    digits = shard_digits(rows.count())
    rows = rows.withColumn("source_key", F.when(F.col("source").isNull(), "null").otherwise(F.concat(F.lit("="), "source")))
    rows = rows.withColumn("shard", F.substring("order", 1, digits))
    sizes = rows.groupBy("source_key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    targets = cut_lineage(source_targets(sizes, weights, max_repeats), "mix-targets")
    total = targets.agg(F.max("total")).first()[0] or 0
    # Shard sums carry the source's numbers, so that the rows meet them by source and shard alone.
    sums = rows.groupBy("source_key", "shard").agg(F.sum("size").alias("_sum"))
    before = Window.partitionBy("source_key").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    sums = sums.join(targets.select("source_key", "source_size", "target"), "source_key")
    inside = Window.partitionBy("source_key", "shard").orderBy("order", "doc_id", "size")
    sized = cut_lineage(
        rows.join(sums.hint("shuffle_merge"), ["source_key", "shard"])
        .withColumn("start", F.col("_before") + F.coalesce(
            F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("row", F.concat_ws("/", "source_key", "shard", F.row_number().over(inside)))
        .select("row", "doc_id", "source_key", "size", "source_size", "target", "start", *keep), "mix-sized",
    )
    wanted = F.round("target").cast("long")
    # Passes over the source, each shifted by its size; blocks that the piece touches, each one row.
    passes = sized.filter("size > 0").select(
        "row", "source_key", "size", "target", F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))).alias("repeat"),
        (F.col("start") + F.col("repeat") * F.col("source_size")).alias("at"),
    ).filter(F.col("at") < wanted).withColumn("end", F.least(F.col("at") + F.col("size"), wanted))
    block = F.lit(block_words)
    pieces = passes.select(
        "row", "source_key", "repeat", "at", "end",
        F.explode(F.sequence(F.floor(F.col("at") / block), F.floor((F.col("end") - 1) / block))).alias("rank"),
    )
    first = F.greatest(F.col("at"), F.col("rank") * block)
    pieces = pieces.withColumn("first_word", first - F.col("at")).withColumn(
        "words", F.least(F.col("end"), (F.col("rank") + 1) * block) - first)
    # Spark sizes the pieces as if an explode made one row of each; without the hint it may broadcast all of them.
    taken = pieces.join(schedule(targets, total, block_words).hint("shuffle_merge"), ["source_key", "rank"])
    return sized, taken.select("row", "slot", "repeat", "first_word", "words")


def mix(docs: DataFrame, keep: tuple[str, ...] = (), **settings) -> DataFrame:
    """What the mix takes of each row: doc_id, size, source_size, target, taken, first_slot, last_slot.

    The slots are those of the schedule in which the row's first and last words stand, null where nothing is
    taken: in their order, any beginning of the mix has about the weights of the whole. See ``mixed_pieces``.
    """
    sized, pieces = mixed_pieces(docs, keep=keep, **settings)
    taken = pieces.groupBy("row").agg(
        F.sum("words").alias("taken"), F.min("slot").alias("first_slot"), F.max("slot").alias("last_slot"))
    return sized.join(taken, "row", "left").select(
        "doc_id", *keep, "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"), "first_slot", "last_slot",
    )


def mixed_rows(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **settings
) -> DataFrame:
    """``docs`` as often as the mix takes them: each row as many times as its size is taken, rounded.

    Only the text in which the mix of a source ends is taken in part; it stays if half of it or more is.
    Texts without words go. Rows with equal id and text share their copies evenly. Other columns stay,
    whatever their names.
    """
    roles = {"doc_id": id_col, "text": text_col, "source": source_col}
    marked = set_apart(docs, **roles).withColumn("_md5", F.md5(whole("text")))
    copies = mix(marked, keep=("_md5",), **settings).groupBy("doc_id", "_md5").agg(
        F.floor(F.sum("taken") / F.greatest(F.sum("size"), F.lit(1)) + 0.5).cast("int").alias("_copies"))
    copies = copies.filter("_copies > 0").select(F.col("doc_id").alias("_id"), F.col("_md5").alias("_text"), "_copies")
    same = marked["doc_id"].eqNullSafe(copies["_id"]) & (marked["_md5"] == copies["_text"])
    taken = marked.join(copies, same).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return put_back(taken, docs, **roles)
