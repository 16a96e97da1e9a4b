"""Pack token sequences into padded batches from length buckets that waste least.

Texts longer than the context are cut into full sequences and a rest. A dynamic program over the
global histogram of sequence lengths picks the bucket bounds with the least padding in total. Inside
a bucket, shuffled sequences fill batches up to a token budget.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import hash_order, running_total, shard_digits, word_count
from millrace.session import cut_lineage


def best_bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets that pad least; the last is the longest length.

    ``lengths`` rises. best[j] is the least padded total of lengths 0..j in so many buckets; the
    padding itself is that less the fixed number of tokens.
    """
    if len(lengths) == 0:
        return []
    below = np.concatenate([[0], np.cumsum(counts)]).astype(np.float64)
    size, sides = len(lengths), lengths.astype(np.float64)
    best = below[1:] * sides
    starts = []
    for _ in range(1, min(buckets, size)):
        before = np.concatenate([[0.0], best])  # before[i]: lengths 0..i-1 are in earlier buckets
        new, start = np.empty(size), np.empty(size, dtype=np.int64)
        for j in range(size):
            cost = before[: j + 1] + (below[j + 1] - below[: j + 1]) * sides[j]
            start[j] = np.argmin(cost)
            new[j] = cost[start[j]]
        best = new
        starts.append(start)
    bounds, j = [int(lengths[-1])], size - 1
    for start in reversed(starts):
        j = start[j] - 1
        if j < 0:
            break
        bounds.append(int(lengths[j]))
    return sorted(bounds)


def sequences(docs: DataFrame, id_col: str, text_col: str, context: int) -> DataFrame:
    """Rows doc_id, copy, part, length: each text in parts of ``context`` words and a rest."""
    rows = docs.select(F.col(id_col).alias("doc_id"), word_count(text_col).alias("n"))
    parts = F.greatest(F.ceil(F.col("n") / context), F.lit(1))
    return rows.select("doc_id", "n", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part")).select(
        "doc_id", "part", F.least(F.col("n") - F.col("part") * context, F.lit(context)).cast("int").alias("length"),
    )


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", context: int = 2048,
    buckets: int = 8, budget: int = 16_384,
) -> DataFrame:
    """Batches of padded sequences: doc_id, part, length, padded, batch, place.

    ``length`` counts words, at most ``context``; ``padded`` is the bound of the sequence's bucket
    and the same for the whole batch ``padded``/``batch``, which holds as many sequences as fit the
    ``budget`` (one at least); ``place`` counts them from 0. Only the last batch of a bucket may be
    shorter. The histogram has one bin for each length up to ``context``, so its size is bounded.

    A null or empty text is one sequence of length 0, in the smallest bucket; repeated rows are
    sequences of their own; an empty table gives no rows. Equal input rows are in the same batches
    on every run.
    """
    rows = cut_lineage(sequences(docs, id_col, text_col, context), "pack-sequences")
    bins = rows.groupBy("length").count().orderBy("length").collect()  # one row a length: context + 1 at most
    bounds = best_bounds(np.array([b[0] for b in bins]), np.array([b[1] for b in bins]), buckets) or [0]
    padded = F.lit(bounds[-1])
    for bound in reversed(bounds[:-1]):
        padded = F.when(F.col("length") <= bound, F.lit(bound)).otherwise(padded)
    total = sum(b[1] for b in bins)
    keyed = rows.withColumn("padded", padded).withColumn("order", hash_order("doc_id", "part"))
    keyed = keyed.withColumn("shard", F.substring("order", 1, shard_digits(total)))
    ranked = running_total(keyed, ["padded"], "shard", ["order", "doc_id", "part", "length"], F.lit(1), "rank")
    room = F.greatest(F.floor(F.lit(budget) / F.greatest("padded", F.lit(1))), F.lit(1))
    return ranked.select(
        "doc_id", F.col("part").cast("long").alias("part"), "length", F.col("padded").cast("int").alias("padded"),
        F.floor(F.col("rank") / room).cast("long").alias("batch"), F.pmod("rank", room).cast("long").alias("place"),
    )
