"""Hard negatives by exact inner products in residue numbers.

Components are whole numbers. A block of anchors and a block of rows are multiplied modulo several small primes: every
product and sum of symmetric residues stays below 2^24, so float32 holds it exactly. The signed score follows from its
residues by Chinese remaindering. Anchors meet all rows slab by slab: first for their best positives, then
for the negatives whose scores lie in the window that each positive opens.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import prod

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import hash_order
from millrace.session import cut_lineage, scratch_path

EXACT = 1 << 24  # float32 holds all whole numbers up to this
LEAST = np.iinfo(np.int64).min
PRIME_BELOW = 256


def primes_for(bound: int) -> list[int]:
    """The largest primes below 256 whose product tells all whole numbers from -bound to bound apart."""
    out, product = [], 1
    for p in range(PRIME_BELOW - 1, 2, -1):
        if product > 2 * bound:
            break
        if all(p % d for d in range(2, int(p ** 0.5) + 1)):
            out.append(p)
            product *= p
    return out


def residues(v: np.ndarray, prime: int) -> np.ndarray:
    """Residues nearest to zero, as float32."""
    half = prime // 2
    return ((v + half) % prime - half).astype(np.float32)


@dataclass
class ResidueProduct:
    """Exact inner products of whole vectors whose absolute value is ``bound`` at most."""

    primes: list[int]
    columns: int  # how many components one float32 product may sum

    @classmethod
    def for_bound(cls, bound: int) -> ResidueProduct:
        if bound >= 1 << 61:
            raise ValueError("scores do not fit 64 bits")
        primes = primes_for(max(bound, 1))
        return cls(primes, (EXACT - 1) // (primes[0] // 2) ** 2)

    def split(self, v: np.ndarray) -> list[np.ndarray]:
        return [residues(v, p) for p in self.primes]

    def scores(self, left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
        """All inner products, from the residues of both sides."""
        whole = prod(self.primes)
        if whole * EXACT * len(self.primes) < 1 << 52:
            # Sum of product times weight, all exact in float64; the weight is 1 modulo its prime, 0 modulo the others.
            total = np.zeros((len(left[0]), len(right[0])))
            for prime, a, b in zip(self.primes, left, right, strict=True):
                rest = whole // prime
                weight = rest * pow(rest, -1, prime) % whole
                weight -= whole if weight > whole // 2 else 0
                for s in range(0, a.shape[1], self.columns):
                    part = a[:, s : s + self.columns] @ b[:, s : s + self.columns].T
                    total += part * np.float64(weight) if a.shape[1] <= self.columns else part % prime * np.float64(weight)
                    if a.shape[1] > self.columns:
                        total -= np.rint(total / whole) * whole
            total -= np.rint(total / whole) * whole
            return total.astype(np.int64)
        return self._by_digits(left, right)

    def _by_digits(self, left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
        """The same for any bound: mixed-radix digits, without a number beyond 64 bits."""
        digits: list[np.ndarray] = []
        for i, prime in enumerate(self.primes):
            a, b = left[i], right[i]
            r = np.zeros((len(a), len(b)), dtype=np.int32)
            for s in range(0, a.shape[1], self.columns):
                r += (a[:, s : s + self.columns] @ b[:, s : s + self.columns].T).astype(np.int32) % prime
            # Mixed radix: take off the earlier digits, one prime after the other.
            for digit, earlier in zip(digits, self.primes, strict=False):
                r = (r - digit) * pow(earlier, -1, prime) % prime
            digits.append(r % prime if not digits else r)
        total = digits[-1].astype(np.int64)
        # The last digit in its symmetric form makes the whole number signed.
        total -= np.where(self._over_half(digits), self.primes[-1], 0)
        for digit, prime in zip(digits[-2::-1], self.primes[-2::-1], strict=True):
            total = total * prime + digit
        return total

    def _over_half(self, digits: list[np.ndarray]) -> np.ndarray:
        """Whether the number is above half the product of the primes, that is, stands for a negative one."""
        # Half of (product - 1) has the digits (p - 1) / 2 for odd primes: compare from the first place on.
        above = np.zeros(digits[0].shape, dtype=bool)
        for digit, prime in zip(digits, self.primes, strict=True):
            half = (prime - 1) // 2
            above = (digit > half) | ((digit == half) & above)
        return above


def labelled_vectors(
    df: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int, label=None,
) -> DataFrame:
    """vec_id, label and v = floor(scale * x); rows with anything null or not finite go, equal rows count once."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    fine = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = df.select(
        F.col(id_col).cast("long").alias("vec_id"),
        (F.col(label_col) if label is None else label).cast("long").alias("label"), x.alias("x"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull()).filter(fine)
    return rows.select("vec_id", "label", F.transform("x", lambda c: F.floor(c * scale)).alias("v")).distinct()


def _matrix(column, width: int) -> np.ndarray:
    """Lists of whole numbers as rows of one width; missing components are 0."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    begin = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width), dtype=np.int64)
    length = np.diff(begin)
    row = np.repeat(np.arange(len(column)), length)
    out[row, np.arange(begin[0], begin[-1]) - np.repeat(begin[:-1], length)] = values[begin[0] : begin[-1]]
    return out


class Best:
    """The first ``k`` rows of each slot by score, ties to the smaller id, over all blocks that a task sees."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.score = np.full((slots, k), LEAST, dtype=np.int64)
        self.id = np.full((slots, k), np.iinfo(np.int64).max, dtype=np.int64)

    def bar(self) -> np.ndarray:
        """A row below this score is not among the first k of its slot."""
        return self.score[:, -1]

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(slot):
            return
        touched = np.unique(slot)
        old = self.id[touched]
        held = old != np.iinfo(np.int64).max
        slot = np.concatenate([np.repeat(touched, self.k)[held.ravel()], slot])
        score = np.concatenate([self.score[touched][held], score])
        ids = np.concatenate([old[held], ids])
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        # One id with several vectors may come more than once; equal rows count once.
        again = np.zeros(len(slot), dtype=bool)
        again[1:] = (slot[1:] == slot[:-1]) & (score[1:] == score[:-1]) & (ids[1:] == ids[:-1])
        slot, score, ids = slot[~again], score[~again], ids[~again]
        rank = np.arange(len(slot)) - np.searchsorted(slot, slot, side="left")
        first = rank < self.k
        self.score[touched] = LEAST
        self.id[touched] = np.iinfo(np.int64).max
        self.score[slot[first], rank[first]] = score[first]
        self.id[slot[first], rank[first]] = ids[first]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        slot, place = np.nonzero(self.id != np.iinfo(np.int64).max)
        return slot, self.score[slot, place], self.id[slot, place]


@dataclass
class Slab:
    """A bounded number of anchors with the residues of their vectors."""

    key: np.ndarray
    label: np.ndarray
    parts: list[np.ndarray]


def _slab(rows: pa.Table, width: int, product: ResidueProduct) -> Slab:
    v = _matrix(rows.column("v"), width)
    return Slab(rows.column("vec_id").to_numpy(), rows.column("label").to_numpy(), product.split(v))


def _blocks(batches: Iterator[pa.RecordBatch], width: int, product: ResidueProduct, rows: int = 2048):
    for batch in batches:
        for s in range(0, batch.num_rows, rows):
            part = batch.slice(s, rows)
            parts = product.split(_matrix(part.column(2), width))
            yield part.column(0).to_numpy(), part.column(1).to_numpy(), parts


ANCHORS = 1024  # anchors whose scores with one block of rows are held at once


def _positives(slab, width: int, product: ResidueProduct, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, best = slab.value, None
        for ids, label, parts in _blocks(batches, width, product):
            best = best or Best(len(s.key), k)
            for a in range(0, len(s.key), ANCHORS):
                b = min(a + ANCHORS, len(s.key))
                score = product.scores([p[a:b] for p in s.parts], parts)
                able = (s.label[a:b, None] == label[None, :]) & (ids[None, :] != s.key[a:b, None])
                able &= score >= best.bar()[a:b, None]
                i, j = np.nonzero(able)
                best.add(i + a, score[i, j], ids[j])
        if best is not None:
            slot, score, ids = best.rows()
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in (slot, ids, score)], names=["slot", "positive_id", "positive_score"])

    return run


def _negatives(slab, width: int, product: ResidueProduct, k: int):
    """For each anchor and positive of the slab, the first rows of another label with low <= score <= high."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (s, owner, low, high), best = slab.value, None
        for ids, label, parts in _blocks(batches, width, product):
            best = best or Best(len(owner), k)
            for a in range(0, len(s.key), ANCHORS):
                b = min(a + ANCHORS, len(s.key))
                score = product.scores([p[a:b] for p in s.parts], parts)
                # What is of the anchor's label is below every window.
                score[s.label[a:b, None] == label[None, :]] = LEAST
                first, last = np.searchsorted(owner, [a, b])
                step = max(1, ANCHORS // 4)
                for c in range(first, last, step):
                    d = min(c + step, last)
                    mine = score[owner[c:d] - a]
                    bar = np.maximum(low[c:d], best.bar()[c:d])
                    i, j = np.nonzero((mine >= bar[:, None]) & (mine <= high[c:d, None]))
                    best.add(i + c, mine[i, j], ids[j])
        if best is not None:
            slot, score, ids = best.rows()
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in (slot, ids, score)], names=["slot", "negative_id", "negative_score"])

    return run


def hard_negatives(
    df: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", label=None, scale: int = 256,
    slab_bytes: int = 8 << 20,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id is divisible by ``every``; a score is the inner product with the anchor of
    floor(``scale`` * x), and higher scores come first, ties by smaller id. The positives of an anchor are its first
    ``positives`` other rows of its label; for each, the first ``negatives`` rows of other labels with low * positive_score <=
    100 * negative_score <= high * positive_score are returned. ``label`` may give the label as an expression.

    Rows take no part with a null id, label, vector or component, or a component that is not finite. A shorter vector
    has zeros in place of the missing components. Equal repeated rows count once; different rows of one id are rows
    of their own, but an anchor's own id is never its positive. Other columns play no part; an empty table gives no rows.
    Scores of 2^61 and more are an error.

    Each slab of anchors (``slab_bytes`` of vectors, so bounded) is given to all tasks, which scan the rows, whatever
    their labels, so no label or row is hot. A task keeps the first rows of each anchor; the tasks' are ranked in windows.
    """
    spark = df.sparkSession
    rows = cut_lineage(labelled_vectors(df, id_col, vector_col, label_col, scale, label), "labelled")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    width, norm2 = rows.agg(F.max(F.size("v")), F.max(square)).first()
    if width is None:
        return spark.createDataFrame([], schema)
    width = max(int(width), 1)
    product = ResidueProduct.for_bound(int(norm2 * 1.000001) + 1)  # by Cauchy and Schwarz
    per_slab = max(1, slab_bytes // (8 * width))
    anchors = rows.filter(F.pmod("vec_id", F.lit(every)) == 0)
    slabs = -(-anchors.count() // per_slab)
    if not slabs:
        return spark.createDataFrame([], schema)
    # Hash buckets of rows that are all different, so that none is far larger than the mean.
    anchors = cut_lineage(
        anchors.withColumn("slab", F.pmod(F.xxhash64("vec_id", "label", "v"), F.lit(slabs))), "anchors")
    path = scratch_path(spark, "negatives")
    for slab in range(slabs):
        held = anchors.filter(F.col("slab") == slab).orderBy("vec_id", "label", hash_order(F.col("v").cast("string"))).toArrow()
        if not held.num_rows:
            continue
        one = _slab(held, width, product)
        shared = spark.sparkContext.broadcast(one)
        found = rows.mapInArrow(_positives(shared, width, product, positives), "slot long, positive_id long, positive_score long")
        order = Window.partitionBy("slot").orderBy(F.desc("positive_score"), "positive_id")
        found = found.distinct().withColumn("place", F.row_number().over(order)).filter(F.col("place") <= positives)
        # A few rows for each anchor of the slab.
        pairs = found.orderBy("slot", "place").toArrow()
        owner, best = pairs.column("slot").to_numpy(), pairs.column("positive_score").to_numpy()
        windows = spark.sparkContext.broadcast((one, owner, -(-low * best // 100), high * best // 100))
        names = pa.table({
            "slot": np.arange(len(owner)), "anchor_id": one.key[owner], "positive_id": pairs.column("positive_id"),
            "positive_score": best})
        got = rows.mapInArrow(_negatives(windows, width, product, negatives), "slot long, negative_id long, negative_score long")
        order = Window.partitionBy("slot").orderBy(F.desc("negative_score"), "negative_id")
        got = got.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
        got.join(spark.createDataFrame(names), "slot").select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score",
            "negative_score").write.mode("append").parquet(path)
        shared.destroy()
        windows.destroy()
    return spark.read.schema(schema).parquet(path)
