"""Vectors of texts: TF-IDF of hashed words, and dense ones by a randomised projection of it.

Both start from a stored table that has the counts of a text's slots beside the text; a task counts its own texts,
so nothing is shuffled for that. A small table of slots goes to all tasks, which add up its products with their
texts; products with a larger one are joins with one row for each text and slot, and sums by row or by slot.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from millrace.session import cut_lineage

_ROW = "__row"
# Largest table of slots, as computed from its shape, that is sent to every task.
_SMALL = 64 << 20
# Numbers that are multiplied at once in a task, and words whose slots it remembers.
_AT_ONCE, _MOST_WORDS = 1 << 21, 200_000
# Bytes of text whose words are found at once, and words whose md5 is; bytes of words; and the bits of 8 bytes that a shorter word keeps.
_TEXT_AT_ONCE, _WORDS_AT_ONCE = 1 << 20, 1 << 14
_IN_WORD = np.array([chr(b).isascii() and (chr(b).islower() or chr(b).isdigit() or chr(b) == "_") for b in range(256)]).astype(np.int8)
_MD5_SINES = [np.uint32(int(abs(math.sin(i + 1)) * 2**32)) for i in range(64)]
_KEPT = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype="<u8")


class _SlotOf(dict):
    """The slot of a word, computed once for most of its occurrences in a task."""

    def __init__(self, slots: int):
        super().__init__()
        self.slots = slots

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MOST_WORDS:
            self.clear()
        self[word] = slot = int.from_bytes(hashlib.md5(word).digest()[:4]) % self.slots
        return slot


def _md5_heads(words: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The number in the first 8 hex digits of the md5 of each word; words are rows of 64 bytes with 0 after their end, at most 55 long."""
    words[np.arange(len(words)), size] = 0x80
    m = np.ascontiguousarray(words.view("<u4").T)
    m[14] = size * 8
    start = [np.uint32(x) for x in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)]
    a, b, c, d = (np.full(len(words), x) for x in start)
    for i in range(64):
        if i < 16:
            f, k = (b & c) | (~b & d), i
        elif i < 32:
            f, k = (d & b) | (~d & c), (5 * i + 1) % 16
        elif i < 48:
            f, k = b ^ c ^ d, (3 * i + 5) % 16
        else:
            f, k = c ^ (b | ~d), 7 * i % 16
        f += a + m[k] + _MD5_SINES[i]
        turn = ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21))[i // 16][i % 4]
        a, d, c, b = d, c, b, b + ((f << np.uint32(turn)) | (f >> np.uint32(32 - turn)))
    return (a + start[0]).byteswap().astype(np.int64)


def _slots_of_run(texts: list[bytes], of: _SlotOf) -> Iterator[np.ndarray]:
    """The slots of all words of each text. A word of up to 8 bytes is one number, looked up once in all the texts."""
    raw = b"\0".join([*texts, bytes(64)])
    data = np.frombuffer(raw, dtype=np.uint8)
    # Begins and ends of words in turn: the last byte is in none.
    edges = np.flatnonzero(np.diff(_IN_WORD[data], prepend=np.int8(0)))
    start, end = edges[::2], edges[1::2]
    size = end - start
    out, short = np.empty(len(start), dtype=np.int64), size <= 8
    keys = np.lib.stride_tricks.sliding_window_view(data, 8)[start[short]].view("<u8").ravel() & _KEPT[size[short]]
    keys, at = np.unique(keys, return_inverse=True)
    found = np.empty(len(keys), dtype=np.int64)
    for i in range(0, len(keys), _WORDS_AT_ONCE):
        words = np.zeros((len(keys[i : i + _WORDS_AT_ONCE]), 64), dtype=np.uint8)
        words[:, :8] = keys[i : i + _WORDS_AT_ONCE, None].view(np.uint8)
        found[i : i + _WORDS_AT_ONCE] = _md5_heads(words, np.count_nonzero(words, axis=1)) % of.slots
    out[short] = found[at]
    middle = np.flatnonzero(~short & (size <= 55))
    for i in range(0, len(middle), _WORDS_AT_ONCE):
        part = middle[i : i + _WORDS_AT_ONCE]
        words = np.lib.stride_tricks.sliding_window_view(data, 64)[start[part]]
        words[np.arange(64) >= size[part, None]] = 0
        out[part] = _md5_heads(words, size[part]) % of.slots
    rest = np.flatnonzero(size > 55)
    out[rest] = [of[raw[s:e]] for s, e in zip(start[rest].tolist(), end[rest].tolist(), strict=True)]
    cuts = np.searchsorted(start, np.cumsum([len(t) + 1 for t in texts]))
    for a, b in zip([0, *cuts[:-1].tolist()], cuts.tolist(), strict=True):
        yield out[a:b]


def _slots_of(texts: pd.Series, slots: int) -> Iterator[np.ndarray]:
    """The slots of all words of each text (UTF-8 in lower case, or null)."""
    of, run, size = _SlotOf(slots), [], 0
    for text in texts:
        run.append(text or b"")
        size += len(run[-1]) + 1
        if size >= _TEXT_AT_ONCE:
            yield from _slots_of_run(run, of)
            run, size = [], 0
    if run:
        yield from _slots_of_run(run, of)


def _lower(text: str):
    return F.lower(F.col(text)).cast("binary")


def sentence_vectors(df: DataFrame, text: str, dims: int = 256, output: str = "vector", kind: str = "float") -> DataFrame:
    """Unit-length TF-IDF vectors of hashed words as an array of ``kind``; all 0 for a text without words.

    A word (a run of letters, digits and underscores, in lower case) goes to the slot that the first 8 hex
    digits of its md5 give modulo ``dims``. The weight of a slot is its count times
    ln((texts + 1) / (texts with the slot + 1)). Only ``dims`` document counts come to the driver.
    """
    @F.pandas_udf("array<int>")
    def counts(texts: pd.Series) -> pd.Series:
        return pd.Series([np.bincount(s, minlength=dims).astype(np.int32) for s in _slots_of(texts, dims)], dtype=object)

    rows = cut_lineage(df.withColumn("__n", counts(_lower(text))), "texts")
    total = rows.count()
    seen = dict(rows.select(F.posexplode("__n").alias("slot", "n")).filter("n > 0").groupBy("slot").count().collect())
    idf = F.array(*[F.lit(math.log((total + 1) / (seen.get(k, 0) + 1))) for k in range(dims)])
    weights = F.transform("__n", lambda n, k: n * F.get(idf, k))

    def unit(w):
        # In a list of one, so that the length is computed once for each text.
        length = F.array(F.sqrt(F.aggregate(w, F.lit(0.0), lambda a, x: a + x * x)))
        return F.transform(length, lambda n: F.transform(w, lambda x: F.when(n > 0, x / n).otherwise(0.0).cast(kind)))[0]

    return rows.withColumn(output, F.transform(F.array(weights), unit)[0]).drop("__n")


def _counted(df: DataFrame, text: str, slots: int) -> DataFrame:
    """``df`` with a number for each row, its slots in rising order and how often words of each are in the text, stored."""
    @F.pandas_udf("slots array<int>, n array<int>")
    def counts(texts: pd.Series) -> pd.DataFrame:
        found = [np.unique(s, return_counts=True) for s in _slots_of(texts, slots)]
        return pd.DataFrame({
            "slots": pd.Series([s.astype(np.int32) for s, _ in found], dtype=object),
            "n": pd.Series([n.astype(np.int32) for _, n in found], dtype=object)})

    return cut_lineage(df.withColumn(_ROW, F.monotonically_increasing_id()).withColumn("__held", counts(_lower(text))), "texts")


def _entries(rows: DataFrame, idf: DataFrame) -> DataFrame:
    """Row, slot, w: the weights of each text, not yet of unit length."""
    held = rows.select(_ROW, F.explode(F.arrays_zip("__held.slots", "__held.n")).alias("e"))
    held = held.select(_ROW, F.col("e.slots").alias("slot"), F.col("e.n").alias("n"))
    return held.join(idf, "slot").select(_ROW, "slot", (F.col("n") * F.col("idf")).alias("w")).filter("w > 0")


def _sums(weight, dims: int) -> list:
    """Plain sums of the places of ``vec``: kept in the rows of a hash table, which many groups do not overflow."""
    return [F.sum(weight * F.get("vec", F.lit(i))).alias(f"s{i}") for i in range(dims)]


def _vec(dims: int):
    return F.array(*[f"s{i}" for i in range(dims)]).alias("vec")


def _product(entries: DataFrame, vectors: DataFrame, on: str, by: str, dims: int) -> DataFrame:
    """The matrix of entries (or its transpose) times the vectors: sums by ``by`` over what meets in ``on``.

    Sums are begun where the rows are, so a frequent slot sends one vector a task. ``squares``: the sum of squared weights.
    """
    squares = F.sum(F.col("w") * F.col("w")).alias("squares")
    return entries.join(vectors, on).groupBy(by).agg(*_sums(F.col("w"), dims), squares).select(by, _vec(dims), "squares")


def _there_and_back(rows: DataFrame, idf: np.ndarray, table: np.ndarray) -> DataFrame:
    """The transposed matrix of unit-length rows times that matrix times the table: slot, vec. Each task adds up its texts."""
    dims = table.shape[1]
    shared = rows.sparkSession.sparkContext.broadcast((idf, table))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, table = shared.value
        out, most = np.zeros_like(table), max(_AT_ONCE // dims, 1)
        for batch in batches:
            begin = batch.column(0).offsets.to_numpy()
            slot, n = (batch.column(i).values.to_numpy() for i in (0, 1))
            weight = n * idf[slot]
            first = 0
            while first < batch.num_rows:
                # As many texts as fit, one at least.
                last = max(int(np.searchsorted(begin, begin[first] + most, side="right")) - 1, first + 1)
                size = np.diff(begin[first : last + 1])
                size = size[size > 0]
                s, w = slot[begin[first] : begin[last]], weight[begin[first] : begin[last], None]
                first = last
                if not len(s):
                    continue
                starts = np.cumsum(size) - size
                ahead, squares = np.add.reduceat(w * table[s], starts), np.add.reduceat(w * w, starts)
                ahead = np.divide(ahead, squares, out=np.zeros_like(ahead), where=squares > 0)
                order = np.argsort(s, kind="stable")
                s = s[order]
                new = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
                out[s[new]] += np.add.reduceat((w * np.repeat(ahead, size, axis=0))[order], new)
        used = np.flatnonzero(out.any(axis=1))
        for a in range(0, len(used), 4096):
            part = used[a : a + 4096]
            offsets = np.arange(len(part) + 1, dtype=np.int32) * dims
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int32)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(out[part].ravel()))],
                names=["slot", "vec"])

    parts = rows.select("__held.slots", "__held.n").mapInArrow(run, "slot int, vec array<double>")
    return parts.groupBy("slot").agg(*_sums(F.lit(1.0), dims)).select("slot", _vec(dims))


def _array_of(table: DataFrame, slots: int, dims: int) -> np.ndarray:
    """A small table of slots as one array."""
    found, out = table.select("slot", "vec").toArrow(), np.zeros((slots, dims))
    if found.num_rows:
        flat = found.column("vec").combine_chunks()
        out[found.column("slot").to_numpy()] = flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
    return out


def _orthonormal(vectors: DataFrame, dims: int) -> DataFrame:
    """The vectors of all slots with orthonormal columns; directions that hold nothing become 0.

    Only the products of columns with each other, dims x dims, come to the driver.
    """
    def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((dims, dims))
        for batch in batches:
            if len(batch):
                m = np.stack(batch["vec"].to_numpy())
                sums += m.T @ m
        yield pd.DataFrame({"vec": [sums.ravel().tolist()]})

    partial = vectors.select("vec").mapInPandas(products, "vec array<double>")
    gram = partial.agg(Summarizer.sum(array_to_vector("vec")).alias("s")).first()["s"].toArray().reshape(dims, dims)
    values, turn = np.linalg.eigh(gram)
    held = values > max(values.max(), 0) * 1e-12
    scale = turn * np.where(held, 1 / np.sqrt(np.where(held, values, 1)), 0)

    def turned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.assign(vec=list(np.stack(batch["vec"].to_numpy()) @ scale))

    return vectors.select("slot", "vec").mapInPandas(turned, "slot int, vec array<double>")


def dense_vectors(
    df: DataFrame, text: str, dims: int = 64, slots: int = 1 << 14, rounds: int = 2, seed: int = 7, output: str = "vector",
) -> DataFrame:
    """Dense vectors of unit length (array of float) whose inner products stand for those of TF-IDF vectors.

    The TF-IDF matrix with ``slots`` columns is multiplied by the ``dims`` directions in which its texts vary most. They come
    from random signs (hashes of slot and number) by ``rounds`` multiplications with the transposed matrix
    and the matrix, made orthonormal after each. Texts without words that weigh anything (null, empty, or only
    words that all texts have) get zeros. Equal texts get equal vectors up to rounding.
    """
    rows = _counted(df, text, slots)
    total = rows.count()
    small = slots * dims * 8 <= _SMALL

    def sent(table: DataFrame) -> DataFrame:
        return F.broadcast(table) if small else table

    texts_with = rows.select(F.explode("__held.slots").alias("slot")).groupBy("slot").agg(F.count("*").alias("texts"))
    idf = cut_lineage(texts_with.select("slot", F.log(F.lit(total + 1.0) / (F.col("texts") + 1)).alias("idf")), "idf")
    entries = _entries(rows, sent(idf))
    signs = F.transform(
        F.sequence(F.lit(0), F.lit(dims - 1)), lambda j: F.when(F.xxhash64("slot", j, F.lit(seed)) % 2 == 0, 1.0).otherwise(-1.0))
    table = df.sparkSession.range(slots).select(F.col("id").cast("int").alias("slot")).select("slot", signs.alias("vec"))
    if small and rounds:
        weights = np.zeros(slots)
        for slot, weight in idf.collect():
            weights[slot] = weight
    for _ in range(rounds):
        if small:
            back = _there_and_back(rows, weights, _array_of(table, slots, dims))
        else:
            # Rows of unit length, there and back: one division by the squared length.
            ahead = _product(entries, table, "slot", _ROW, dims)
            ahead = ahead.select(_ROW, F.transform("vec", lambda x: x / F.col("squares")).alias("vec"))
            back = _product(entries, ahead, _ROW, "slot", dims)
        table = cut_lineage(_orthonormal(cut_lineage(back.select("slot", "vec"), "directions"), dims), "directions")
    found = _product(entries, sent(table), "slot", _ROW, dims).select(_ROW, F.col("vec").alias("__v"))
    length = F.sqrt(F.aggregate("__v", F.lit(0.0), lambda a, x: a + x * x))
    found = found.withColumn("__n", length).select(
        _ROW, F.transform("__v", lambda x: F.when(F.col("__n") > 0, x / F.col("__n")).otherwise(0.0).cast("float")).alias("__v"))
    zeros = F.array_repeat(F.lit(0.0).cast("float"), dims)
    return rows.join(found, _ROW, "left").withColumn(output, F.coalesce("__v", zeros)).drop(_ROW, "__v", "__held")
