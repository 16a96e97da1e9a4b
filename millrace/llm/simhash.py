"""Near-duplicate texts by SimHash fingerprints and multi-index hashing.

Fingerprints of 64 bits link at 3 or fewer differing bits. Then one 32-bit half differs in one bit
at most. So each fingerprint is listed by both halves, and looks into the lists of the halves next
to its own; of two halves that differ in a bit, the one with the bit set looks up the other. What
meets in a list is compared in full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import put_back, set_apart, tasks_for, whole
from millrace.llm.components import components
from millrace.session import cut_lineage

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
# bit j of each byte value
BITS = ((np.arange(256)[:, None] >> np.arange(8)[None, :]) & 1).astype(np.int64)
WITHIN = 3
SEED = 42


def shingle_hashes(text: str, size: int = 3) -> list[int]:
    """XXH64 of each run of ``size`` words, of all words where there are fewer, none without words."""
    words = text.encode("utf-8", "surrogatepass").translate(LOWER).split()
    if len(words) < size:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else []
    digest = xxhash.xxh64_intdigest
    return [digest(s, SEED) for s in map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))]


def fingerprint_array(texts: list[str], size: int = 3) -> np.ndarray:
    """Fingerprints as signed longs: a bit is set if over half of the shingle hashes have it."""
    counts = np.zeros((len(texts), 64), dtype=np.int64)
    totals = np.zeros(len(texts), dtype=np.int64)
    for start, stop in _slices(texts):
        hashes = [np.array(shingle_hashes(t, size), dtype=np.uint64) for t in texts[start:stop]]
        lengths = np.array([len(h) for h in hashes])
        totals[start:stop] = lengths
        if not lengths.sum():
            continue
        octets = np.concatenate(hashes).astype("<u8").view(np.uint8).reshape(-1, 8)
        row = np.repeat(np.arange(stop - start) * 256, lengths)
        for k in range(8):
            seen = np.bincount(row + octets[:, k], minlength=256 * (stop - start)).reshape(-1, 256)
            counts[start:stop, 8 * k : 8 * k + 8] = seen @ BITS
    bits = (2 * counts > totals[:, None]).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").reshape(-1).astype(np.uint64).view(np.int64)


def _slices(texts: list[str], chars: int = 2_000_000, most: int = 1024) -> Iterator[tuple[int, int]]:
    """Cuts a batch so that the shingles in memory stay few; each slice has one text at least."""
    start = held = 0
    for i, t in enumerate(texts):
        if i > start and (held + len(t) > chars or i - start >= most):
            yield start, i
            start, held = i, 0
        held += len(t)
    if texts:
        yield start, len(texts)


def fingerprints(docs: DataFrame, keep: list[str], text_col: str = "text", size: int = 3) -> DataFrame:
    """The columns ``keep`` and ``fp``, the fingerprint as a long; null text is empty, with 0."""
    rows = docs.select(*keep, whole(text_col).alias("_text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.drop("_text").schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("_text")
            found = pa.array(fingerprint_array(batch.column(at).to_pylist(), size))
            rest = [i for i in range(batch.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in rest] + [found], names=[batch.schema.names[i] for i in rest] + ["fp"])

    return rows.mapInArrow(run, f"{fields}, fp long")


def _linked(homes: np.ndarray, guests: np.ndarray, within: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what lies within the distance: home to home, and guest to home.

    Each value once reached is not compared again, so a dense list costs about its length, and at
    most one link for each value comes out.
    """
    free_homes, free_guests = homes, guests
    from_, to = [], []

    def reach(front: np.ndarray, free: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the free ones some value of the front reaches, and that value."""
        hit = np.zeros(len(free), dtype=bool)
        by = np.zeros(len(free), dtype=np.uint64)
        step = max(1, 2_000_000 // max(1, len(free)))
        for i in range(0, len(front), step):
            near = np.bitwise_count(front[i : i + step, None] ^ free[None, :]) <= within
            new = near.any(axis=0) & ~hit
            by[new] = front[i : i + step][near[:, new].argmax(axis=0)]
            hit |= new
        return hit, by

    while len(free_homes):
        front_homes, front_guests = free_homes[:1], free_guests[:0]
        free_homes = free_homes[1:]
        while len(front_homes) or len(front_guests):
            hit_g, by_g = reach(front_homes, free_guests)
            front = np.concatenate([front_homes, front_guests])
            hit_h, by_h = reach(front, free_homes)
            from_ += [by_g[hit_g], by_h[hit_h]]
            to += [free_guests[hit_g], free_homes[hit_h]]
            front_guests, free_guests = free_guests[hit_g], free_guests[~hit_g]
            front_homes, free_homes = free_homes[hit_h], free_homes[~hit_h]
    if not from_:
        return homes[:0], homes[:0]
    return np.concatenate(from_), np.concatenate(to)


def _links_of_lists(within: int):
    """Function for ``mapInPandas`` over rows sorted by list: the links inside each list."""
    key = ["half", "key", "cell"]

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        fps = rows["fp"].to_numpy().view(np.uint64)
        guest = rows["guest"].to_numpy()
        new = (rows[key].to_numpy()[1:] != rows[key].to_numpy()[:-1]).any(axis=1)
        edges = np.concatenate([[0], np.flatnonzero(new) + 1, [len(rows)]])
        a, b = [], []
        for s, e in zip(edges[:-1], edges[1:], strict=True):
            if e - s < 2:
                continue
            x, y = _linked(fps[s:e][~guest[s:e]], fps[s:e][guest[s:e]], within)
            a.append(x)
            b.append(y)
        none = np.zeros(0, dtype=np.uint64)
        return pd.DataFrame({
            "a": np.concatenate([none, *a]).view(np.int64), "b": np.concatenate([none, *b]).view(np.int64)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            # The last list may go on in the next batch.
            last = (batch[key] == batch[key].iloc[-1]).all(axis=1).to_numpy()
            cut = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
            if cut or (held and (held[-1][key].iloc[-1] != batch[key].iloc[0]).any()):
                yield solve(pd.concat([*held, batch.iloc[:cut]]))
                held = []
            held.append(batch.iloc[cut:])
        if held:
            yield solve(pd.concat(held))

    return run


def fingerprint_links(fps: DataFrame, list_rows: int = 20_000) -> DataFrame:
    """Links a, b that connect all distinct fingerprints within 3 bits; not every close pair has one.

    ``fps`` has distinct ``fp``. A list with more than ``list_rows`` rows is cut into blocks, and each two
    blocks meet in a task of their own.
    """
    spark = fps.sparkSession
    low = F.lit(0xFFFFFFFF)
    halves = fps.select("fp", F.explode(F.array(
        F.struct(F.lit(0).alias("half"), F.shiftrightunsigned("fp", 32).alias("own")),
        F.struct(F.lit(1).alias("half"), F.col("fp").bitwiseAND(low).alias("own")),
    )).alias("x")).select("fp", "x.*")
    homes = halves.select("half", F.col("own").alias("key"), "fp", F.lit(False).alias("guest"))
    one_off = F.filter(
        F.transform(F.sequence(F.lit(0), F.lit(31)), lambda j: F.when(
            F.call_function("shiftright", F.col("own"), j).bitwiseAND(F.lit(1)) == 1,
            F.col("own").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), j)))),
        lambda k: k.isNotNull(),
    )
    guests = halves.select("half", F.explode(one_off).alias("key"), "fp", F.lit(True).alias("guest"))
    listed = homes.groupBy("half", "key").count().drop("count")
    # Spark sizes what an explode makes as if it made one row of each; without the hint it may broadcast all of it.
    rows = cut_lineage(homes.unionByName(guests.join(listed.hint("shuffle_merge"), ["half", "key"])), "lists")
    sizes = rows.groupBy("half", "key").count().filter("count > 1").select(
        "half", "key", F.ceil(F.col("count") / list_rows).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("blocks")).cast("int")
    cells = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.least(other, F.col("block")) * F.col("blocks") + F.greatest(other, F.col("block")))
    met = rows.join(sizes.hint("shuffle_merge"), ["half", "key"]).withColumn("block", block).select(
        "half", "key", F.explode(cells).alias("cell"), "guest", "fp")
    tasks = tasks_for(spark, 0, 1)
    return (
        met.repartition(tasks, "half", "key", "cell").sortWithinPartitions("half", "key", "cell", "guest")
        .mapInPandas(_links_of_lists(WITHIN), "a long, b long")
    )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row for each text: doc_id, fp, component_id, and the columns ``keep``.

    ``component_id`` is the smallest id of all texts that links reach. Null and empty texts have
    fingerprint 0 and link as any other; ids that are null are never the smallest, unless there is
    no other. Repeated rows are all returned. An empty table gives no rows.
    """
    rows = cut_lineage(
        fingerprints(docs.select(F.col(id_col).alias("doc_id"), *keep, F.col(text_col).alias("text")), ["doc_id", *keep]),
        "fingerprints")
    firsts = cut_lineage(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "firsts")
    roots = components(fingerprint_links(firsts.select("fp")), "a", "b")
    rooted = cut_lineage(
        firsts.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
        .select("fp", "first", F.coalesce("root", "fp").alias("root")), "rooted")
    # Most fingerprints are alone; the smallest id of a component is found before it is handed out.
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = rooted.join(smallest, "root").select("fp", "root", "component_id")
    return rows.join(classes, "fp")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay when one of each component stays: the one with the smallest id.

    All columns stay, whatever their names. Among rows with the same id, and of null ids, the order of
    the texts' hashes decides; of equal rows one stays.
    """
    roles = {"doc_id": id_col, "text": text_col}
    marked = set_apart(docs, **roles).withColumn("_md5", F.md5(whole("text")))
    found = near_duplicates(marked, keep=("_md5",))
    best = found.groupBy("root").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("_md5").alias("md5"))).alias("best"))
    best = best.select(F.col("best.id").alias("_best_id"), F.col("best.md5").alias("_best_md5"))
    stay = marked.join(
        best, marked["doc_id"].eqNullSafe(best["_best_id"]) & (marked["_md5"] == best["_best_md5"]), "left_semi")
    return put_back(stay.dropDuplicates(["doc_id", "_md5"]), docs, **roles)
