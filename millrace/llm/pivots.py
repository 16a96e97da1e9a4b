"""Exact top-k by inner product with a pivot-distance index.

Each vector gets one more component so that all have the same norm; then a larger inner product is
a smaller distance, and the triangle inequality holds. Vectors are keyed by their nearest pivot and
their distance to it, in rings. A query visits rings in the order of their best possible score, more
in each round, and stops when no ring that is left can reach its k-th score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import hash_order
from millrace.session import cut_lineage


@dataclass
class Directory:
    """Pivots with the added component, and the rings: pivot, ring, least and largest distance, chunks."""

    width: int
    norm2: float
    pivots: np.ndarray
    rings: pd.DataFrame

    def lifted(self, v: np.ndarray, query: bool) -> np.ndarray:
        """Vectors with the added component: 0 for a query, what is missing to the norm for a row."""
        extra = np.zeros(len(v)) if query else np.sqrt(np.maximum(self.norm2 - (v * v).sum(1), 0.0))
        return np.column_stack([v, extra])

    def distances(self, lifted: np.ndarray) -> np.ndarray:
        square = (lifted * lifted).sum(1)[:, None] + (self.pivots * self.pivots).sum(1)[None, :] - 2 * lifted @ self.pivots.T
        return np.sqrt(np.maximum(square, 0.0))

    def best_scores(self, v: np.ndarray) -> np.ndarray:
        """The most that a row of each ring can score for each query, a little too high rather than too low."""
        d = self.distances(self.lifted(v, query=True))[:, self.rings["pivot"].to_numpy()]
        near = np.maximum(np.maximum(d - self.rings["far"].to_numpy(), self.rings["near"].to_numpy() - d), 0.0)
        slack = 1e-6 * (1.0 + np.sqrt(self.norm2))
        near = np.maximum(near - slack, 0.0)
        own = (v * v).sum(1)[:, None]
        best = (own + self.norm2 - near * near) / 2
        return best + 1e-9 * (own + self.norm2) + 1e-6


def _matrix(column, width: int) -> np.ndarray:
    """Lists of whole numbers as rows of one width; missing components are 0."""
    out = np.zeros((len(column), width))
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    return out


def _pivots(rows: np.ndarray, number: int, turns: int = 8) -> np.ndarray:
    """Centres of the rows by k-means from spread starts; at most ``number``."""
    chosen = rows[:1]
    least = ((rows - chosen[0]) ** 2).sum(1)
    while len(chosen) < number and least.max() > 0:
        chosen = np.vstack([chosen, rows[int(np.argmax(least))]])
        least = np.minimum(least, ((rows - chosen[-1]) ** 2).sum(1))
    for _ in range(turns):
        square = (rows * rows).sum(1)[:, None] + (chosen * chosen).sum(1)[None, :] - 2 * rows @ chosen.T
        nearest = square.argmin(1)
        chosen = np.vstack([rows[nearest == i].mean(0) if (nearest == i).any() else chosen[i] for i in range(len(chosen))])
    return chosen


def whole_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """vec_id and v = floor(scale * x) for each component; rows with anything null or not finite go."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    fine = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return (
        df.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x"))
        .filter(F.col("vec_id").isNotNull() & F.col("x").isNotNull()).filter(fine)
        .select("vec_id", F.transform("x", lambda c: F.floor(c * scale)).alias("v"))
    )


def _meet(k: int, width: int, exact: bool):
    """Best k rows of one chunk for each query that visits it, of those that can still count."""

    def run(chunk: pa.Table, queries: pa.Table) -> pa.Table:
        schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
        if not chunk.num_rows or not queries.num_rows:
            return schema.empty_table()
        kind = np.float64 if exact else np.int64
        chunk = chunk.sort_by("vec_id")
        ids = chunk.column("vec_id").to_numpy()
        rows = _matrix(chunk.column("v").to_pylist(), width).astype(kind)
        out = []
        for a in range(0, queries.num_rows, 1024):
            part = queries.slice(a, 1024)
            q = part.column("query_id").to_numpy()
            least = part.column("least").to_numpy()
            score = (_matrix(part.column("v").to_pylist(), width).astype(kind) @ rows.T).astype(np.int64)
            able = (score >= least[:, None]) & (ids[None, :] != q[:, None])
            score = np.where(able, score, np.iinfo(np.int64).min)
            if score.shape[1] > k:
                bar = np.partition(score, score.shape[1] - k, axis=1)[:, -k]
                able &= score >= bar[:, None]
            i, j = np.nonzero(able)
            order = np.lexsort((ids[j], -score[i, j], i))
            i, j = i[order], j[order]
            rank = np.arange(len(i)) - np.searchsorted(i, i, side="left")
            i, j = i[rank < k], j[rank < k]
            out.append((q[i], ids[j], score[i, j]))
        return pa.table([np.concatenate(c) for c in zip(*out, strict=True)], schema=schema)

    return run


def top_k(
    df: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256,
    pivots: int = 64, rings: int = 16, chunk_rows: int = 2048, sample: int = 4096, query_rows: int = 20_000,
) -> DataFrame:
    """The ``k`` rows with the highest inner product for each query: query_id, rank, vec_id, score.

    Queries are the rows whose id is divisible by ``every``; all other rows are candidates. Ties go
    to the smaller id. Vectors that are null, or hold null or what is not finite, take no part, nor do rows
    without an id; a vector that is shorter than another has zeros in place of the missing components.
    Equal repeated rows count once. An empty table gives no rows.

    Pivots come from ``sample`` rows at most, so the directory of ``pivots`` times ``rings`` rings is
    bounded and is given to the tasks. A ring with many rows is cut into chunks; queries meet chunks
    in blocks. No pair is visited that the bound rules out.
    """
    rows = cut_lineage(whole_vectors(df, id_col, vector_col, scale).distinct(), "vectors")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    width, norm2, number = rows.agg(F.max(F.size("v")), F.max(square), F.count("*")).first()
    schema = "query_id long, rank int, vec_id long, score long"
    if not number:
        return df.sparkSession.createDataFrame([], schema)
    width, norm2 = max(int(width), 1), float(norm2)
    directory = Directory(width, norm2, np.zeros((1, width + 1)), pd.DataFrame())
    picked = [r[0] for r in rows.orderBy(hash_order("vec_id"), "vec_id").limit(sample).select("v").collect()]
    directory.pivots = _pivots(directory.lifted(_matrix(picked, width), query=False), pivots)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column(1).to_pylist(), width)
            d = directory.distances(directory.lifted(v, query=False))
            nearest = d.argmin(1) if len(v) else np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(nearest, pa.int64()), pa.array(d[np.arange(len(v)), nearest])],
                names=["vec_id", "v", "pivot", "distance"])

    placed = cut_lineage(rows.mapInArrow(assign, "vec_id long, v array<long>, pivot long, distance double"), "placed")
    shares = [i / rings for i in range(1, rings)]
    cuts = {r["pivot"]: sorted(set(r["cuts"])) for r in placed.groupBy("pivot").agg(
        F.percentile_approx("distance", shares, 1000).alias("cuts")).collect()}  # one row a pivot
    ring = F.lit(0)
    for pivot, at in cuts.items():
        inside = F.size(F.filter(F.array(*[F.lit(c) for c in at]), lambda c: c <= F.col("distance")))
        ring = F.when(F.col("pivot") == pivot, inside).otherwise(ring)
    placed = placed.withColumn("ring", ring)
    found = placed.groupBy("pivot", "ring").agg(
        F.min("distance").alias("near"), F.max("distance").alias("far"), F.count("*").alias("n")).toPandas()
    found = found.sort_values(["pivot", "ring"]).reset_index(drop=True)  # pivots times rings rows at most
    found["chunks"] = -(-found["n"] // chunk_rows)
    directory.rings = found
    known = df.sparkSession.createDataFrame(found[["pivot", "ring", "chunks"]].astype("int64"))
    chunked = cut_lineage(
        placed.join(F.broadcast(known), ["pivot", "ring"])
        .select("pivot", F.col("ring").cast("long").alias("ring"),
                F.pmod(F.xxhash64("vec_id"), F.col("chunks")).alias("chunk"), "vec_id", "v"), "chunks")
    queries = rows.filter(F.pmod("vec_id", F.lit(every)) == 0).select(
        F.col("vec_id").alias("query_id"), "v", F.lit(None).cast("long").alias("least"))
    blocks = -(-max(1, number // every) // query_rows)
    best = None
    begin, size = 0, 4
    total = len(found)
    while begin < total:
        visits = cut_lineage(queries.mapInArrow(
            _visits(directory, begin, begin + size), "query_id long, v array<long>, least long, pivot long, ring long, chunk long"
        ).withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks))), "visits")
        begin, size = begin + size, size * 4
        if visits.isEmpty():
            # A later ring of some query may still be able; the bounds fall along its order, so none is.
            break
        keys = ["pivot", "ring", "chunk", "block"]
        met = chunked.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
        # Only chunks that some query visits are moved.
        met = met.join(visits.select(*keys).distinct(), keys, "left_semi")
        new = met.groupBy(*keys).cogroup(visits.groupBy(*keys)).applyInArrow(
            _meet(k, width, norm2 < 2.0 ** 52), "query_id long, vec_id long, score long")
        new = new if best is None else new.unionByName(best.select("query_id", "vec_id", "score"))
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        best = cut_lineage(new.withColumn("rank", rank).filter(F.col("rank") <= k), "best")
        bars = best.filter(F.col("rank") == k).select("query_id", F.col("score").alias("least"))
        queries = cut_lineage(queries.drop("least").join(bars, "query_id", "left").select("query_id", "v", "least"), "queries")
    if best is None:
        return df.sparkSession.createDataFrame([], schema)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _visits(directory: Directory, begin: int, end: int):
    """For each query, the rings from ``begin`` to ``end`` in its order that can still reach its k-th score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot, ring, chunks = (directory.rings[c].to_numpy(dtype=np.int64) for c in ("pivot", "ring", "chunks"))
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            able = directory.best_scores(_matrix(table.column("v").to_pylist(), directory.width))
            order = np.argsort(-able, axis=1, kind="stable")[:, begin:end]
            bar = np.array([-np.inf if b is None else float(b) for b in table.column("least").to_pylist()])
            i, j = np.nonzero(np.take_along_axis(able, order, axis=1) >= bar[:, None])
            r = order[i, j]
            number = chunks[r]
            i, r = np.repeat(i, number), np.repeat(r, number)
            chunk = np.arange(len(i)) - np.repeat(np.cumsum(number) - number, number)
            rows = table.take(pa.array(i, pa.int64()))
            least = rows.column("least").fill_null(np.iinfo(np.int64).min)
            yield from pa.table({
                "query_id": rows.column("query_id"), "v": rows.column("v"), "least": least,
                "pivot": pivot[r], "ring": ring[r], "chunk": chunk}).combine_chunks().to_batches()

    return run
