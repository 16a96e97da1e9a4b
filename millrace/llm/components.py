"""Connected components of a graph whose edges are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import cut_lineage


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Rows node, root: nodes of one component share a root. Nodes without an edge are not listed.

    Each round moves every node to the first of its neighbours and itself, in an order drawn anew
    by hash, and draws the edges between the new places. The order keeps chains short, so a few
    rounds do, as many as the logarithm of the nodes. Minima are combined before the shuffle, so a
    node with very many edges is no burden; all tables are written to the shared folder.
    """
    work = cut_lineage(
        edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a != b").distinct(), "edges")
    roots, turn = None, 0
    while not work.isEmpty():
        turn += 1
        both = work.select(F.col("a").alias("node"), F.col("b").alias("near")).unionAll(
            work.select(F.col("b").alias("node"), F.col("a").alias("near")))
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(turn)).alias("rank"), F.col(c).alias("id"))  # noqa: E731, B023
        moves = cut_lineage(
            both.groupBy("node").agg(F.min(rank("near")).alias("best"))
            .select("node", F.least("best", rank("node"))["id"].alias("root")), "moves",
        )
        if roots is None:
            roots = moves
        else:
            later = moves.select(F.col("node").alias("root"), F.col("root").alias("_root"))
            roots = cut_lineage(
                roots.join(later, "root", "left").select("node", F.coalesce("_root", "root").alias("root")), "roots")
        to_a = moves.select(F.col("node").alias("a"), F.col("root").alias("new_a"))
        to_b = moves.select(F.col("node").alias("b"), F.col("root").alias("new_b"))
        work = cut_lineage(
            work.join(to_a, "a").join(to_b, "b")
            .select(F.least("new_a", "new_b").alias("a"), F.greatest("new_a", "new_b").alias("b"))
            .filter("a != b").distinct(), "edges",
        )
    if roots is None:
        roots = work.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots
