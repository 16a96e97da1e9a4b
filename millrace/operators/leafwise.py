"""Boosted trees that grow leaf by leaf: the leaf with the greatest gain is split next.

Spark ML's trees grow level by level. Here the executors sum gradients into histograms of binned
features and Spark adds them up and finds the best split of each leaf; the driver holds the tree
and one row per leaf. Gradients are whole numbers of a fixed unit, so sums do not depend on the
order of tasks, and a run that lost executors gives the same trees.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from millrace.session import cut_lineage

SQUARED, LOGISTIC = "squared", "logistic"


@dataclass
class Tree:
    """Nodes in arrays: rows with ``bin <= cut`` of the feature go left; a node without children is a leaf."""

    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def add(self, value: float) -> int:
        for column, start in ((self.feature, 0), (self.cut, 0), (self.left, -1), (self.right, -1), (self.value, value)):
            column.append(start)
        return len(self.value) - 1

    def leaves_of(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row of ``bins`` (rows x features)."""
        feature, cut, left, right = (np.asarray(c) for c in (self.feature, self.cut, self.left, self.right))
        at, rows = np.zeros(len(bins), dtype=np.int64), np.arange(len(bins))
        while len(rows):
            rows = rows[left[at[rows]] >= 0]
            node = at[rows]
            at[rows] = np.where(bins[rows, feature[node]] <= cut[node], left[node], right[node])
        return at

    def values_of(self, bins: np.ndarray) -> np.ndarray:
        return np.asarray(self.value)[self.leaves_of(bins)]


def bin_edges(df: DataFrame, columns: Sequence[str], bins: int, accuracy: float = 0.001) -> list[list[float]]:
    """Cuts between the bins of each column: quantiles from one pass; at most ``bins`` - 1 numbers a column."""
    doubles = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(f"x{i}") for i, c in enumerate(columns)])
    shares = [k / bins for k in range(1, bins)]
    found = doubles.agg(*[
        F.percentile_approx(f"x{i}", shares, int(1 / accuracy)).alias(f"x{i}") for i in range(len(columns))]).first()
    return [sorted(set(found[i] or [])) for i in range(len(columns))]


def to_bins(values: np.ndarray, edges: Sequence[Sequence[float]]) -> np.ndarray:
    """Bin numbers of ``values`` (rows x features); missing values have bin 0 to themselves."""
    out = np.empty(values.shape, dtype=np.int16)
    for i, cuts in enumerate(edges):
        column = values[:, i]
        out[:, i] = np.where(np.isnan(column), 0, 1 + np.searchsorted(cuts, column, side="left"))
    return out


def _slopes(kind: str, label: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivative of the loss."""
    if kind == SQUARED:
        return margin - label, np.ones(len(label))
    chance = 1 / (1 + np.exp(-margin))
    return chance - label, chance * (1 - chance)


def _bins_of(batch: pa.RecordBatch, features: int) -> np.ndarray:
    return np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(features)])


def _histograms(kind: str, features: int, bins: int, recent: list[Tree], tree: Tree, wanted: list[int], units):
    """Sums of the wanted nodes' rows in one task: node, feature, bin, g and h (in units) and n."""
    slot = np.full(len(tree.value), -1)
    slot[wanted] = np.arange(len(wanted))
    cells = len(wanted) * features * bins

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((3, cells), dtype=np.int64)
        for batch in batches:
            x = _bins_of(batch, features)
            label, margin = (batch.column(features + k).to_numpy(zero_copy_only=False) for k in (0, 1))
            for done in recent:
                margin = margin + done.values_of(x)
            g, h = _slopes(kind, label, margin)
            at = slot[tree.leaves_of(x)]
            inside = at >= 0
            x, at, g, h = x[inside], at[inside], np.rint(g[inside] * units[0]), np.rint(h[inside] * units[1])
            for f in range(features):
                cell = (at * features + f) * bins + x[:, f]
                # Batches are small enough for whole numbers to stay exact in doubles.
                for row, weights in enumerate((g, h, None)):
                    sums[row] += np.bincount(cell, weights, cells).astype(np.int64)
        used = np.flatnonzero(sums[2])
        yield pa.RecordBatch.from_arrays([
            pa.array(np.asarray(wanted, dtype=np.int32)[used // (features * bins)]),
            pa.array((used // bins % features).astype(np.int32)), pa.array((used % bins).astype(np.int32)),
            *[pa.array(s[used]) for s in sums]], names=["node", "feature", "bin", "g", "h", "n"])

    return run


def _best_splits(sums: DataFrame, units: tuple[float, float], l2: float, least_rows: int) -> DataFrame:
    """The best split of each node: feature, cut, gain, and what lies on both sides of it.

    Ties go to the smallest feature, then cut.
    """
    # One row a task and bin already: sent once by node and feature, which serves the window too.
    added = sums.repartition("node", "feature").groupBy("node", "feature", "bin").agg(*[F.sum(c).alias(c) for c in ("g", "h", "n")])
    whole = Window.partitionBy("node", "feature")
    below = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    sides = added.select(
        "node", "feature", "bin",
        *[F.sum(c).over(below).alias(f"{c}_left") for c in ("g", "h", "n")],
        *[F.sum(c).over(whole).alias(c) for c in ("g", "h", "n")],
    ).withColumns({f"{c}_right": F.col(c) - F.col(f"{c}_left") for c in ("g", "h", "n")})

    def strength(side: str):
        g, h = F.col(f"g{side}") / units[0], F.col(f"h{side}") / units[1] + l2
        return F.when(h > 0, g * g / h).otherwise(0.0)

    gain = strength("_left") + strength("_right") - strength("")
    able = sides.filter((F.col("n_left") >= least_rows) & (F.col("n_right") >= least_rows)).withColumn("gain", gain)
    return able.groupBy("node").agg(F.max_by(
        F.struct("feature", F.col("bin").alias("cut"), "gain", "g_left", "h_left", "g_right", "h_right"),
        F.struct("gain", -F.col("feature"), -F.col("bin"))).alias("best"))


class _Growth:
    """One tree while it grows. Splits are looked up ahead, so that one scan serves several of them."""

    def __init__(self, find, value, leaves: int):
        self.find, self.value, self.leaves = find, value, leaves
        self.ahead, self.best, self.known = Tree(), {}, set()
        self.ahead.add(0.0)

    def _open(self, node: int) -> None:
        """Give a node with a known split its two children in the tree that is looked ahead."""
        best = self.best[node]
        t = self.ahead
        t.feature[node], t.cut[node] = best["feature"], best["cut"]
        t.left[node], t.right[node] = (
            t.add(self.value(best["g_left"], best["h_left"])), t.add(self.value(best["g_right"], best["h_right"])))

    def _look(self, frontier: list[int], room: int) -> None:
        """Find the splits of all open leaves, and of the children of those that may be split next."""
        likely = sorted((n for n in frontier if n in self.best), key=lambda n: -self.best[n]["gain"])[:room]
        for node in likely:
            if self.ahead.left[node] < 0:
                self._open(node)
        asked = [n for n in range(len(self.ahead.value)) if self.ahead.left[n] < 0 and n not in self.known]
        self.best |= self.find(self.ahead, asked)
        self.known |= set(asked)

    def grow(self) -> Tree | None:
        """The tree with at most ``leaves`` leaves; none if no split gains anything."""
        frontier, chosen = [0], set()
        while len(frontier) < self.leaves:
            if any(n not in self.known for n in frontier):
                self._look(frontier, self.leaves - len(frontier))
            able = [n for n in frontier if n in self.best]
            if not able:
                break
            node = min(able, key=lambda n: (-self.best[n]["gain"], n))
            if self.ahead.left[node] < 0:
                self._open(node)
            chosen.add(node)
            frontier.remove(node)
            frontier += [self.ahead.left[node], self.ahead.right[node]]
        if not chosen:
            return None
        # Leave out what was looked up but not chosen.
        tree, numbers = Tree(), {}

        def copy(node: int) -> int:
            numbers[node] = at = tree.add(self.ahead.value[node])
            if node in chosen:
                tree.feature[at], tree.cut[at] = self.ahead.feature[node], self.ahead.cut[node]
                tree.left[at] = copy(self.ahead.left[node])
                tree.right[at] = copy(self.ahead.right[node])
            return at

        copy(0)
        return tree


class _LeafwiseParams(HasInputCols, HasLabelCol, HasPredictionCol):
    kind = Param(Params._dummy(), "kind", "squared (numbers) or logistic (0 or 1)", TypeConverters.toString)
    scoreCol = Param(Params._dummy(), "scoreCol", "column of the chance of 1, if logistic", TypeConverters.toString)

    def __init__(self, *args):
        super().__init__(*args)
        self._setDefault(kind=SQUARED, scoreCol="score", predictionCol="prediction")


class LeafwiseModel(Model, _LeafwiseParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted trees; saved and loaded as any stage of a pipeline."""

    content = Param(Params._dummy(), "content", "edges, base and trees as JSON", TypeConverters.toString)

    def __init__(self, **values):
        super().__init__()
        self._set(**values)

    @property
    def trees(self) -> list[Tree]:
        return [Tree(**t) for t in json.loads(self.getOrDefault("content"))["trees"]]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        found = json.loads(self.getOrDefault("content"))
        edges, base, trees = found["edges"], found["base"], self.trees

        @F.pandas_udf("double")
        def margin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            for batch in batches:
                bins = to_bins(batch.to_numpy(dtype=np.float64), edges)
                total = np.full(len(bins), base)
                for tree in trees:
                    total += tree.values_of(bins)
                yield pd.Series(total)

        inputs = F.struct(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(self.getInputCols())])
        result = margin(inputs)
        if self.getOrDefault("kind") == SQUARED:
            return dataset.withColumn(self.getPredictionCol(), result)
        score = self.getOrDefault("scoreCol")
        scored = dataset.withColumn(score, 1 / (1 + F.exp(-result)))
        return scored.withColumn(self.getPredictionCol(), (F.col(score) >= 0.5).cast("double"))


class LeafwiseTrees(Estimator, _LeafwiseParams, DefaultParamsReadable, DefaultParamsWritable):
    """Boosted trees of at most ``leaves`` leaves each, split best leaf first.

    Rows with a null label are left out; missing inputs count as smaller than all values. Growth stops
    when no split gains anything. A table without rows gives a model that says 0. The binned rows are
    stored in the shared folder, and again with the sums so far after every ``storeEvery`` trees.
    """

    rounds = Param(Params._dummy(), "rounds", "number of trees", TypeConverters.toInt)
    leaves = Param(Params._dummy(), "leaves", "leaves of a tree at most", TypeConverters.toInt)
    rate = Param(Params._dummy(), "rate", "share of each tree's step that is taken", TypeConverters.toFloat)
    bins = Param(Params._dummy(), "bins", "bins of a feature at most", TypeConverters.toInt)
    l2 = Param(Params._dummy(), "l2", "ridge penalty of leaf values", TypeConverters.toFloat)
    leastRows = Param(Params._dummy(), "leastRows", "rows of a leaf at least", TypeConverters.toInt)
    storeEvery = Param(Params._dummy(), "storeEvery", "trees between stored sums", TypeConverters.toInt)

    @keyword_only
    def __init__(
        self, *, inputCols=None, labelCol="label", predictionCol="prediction", scoreCol="score", kind=SQUARED, rounds=100,
        leaves=32, rate=0.1, bins=255, l2=0.0, leastRows=20, storeEvery=10,
    ):
        super().__init__()
        self._setDefault(rounds=100, leaves=32, rate=0.1, bins=255, l2=0.0, leastRows=20, storeEvery=10)
        self._set(**self._input_kwargs)
        if self.getOrDefault("kind") not in (SQUARED, LOGISTIC):
            raise ValueError(f"kind is {SQUARED} or {LOGISTIC}")
        if self.getOrDefault("leaves") < 2 or not 2 <= self.getOrDefault("bins") <= 32_000:
            raise ValueError("a tree has two leaves at least, and a feature 2 to 32,000 bins")

    def _fit(self, dataset: DataFrame) -> LeafwiseModel:
        get = self.getOrDefault
        columns, kind, rate, l2 = self.getInputCols(), get("kind"), get("rate"), get("l2")
        count = len(columns)
        label = F.col(self.getLabelCol()).cast("double")
        rows = dataset.filter(label.isNotNull() & ~F.isnan(label))
        edges = bin_edges(rows, columns, get("bins"))
        fields = ", ".join(f"b{i} short" for i in range(count)) + ", label double, margin double"

        def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                values = np.column_stack([
                    batch.column(i).cast(pa.float64()).to_numpy(zero_copy_only=False) for i in range(count)])
                bins = to_bins(values, edges)
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(bins[:, i]) for i in range(count)], batch.column(count), batch.column(count + 1)],
                    names=[*[f"b{i}" for i in range(count)], "label", "margin"])

        values = rows.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)], label.alias("label"))
        total, mean, low, high = values.agg(F.count("*"), F.avg("label"), F.min("label"), F.max("label")).first()
        if kind == LOGISTIC and total and not (low >= 0 and high <= 1):
            raise ValueError("a logistic label lies between 0 and 1")
        mean = mean or 0.0
        share = min(max(mean, 1e-6), 1 - 1e-6)
        base = float(np.log(share / (1 - share))) if kind == LOGISTIC and total else mean
        # Units so small that the sums of all rows stay below 2^62, and those of a batch below 2^53.
        greatest = 1.0 if kind == LOGISTIC or not total or high == low else high - low
        finest = 2.0 ** min(36, 58 - int(total).bit_length())
        units = (finest / 2.0 ** float(np.ceil(np.log2(greatest))), finest)
        data = cut_lineage(values.withColumn("margin", F.lit(base)).mapInArrow(binned, fields), "binned")
        width = max((len(e) for e in edges), default=0) + 2
        trees: list[Tree] = []
        recent: list[Tree] = []

        def find(tree: Tree, nodes: list[int]) -> dict:
            sums = data.mapInArrow(
                _histograms(kind, count, width, recent, tree, nodes, units), "node int, feature int, bin int, g long, h long, n long")
            best = _best_splits(sums, units, l2, get("leastRows")).collect()
            return {r["node"]: r["best"].asDict() for r in best if r["best"]["gain"] > 1e-12 * greatest ** 2}

        def value(g: int, h: int) -> float:
            below = h / units[1] + l2
            return -rate * (g / units[0]) / below if below > 0 else 0.0

        def advanced(batches: Iterator[pa.RecordBatch], done: list[Tree]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                margin = batch.column(count + 1).to_numpy(zero_copy_only=False)
                bins = _bins_of(batch, count)
                for tree in done:
                    margin = margin + tree.values_of(bins)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(margin)], names=batch.schema.names)

        for number in range(get("rounds") if total else 0):
            tree = _Growth(find, value, get("leaves")).grow()
            if tree is None:
                break
            trees.append(tree)
            recent.append(tree)
            if len(recent) == get("storeEvery") and number + 1 < get("rounds"):
                done = list(recent)
                data = cut_lineage(data.mapInArrow(lambda b, done=done: advanced(b, done), fields), "binned")
                recent.clear()
        content = json.dumps({"edges": edges, "base": base, "trees": [vars(t) for t in trees]})
        return LeafwiseModel(
            inputCols=columns, predictionCol=self.getPredictionCol(), scoreCol=get("scoreCol"), kind=kind, content=content)
