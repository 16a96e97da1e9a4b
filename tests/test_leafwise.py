"""Leaf-wise trees against a direct computation, search by halving, and stages saved with a model."""

import math
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.operators import learn, quality
from millrace.operators.leafwise import LeafwiseModel, LeafwiseTrees
from millrace.operators.search import halving_search
from millrace.operators.stages import Bands, PythonModel


def grown(x, y, leaves, least):
    """Predictions of one tree, each leaf tried at each place, best first."""
    parts, fits = [np.arange(len(y))], lambda r: (y[r].sum() ** 2) / len(r)
    while len(parts) < leaves:
        best = None
        for p, rows in enumerate(parts):
            for f in range(x.shape[1]):
                for cut in np.unique(x[rows, f])[:-1]:
                    a, b = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]
                    if min(len(a), len(b)) >= least:
                        gain = fits(a) + fits(b) - fits(rows)
                        if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                            best = (gain, p, a, b)
        if best is None:
            break
        parts[best[1]:best[1] + 1] = [best[2], best[3]]
    out = np.zeros(len(y))
    for rows in parts:
        out[rows] = y[rows].mean()
    return out


@pytest.mark.parametrize("leaves, least", [(2, 1), (7, 5), (32, 3)])
def test_one_tree_as_computed_directly(spark, leaves, least):
    rng = np.random.default_rng(leaves)
    x = rng.integers(0, 40, (300, 3)).astype(float)
    y = np.where(x[:, 0] > 20, x[:, 1] ** 1.5, -x[:, 2]) + rng.normal(0, 3, 300)
    y -= y.mean()
    rows = spark.createDataFrame(pd.DataFrame({"k": range(300), "a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "y": y})).repartition(5)
    model = LeafwiseTrees(inputCols=["a", "b", "c"], labelCol="y", rounds=1, rate=1.0, leaves=leaves, leastRows=least).fit(rows)
    got = model.transform(rows).orderBy("k").toPandas()["prediction"]
    assert np.allclose(got, grown(x, y, leaves, least), atol=1e-5)
    assert sum(n < 0 for n in model.trees[0].left) <= leaves


def curved(spark, n=3000):
    return spark.range(n).select(
        F.col("id").alias("k"), (F.col("id") % 83).cast("double").alias("a"), (F.col("id") * 7 % 101).cast("double").alias("b"),
    ).withColumn("chance", 1 / (1 + F.exp(-(F.sin(F.col("a") / 12) * 3 + (F.col("b") - 50) / 15)))).withColumn(
        "label", (F.pmod(F.xxhash64("k"), F.lit(1000)) / 1000 < F.col("chance")).cast("int"))


def test_no_worse_than_level_by_level(spark):
    rows = curved(spark).cache()
    train, test = rows.filter("k % 4 > 0"), rows.filter("k % 4 = 0")
    leafwise = LeafwiseTrees(inputCols=["a", "b"], kind="logistic", rounds=12, rate=0.2, leaves=8, storeEvery=5).fit(train)
    ours = quality.probability_metrics(leafwise.transform(test), "score", "label").first()
    level = learn.churn_classifier(train, "label", numeric=["a", "b"], rounds=12, step=0.2, depth=3).transform(test)
    chance = level.withColumn("score", vector_to_array("probability")[1])
    theirs = quality.probability_metrics(chance, "score", "label").first()
    assert ours["log_loss"] < 1.03 * theirs["log_loss"] and ours["auc"] > theirs["auc"] - 0.01
    # Sums of whole numbers: another partitioning gives the same trees.
    again = LeafwiseTrees(inputCols=["a", "b"], kind="logistic", rounds=2, leaves=8).fit(train.repartition(7))
    first = LeafwiseTrees(inputCols=["a", "b"], kind="logistic", rounds=2, leaves=8, storeEvery=1).fit(train.coalesce(2))
    for one, other in zip(again.trees, first.trees, strict=True):
        assert (one.feature, one.cut, one.left) == (other.feature, other.cut, other.left)
        assert np.allclose(one.value, other.value, atol=1e-12)


def test_awkward_rows(spark):
    schema = "a double, b int, y double, prediction string"
    rows = spark.createDataFrame([
        (None, 1, 5.0, "x"), (float("nan"), 1, 5.0, "x"), (float("inf"), None, 1.0, None), (1.0, 2, None, None), (2.0, 2, float("nan"), None),
        *[(2.0, 2, 1.0, "y")] * 4], schema)
    model = LeafwiseTrees(inputCols=["a", "b"], labelCol="y", rounds=1, rate=1.0, leastRows=1).fit(rows)
    got = [r["prediction"] for r in model.transform(rows).collect()]
    assert len(got) == 9 and np.allclose(got[:3], [5.0, 5.0, 1.0]) and np.allclose(got[5:], 1.0)
    constant = LeafwiseTrees(inputCols=["a"], labelCol="y", rounds=3).fit(rows.filter("y = 1"))
    assert constant.trees == [] and constant.transform(rows).agg(F.min("prediction"), F.max("prediction")).first() == (1.0, 1.0)
    nothing = LeafwiseTrees(inputCols=["a"], labelCol="y", rounds=3).fit(rows.limit(0))
    assert nothing.transform(rows).agg(F.max("prediction")).first()[0] == 0.0 and nothing.transform(rows.limit(0)).count() == 0
    with pytest.raises(ValueError):
        LeafwiseTrees(inputCols=["a"], labelCol="y", kind="logistic").fit(rows)
    tiny = rows.filter("y > 0").withColumn("y", F.col("y") * 1e-30)
    small = LeafwiseTrees(inputCols=["a", "b"], labelCol="y", rounds=1, rate=1.0, leastRows=1).fit(tiny)
    assert math.isclose(small.transform(rows).first()["prediction"], 5e-30, rel_tol=1e-6)


def test_pipeline_is_saved_with_its_bands(spark, tmp_path):
    (tmp_path / "foreign_model.py").write_text("def doubled(frame):\n    return frame['a'] * 2 + frame['prediction']\n")
    spark.sparkContext.addPyFile(str(tmp_path / "foreign_model.py"))
    rows = curved(spark, 400)
    stages = [
        LeafwiseTrees(inputCols=["a", "b"], labelCol="chance", rounds=2, rate=0.9, leaves=6),
        PythonModel(["a", "prediction"], "sum", "foreign_model:doubled"),
        Bands("prediction", "band", [0.3, 0.7], ["low", "middle", "high"]),
    ]
    model = Pipeline(stages=stages).fit(rows)
    model.write().overwrite().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m"))
    assert isinstance(loaded.stages[0], LeafwiseModel) and loaded.stages[2].getOrDefault("labels") == ["low", "middle", "high"]
    before, after = (m.transform(rows).orderBy("k").collect() for m in (model, loaded))
    assert before == after and len({r["band"] for r in after}) > 1
    assert all(math.isclose(r["sum"], 2 * r["a"] + r["prediction"]) for r in after)
    nulls = rows.limit(3).withColumn("prediction", F.lit(None).cast("double"))
    assert [r["band"] for r in loaded.stages[2].transform(nulls).collect()] == [None] * 3
    with pytest.raises(ValueError):
        Bands("a", "b", [2.0, 1.0], ["x", "y", "z"])
    with pytest.raises(AttributeError):
        PythonModel(["a"], "s", "foreign_model:absent").transform(rows)


def test_halving(spark):
    rows = curved(spark, 2000).cache()
    calls = []

    def fit(sample, setting):
        calls.append(sample.count())
        return LeafwiseTrees(inputCols=["a", "b"], labelCol="chance", leaves=4, **setting).fit(sample)

    def loss(scored):
        return scored.agg(F.avg((F.col("chance") - F.col("prediction")) ** 2)).first()[0]

    settings = [{"rate": r, "rounds": n} for n in (1, 3) for r in (1e-6, 0.4)]
    found = halving_search(rows, "k", settings, fit, loss, shares=(0.2, 1.0), keep=0.5)
    tries = found.tries.orderBy("rung", "loss").collect()
    assert found.setting == {"rate": 0.4, "rounds": 3} and found.in_time
    assert [(t.rung, t.kept) for t in tries] == [(0, True), (0, True), (0, False), (0, False), (1, True), (1, False)]
    assert len(set(calls[:4])) == 1 and calls[0] < calls[4] / 3 and tries[0].rows == calls[0]


def test_halving_stops_in_time(spark):
    rows = curved(spark, 200)
    slow = F.udf(lambda k: time.sleep(0.2) or k, "long")

    def fit(sample, setting):
        if setting["slow"]:
            sample.select(slow("k")).collect()
        return LeafwiseTrees(inputCols=["a"], labelCol="chance", rounds=1, leaves=2).fit(sample)

    started = time.monotonic()
    found = halving_search(
        rows.coalesce(1), "k", [{"slow": False}, {"slow": True}], fit, lambda s: s.agg(F.avg("prediction")).first()[0], shares=(1.0,), seconds=12)
    assert time.monotonic() - started < 20 and not found.in_time and found.setting == {"slow": False}
    with pytest.raises(TimeoutError):
        halving_search(rows, "k", [{"slow": False}], fit, lambda s: 0.0, seconds=0)
    with pytest.raises(ZeroDivisionError):
        halving_search(rows, "k", [{}], lambda s, t: 1 / 0, lambda s: 0.0, seconds=60)
