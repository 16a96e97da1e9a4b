"""Training, evaluation and scoring on Spark ML; the data stays on the executors."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import (
    Bucketizer, Imputer, OneHotEncoder, StandardScaler, StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from millrace.functions.numbers import fare_band, lenient_double
from millrace.operators.onehot import category_values
from millrace.operators.quality import binary_metrics
from millrace.session import cut_lineage
from millrace.sources.writers import save_table


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text to double, null where it is no number."""
    return df.withColumns({c: lenient_double(c) for c in columns})


def impute_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill nulls with the column mean; the means of all columns come from one pass."""
    stage = Imputer(strategy="mean", inputCols=list(columns), outputCols=[f"__{c}" for c in columns])
    filled = stage.fit(df).transform(df)
    return filled.withColumns({c: F.col(f"__{c}") for c in columns}).drop(*[f"__{c}" for c in columns])


def standardise(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Centre and divide by the sample standard deviation (n - 1); a constant column gives 0."""
    stats = df.agg(*[
        F.struct(F.avg(c).alias("mean"), F.stddev_samp(c).alias("sd")).alias(c) for c in columns
    ]).first()
    return df.withColumns({
        c: (F.col(c) - stats[c]["mean"]) / stats[c]["sd"] if stats[c]["sd"] else F.col(c) * 0.0
        for c in columns
    })


def feature_stages(
    numeric: Sequence[str], categorical: Sequence[str] = (), passthrough: Sequence[str] = (),
    output: str = "features",
) -> list:
    """Impute and scale numbers, one-hot categories (an unknown value gives no 1), assemble.

    Categories are indexed by name, so the order does not depend on counts. ``passthrough``
    columns, such as 0/1 flags, go in as they are, once.
    """
    stages, parts = [], []
    if numeric:
        filled = [f"{c}__filled" for c in numeric]
        stages += [
            Imputer(strategy="mean", inputCols=list(numeric), outputCols=filled),
            VectorAssembler(inputCols=filled, outputCol="__numbers"),
            StandardScaler(inputCol="__numbers", outputCol="__scaled", withMean=True, withStd=True),
        ]
        parts.append("__scaled")
    if categorical:
        indexed, encoded = [f"{c}__index" for c in categorical], [f"{c}__flags" for c in categorical]
        # "keep" sends unknown values to one extra index, which the encoder's dropLast leaves out.
        stages += [
            StringIndexer(
                inputCols=list(categorical), outputCols=indexed, handleInvalid="keep",
                stringOrderType="alphabetAsc",
            ),
            OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
        ]
        parts += encoded
    stages.append(VectorAssembler(inputCols=[*parts, *passthrough], outputCol=output, handleInvalid="keep"))
    return stages


def _bounds(df: DataFrame, columns: Sequence[str], bins: int) -> list[list[float]]:
    """Lower bounds of the bins of each column: all its values where they are few, else quantiles."""
    sizes = df.agg(*[F.approx_count_distinct(c) for c in columns]).first()
    shares = [k / bins for k in range(1, bins)]
    found = df.agg(*[
        F.collect_set(F.col(c).cast("double")) if n <= bins else F.percentile_approx(F.col(c).cast("double"), shares, 1000)
        for c, n in zip(columns, sizes, strict=True)]).first()
    return [sorted(set(bounds or [])) for bounds in found]


def fare_regressor(
    train: DataFrame, label: str, numeric: Sequence[str], rounds: int = 100, depth: int = 5, seed: int = 123, bins: int = 32,
):
    """Boosted regression trees. Depth 5 allows 32 leaves; trees grow level by level.

    Inputs are cut into ``bins`` bins, as Spark's trees do on their own. Rows alike in all bins go through the trees
    as one row, with their number as weight and their mean label: splits and leaves of squared loss depend on nothing else, so every
    row counts, and the hundreds of passes of the boosting read at most one row for each combination of bins.
    """
    filled, binned = [f"{c}__filled" for c in numeric], [f"{c}__bin" for c in numeric]
    prepared = Pipeline(stages=feature_stages(numeric)).fit(train)
    rows = prepared.transform(train)
    cut = Bucketizer(
        inputCols=filled, outputCols=binned, handleInvalid="keep",
        splitsArray=[[-math.inf, *(b or [0.0]), math.inf] for b in _bounds(rows, filled, bins)])
    value = F.col(label).cast("double")
    # A missing label stays one, which the trees refuse.
    mean = F.when(F.count(value) == F.count("*"), F.avg(value)).alias(label)
    # Without the cutter's metadata, by which the order of the bins would not count.
    plain = cut.transform(rows).withColumns({c: F.col(c) + 0.0 for c in binned})
    alike = cut_lineage(
        plain.groupBy(*binned).agg(F.count("*").cast("double").alias("__weight"), mean), "alike")
    join = VectorAssembler(inputCols=binned, outputCol="__bins", handleInvalid="keep")
    tree = GBTRegressor(
        labelCol=label, featuresCol="__bins", predictionCol="prediction", maxIter=rounds, maxDepth=depth,
        maxBins=2 * bins, weightCol="__weight", seed=seed,
    )
    return PipelineModel(stages=[*prepared.stages, cut, join, tree.fit(join.transform(alike))])


def _frequent_values(df: DataFrame, columns: Sequence[str], most: int) -> DataFrame:
    """Null in place of all but the most frequent values, so that what an indexer collects is bounded."""
    values = category_values(df, columns, most) if columns else {}
    return df.withColumns({c: F.when(F.col(c).cast("string").isin(v), F.col(c)) for c, v in values.items()})


def churn_classifier(
    train: DataFrame, label: str, numeric: Sequence[str] = (), categorical: Sequence[str] = (),
    passthrough: Sequence[str] = (), rounds: int = 20, step: float = 0.1, depth: int = 5,
    min_instances: int = 3, subsample: float = 1.0, seed: int = 123, most_values: int = 1000,
):
    """Boosted classification trees behind one feature pipeline; remaining columns stay.

    The ``most_values`` most frequent values of each category are told apart; all others count as one
    unknown value, in training and in scoring.
    """
    train = _frequent_values(train, categorical, most_values)
    tree = GBTClassifier(
        labelCol=label, featuresCol="features", predictionCol="prediction", maxIter=rounds, stepSize=step,
        maxDepth=depth, minInstancesPerNode=min_instances, subsamplingRate=subsample, seed=seed,
    )
    return Pipeline(stages=[*feature_stages(numeric, categorical, passthrough), tree]).fit(train)


def model_search(
    train: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str] = (),
    depths: Sequence[int] = (3, 5), steps: Sequence[float] = (0.1,), rounds: int = 10, seed: int = 123,
    parallelism: int = 2, most_values: int = 1000,
):
    """Try a small grid on one held-out split; the best model and the metric of each try.

    Categories as in ``churn_classifier``.
    """
    train = _frequent_values(train, categorical, most_values)
    tree = GBTClassifier(labelCol=label, featuresCol="features", maxIter=rounds, seed=seed)
    grid = ParamGridBuilder().addGrid(tree.maxDepth, list(depths)).addGrid(tree.stepSize, list(steps)).build()
    search = TrainValidationSplit(
        estimator=Pipeline(stages=[*feature_stages(numeric, categorical), tree]),
        estimatorParamMaps=grid, evaluator=BinaryClassificationEvaluator(labelCol=label),
        trainRatio=0.75, seed=seed, parallelism=parallelism,
    )
    return search.fit(train)


def regression_rmse(scored: DataFrame, label: str) -> float:
    return RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse").evaluate(scored)


def evaluate_sets(sets: dict[str, DataFrame], label: str, prediction: str = "prediction") -> DataFrame:
    """One row of metrics per named data set."""
    result = None
    for name, scored in sets.items():
        one = binary_metrics(scored, label, prediction).withColumn("dataset", F.lit(name))
        result = one if result is None else result.unionByName(one)
    return result


def banded(scored: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Replace a numeric prediction by its fare band."""
    return scored.withColumn(prediction, fare_band(prediction))


def score_to_table(
    features: DataFrame, model: Model, key: str, table: str, prediction: str = "prediction"
) -> DataFrame:
    """Score the features and save (key, prediction) as a table."""
    return save_table(model.transform(features).select(key, prediction), table)


def column_model(predict: Callable[[pd.DataFrame], pd.Series], result_type: str = "double"):
    """A model that is not Spark's as a column function over ``struct(inputs)``.

    ``predict`` gets Arrow batches as pandas frames, inside tasks.
    """
    @F.pandas_udf(result_type)
    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for batch in batches:
            yield predict(batch)

    return apply


def register_model(spark: SparkSession, name: str, predict, result_type: str = "double") -> None:
    """Make ``name(struct(...))`` known to SQL."""
    spark.udf.register(name, column_model(predict, result_type))


def encode_with(
    df: DataFrame, text: str, load: Callable[[], Callable[[list[str]], list]], output: str = "vector"
) -> DataFrame:
    """Vectors from a model of the caller's, which ``load`` opens once per task."""
    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for batch in batches:
            yield batch.assign(**{output: [list(map(float, v)) for v in model(batch[text].tolist())]})

    vector = T.StructField(output, T.ArrayType(T.FloatType()))
    return df.mapInPandas(encode, T.StructType([*df.schema.fields, vector]))
