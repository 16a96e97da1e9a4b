"""Pipeline stages that Spark ML lacks and that are saved with a model: bands, and models of other kinds."""

from __future__ import annotations

import importlib
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F

from millrace.functions.numbers import band


class Bands(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """The label of the first bound above a number, else the last label; null gives null.

    ``labels`` has one more entry than ``bounds``, which rise. The output may replace the input.
    """

    bounds = Param(Params._dummy(), "bounds", "upper bounds, exclusive, rising", TypeConverters.toListFloat)
    labels = Param(Params._dummy(), "labels", "a label for each bound, and one beyond", TypeConverters.toListString)

    def __init__(self, inputCol: str = "prediction", outputCol: str = "band", bounds: Sequence[float] = (), labels: Sequence[str] = ("",)):
        super().__init__()
        if len(labels) != len(bounds) + 1 or list(bounds) != sorted(bounds):
            raise ValueError("bounds rise, and there is one label more than bounds")
        self._set(inputCol=inputCol, outputCol=outputCol, bounds=list(bounds), labels=list(labels))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        pairs = list(zip([*self.getOrDefault("bounds"), None], self.getOrDefault("labels"), strict=True))
        return dataset.withColumn(self.getOutputCol(), band(self.getInputCol(), pairs))


class PythonModel(Transformer, HasInputCols, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """A model that is not Spark's: a function of an importable module, from a frame of inputs to a series.

    What is saved is its name, ``module:function``, so the module must be there when it is loaded. If the
    function has an attribute ``load``, it is called once per task and returns the function to use.
    """

    function = Param(Params._dummy(), "function", "module:function", TypeConverters.toString)
    resultType = Param(Params._dummy(), "resultType", "type of the output column", TypeConverters.toString)

    def __init__(self, inputCols: Sequence[str] = (), outputCol: str = "prediction", function: str = "", resultType: str = "double"):
        super().__init__()
        self._set(inputCols=list(inputCols), outputCol=outputCol, function=function, resultType=resultType)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        module, _, name = self.getOrDefault("function").partition(":")
        getattr(importlib.import_module(module), name)  # missing here is an error before any job

        @F.pandas_udf(self.getOrDefault("resultType"))
        def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            predict = getattr(importlib.import_module(module), name)
            predict = predict.load() if hasattr(predict, "load") else predict
            for batch in batches:
                yield predict(batch)

        return dataset.withColumn(self.getOutputCol(), apply(F.struct(*self.getInputCols())))
