"""Training sets from feature lookups, and scoring with the same lookups."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.ml import Model, PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.operators.asof import MAX_GROUP_ROWS, Features, asof_join_all, keyed_lookup
from millrace.operators.keys import hot_groups
from millrace.operators.store import FeatureTable
from millrace.sources import files


@dataclass(frozen=True)
class FeatureLookup:
    """Features of one table, found by key, and by time where the table has a time key."""

    table: str
    features: Sequence[str]
    lookup_key: Sequence[str]
    timestamp_lookup_key: str | None = None

    @property
    def keys(self) -> list[str]:
        return [self.lookup_key] if isinstance(self.lookup_key, str) else list(self.lookup_key)


def attach(
    raw: DataFrame, lookups: Sequence[FeatureLookup], *, inclusive: bool = False,
    max_group_rows: int = MAX_GROUP_ROWS, bin_seconds: int = 3600,
) -> DataFrame:
    """Join the features of all lookups to the raw rows.

    Lookups by the same key and time are answered by one as-of join. Hot keys are counted on the
    raw rows and the stored tables, never on the output of an earlier join.
    """
    spark = raw.sparkSession
    groups: dict[tuple, list[tuple[FeatureLookup, FeatureTable]]] = {}
    for look in lookups:
        table = FeatureTable.open(spark, look.table)
        if (look.timestamp_lookup_key is None) != (table.timestamp_key is None):
            raise ValueError("a time-series table needs a timestamp lookup key, another table has none")
        groups.setdefault((tuple(look.keys), look.timestamp_lookup_key), []).append((look, table))
    df = raw
    for (keys, ts), members in groups.items():
        counted = [raw.select(*keys)]
        if ts is not None:
            counted += [
                table.read().select(*[F.col(k).alias(name) for k, name in zip(table.keys, keys)])
                for _, table in members
            ]
        hot = [row[:-1] for row in hot_groups(counted, list(keys), max_group_rows)]
        if ts is not None:
            sides = [Features(t.read(), t.keys, t.timestamp_key, list(look.features)) for look, t in members]
            df = asof_join_all(
                df, sides, keys=keys, left_ts=ts, inclusive=inclusive, hot_keys=hot,
                max_group_rows=max_group_rows, bin_seconds=bin_seconds,
            )
        else:
            for look, t in members:
                df = keyed_lookup(
                    df, t.read(), keys=keys, right_keys=t.keys, values=list(look.features), hot_keys=hot,
                    unique=True,
                )
    wanted = [f for look in lookups for f in look.features]
    return df.select(*raw.columns, *wanted)


@dataclass(frozen=True)
class TrainingSet:
    """Raw rows and what to look up for them; nothing runs until ``to_df``."""

    raw: DataFrame
    lookups: Sequence[FeatureLookup]
    label: str | None = None
    exclude: Sequence[str] = field(default_factory=tuple)

    def to_df(self, **asof_options) -> DataFrame:
        """Attach all features, then drop the excluded columns, which may be lookup times."""
        if self.label is not None and self.label not in self.raw.columns:
            raise ValueError(f"label {self.label} is not in the raw data")
        return attach(self.raw, self.lookups, **asof_options).drop(*self.exclude)

    def spec(self, inputs: dict[str, str] | None = None) -> str:
        """The lookups, and the types of the model's inputs if given, as JSON to be kept beside the model."""
        times = {
            look.timestamp_lookup_key: self.raw.schema[look.timestamp_lookup_key].dataType.simpleString()
            for look in self.lookups if look.timestamp_lookup_key
        }
        return json.dumps({
            "lookups": [asdict(look) for look in self.lookups], "label": self.label,
            "exclude": list(self.exclude), "times": times, "inputs": inputs or {},
        })


def save_spec(spark: SparkSession, training_set: TrainingSet, path: str, inputs: dict[str, str] | None = None) -> None:
    files.write_text(spark, path, training_set.spec(inputs), overwrite=True)


def model_inputs(model: Model, df: DataFrame) -> dict[str, str]:
    """Columns of ``df`` that the stages of ``model`` read, with their types; SQL stages name none."""
    made, found = set(), {}
    for stage in getattr(model, "stages", [model]):
        for param in ("inputCol", "inputCols", "featuresCol"):
            if stage.hasParam(param) and stage.isDefined(param):
                value = stage.getOrDefault(param)
                for name in [value] if isinstance(value, str) else value:
                    if name in df.columns and name not in made:
                        found[name] = df.schema[name].dataType.simpleString()
        for param in ("outputCol", "outputCols", "predictionCol"):
            if stage.hasParam(param) and stage.isDefined(param):
                value = stage.getOrDefault(param)
                made |= {value} if isinstance(value, str) else set(value)
    return found


def score_batch(
    df: DataFrame, spec: str, model: Model | Callable[[DataFrame], DataFrame],
    prediction: str = "prediction", result_type: str | None = None, **asof_options,
) -> DataFrame:
    """Look the features up again as in training, score, and keep all input and feature columns.

    Lookup times, and model inputs where ``save_model`` noted them, must have the name and type that
    they had in training. ``model`` is a fitted Spark model or a function from DataFrame to DataFrame that adds the ``prediction`` column.
    """
    saved = json.loads(spec)
    for name, kind in saved["times"].items():
        got = df.schema[name].dataType.simpleString() if name in df.columns else "missing"
        if got != kind:
            raise TypeError(f"lookup time {name} is {got}, was {kind} in training")
    df = attach(df, [FeatureLookup(**look) for look in saved["lookups"]], **asof_options)
    for name, kind in saved.get("inputs", {}).items():
        got = df.schema[name].dataType.simpleString() if name in df.columns else "missing"
        if got != kind:
            raise TypeError(f"model input {name} is {got}, was {kind} in training")
    scored = model.transform(df) if isinstance(model, Model) else model(df)
    result = F.col(prediction)
    if result_type:
        result = result.cast(result_type)
    return scored.select(*df.columns, result.alias(prediction))


def save_model(model: PipelineModel, training_set: TrainingSet, path: str, trained: DataFrame | None = None) -> None:
    """Keep a fitted model together with the lookups that its features come from.

    With ``trained``, the rows it was fitted on, the types of its inputs are kept as well and checked
    before scoring. Stages that Spark does not have (``millrace.operators.stages``) are kept too.
    """
    spark = training_set.raw.sparkSession
    model.write().overwrite().save(f"{path}/model")
    inputs = None if trained is None else model_inputs(model, trained)
    save_spec(spark, training_set, f"{path}/features.json", inputs)


def score_saved(df: DataFrame, path: str, **options) -> DataFrame:
    """``score_batch`` with a model and lookups kept by ``save_model``."""
    spec = files.read_text(df.sparkSession, f"{path}/features.json")
    return score_batch(df, spec, PipelineModel.load(f"{path}/model"), **options)
