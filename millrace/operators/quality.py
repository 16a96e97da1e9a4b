"""Checks on predictions and models, as tables."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from millrace.functions.numbers import matches
from millrace.operators.ranks import running_total
from millrace.session import cut_lineage

# The share of right answers that every slice needs, and the shortest description.
SLICE_THRESHOLD = 0.55
MIN_DESCRIPTION = 20

REPORT_SCHEMA = "check string, passed int, detail string"


def slice_columns(df: DataFrame, slices: str | Sequence[str]) -> list[str]:
    """Slice columns from a list or a comma-separated text; an unknown one is an error."""
    names = [s.strip() for s in slices.split(",")] if isinstance(slices, str) else list(slices)
    missing = [s for s in names if s not in df.columns]
    if missing:
        raise ValueError(f"unknown slice columns: {missing}")
    return names


def slice_accuracy(df: DataFrame, slices: str | Sequence[str], label: str, prediction: str) -> DataFrame:
    """Right answers, observations and their ratio per slice."""
    names = slice_columns(df, slices)
    right = matches(label, prediction)
    return df.groupBy(*names).agg(
        F.sum(right).alias("acc"), F.count("*").alias("obs"), F.avg(right).alias("pct_acc")
    )


def slice_gate(sliced: DataFrame, threshold: float = SLICE_THRESHOLD) -> DataFrame:
    """One row: whether every slice reaches the threshold. No slices, no pass."""
    return sliced.agg(
        F.count("*").alias("slices"),
        F.min("pct_acc").alias("worst"),
        F.coalesce((F.min("pct_acc") >= threshold).cast("int"), F.lit(0)).alias("passed"),
    )


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(label, prediction).agg(F.count("*").alias("n"))


def binary_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Accuracy, precision, recall and F1 of class 1 in one pass."""
    def both(a: int, b: int):
        return F.sum(((F.col(label) == a) & (F.col(prediction) == b)).cast("long"))

    counts = df.agg(
        both(1, 1).alias("tp"), both(0, 1).alias("fp"), both(1, 0).alias("fn"), both(0, 0).alias("tn")
    )
    return counts.select(
        "*",
        F.try_divide(F.col("tp") + F.col("tn"), F.expr("tp + fp + fn + tn")).alias("accuracy"),
        F.try_divide(F.col("tp"), F.expr("tp + fp")).alias("precision"),
        F.try_divide(F.col("tp"), F.expr("tp + fn")).alias("recall"),
        F.try_divide(2 * F.col("tp"), F.expr("2 * tp + fp + fn")).alias("f1"),
    )


def _running_counts(df: DataFrame, score: str, label: str, parts: Sequence[str], bucket_rows: int) -> DataFrame:
    """For each distinct score of each part, from the highest down, how many of class 1 and 0 score so much or more."""
    per_score = df.filter(F.col(label).isNotNull()).groupBy(*parts, score).agg(
        F.sum((F.col(label) == 1).cast("long")).alias("tp"),
        F.sum((F.col(label) == 0).cast("long")).alias("fp"),
    ).filter(F.col(score).isNotNull()).withColumns({
        "__down": -F.col(score).cast("double"), "__tp": F.col("tp"), "__fp": F.col("fp")})
    # Read three times below; the scores may come from a model, which should run once.
    per_score = cut_lineage(per_score, "scores")
    buckets = -(-per_score.count() // bucket_rows)
    shares = [i / buckets for i in range(1, buckets)]
    cuts = per_score.approxQuantile("__down", shares, 0.5 / buckets) if shares else []
    splits = [float("-inf"), *sorted({c for c in cuts if math.isfinite(c)}), float("inf")]
    if len(splits) > 2:
        bucketed = Bucketizer(
            splits=splits, inputCol="__down", outputCol="__bucket", handleInvalid="keep").transform(per_score)
    else:
        # One bucket; not a literal, which would leave the join in the running total without a key.
        bucketed = per_score.withColumn("__bucket", F.pmod(F.xxhash64("__down"), F.lit(1)).cast("double"))
    return running_total(
        bucketed, ["tp", "fp"], bucket="__bucket", order=[F.col("__down")], within=parts, grand_total=True
    )


def curve_points(df: DataFrame, score: str, label: str, bucket_rows: int = 100_000) -> DataFrame:
    """ROC and precision-recall points, one per distinct score, from the highest score down.

    Rows are first counted per score. The distinct scores may still be many, so the running counts
    go through buckets of about ``bucket_rows`` scores between approximate quantiles. Infinite
    scores are the first and last points; NaN, where a model failed, comes after all others. Rows
    without score or label are left out.
    """
    points = _running_counts(df, score, label, [], bucket_rows)
    return points.select(
        score, "tp", "fp",
        F.try_divide("tp", "tp_total").alias("tpr"),
        F.try_divide("fp", "fp_total").alias("fpr"),
        F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
    )


def probability_metrics(
    df: DataFrame, score: str, label: str, parts: Sequence[str] = (), bucket_rows: int = 100_000, least: float = 1e-15,
) -> DataFrame:
    """Area under the ROC curve and log loss of scores from 0 to 1 for each part, such as train, validation and test.

    The area is the share of pairs of class 1 and 0 in which class 1 scores higher, ties counting half; it comes from ranks
    of the distinct scores, in buckets, so no pair is formed and no task sees all scores. It is null where a class is missing.
    Log loss takes the score of the right class as ``least`` at least. Rows without score or label are left out.
    """
    if not parts:
        # One part; not a literal, which would leave the joins without a key.
        whole = df.withColumn("__part", F.pmod(F.xxhash64(score), F.lit(1)))
        return probability_metrics(whole, score, label, ["__part"], bucket_rows, least).drop("__part")
    parts = list(parts)
    counts = _running_counts(df, score, label, parts, bucket_rows)
    # Pairs won by class 1: for the class 0 rows of each score, those of class 1 above, and half of those beside.
    won = F.col("__fp") * (F.col("tp") - F.col("__tp") + F.col("__tp") / 2)
    area = counts.groupBy(*parts).agg(
        F.try_divide(F.sum(won), F.max("tp_total").cast("double") * F.max("fp_total")).alias("auc"))
    given = F.when(F.col(label) == 1, F.col(score).cast("double")).otherwise(1 - F.col(score))  # to the class that is right
    loss = df.filter(F.col(label).isNotNull() & F.col(score).isNotNull()).groupBy(*parts).agg(
        F.count("*").alias("n"), F.avg(-F.log(F.greatest(given, F.lit(least)))).alias("log_loss"))
    same = [loss[p].eqNullSafe(area[p]) for p in parts]
    return loss.join(area, reduce(lambda x, y: x & y, same)).select(*[loss[p] for p in parts], "n", "auc", "log_loss")


def calibration(df: DataFrame, score: str, label: str, parts: Sequence[str] = (), bins: int = 10) -> DataFrame:
    """For each part and each bin of scores from 0 to 1: rows, mean score, and share of class 1."""
    place = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    return df.filter(F.col(label).isNotNull() & F.col(score).isNotNull()).groupBy(*parts, place.alias("bin")).agg(
        F.count("*").alias("n"), F.avg(score).alias("mean_score"), F.avg((F.col(label) == 1).cast("double")).alias("positive_share"))


def schema_report(df: DataFrame, expected: T.StructType) -> DataFrame:
    """One row per expected input column: whether it is there with the expected type."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema}
    rows = []
    for f in expected:
        wanted, got = f.dataType.simpleString(), actual.get(f.name)
        detail = "missing" if got is None else f"{got}, expected {wanted}" if got != wanted else wanted
        rows.append((f.name, int(got == wanted), detail))
    return df.sparkSession.createDataFrame(rows, REPORT_SCHEMA)


def description_check(df: DataFrame, column: str = "description", min_length: int = MIN_DESCRIPTION) -> DataFrame:
    """Flag rows whose description is longer than ``min_length`` characters."""
    long_enough = F.coalesce((F.length(column) > min_length).cast("int"), F.lit(0))
    return df.withColumn("has_description", long_enough)


def scoring_check(spark: SparkSession, run) -> DataFrame:
    """Call ``run()``, which must give a DataFrame, and score all of it; report if that worked."""
    try:
        run().write.format("noop").mode("overwrite").save()
        outcome = ("predicts", 1, "")
    except Exception as error:  # any failure of the model is the finding
        outcome = ("predicts", 0, str(error))
    return spark.createDataFrame([outcome], REPORT_SCHEMA)


def decision(reports: Sequence[DataFrame]) -> DataFrame:
    """Accept when each check in each report passed."""
    checks = reports[0].select("check", "passed")
    for report in reports[1:]:
        checks = checks.unionByName(report.select("check", "passed"))
    return checks.agg(
        F.count("*").alias("checks"), F.coalesce(F.min("passed"), F.lit(0)).alias("accepted")
    )


def null_key_report(frames: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """How many rows of each named frame have no key; an inner join drops those."""
    result = None
    for name, (df, key) in frames.items():
        one = df.agg(
            F.count("*").alias("row_count"), F.count_if(F.col(key).isNull()).alias("null_keys")
        ).select(F.lit(name).alias("name"), "row_count", "null_keys")
        result = one if result is None else result.unionByName(one)
    return result
