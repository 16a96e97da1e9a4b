"""Comparing answers with expected answers and with the context they were given."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def words(c: Column | str) -> Column:
    """Distinct lower-case words; a word is a run of letters and digits."""
    text = F.col(c) if isinstance(c, str) else c
    parts = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    return F.array_distinct(F.filter(parts, lambda w: w != ""))


def request_text(df: DataFrame, column: str = "request") -> Column:
    """The question as text: a string as it is, or the last message of a ``messages`` array."""
    if isinstance(df.schema[column].dataType, T.StructType):
        return F.element_at(F.col(f"{column}.messages"), -1)["content"]
    return F.col(column)


def _overlap(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def evaluate_answers(
    df: DataFrame, response: str = "response", expected: str = "expected_response",
    context: str | None = "retrieved_context",
) -> DataFrame:
    """Add exact match, word precision, recall and F1, and the share of words found in the context.

    ``context`` is an array of structs with a ``content`` field. Words count once each. A measure
    with nothing to divide by is null. All of it is column expressions, row by row.
    """
    got, want = words(response), words(expected)
    common = _overlap(got, want)
    added = {
        "exact_match": F.coalesce((F.trim(response) == F.trim(expected)).cast("int"), F.lit(0)),
        "word_precision": F.try_divide(common, F.size(got)),
        "word_recall": F.try_divide(common, F.size(want)),
        "word_f1": F.try_divide(2 * common, F.size(got) + F.size(want)),
    }
    if context is not None:
        pieces = F.concat_ws(" ", F.transform(context, lambda d: d["content"]))
        added["context_coverage"] = F.try_divide(_overlap(got, words(pieces)), F.size(got))
    return df.withColumns(added)


def answer_summary(evaluated: DataFrame) -> DataFrame:
    """Means over all answers."""
    measures = ["exact_match", "word_precision", "word_recall", "word_f1", "context_coverage"]
    return evaluated.agg(
        F.count("*").alias("answers"),
        *[F.avg(m).alias(f"mean_{m}") for m in measures if m in evaluated.columns],
    )
