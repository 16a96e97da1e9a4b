"""Numeric coercion, bands and label mapping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Upper bounds and labels of the fare bands (the last label starts with a blank).
FARE_BANDS = (
    (10.0, "$0 - $9.99"),
    (20.0, "$10 - $19.99"),
    (None, " > $20"),
)


def lenient_double(c: Column | str) -> Column:
    """Text to double, null where the text is no number."""
    return _col(c).try_cast("double")


def lenient_int(c: Column | str) -> Column:
    """Number or numeric text to int, cutting the fraction; null where it is no number."""
    return lenient_double(c).try_cast("int")


def band(c: Column | str, bands: Sequence[tuple[float | None, str]]) -> Column:
    """The label of the first band whose bound is above the value. A null value has no band."""
    value, result = _col(c), F.lit(None).cast("string")
    for bound, label in reversed(bands):
        result = F.lit(label) if bound is None else F.when(value < bound, label).otherwise(result)
    return F.when(value.isNotNull(), result)


def fare_band(c: Column | str) -> Column:
    return band(c, FARE_BANDS)


def label_to_int(c: Column | str, mapping: Mapping[str, int]) -> Column:
    """Map labels to ints; a label outside ``mapping`` becomes null."""
    result = F.lit(None).cast("int")
    for label, value in mapping.items():
        result = F.when(_col(c) == label, F.lit(value)).otherwise(result)
    return result.cast("int")


def matches(a: Column | str, b: Column | str) -> Column:
    """1 where both columns hold the same non-null value, else 0."""
    return F.coalesce((_col(a) == _col(b)).cast("int"), F.lit(0))
