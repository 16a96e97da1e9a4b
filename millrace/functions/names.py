"""Column-name cleaning. These change names only, so no Spark job runs."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

_UNDERSCORED = {" ": "_", "-": "_"}
_BRONZE = str.maketrans({**_UNDERSCORED, "(": "", ")": ""})
_FEATURE = str.maketrans({**_UNDERSCORED, "(": "_", ")": "_"})

# Names that the snake-case rule splits wrongly, and their repair.
SNAKE_REPAIRS = {"streaming_t_v": "streaming_tv", "customer_i_d": "customer_id"}


def snake_name(name: str) -> str:
    """camelCase to snake_case: every capital but a leading one opens a word.

    Doubled underscores are merged once, left to right.
    """
    spaced = name[:1] + re.sub("([A-Z])", r"_\1", name[1:])
    return spaced.lower().replace("__", "_")


def bronze_name(name: str) -> str:
    """snake_case, parentheses removed, spaces and hyphens as underscores."""
    return snake_name(name).translate(_BRONZE)


def feature_name(name: str) -> str:
    """Lower case with parentheses, spaces and hyphens each as one underscore."""
    return name.lower().translate(_FEATURE)


def clean_columns(
    df: DataFrame,
    rule: Callable[[str], str] = bronze_name,
    repairs: Mapping[str, str] | None = None,
) -> DataFrame:
    """Rename all columns by ``rule``, then by the explicit ``repairs``.

    Raises if two columns would end up with the same name.
    """
    fixes = SNAKE_REPAIRS if repairs is None else repairs
    names = [fixes.get(new, new) for new in map(rule, df.columns)]
    doubled = sorted({n for n in names if names.count(n) > 1})
    if doubled:
        raise ValueError(f"columns collide after cleaning: {doubled}")
    return df.toDF(*names)
