"""Values drawn from a hash of seed, field name and key.

Unlike ``rand``, they depend only on the row's own key: a task that runs again, on another
executor or after repartitioning, draws the same values, so nothing has to be cached for them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def _digest(seed: int, field: str, keys: Sequence[Column | str]) -> Column:
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(field), *[c.cast("string") for c in cols]))


def unit_of(seed: int, field: str, *keys: Column | str) -> Column:
    """A double in [0, 1) from the first 32 bits of the hash."""
    return F.conv(F.substring(_digest(seed, field, keys), 1, 8), 16, 10).cast("double") / float(2**32)


def random_id(seed: int, field: str, *keys: Column | str, length: int = 32) -> Column:
    """A hexadecimal identifier of ``length`` characters (32 at most)."""
    return F.substring(_digest(seed, field, keys), 1, length)


def pick(values: Sequence[str], seed: int, field: str, *keys: Column | str) -> Column:
    """One of ``values``, all equally likely."""
    slot = F.floor(unit_of(seed, field, *keys) * len(values)).cast("int")
    return F.element_at(F.array(*[F.lit(v) for v in values]), slot + 1)


def pick_weighted(
    weights: Sequence[tuple[str | None, float]], seed: int, field: str, *keys: Column | str
) -> Column:
    """One value by relative weight; ``None`` may be one of the values."""
    total, reached = math.fsum(w for _, w in weights), 0.0
    draw = unit_of(seed, field, *keys)
    result = F.lit(weights[-1][0]).cast("string")
    bounds = []
    for value, weight in weights[:-1]:
        reached += weight / total
        bounds.append((value, reached))
    for value, bound in reversed(bounds):
        result = F.when(draw < bound, F.lit(value).cast("string")).otherwise(result)
    return result


def normal_of(mean: float, sd: float, seed: int, field: str, *keys: Column | str) -> Column:
    """A normal draw by the Box-Muller transform of two hash draws."""
    radius = F.sqrt(-2.0 * F.log(1.0 - unit_of(seed, field + ":r", *keys)))
    angle = 2.0 * math.pi * unit_of(seed, field + ":a", *keys)
    return mean + sd * radius * F.cos(angle)
