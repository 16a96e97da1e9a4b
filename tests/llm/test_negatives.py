"""Hard negatives and their residue arithmetic against plain whole numbers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int, slot string, score string, v string, rank string"


@pytest.mark.parametrize("bound,width", [(1, 1), (300, 64), (70_000, 64), (10 ** 5, 4000), (10 ** 9, 3000), (2 ** 60, 5)])
def test_products_are_exact(bound, width):
    rng = np.random.default_rng(0)
    most = int((bound / width) ** 0.5)
    a, b = rng.integers(-most, most + 1, (40, width)), rng.integers(-most, most + 1, (50, width))
    a[0], b[0], b[1] = most, most, -most
    product = negatives.ResidueProduct.for_bound(bound)
    left, right = product.split(a), product.split(b)
    assert (product.scores(left, right) == a @ b.T).all()
    assert (product._by_digits(left, right) == a @ b.T).all()
    assert product.columns * (product.primes[0] // 2) ** 2 < 2 ** 24


def rows():
    rng = random.Random(7)
    out = [(i, [rng.randint(-3, 3) / 16 for _ in range(6)], rng.choice([1, 1, 2, 3]), "x", "x", "x", "x") for i in range(400)]
    out += [out[50], out[51], out[52], out[52]]  # repeated rows
    out += [
        (None, [0.5] * 6, 1, *"xxxx"), (1000, None, 1, *"xxxx"), (1050, [0.5, None], 1, *"xxxx"), (1100, [0.1] * 6, None, *"xxxx"),
        (1150, [float("nan")] * 6, 1, *"xxxx"), (1200, [float("inf")] * 6, 2, *"xxxx"), (1250, [0.25, 0.5], 1, *"xxxx"),
        (1300, [], 2, *"xxxx"), (-50, [0.3] * 6, 9, *"xxxx"),
    ]
    return out


def brute(rows, positives=5, count=3, low=50, high=95):
    held = set()
    for i, v, label, *_ in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        held.add((i, tuple(math.floor(256 * x) for x in v), label))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for i, v, label in held:
        if i % 50:
            continue
        scored = sorted((-dot(v, w), j, other) for j, w, other in held if j != i)
        for s, p, _ in [x for x in scored if x[2] == label][:positives]:
            fine = [x for x in scored if x[2] != label and low * -s <= 100 * -x[0] <= high * -s][:count]
            out += [(i, p, rank, j, -s, -t) for rank, (t, j, _) in enumerate(fine, 1)]
    return sorted(out)


@pytest.mark.parametrize("slab_bytes", [8 << 20, 100])
def test_hard_negatives(spark, monkeypatch, slab_bytes):
    monkeypatch.setattr(negatives, "ANCHORS", 4)
    df = spark.createDataFrame(rows(), SCHEMA).repartition(5)
    got = negatives.hard_negatives(df, slab_bytes=slab_bytes)
    assert sorted(map(tuple, got.collect())) == brute(rows())
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_other_settings_and_label(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    changed = [(i, v, (b + 1) % 10 if i is not None and b is not None and i % 7 == 0 else b) for i, v, b, *_ in rows()]
    got = negatives.hard_negatives(df, positives=2, negatives=6, low=0, high=100, label=moved)
    assert sorted(map(tuple, got.collect())) == brute(changed, 2, 6, 0, 100)


def test_nothing_to_mine(spark):
    assert negatives.hard_negatives(spark.createDataFrame([], SCHEMA)).collect() == []
    one_label = spark.createDataFrame([(i, [1.0, 2.0], 1, *"xxxx") for i in range(60)], SCHEMA)
    assert negatives.hard_negatives(one_label).collect() == []
    no_anchor = spark.createDataFrame([(i, [1.0], i % 2, *"xxxx") for i in range(1, 40)], SCHEMA)
    assert negatives.hard_negatives(no_anchor).collect() == []
