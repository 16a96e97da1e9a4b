"""Source mixing and packing: awkward rows, targets, repeats, and the least padding by brute force."""

import re
from itertools import combinations

import numpy as np
import pytest
from helpers import awkward, empty

from millrace.llm import mixing, packing


def targets_by_rounds(sizes, weights=(5, 2, 1)):
    """Share by weight, stop at three times the size, reshare what is above, until none is."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in full]
        share = (total - sum(full.values())) / max(sum(weight[s] for s in open_), 1)
        above = [s for s in open_ if weight[s] * share > 3 * sizes[s]]
        if not above:
            return {s: full.get(s, weight[s] * share) for s in names}
        full |= {s: 3 * sizes[s] for s in above}


def test_mix_of_awkward_rows(spark):
    df = awkward(spark)
    rows = mixing.mix(df).collect()
    assert len(rows) == df.count()
    sizes = {}
    for r in df.collect():
        sizes[r.source] = sizes.get(r.source, 0) + len((r.text or "").encode().split())
    want = targets_by_rounds(sizes)
    taken = {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        taken.setdefault((r.source_size, r.target), 0)
        taken[r.source_size, r.target] += r.taken
    assert sorted(round(t, 6) for _, t in taken) == sorted(round(t, 6) for t in want.values())
    assert all(abs(n - t) <= 1 for (_, t), n in taken.items())
    again = mixing.mix(df.repartition(7)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1, None: 1000}, {"a": 0, "b": 7}, {"z": 5}, {"a": 1, "b": 1, "c": 1, "d": 500}])
def test_targets(spark, sizes):
    rows = [(f"={s}", s, n) for s, n in sizes.items()]
    df = spark.createDataFrame(rows, "source_key string, source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    assert {s: pytest.approx(t) for s, t in targets_by_rounds(sizes).items()} == got


def test_points_are_even(spark):
    rows = spark.range(1000).select(mixing.slot_point("id", __import__("pyspark").sql.functions.lit(1.0)).alias("p")).collect()
    points = np.sort([r.p for r in rows])
    assert np.abs(points - (np.arange(1000) + 0.5) / 1000).max() < 0.01


def test_small_sources_keep_all_blocks(spark):
    """Sources of 50 to 3,000 words beside 10^8: as many slots as blocks, each slot once."""
    small = [50, 100, 1000, 3000] * 10
    rows, low = [], 0
    for i, n in enumerate([n for s in small for n in (10**8 // len(small) - s, s)]):
        rows.append((f"={i}", i, low, low + n))
        low += n
    targets = spark.createDataFrame(rows, "source_key string, number int, low long, high long")
    slots = mixing.schedule(targets, low, 256).toPandas()
    assert slots["slot"].is_unique
    ranks = slots.groupby("source_key")["rank"].apply(set)
    assert all(set(range(-(-(high - low) // 256))) <= ranks.get(key, set()) for key, _, low, high in rows)


def test_mix_with_tiny_sources(spark):
    rows = [(i, "word " * 2000, "big") for i in range(10)] + [(100 + i, "one two", f"tiny{i}") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(df, keep=(), block_words=2).toPandas()
    assert len(out) == 40
    assert (out[out["size"] == 2]["taken"] - out[out["size"] == 2]["target"]).abs().max() <= 1
    big = out[out["size"] == 2000]
    assert abs(big["taken"].sum() - big["target"].iloc[0]) <= 1


def test_every_beginning_of_the_mix_has_the_weights(spark):
    """Words of a source among the first slots stay near its share, while it still has words."""
    rows = [(i, "word " * (20 + i % 50), "abc"[i % 3]) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sized, pieces = mixing.mixed_pieces(df, block_words=16)
    taken = pieces.join(sized.select("row", "source_size", "target"), "row").toPandas()
    total, targets = 0, {}
    for (size, target), words in taken.groupby(["source_size", "target"])["words"]:
        assert abs(words.sum() - target) <= 1
        total, targets[size, target] = total + words.sum(), target
    slots = taken.groupby("slot")["words"].sum().sort_index()
    assert slots.max() <= 16 and (slots == 16).mean() > 0.98
    for slot in slots.index[len(slots) // 20 :: len(slots) // 20]:
        begun = taken[taken["slot"] <= slot]
        for (size, target), words in begun.groupby(["source_size", "target"])["words"]:
            assert abs(words.sum() / begun["words"].sum() - target / total) < 0.05
    out = mixing.mix(df, block_words=16).toPandas()
    assert (out["first_slot"] <= out["last_slot"]).eq(out["taken"] > 0).all()
    assert out["first_slot"].isna().eq(out["taken"] == 0).all()


def test_empty_tables(spark):
    assert mixing.mix(empty(spark)).count() == 0
    assert mixing.mixed_rows(empty(spark)).count() == 0
    assert packing.pack(empty(spark)).count() == 0


def test_mixed_rows(spark):
    df = awkward(spark)
    out = mixing.mixed_rows(df)
    assert out.columns == df.columns
    assert {r.text for r in out.collect()} <= {r.text for r in df.collect() if (r.text or "").split()}


@pytest.mark.parametrize("buckets", [1, 2, 3, 6])
def test_best_bounds(buckets):
    rng = np.random.default_rng(buckets)
    lengths = np.sort(rng.choice(40, 6, replace=False))
    counts = rng.integers(1, 50, 6)

    def padded(bounds):
        return sum(c * min(b for b in bounds if b >= n) for n, c in zip(lengths, counts, strict=True))

    best = min(padded([*inner, lengths[-1]]) for k in range(buckets) for inner in combinations(lengths[:-1], k))
    bounds = packing.best_bounds(lengths, counts, buckets)
    assert len(bounds) <= buckets and bounds[-1] == lengths[-1] and padded(bounds) == best


def test_pack_of_awkward_rows(spark):
    df = awkward(spark)
    rows = packing.pack(df, context=100, buckets=3, budget=350).collect()
    words = [len((r.text or "").encode().split()) for r in df.collect()]
    assert len(rows) == sum(max(-(-n // 100), 1) for n in words)
    assert sum(r.length for r in rows) == sum(words)
    batches = {}
    for r in rows:
        assert r.length <= r.padded <= 100
        batches.setdefault((r.padded, r.batch), []).append(r.place)
    for (padded, _), places in batches.items():
        assert sorted(places) == list(range(len(places)))
        assert len(places) * padded <= max(350, padded)
    partly = [k for k, v in batches.items() if len(v) < max(350 // max(k[0], 1), 1)]
    assert len({p for p, _ in partly}) == len(partly)  # one short batch a bucket at most
    assert sorted(map(str, rows)) == sorted(map(str, packing.pack(df.repartition(5), context=100, buckets=3, budget=350).collect()))


def test_pieces_of_the_mix_are_not_broadcast(spark):
    docs = spark.range(300).selectExpr("id AS doc_id", "concat('s', id % 3) AS source", "repeat('word ', 700) AS text")
    sized, pieces = mixing.mixed_pieces(docs)
    plan = pieces._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"SortMergeJoin(\(skew=true\))? \[source_key#\d+, rank#\d+L?\], \[source_key#\d+, rank#\d+L?\]", plan)
    assert pieces.agg({"words": "sum"}).first()[0] > 0 and sized.count() == 300
