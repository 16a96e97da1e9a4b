"""Quality and toxicity scores: held-out accuracy, awkward rows, the scan for segments."""

import numpy as np
import pyarrow as pa
import pytest
from helpers import LONG, awkward, empty
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import quality, toxicity
from millrace.llm.queries import QUERIES


@pytest.fixture(scope="module")
def larger():
    return "/root/testdata/sf0.01"


def held_out_accuracy(spark, folder, name, label):
    rows = QUERIES[name](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").filter("held_out").collect()
    return np.mean([r.predicted == r[label] for r in rows])


def test_held_out(spark, larger):
    assert held_out_accuracy(spark, larger, "op4_quality", "quality") > 0.95
    assert held_out_accuracy(spark, larger, "op2_toxicity", "toxic") > 0.9


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_awkward_rows(spark):
    df = awkward(spark)
    some = labels(spark, [(i, i % 2, int(i % 3 == 0)) for i in range(20)] + [(None, 1, 1), (3, None, None), (99, 1, 0), (4, 0, 1)])
    model = quality.fit_quality(df, some)
    scored = quality.score_quality(df, model)
    assert scored.columns == [c for c in df.columns if c != "score"] + ["score"]
    assert scored.count() == df.count() and scored.filter("score is null or score < 0 or score > 1").count() == 0
    tox = toxicity.fit_toxicity(df, some, slots=1 << 12)
    found = toxicity.score_toxicity(df, tox)
    assert found.count() == df.count() and found.filter("score is null or score < 0 or score > 1").count() == 0
    assert toxicity.toxic_passages(df, tox).count() >= 0
    none = labels(spark, [])
    assert quality.score_quality(df, quality.fit_quality(df, none)).count() == df.count()
    assert toxicity.score_toxicity(df, toxicity.fit_toxicity(df, none, slots=1 << 12)).count() == df.count()
    assert quality.score_quality(empty(spark), model).count() == 0
    assert toxicity.score_toxicity(empty(spark), tox).count() == 0
    assert toxicity.fit_toxicity(empty(spark), some, slots=1 << 12) is not None


def test_features_do_not_depend_on_neighbours():
    texts = [None, "", "one", "a b c a b c a b c", "line\nline\nother line", "Ünï çødé!", LONG, "x | y | z"]
    together = quality.feature_rows(pa.array(texts))
    alone = np.vstack([quality.feature_rows(pa.array([t], pa.string())) for t in texts])
    assert np.allclose(together, alone)
    at = dict(zip(quality.FEATURES, together[3], strict=True))
    assert at["repeated_runs"] == pytest.approx(4 / 9) and at["distinct_words"] == pytest.approx(3 / 9)


def test_pairs_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit_additive(x, y, rounds=20)
    assert (0, 1) in model.pairs
    assert ((model.score(x) > 0.5) == y).mean() > 0.9


def by_definition(scores):
    """Maximal segments by their definition: take the best, then the same to the left and right of it."""
    best, span = 0, None
    for i in range(len(scores)):
        for j in range(i + 1, len(scores) + 1):
            total = sum(scores[i:j])
            if total > best or (span and total == best and j - i < span[1] - span[0]):
                best, span = total, (i, j)
    if not span:
        return []
    i, j = span
    left = by_definition(scores[:i])
    right = [(a + j, b + j, s) for a, b, s in by_definition(scores[j:])]
    return left + [(i, j, best)] + right


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-7, 7).filter(bool), max_size=14))
def test_maximal_segments(scores):
    got = toxicity.maximal_segments(scores)
    want = by_definition(scores)
    assert sorted(t for _, _, t in got) == sorted(t for _, _, t in want)
    assert all(sum(scores[a:b]) == t for a, b, t in got)


def test_passages_point_at_the_words(spark):
    clean = [(i, f"the word number {i} of and to in house tree river " * 3, 1, 0) for i in range(200)]
    bad = [(1000 + i, f"the word {i} of awfulword nastyword and to house river tree " * 2, 1, 1) for i in range(60)]
    df = spark.createDataFrame([(a, b) for a, b, _, _ in clean + bad], "doc_id long, text string")
    model = toxicity.fit_toxicity(df, labels(spark, [(a, q, t) for a, _, q, t in clean + bad]), slots=1 << 14)
    rows = toxicity.toxic_passages(df, model, keep=("doc_id", "text"), chance=0.05).collect()
    assert {r.doc_id for r in rows} == {a for a, _, _, _ in bad}
    for r in rows:
        assert "awfulword" in r.text.encode()[r.first_byte : r.end_byte].decode()


def test_segments_of_falling_sums_take_linear_time():
    """Every earlier segment starts higher: 30,000 steps back for each token took most of a minute."""
    import time

    begin = time.perf_counter()
    assert len(toxicity.maximal_segments([1.0, -2.0] * 30_000)) == 30_000
    assert time.perf_counter() - begin < 5
