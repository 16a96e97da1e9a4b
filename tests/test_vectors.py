"""Vectors of texts against numpy on small tables."""

import hashlib
import math
import re

import numpy as np
import pytest

from millrace.operators import vectors

SLOTS = 512


def tfidf(texts, slots):
    words = [[w for w in re.split("[^a-z0-9_]+", (t or "").lower()) if w] for t in texts]
    m = np.zeros((len(texts), slots))
    for i, ws in enumerate(words):
        for w in ws:
            m[i, int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % slots] += 1
    m *= np.log((len(texts) + 1) / ((m > 0).sum(axis=0) + 1))
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)


def themed(n=240, themes=12):
    rng = np.random.default_rng(5)
    words = [[f"t{k}w{i}" for i in range(15)] for k in range(themes)]
    common = [f"common{i}" for i in range(30)]
    return [" ".join([*rng.choice(words[i % themes], 12), *rng.choice(common, 12)]) for i in range(n)]


AWKWARD = [None, "", "  ...", "One two, TWO", "one two two", "one two two", "é é", "long " * 50_000 + "tail"]


@pytest.mark.parametrize("texts", [AWKWARD, themed(30)])
def test_tfidf_is_that_of_numpy(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = vectors.sentence_vectors(df, "text", dims=64, kind="double")
    assert got.columns == ["id", "text", "vector"] and got.count() == len(texts)
    rows = {r.id: r.vector for r in got.collect()}
    np.testing.assert_allclose(np.array([rows[i] for i in range(len(texts))]), tfidf(texts, 64), atol=1e-9)


def test_projection_keeps_neighbours(spark):
    texts = themed()
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(5)
    rows = {r.id: r.vector for r in vectors.dense_vectors(df, "text", dims=16, slots=SLOTS).collect()}
    dense = np.array([rows[i] for i in range(len(texts))], dtype=float)
    np.testing.assert_allclose(np.linalg.norm(dense, axis=1), 1, atol=1e-5)
    full = tfidf(texts, SLOTS)
    # As close to the texts as the best 16 directions there are.
    u, s, _ = np.linalg.svd(full, full_matrices=False)
    best = (u * s)[:, :16]
    best /= np.linalg.norm(best, axis=1, keepdims=True)
    assert np.abs(dense @ dense.T - best @ best.T).mean() < 0.05
    near = full @ full.T
    for m in (near, like := dense @ dense.T):
        np.fill_diagonal(m, -1)
    theme = np.arange(len(texts)) % 12
    assert (theme[like.argmax(axis=1)] == theme).mean() >= 0.95
    chosen = near[np.arange(len(texts)), like.argmax(axis=1)]
    assert (chosen >= 0.5 * near.max(axis=1)).mean() >= 0.9


def test_projection_of_awkward_rows(spark):
    df = spark.createDataFrame(list(enumerate(AWKWARD)), "id int, text string")
    rows = {r.id: r.vector for r in vectors.dense_vectors(df, "text", dims=4, slots=64).collect()}
    assert len(rows) == len(AWKWARD) and all(len(v) == 4 and not any(map(math.isnan, v)) for v in rows.values())
    assert [rows[i] for i in (0, 1, 2, 6)] == [[0.0] * 4] * 4
    np.testing.assert_allclose(rows[4], rows[5], atol=1e-6)
    none = vectors.dense_vectors(df.limit(0), "text", dims=4, slots=64)
    assert none.count() == 0 and none.columns == ["id", "text", "vector"]
    assert vectors.sentence_vectors(df.limit(0), "text").count() == 0


def test_only_small_tables_of_slots_are_sent(spark, monkeypatch):
    df = spark.createDataFrame(list(enumerate(themed(10))), "id int, text string")
    plan = lambda: vectors.dense_vectors(df, "text", dims=4, slots=64, rounds=0)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan()
    monkeypatch.setattr(vectors, "_SMALL", 100)
    assert "strategy=broadcast" not in plan()


def test_large_tables_of_slots_give_the_same_products(spark, monkeypatch):
    texts = [*themed(60), *AWKWARD]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(3)

    def products():
        rows = {r.id: r.vector for r in vectors.dense_vectors(df, "text", dims=6, slots=SLOTS).collect()}
        dense = np.array([rows[i] for i in range(len(texts))], dtype=float)
        return dense @ dense.T

    small = products()
    monkeypatch.setattr(vectors, "_SMALL", 100)
    np.testing.assert_allclose(products(), small, atol=1e-4)


def test_sums_of_many_rows_are_plain(spark):
    """Sums of vector objects are sorted from 128 groups on, with every vector that meets an entry."""
    df = spark.createDataFrame(list(enumerate(themed(10))), "id int, text string")
    plan = vectors.dense_vectors(df, "text", dims=4, slots=64, rounds=0)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "ObjectHashAggregate" not in plan and "SortAggregate" not in plan


def test_sparse_vectors_need_no_shuffle(spark):
    df = spark.createDataFrame(list(enumerate(themed(10))), "id int, text string")
    plan = vectors.sentence_vectors(df, "text", dims=16)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_slots_of_runs_of_texts(monkeypatch):
    """Words of 1 to 20 bytes at all edges, in one run or one for each text; a word is not looked up at each place."""
    rng = np.random.default_rng(4)
    odd = [b"", b"a", b"_", b" ", b"12345678", b"123456789", b"a\0b\0", b"abcdefgh abcdefghi abcdefg", "é_é".encode(), bytes(range(256)), None, b""]
    texts = odd + [bytes(rng.choice(list(b"ab_1 .\0\n\xc3"), n)) for n in range(80)]
    want = [[int(hashlib.md5(w).hexdigest()[:8], 16) % 97 for w in re.findall(rb"[a-z0-9_]+", t or b"")] for t in texts]
    for most in (1, 50, 1 << 20):
        monkeypatch.setattr(vectors, "_TEXT_AT_ONCE", most)
        assert [s.tolist() for s in vectors._slots_of(texts, 97)] == want


def test_md5_of_many_words(monkeypatch):
    """Lengths on both sides of each limit; few words go through the dictionary."""
    monkeypatch.setattr(vectors, "_WORDS_AT_ONCE", 7)
    asked, missing = [], vectors._SlotOf.__missing__
    monkeypatch.setattr(vectors._SlotOf, "__missing__", lambda self, word: asked.append(len(word)) or missing(self, word))
    words = [(b"abc123_xyz" * 13)[n % 10 :][:n] for n in range(1, 121)] * 2
    want = [int(hashlib.md5(w).hexdigest()[:8], 16) for w in words]
    assert [s.tolist() for s in vectors._slots_of([b" ".join(words), b"", b"a"], 1 << 32)] == [want, [], [int(hashlib.md5(b"a").hexdigest()[:8], 16)]]
    assert sorted(asked) == list(range(56, 121))
