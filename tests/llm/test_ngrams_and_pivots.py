"""Stupid-backoff scores and exact top-k against brute force."""

import math
from collections import Counter

import numpy as np
import pytest
from helpers import awkward, empty
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import ngrams, pivots


def backoff(texts, order=3, factor=0.4):
    words = [bytes(b + 32 if 65 <= b <= 90 else b for b in (t or "").encode()).split() for t in texts]
    own = [[Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) for n in range(1, order + 1)] for w in words]
    every = [sum((o[n] for o in own), Counter()) for n in range(order)]
    total = sum(map(len, words))
    for w, o in zip(words, own, strict=True):
        rest = max(total - len(w), 1)
        score = given_up = 0
        for i in range(len(w)):
            most = min(i + 1, order)
            for n in range(most, 0, -1):
                gram = tuple(w[i - n + 1 : i + 1])
                seen = every[n - 1][gram] - o[n - 1][gram]
                context = max(every[n - 2][gram[:-1]] - o[n - 2][gram[:-1]], 1) if n > 1 else rest
                if seen:
                    score += math.log(factor ** (most - n) * seen / context)
                    break
            else:
                n = 1
                score += math.log(factor ** (most - 1) * factor / (rest + 1))
            given_up += n < most
        yield len(w), score, given_up


@pytest.mark.parametrize("order", [1, 2, 3])
def test_backoff_scores(spark, order):
    df = awkward(spark)
    rows = df.collect()
    want = sorted((n, round(s, 4), b) for n, s, b in backoff([r.text for r in rows], order))
    got = ngrams.backoff_scores(df, order=order, chunk_bytes=1000).collect()
    assert sorted((r.n_words, round(r.log_score, 4), r.n_backed_off) for r in got) == want
    assert sorted(map(str, (r.doc_id for r in got))) == sorted(map(str, (r.doc_id for r in rows)))
    assert all((r.mean_log_score is None) == (r.n_words == 0) for r in got)
    assert ngrams.backoff_scores(empty(spark)).count() == 0


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=50))
def test_keys_round_trip(keys):
    keys = np.sort(np.array(keys, dtype=np.uint32))
    assert ngrams.unpack_keys(ngrams.pack_keys(keys)).tolist() == keys.tolist()


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=50))
def test_wide_keys_round_trip(keys):
    keys = np.sort(np.array(keys, dtype=np.uint64))
    assert ngrams.unpack_keys(ngrams.pack_keys(keys)).tolist() == keys.tolist()


@settings(max_examples=50, deadline=None)
@given(st.sampled_from([np.uint8, np.int64]), st.lists(st.integers(0, 2**63 - 1), max_size=50))
def test_numbers_round_trip(kind, numbers):
    numbers = np.array(numbers, dtype=np.int64).astype(kind)
    got = ngrams.unpack_numbers(ngrams.pack_numbers(numbers), kind)
    assert got.dtype == kind and got.tolist() == numbers.tolist()


@pytest.mark.parametrize("n", [850, 50_000])
def test_what_a_chunk_sends_is_near_its_information(n):
    """Random hashes at the density of a chunk: log2(mean difference) + 1.44 bits are the least for one."""
    rng = np.random.default_rng(3)
    keys = np.sort(rng.integers(0, n << 42, n).astype(np.uint64))
    assert len(ngrams.pack_keys(keys)) < n * (42 + 1.44) / 8 * 1.04 + 40
    assert ngrams.unpack_keys(ngrams.pack_keys(keys)).tolist() == keys.tolist()
    counts = np.where(rng.random(n) < 0.95, 1, 2).astype(np.uint8)
    assert len(ngrams.pack_numbers(counts)) < n / 4 + 60
    totals = rng.integers(2, 200, n)
    assert len(ngrams.pack_numbers(totals)) < 1.1 * n + 60


def test_hashes_that_differ_in_high_bits_only():
    """One partition and the low 32 bits do not tell these apart; the count tables must."""
    hashes = np.array([7, 7 + (64 << 32), 7 + (128 << 32)], dtype=np.uint64)
    rows = [(p, c, k, n) for c, own in ((0, hashes[:2]), (1, hashes[1:])) for p, k, n in ngrams._blobs(own, 64, np.array([5, 9], dtype=np.uint8))]
    assert {r[0] for r in rows} == {0}
    table = ngrams.pa.table(dict(zip(("part", "chunk", "keys", "counts"), map(list, zip(*rows, strict=True)), strict=True)))
    got = {r["chunk"]: (ngrams.unpack_keys(r["keys"]).tolist(), np.frombuffer(r["totals"]).view(np.int64).tolist())
           for r in ngrams._sum_table(table).to_pylist()}
    assert got == {0: ([1], [14]), 1: ([0], [14])}


def brute(rows, k=5):
    fine = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        fine[i, tuple(math.floor(256 * x) for x in v)] = i
    for (q, v) in fine:
        if q % 50 == 0:
            found = sorted((-sum(a * b for a, b in zip(v, w)), i) for (i, w) in fine if i != q)
            yield from ((q, r, i, -s) for r, (s, i) in enumerate(found[:k], 1))


@pytest.mark.parametrize("settings_", [{}, {"pivots": 4, "rings": 3, "chunk_rows": 10, "query_rows": 2, "sample": 50}])
def test_top_k(spark, settings_):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(300)]
    rows += [(400 + i, rows[7][1]) for i in range(20)]  # ties
    rows += [(450, rows[0][1]), (rows[3][0], rows[3][1]), (500, None), (550, [1.0, None]), (600, [math.inf] * 6), (650, [math.nan] * 6)]
    rows += [(None, [1.0] * 6), (700, []), (-50, [100.0] * 6), (701, [0.5, 0.5])]
    df = spark.createDataFrame([(i, v, "clash") for i, v in rows], "vec_id long, embedding array<double>, score string")
    got = pivots.top_k(df, **settings_).collect()
    assert sorted(tuple(r) for r in got) == sorted(brute(rows))


def test_top_k_of_few_rows(spark):
    schema = "vec_id long, embedding array<float>"
    assert pivots.top_k(spark.createDataFrame([], schema)).count() == 0
    assert pivots.top_k(spark.createDataFrame([(0, [1.0])], schema)).count() == 0
    assert pivots.top_k(spark.createDataFrame([(0, [1.0]), (1, [0.0])], schema)).count() == 1


def test_counting_a_chunk_takes_little_memory():
    import tracemalloc

    import pyarrow as pa

    from millrace.llm import words

    n = 400
    texts = [" ".join(f"w{(i * 7919 + k * k) % 5000}" for k in range(2000)) for i in range(n)]
    texts[0] = "often " * 1000  # 1000 = 3 * 255 + 235
    chunk = pa.table({
        "chunk": pa.array([0] * n), "md5": [f"{i:032d}" for i in range(n)], "doc_id": pa.array(range(n), pa.int64()), "text": texts})
    words._powers.clear()
    tracemalloc.start()
    out = ngrams._count_chunk(3, 8)(chunk).to_pylist()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 28 * sum(map(len, texts))
    keys = np.concatenate([ngrams.unpack_keys(r["keys"]) for r in out])
    counts = np.concatenate([np.frombuffer(r["counts"], dtype=np.uint8) for r in out])
    assert (keys[1:] >= keys[:-1]).all() and counts.astype(int).sum() == sum(3 * len(t.split()) - 3 for t in texts)
    repeated = keys[1:][keys[1:] == keys[:-1]]
    assert len(repeated) >= 9 and (counts[:-1][keys[1:] == keys[:-1]] == 255).all()
