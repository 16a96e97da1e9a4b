"""Suffix order and removal of repeated strings against brute force."""

import hashlib
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import awkward, empty
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import suffixes


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=80))
def test_suffix_order(symbols):
    order = suffixes.suffix_order(np.array(symbols, dtype=np.int64))
    assert list(order) == sorted(range(len(symbols)), key=lambda i: symbols[i:])


def test_suffix_order_of_long_repeats():
    symbols = np.tile(np.arange(1, 8), 200)
    flat = symbols.tolist()
    assert list(suffixes.suffix_order(symbols)) == sorted(range(len(flat)), key=lambda i: flat[i:])


def expected(rows):
    """(id, bytes, removed, spans, hash) by looking at every string of 50 bytes."""
    texts = [(r.doc_id if r.doc_id is not None else suffixes.NO_ID, r.doc_id, (r.text or "").encode()) for r in rows]
    first = {}
    for key, _, t in texts:
        for j in range(len(t) - 49):
            first[t[j : j + 50]] = min(key, first.get(t[j : j + 50], key))
    for key, doc_id, t in texts:
        gone = np.zeros(len(t), dtype=bool)
        for j in range(len(t) - 49):
            if first[t[j : j + 50]] < key:
                gone[j : j + 50] = True
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(t) else 0
        left = np.frombuffer(t, dtype=np.uint8)[~gone].tobytes()
        yield doc_id, len(t), int(gone.sum()), spans, hashlib.sha256(left).hexdigest()


@pytest.mark.parametrize("source", ["awkward", "table"])
def test_against_all_strings(spark, data, source):
    df = awkward(spark) if source == "awkward" else spark.read.parquet(f"{data}/documents.parquet")
    got = suffixes.remove_repeats(df)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, expected(df.collect())))


def test_overlapping_passages(spark):
    rng = np.random.default_rng(3)
    letters = lambda n: "".join(rng.choice(list("abcdefgh"), n))
    a, b, c = letters(120), letters(49), letters(50)
    texts = [a, "x" + a[:60] + "y" + a[40:110], b, "q" + b + "q", c, c, "é" * 40, "ü" + "é" * 40, "z" * 200, "z" * 75 + "k"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = suffixes.remove_repeats(df)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, expected(df.collect())))


def test_heavy_anchors_are_dealt_by_window(spark, data):
    """The same result when every anchor counts as heavy; pieces of one anchor then have several partitions."""
    df = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").unionByName(awkward(spark).select("doc_id", "text"))
    read = lambda **s: sorted(map(str, map(tuple, suffixes.search_repeats(df, keep_text=True, **s).collect())))
    assert read(heavy=1, chunk_bytes=50_000) == read(heavy=1 << 40)
    texts = [(f"{i:026d}" + "The same twenty-six bytes.")[-60:] + f"{i * 7919:026d}" for i in range(400)]
    chunk = pa.table({"chunk": [0] * 400, "md5": [f"{i:03d}" for i in range(400)], "doc_key": list(range(400)), "text": texts})
    lists = suffixes._anchor_lists(1)(chunk)
    spread = {}
    for heavy in (1, 1 << 40):
        shared = suffixes._shared_anchors(lists, heavy)
        one = suffixes._pieces_of_chunk(1)(chunk, shared)
        size = Counter()
        for keys, lengths in zip(one.column("keys").to_pylist(), one.column("lengths").to_pylist(), strict=True):
            for k, n in zip(np.frombuffer(keys, np.uint32), np.frombuffer(lengths, np.int32)[: len(keys) // 4], strict=True):
                size[int(k)] += int(n)
        spread[heavy] = max(size.values())
    assert spread[1] * 20 < spread[1 << 40]


def test_equal_rows_leave_the_reading_task_once():
    batch = pa.RecordBatch.from_pydict({"chunk": [1] * 6, "md5": list("aabbab"), "doc_key": [1, 1, 1, 2, 1, 2], "text": list("xxyyxy")})
    out = pa.Table.from_batches(suffixes._once(iter([batch, batch])))
    assert out.num_rows == 3


def test_texts_without_repeats(spark):
    df = awkward(spark)
    out = suffixes.without_repeats(df)
    assert out.columns == df.columns
    left = {r.doc_id: r.text for r in out.collect() if r.doc_id is not None}
    whole = {r.doc_id: r.text for r in df.collect() if r.doc_id is not None}
    assert left[7] == whole[7] and 19 not in left and left[0] is None


def test_empty_table(spark):
    assert suffixes.remove_repeats(empty(spark)).count() == 0
    assert suffixes.without_repeats(empty(spark)).count() == 0


def test_chunks_take_little_memory():
    """A task holds the chunks of two cores beside the JVM's heap: 12 bytes for each byte of text, not 25."""
    import tracemalloc

    n, text = 400, "some words of a text, " * 500
    texts = [f"{i} {text}" for i in range(n)]
    chunk = pa.table({
        "chunk": pa.array([0] * n), "md5": [f"{i:032d}" for i in range(n)], "doc_key": pa.array(range(n), pa.int64()), "text": texts})
    covered = pa.table({
        "numbers": [b"\0\0\0\0\1\0\0\0"], "starts": [b"\0" * 16], "lengths": [b"\x32\0\0\0\x33\0\0\0"]})
    tracemalloc.start()
    done = suffixes._cut_texts(chunk, covered)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 12 * sum(map(len, texts))
    assert done.column("n_removed").to_pylist()[:3] == [50, 51, 0] and done.column("n_spans").to_pylist()[:3] == [1, 1, 0]
    assert done.column("kept").to_pylist()[:2] == [texts[0][50:], texts[1][51:]]


def _peak_mb(run) -> tuple[float, pa.Table]:
    suffixes.W._powers.clear()
    tracemalloc.start()
    try:
        out = run()
        return tracemalloc.get_traced_memory()[1] / 1e6, out
    finally:
        tracemalloc.stop()


def test_memory_for_many_heavy_windows():
    """A chunk whose windows are all heavy: a few bytes for each window, not dozens of arrays of all of them."""
    rng = np.random.default_rng(5)
    long = rng.integers(97, 123, 600_000, dtype=np.uint8).tobytes().decode()
    chunk = pa.table({"chunk": [0] * 4, "md5": list("abcd"), "doc_key": [1, 1, 1, 2], "text": [long, long, long, long]})
    shared = suffixes._shared_anchors(suffixes._anchor_lists(1)(chunk), 1)
    peak, pieces = _peak_mb(lambda: suffixes._pieces_of_chunk(1)(chunk, shared))
    assert peak < 500, f"{peak:.0f} MB"
    covered = pieces.filter(pa.array(np.array(pieces["part"]) == -1))
    marks = np.zeros(len(long) + 1, dtype=np.int64)
    for numbers, starts, sizes in zip(*(covered[c].to_pylist() for c in ("numbers", "starts", "lengths")), strict=True):
        assert set(np.frombuffer(numbers, dtype=np.int32).tolist()) == {3}
        start, size = np.frombuffer(starts, dtype=np.int64), np.frombuffer(sizes, dtype=np.int32)
        np.add.at(marks, start, 1)
        np.add.at(marks, start + size, -1)
    assert (np.cumsum(marks)[:-1] > 0).all()


def test_equal_pieces_of_a_partition_are_sorted_once():
    """One frequent string in most texts, and a longer one around it in two; the first text has it twice."""
    rng = np.random.default_rng(7)
    string = rng.integers(97, 123, 50, dtype=np.uint8).tobytes()
    wide = string + b"0123456789"
    pieces = [(1, string), (1, string), (3, wide), (4, wide), *((k, string) for k in range(5, 30_000))]
    blob = lambda kind, values: [np.array(values, dtype=kind).tobytes()]
    rows = pa.table({
        "part": [0], "chunk": [0], "keys": blob(np.uint32, [9] * len(pieces)), "docs": blob(np.int64, [d for d, _ in pieces]),
        "numbers": blob(np.int32, range(len(pieces))), "starts": blob(np.int64, [100] * len(pieces)),
        "lengths": blob(np.int32, [len(b) for _, b in pieces]), "bytes": [b"".join(b for _, b in pieces)]})
    peak, out = _peak_mb(lambda: suffixes._repeats_of_partition()(rows))
    assert peak < 40, f"{peak:.0f} MB"
    read = lambda name, kind: np.concatenate([np.frombuffer(b, dtype=kind) for b in out[name].to_pylist()]).tolist()
    found = sorted(zip(read("numbers", np.int32), read("starts", np.int64), read("lengths", np.int32), strict=True))
    assert found == [(2, 100, 50), (3, 100, 60), *((n, 100, 50) for n in range(4, len(pieces)))]


def test_hashes_do_not_depend_on_slices():
    rng = np.random.default_rng(11)
    data = rng.integers(0, 4, 5_000, dtype=np.uint8)
    starts = np.sort(rng.integers(0, 4_900, 700))
    sizes = rng.integers(1, 100, 700)
    whole = suffixes._hashes(data, starts, sizes)
    for most in (1, 97, 1_000):
        assert (suffixes._hashes(data, starts, sizes, most) == whole).all()
    assert len({(bytes(data[a : a + n]), h) for a, n, h in zip(starts, sizes, whole)}) == len({bytes(data[a : a + n]) for a, n in zip(starts, sizes)})
