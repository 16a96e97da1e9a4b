"""SimHash fingerprints, links and classes against brute force."""

import random
import re

import numpy as np
import xxhash
from helpers import awkward, empty

from millrace.llm import simhash
from millrace.llm.components import components
from millrace.session import cut_lineage


def fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    runs = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in runs]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def classes(values, within=3):
    """Smallest index of each component by brute force."""
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= within:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def test_awkward_rows(spark):
    df = awkward(spark)
    got = simhash.near_duplicates(df).collect()
    rows = df.collect()
    assert len(got) == len(rows)
    expected = [(r.doc_id, fingerprint(r.text)) for r in rows]
    assert sorted(map(str, ((r.doc_id, r.fp & (2**64 - 1)) for r in got))) == sorted(map(str, expected))
    root = classes([f for _, f in expected])
    smallest = {}
    for (doc_id, _), r in zip(expected, root):
        if doc_id is not None:
            smallest[r] = min(doc_id, smallest.get(r, doc_id))
    want = sorted(str((d, smallest.get(r))) for (d, _), r in zip(expected, root))
    assert sorted(str((r.doc_id, r.component_id)) for r in got) == want


def test_empty_table(spark):
    assert simhash.near_duplicates(empty(spark)).count() == 0
    assert simhash.one_of_each(empty(spark)).count() == 0


def test_links_of_close_fingerprints(spark):
    rng = random.Random(1)
    values = [rng.getrandbits(64) for _ in range(150)]
    for bits in (1, 2, 3, 4, 5):
        for v in values[:40]:
            for j in rng.sample(range(64), bits):
                v ^= 1 << j
            values.append(v)
    base = rng.getrandbits(64)  # a dense group, all in a few bits
    values += [base ^ sum(1 << j for j in rng.sample(range(10), 5)) for _ in range(200)]
    values = list(dict.fromkeys(values))
    df = spark.createDataFrame([(int(np.uint64(v).astype(np.int64)),) for v in values], "fp long")
    for list_rows in (20_000, 25):  # whole lists, and lists cut in blocks
        links = simhash.fingerprint_links(df, list_rows).collect()
        assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 3 for a, b in links)
        at = {int(np.uint64(v).astype(np.int64)): i for i, v in enumerate(values)}
        root = list(range(len(values)))

        def find(i):
            while root[i] != i:
                i = root[i]
            return i

        for a, b in links:
            x, y = find(at[a]), find(at[b])
            root[max(x, y)] = min(x, y)
        assert [find(i) for i in range(len(values))] == classes(values)


def test_one_of_each_keeps_smallest(spark):
    df = awkward(spark)
    stay = simhash.one_of_each(df)
    assert stay.columns == df.columns
    ids = [r.component_id for r in simhash.near_duplicates(df).select("component_id", "root").distinct().collect()]
    assert sorted(map(str, (r.doc_id for r in stay.collect()))) == sorted(map(str, ids))


def test_components_of_chain_and_star(spark):
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    loops = [(5000, 5000)]
    got = components(spark.createDataFrame(chain + star + loops, "a long, b long"), "a", "b").collect()
    roots = {}
    for node, root in got:
        roots.setdefault(root, set()).add(node)
    assert sorted(map(len, roots.values())) == [300, 301]
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_lists_are_not_broadcast(spark, monkeypatch):
    plans = {}

    def noted(df, name="cut"):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return cut_lineage(df, name)

    monkeypatch.setattr(simhash, "cut_lineage", noted)
    fps = cut_lineage(spark.range(500).selectExpr("xxhash64(id) AS fp"), "fps")
    links = simhash.fingerprint_links(fps)
    assert "SortMergeJoin" in plans["lists"] and "Broadcast" not in plans["lists"]
    assert "Broadcast" not in links._jdf.queryExecution().executedPlan().toString()
