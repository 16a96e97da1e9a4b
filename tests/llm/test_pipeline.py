"""The pipeline against brute force, stage by stage, and on awkward rows."""

import corpus_pipeline
from helpers import CLASHING, awkward, empty
from test_mix_and_pack import targets_by_rounds
from test_simhash import classes, fingerprint
from test_suffixes import expected

from millrace.session import cut_lineage


def test_stages_by_brute_force(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, cut_lineage(stage(spark, docs, data), "stage")
        kept[name] = (before.collect(), docs.collect())
        if name != "length_buckets":
            assert docs.columns == before.columns
    before, after = kept["quality_classifier"]
    good = {r.doc_id for r in spark.read.parquet(f"{data}/labels.parquet").filter("quality = 1").collect()}
    assert {r.doc_id for r in after} >= good & {r.doc_id for r in before} and len(after) < len(before)
    before, after = kept["simhash_near_dedup"]
    first = {}
    for r, root in zip(before, classes([fingerprint(r.text) for r in before]), strict=True):
        first[root] = min(r.doc_id, first.get(root, r.doc_id))
    assert sorted(r.doc_id for r in after) == sorted(first.values())
    before, after = kept["suffix_array_dedup"]
    removed = {d: n for d, _, n, _, _ in expected(before)}
    texts = {r.doc_id: r.text for r in before}
    for r in after:
        assert len(texts[r.doc_id].encode()) - len(r.text.encode()) - removed[r.doc_id] in range(7)
    before, after = kept["source_mix"]
    sizes, words = {}, {}
    for r in before:
        words[r.doc_id] = len(r.text.encode().split())
        sizes[r.source] = sizes.get(r.source, 0) + words[r.doc_id]
    for source, target in targets_by_rounds(sizes).items():
        taken = sum(words[r.doc_id] for r in after if r.source == source)
        assert abs(taken - target) <= max(words[r.doc_id] for r in before if r.source == source)
    before, after = kept["length_buckets"]
    assert sum(r.length for r in after) == sum(len(r.text.encode().split()) for r in before)
    assert sorted(map(str, corpus_pipeline.run(spark, data).collect())) == sorted(map(str, after))


def test_awkward_rows_and_empty_table(spark, data):
    for df in (awkward(spark), empty(spark)):
        docs = df
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = cut_lineage(stage(spark, docs, data), "stage")
            assert docs.columns == df.columns
        for r in docs.collect():
            assert [r[c] for c in CLASHING] == ([None] * len(CLASHING) if r.doc_id is None else ["clash"] * len(CLASHING))
        assert corpus_pipeline.STAGES[-1][1](spark, docs, data).count() >= 0
