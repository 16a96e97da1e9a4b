"""Byte-level BPE against tiktoken, phrases against a count of everything."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from helpers import awkward, awkward_rows, empty
from pyspark.sql import functions as F

from millrace.llm import bpe, phrases
from millrace.llm.queries import QUERIES

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
TIKTOKEN = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary.build(RANKS)


def ids_of(vocabulary, text):
    packed = bpe._encoded([text], regex.compile(public_tokenizers.PATTERN), vocabulary)[0]
    return np.frombuffer(packed, dtype="<u4").tolist()


def test_perfect_hash_is_minimal(vocabulary):
    data, begin = bpe.flat_bytes(sorted(RANKS))
    slots = vocabulary.hash.slots(bpe.hash_runs(data, begin, vocabulary.seed))
    assert sorted(slots.tolist()) == list(range(len(RANKS)))


def test_first_tier_finds_tokens_only(vocabulary):
    rng = random.Random(1)
    pieces = rng.sample(sorted(RANKS), 500) + [bytes(rng.randrange(256) for _ in range(rng.randint(1, 200))) for _ in range(500)]
    found = vocabulary.whole_tokens(*bpe.flat_bytes(pieces))
    assert found.tolist() == [RANKS.get(p, -1) for p in pieces]


def test_same_ids_for_every_character(vocabulary):
    for low in range(0, 0x110000, 8192):
        text = "".join(f"a{chr(c)}b{chr(c)} 1{chr(c)}{chr(c)}!" for c in range(low, low + 8192) if not 0xD800 <= c < 0xE000)
        if text:
            assert ids_of(vocabulary, text) == TIKTOKEN.encode_ordinary(text)


@pytest.mark.parametrize("text", [
    "", " ", "\n\n \t x", "a" * 5000, "ab" * 3000, "it's we'll I'D <|endoftext|>", "\0\0 \0", "漢字仮名交じり文 😀👍🏽" * 50,
])
def test_same_ids(vocabulary, text):
    ids = ids_of(vocabulary, text)
    assert ids == TIKTOKEN.encode_ordinary(text)
    assert vocabulary.decode(np.array(ids, dtype=np.uint32)) == text.encode()


def test_long_text_in_pieces(vocabulary, monkeypatch):
    rng = random.Random(2)
    text = " ".join("".join(rng.choice("abcdefgé1 ") for _ in range(rng.randint(1, 12))) for _ in range(4000))
    monkeypatch.setattr(bpe, "MOST_PIECE", 100)
    monkeypatch.setattr(bpe, "MOST_MEMO", 50)
    assert ids_of(vocabulary, text) == TIKTOKEN.encode_ordinary(text)


def test_byte_level_vocabulary_is_asked_for():
    with pytest.raises(ValueError):
        bpe.Vocabulary.build({b"a": 0})


def test_query_13(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    want = []
    for r in docs:
        ids = TIKTOKEN.encode_ordinary(r["text"])
        want.append((r["doc_id"], len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(),
                     hashlib.sha256(r["text"].encode()).hexdigest()))
    got = QUERIES["op13_byte_bpe"](spark, data)
    assert got.dtypes == [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_encode_awkward(spark):
    clashing = awkward(spark).withColumn("ids", F.lit("clash")).withColumn("bytes", F.lit(1))
    encoded = bpe.encode(clashing, RANKS, public_tokenizers.PATTERN)
    got = [(r["doc_id"], bytes(r["bytes"])) for r in bpe.decode(encoded, RANKS).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(got, key=key) == sorted(((r[0], (r[1] or "").encode()) for r in awkward_rows()), key=key)
    assert bpe.decode(bpe.encode(empty(spark), RANKS, public_tokenizers.PATTERN), RANKS).collect() == []


def brute_phrases(rows, longest, least, keep, share):
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = [w for w in re.split("[ \t]+", piece) if w]
            total[lang] += len(words)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, c in counts.items():
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        held = Counter()
        for q, b in found.items():
            for m in range(2, len(q)):
                for i in range(len(q) - m + 1):
                    held[q[i : i + m]] = max(held[q[i : i + m]], b)
        rows = []
        for p, a in found.items():
            if held[p] and 100 * held[p] >= share * a:
                continue
            score, k = min((1000 * a * total[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(rows)[:keep], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def text_rows():
    rng = random.Random(3)
    words = ["a", "b", "c", "E", "é", "漢", "w1"]
    gaps = [" "] * 8 + [". ", ",", "\n", "\t", "  ", "\x0b"]
    rows = [(rng.choice(["en", "de", None]), "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randint(0, 120))))
            for _ in range(150)]
    return rows + [("en", None), ("fr", ""), ("en", "x\0y x\0y " * 50), ("en", " ".join(["b a"] * 3000))]


@pytest.mark.parametrize("longest,least,keep,share", [(5, 15, 40, 100), (3, 40, 2000, 80)])
def test_phrases_against_brute_force(spark, monkeypatch, longest, least, keep, share):
    # Small bounds: texts are cut into runs, and candidates take several tries.
    monkeypatch.setattr(phrases, "RUN_BYTES", 500)
    monkeypatch.setattr(phrases, "TRIE_PHRASES", 100)
    df = spark.createDataFrame(text_rows(), "lang string, text string").repartition(4)
    got = phrases.collocations(df, longest, least, keep, share).collect()
    assert sorted(map(tuple, got)) == brute_phrases(text_rows(), longest, least, keep, share)


def test_only_frequent_phrases_are_counted_by_tries(spark, monkeypatch):
    rng = random.Random(5)
    rows = [("en", " ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(400)) + " very often" * 3) for _ in range(6)]
    held, passes = [], []
    build, summed = phrases.DoubleArray.build, phrases._summed
    monkeypatch.setattr(phrases.DoubleArray, "build", lambda rows: held.append(len(rows)) or build(rows))
    monkeypatch.setattr(phrases, "_summed", lambda *a: passes.append(a[2]) or summed(*a))
    monkeypatch.setattr(phrases, "buckets_for", lambda words: 64)  # each bucket is full
    monkeypatch.setattr(phrases, "TRIE_PHRASES", 20)
    got = phrases.collocations(spark.createDataFrame(rows, "lang string, text string").repartition(3), 2, 9, 2000, 101).collect()
    assert sorted(map(tuple, got)) == brute_phrases(rows, 2, 9, 2000, 101)
    assert sum(held) == len(got) < 100
    # The frequent words, the buckets of pairs, and tries in turns of some.
    assert len(passes) == 2 + -(-(-(-len(got) // 20)) // phrases.TRIES_AT_ONCE)


def test_counted_phrases_are_not_broadcast(spark):
    found = phrases.collocations(spark.createDataFrame(text_rows(), "lang string, text string"), 3, 15)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and not re.search(r"BroadcastExchange.*array<bigint>", plan)


def test_phrases_awkward(spark):
    clashing = awkward(spark).withColumn("words", F.lit("clash")).withColumn("key", F.lit(1)).withColumn("a", F.lit(1))
    rows = [(r[2], r[1]) for r in awkward_rows()]
    assert sorted(map(tuple, phrases.collocations(clashing, least=4).collect())) == brute_phrases(rows, 5, 4, 2000, 100)
    assert phrases.collocations(empty(spark)).collect() == []


def test_double_array_counts():
    rng = np.random.default_rng(4)
    keys = np.sort(rng.choice(2 ** 62, 60, replace=False)).astype(np.uint64)
    codes = rng.integers(-1, 60, 20_000).astype(np.int32)
    held = np.unique(rng.integers(0, 60, (900, 3)), axis=0)
    trie = phrases.DoubleArray.build(keys[held])
    places = {tuple(p): i for i, p in enumerate(held.tolist())}
    want = np.zeros(len(held), dtype=int)
    for i in range(len(codes) - 2):
        at = places.get(tuple(codes[i : i + 3].tolist()))
        if at is not None:
            want[at] += 1
    assert trie.count(keys, codes).tolist() == want.tolist()
    assert trie.count(np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int32)).sum() == 0
