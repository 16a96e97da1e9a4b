"""Phrases that stand together more often than their parts would: Apriori levels counted by double-array tries.

Texts are split once, into runs with a small dictionary of their own, and stored. Level by level, the phrases seen
whose two shorter parts are frequent and whose hash bucket is full enough (an upper bound of their count, so none is
lost) are sent with how often a task met them, and those that add up to enough are candidates, however full the buckets are.
They go into double-array tries of bounded size that all tasks get, some at a time; numpy moves the
states of all text positions at once, one word at a time, and counts the accepting states; tasks' counts are summed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm import words as W
from millrace.llm.common import whole
from millrace.session import cut_lineage, scratch_path

BLOCK = 1 << 14  # counters that are summed in one group
RUN_BYTES = 4 << 20  # text that is split at once
MOST_HELD = 500_000  # different phrases that a task holds before it gives them out
TRIE_PHRASES = 250_000  # phrases of one trie
TRIES_AT_ONCE = 4  # tries that one pass over the runs counts
_STOPS = b".,;:!?\n\x0b\x0c\r"
# Lower case for A-Z, one mark for all that ends a piece, one for all that ends a word.
_PLAIN = bytes(
    10 if b in _STOPS else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))


def _runs(texts: list[bytes]) -> Iterator[bytes]:
    """Texts in one piece each, put together or cut where a piece ends, to some megabytes."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text) + 1
        if size < RUN_BYTES:
            continue
        data, begin = b"\n".join(held).translate(_PLAIN), 0
        while begin < len(data):
            end = data.find(b"\n", begin + RUN_BYTES)
            end = len(data) if end < 0 else end
            yield data[begin:end]
            begin = end + 1
        held, size = [], 0
    if held:
        yield b"\n".join(held).translate(_PLAIN)


def _split(seed: int):
    """Texts by language in; runs out: language, different words, how often each, their keys, and words by number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in W.pieces(batch.column(1), 2 * RUN_BYTES, batch.num_rows):
                part = batch.slice(start, stop - start)
                of_lang: dict[str, list[bytes]] = {}
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    of_lang.setdefault(lang, []).append(text.encode())
                for lang in list(of_lang):
                    for data in _runs(of_lang.pop(lang)):
                        yield coded(lang, data)

    def coded(lang: str, data: bytes) -> pa.RecordBatch:
        tokens = data.replace(b"\n", b" \n ").split(b" ")
        place = dict.fromkeys(tokens)
        # Neither the mark between pieces nor the nothing between two blanks is a word.
        words = [w for w in place if w and w != b"\n"]
        place.update(zip(words, range(len(words)), strict=True))
        place[b"\n"], place[b""] = -1, -2
        code = np.fromiter(map(place.__getitem__, tokens), dtype=np.int32, count=len(tokens))
        code = code[code > -2]
        counts = np.bincount(code + 1, minlength=len(words) + 1)[1:]
        prefix = lang.encode() + b"\0"
        keys = np.array([xxhash.xxh64_intdigest(prefix + w, seed) for w in words], dtype=np.uint64)
        return pa.RecordBatch.from_arrays([
            pa.array([lang]), pa.array([[w.decode() for w in words]], pa.list_(pa.string())),
            pa.array([counts], pa.list_(pa.int64())), pa.array([keys.view(np.int64)], pa.list_(pa.int64())),
            pa.array([code.astype("<i4").tobytes()], pa.binary()),
        ], names=["lang", "words", "counts", "keys", "codes"])

    return run


def _lists(column: pa.Array) -> Iterator[np.ndarray]:
    """The numbers of each list."""
    begin, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    return (values[a:b] for a, b in zip(begin[:-1], begin[1:], strict=True))


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each run the keys of its words, and the word at each place by number, -1 between pieces."""
    for batch in batches:
        for keys, codes in zip(_lists(batch.column(0)), batch.column(1).to_pylist(), strict=True):
            yield keys.view(np.uint64), np.frombuffer(codes, dtype="<i4")


def _keys_of(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The key of the word at each place of a run, 0 between pieces."""
    for keys, codes in _coded(batches):
        yield np.append(keys, np.uint64(0))[codes]


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return (h >> np.uint64(65 - buckets.bit_length())).astype(np.int64)


def buckets_for(words: int) -> int:
    """A power of two near a sixteenth of all words, between 2^18 and 2^23."""
    return 1 << min(max((words // 16).bit_length(), 18), 23)


def _longer(h: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Hash of a phrase from the hash of all but its last word, and that word's key."""
    return W.mix(h * W.BASE + key)


def _able(keys: np.ndarray, size: int, frequent: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Where phrases of ``size`` words begin whose two parts of one word less are frequent, and their hashes."""
    at, h = np.flatnonzero(keys), keys[keys != 0]
    for k in range(1, size):
        on = frequent[k - 1][_bucket(h, len(frequent[k - 1]))]
        at, h = at[on], h[on]
        # The rest of the phrase begins one word later and has to be there too.
        both = np.flatnonzero(np.diff(at) == 1)
        at, h = at[both], h[both]
        h = _longer(h, keys[at + k])
    return at, h


def _summed(
    df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[np.ndarray, np.ndarray]]], counters: int,
    most: int | None = None,
) -> np.ndarray:
    """Sums of counters over all rows; ``work`` gives places and what to add there.

    Each task adds up one vector, whose blocks are summed over the tasks, in two steps where there are many. Beyond ``most`` (255 or
    less) sums need not be exact, so one byte each is sent.
    """
    kind = np.int64 if most is None else np.uint8
    limit = np.iinfo(kind).max
    spare = -counters % BLOCK

    def packed(block: np.ndarray) -> bytes:
        return pa.compress(np.minimum(block, limit).astype(kind).tobytes(), "zstd", asbytes=True)

    def opened(block: bytes) -> np.ndarray:
        return np.frombuffer(pa.decompress(block, BLOCK * np.dtype(kind).itemsize, "zstd", asbytes=True), dtype=kind)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(counters + spare, dtype=np.int64 if most is None else np.int32)
        for at, n in work(batches):
            total[at] += n.astype(total.dtype)
        rows = [(i, packed(part)) for i, part in enumerate(total.reshape(-1, BLOCK)) if part.any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=["block", "counts"])

    def add(rows: pa.Table) -> pa.Table:
        total = np.zeros(BLOCK, dtype=np.int64)
        for c in rows.column("counts").to_pylist():
            total += opened(c)
        return pa.table({"block": rows.column("block").slice(0, 1), "counts": pa.array([packed(total)], pa.binary())})

    schema = "block long, counts binary"
    sums, tasks = df.mapInArrow(count, schema), df.rdd.getNumPartitions()
    if tasks > 256:
        sums = sums.withColumn("some", F.spark_partition_id() % F.lit(tasks // 256)).groupBy("block", "some").applyInArrow(add, schema)
    out = np.zeros(counters + spare, dtype=kind)
    for block, counts in sums.groupBy("block").applyInArrow(add, schema).collect():  # counters / BLOCK rows, in one job
        out[block * BLOCK : (block + 1) * BLOCK] = opened(counts)
    return out[:counters]


def _rows_of_keys(column: pa.Array) -> np.ndarray:
    """Phrases of one length as rows of keys."""
    return column.flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(len(column), -1 if len(column) else 1)


def _hashes_of(rows: np.ndarray) -> np.ndarray:
    """Hashes of phrases, given as rows of keys."""
    h = rows[:, 0]
    for k in range(1, rows.shape[1]):
        h = _longer(h, rows[:, k])
    return h


def _phrase_column(rows: np.ndarray) -> pa.Array:
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(rows).view(np.int64).ravel()))


def _distinct(h: np.ndarray, rows: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different phrases in the order of their hashes, and sums of ``n``. (Of two that share a hash one may come twice.)"""
    order = np.argsort(h, kind="stable")
    h, rows, n = h[order], rows[order], n[order]
    new = np.flatnonzero(np.concatenate([np.ones(min(len(h), 1), dtype=bool), (rows[1:] != rows[:-1]).any(1)]))
    return h[new], rows[new], np.add.reduceat(n, new) if len(new) else n


def _seen(size: int, frequent, full, blocks: int):
    """The different phrases of ``size`` words of a task that may be frequent and how often each, packed by ranges of their hashes."""

    def packed(h: np.ndarray, rows: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        block = (h >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)
        begin = np.flatnonzero(np.concatenate([np.ones(min(len(h), 1), dtype=bool), block[1:] != block[:-1]]))
        ranges = list(zip(begin, [*begin[1:], len(h)], strict=False))
        parts = [rows[a:b].astype("<u8").tobytes() for a, b in ranges]
        times = [pa.compress(n[a:b].astype("<i8").tobytes(), "zstd", asbytes=True) for a, b in ranges]
        return pa.RecordBatch.from_arrays(
            [pa.array(block[begin].astype(np.int64)), pa.array(parts, pa.binary()), pa.array(times, pa.binary())],
            names=["block", "phrases", "times"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, dtype=np.uint64), np.zeros((0, size), dtype=np.uint64), np.zeros(0, dtype=np.int64)
        held = none
        for keys in _keys_of(batches):
            at, h = _able(keys, size, frequent.value)
            on = full.value[_bucket(h, len(full.value))]
            found = _distinct(h[on], keys[at[on][:, None] + np.arange(size)], np.ones(np.count_nonzero(on), dtype=np.int64))
            held = _distinct(*map(np.concatenate, zip(held, found, strict=True)))
            if len(held[0]) >= MOST_HELD:
                yield packed(*held)
                held = none
        if len(held[0]):
            yield packed(*held)

    return run


def _united(size: int, least: int):
    """The different phrases of one range of hashes that tasks met ``least`` times or more together."""

    def run(rows: pa.Table) -> pa.Table:
        parts = rows.column("phrases").to_pylist()
        keys = np.frombuffer(b"".join(parts), dtype="<u8").reshape(-1, size)
        n = np.concatenate([
            np.frombuffer(pa.decompress(t, len(p) // size, "zstd", asbytes=True), dtype="<i8")
            for t, p in zip(rows.column("times").to_pylist(), parts, strict=True)])
        order = np.lexsort(keys.T)
        keys, n = keys[order], n[order]
        new = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(1)]))
        return pa.table({"phrase": _phrase_column(keys[new[np.add.reduceat(n, new) >= least]])})

    return run


def _more(base: np.ndarray, check: np.ndarray, accept: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The arrays with ``n`` more unused states."""
    unused = np.full(n, -1, dtype=np.int64)
    return np.append(base, np.zeros(n, dtype=np.int64)), np.append(check, unused), np.append(accept, unused)


@dataclass
class DoubleArray:
    """A trie of phrases in two arrays: from state s, symbol c leads to base[s] + c if check there is s.

    ``symbols`` are the words' keys in order; symbol 0 stands for all other words. ``accept`` is the phrase's number.
    """

    symbols: np.ndarray
    base: np.ndarray
    check: np.ndarray
    accept: np.ndarray
    size: int
    phrases: int

    @classmethod
    def build(cls, phrases: np.ndarray) -> DoubleArray:
        """From rows of keys, all different and of one length."""
        number, size = phrases.shape
        symbols, codes = np.unique(phrases, return_inverse=True)
        codes = codes.reshape(phrases.shape).astype(np.int64) + 1
        order = np.lexsort(codes.T[::-1])
        codes = codes[order]
        room = 2 * (number * size + len(symbols)) + 512
        base, check, accept = np.zeros(room, dtype=np.int64), np.full(room, -1, dtype=np.int64), np.full(room, -1, dtype=np.int64)
        check[0] = 0
        node = np.zeros(number, dtype=np.int64)  # state of each phrase's first words
        top, tries = 1, np.arange(256)
        for level in range(size):
            code = codes[:, level]
            new = np.ones(number, dtype=bool)
            new[1:] = (node[1:] != node[:-1]) | (code[1:] != code[:-1])
            first = np.flatnonzero(new)  # one phrase for each child
            parent, child = node[first], code[first]
            begin = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]]))
            end = np.append(begin[1:], len(parent))
            place = np.zeros(len(first), dtype=np.int64)
            children = end - begin
            several = np.flatnonzero(children > 1)
            start = 0
            for i in several[np.argsort(-children[several], kind="stable")]:  # most children first
                a, b = begin[i], end[i]
                c = child[a:b]
                while True:
                    if start + 256 + int(c[-1]) >= len(check):
                        base, check, accept = _more(base, check, accept, len(check))
                    free = (check[start + tries[:, None] + c] < 0).all(1)
                    at = int(free.argmax())
                    if free[at]:
                        break
                    start += 256  # fewer children fit at least as well from here on
                base[parent[a]] = start + at
                place[a:b] = start + at + c
                check[place[a:b]] = parent[a]
            # Single children take the states that are left.
            single = begin[children == 1]
            low = len(symbols) + 1
            left = low + np.flatnonzero(check[low:] < 0)
            if len(left) < len(single):
                more = len(single) + len(check)
                left = np.concatenate([left, np.arange(len(check), more)])
                base, check, accept = _more(base, check, accept, len(single))
            at = left[: len(single)]
            base[parent[single]] = at - child[single]
            place[single], check[at] = at, parent[single]
            top = max(top, int(place.max()))
            node = place[np.cumsum(new) - 1]
        accept[node] = order
        # A base may lie anywhere up to the last state.
        stop = top + len(symbols) + 2
        base, check, accept = (x[:stop].astype(np.int32) for x in _more(base, check, accept, max(0, stop - len(check))))
        return cls(symbols, base, check, accept, size, number)

    def count(self, keys: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """How often each phrase begins at the places of a run (``codes`` are places in ``keys``, -1 between pieces)."""
        at = np.minimum(np.searchsorted(self.symbols, keys), len(self.symbols) - 1)
        lut = np.append(np.where(self.symbols[at] == keys, at + 1, 0), 0)
        symbol = lut[codes].astype(np.int32)
        place = np.flatnonzero(symbol)
        state = np.zeros(len(place), dtype=np.int32)
        for level in range(self.size):
            inside = place < len(symbol) - level
            place, state = place[inside], state[inside]
            c = symbol[place + level]
            to = self.base[state] + c
            on = (c > 0) & (self.check[to] == state)
            place, state = place[on], to[on]
        return np.bincount(self.accept[state], minlength=self.phrases)


def _frequent_of_size(
    spark: SparkSession, runs: DataFrame, size: int, least: int, frequent: list[np.ndarray], buckets: int, blocks: int,
) -> tuple[DataFrame, np.ndarray]:
    """Phrases of ``size`` words with their counts, those of ``least`` occurrences at least, and the buckets of their hashes."""
    spread = runs.select("keys", "codes")
    shared = spark.sparkContext.broadcast(frequent)

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for keys in _keys_of(batches):
            yield np.unique(_bucket(_able(keys, size, shared.value)[1], buckets), return_counts=True)

    # A bucket counts its phrases together, so a phrase in an emptier one is not frequent.
    full = spark.sparkContext.broadcast(_summed(spread, hashes, buckets, least if least <= 255 else None) >= least)
    seen = spread.mapInArrow(_seen(size, shared, full, blocks), "block long, phrases binary, times binary")
    candidates = cut_lineage(seen.groupBy("block").applyInArrow(_united(size, least), "phrase array<long>"), "phrases-seen")
    tries = -(-candidates.count() // TRIE_PHRASES)
    schema = "phrase array<long>, a long"
    path = scratch_path(spark, "phrases")
    of_size, found = np.zeros(buckets, dtype=bool), False
    for start in range(0, tries, TRIES_AT_ONCE):
        parts = []
        for i in range(start, min(start + TRIES_AT_ONCE, tries)):
            held = candidates.filter(F.pmod(F.xxhash64("phrase"), F.lit(tries)) == i).toArrow().column("phrase").combine_chunks()
            if len(held):
                parts.append(_rows_of_keys(held))
        if not parts:
            continue
        rows = np.concatenate(parts)
        built = spark.sparkContext.broadcast([DoubleArray.build(part) for part in parts])

        def accepted(batches: Iterator[pa.RecordBatch], built=built) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for keys, codes in _coded(batches):
                begin = 0
                for trie in built.value:
                    n = trie.count(keys, codes)
                    at = np.flatnonzero(n)
                    yield begin + at, n[at]
                    begin += trie.phrases

        total = _summed(spread, accepted, len(rows))
        on = total >= least
        if on.any():
            found = True
            of_size[_bucket(_hashes_of(rows[on]), buckets)] = True
            spark.createDataFrame(pa.table({"phrase": _phrase_column(rows[on]), "a": total[on]})).write.mode("append").parquet(path)
        built.destroy()
    shared.destroy()
    full.destroy()
    return (spark.read.schema(schema).parquet(path) if found else spark.createDataFrame([], schema)), of_size


def _word_table(docs: DataFrame, lang_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Stored runs of texts, and stored words (lang, word, key, n) whose keys are all different."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), whole(text_col).alias("text"))
    for seed in range(1000):
        schema = "lang string, words array<string>, counts array<long>, keys array<long>, codes binary"
        path = scratch_path(docs.sparkSession, "runs")
        # Rows of megabytes: few to a file, as a file's rows are read together.
        rows.mapInArrow(_split(seed), schema).write.option("maxRecordsPerFile", 16).parquet(path)
        runs = docs.sparkSession.read.schema(schema).parquet(path)
        word = F.explode(F.arrays_zip("words", "counts", "keys"))
        words = runs.select("lang", word.alias("w")).select("lang", "w.words", "w.counts", "w.keys")
        words = words.groupBy("lang", F.col("words").alias("word"), F.col("keys").alias("key")).agg(F.sum("counts").alias("n"))
        words = cut_lineage(words, "words")
        if words.groupBy("key").count().filter("count > 1").isEmpty() and words.filter("key = 0").isEmpty():
            return runs, words
    raise RuntimeError("no seed gives all words keys of their own")


def collocations(
    docs: DataFrame, longest: int = 5, least: int = 100, keep: int = 2000, share: int = 100,
    lang_col: str = "lang", text_col: str = "text",
) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts, with A-Z in lower case, are split at ``. , ; : ! ?`` and line ends into pieces, and those at blanks and tabs into words.
    A phrase is 2 to ``longest`` words in a row inside a piece, counted with overlaps; one with ``least``
    occurrences is a candidate. Cut after its first words it gives l and r, the counts of the two parts, and the score
    floor(1000 * a * n / (l * r)) with n, all words of the language; the lowest counts, of equal ones that
    with fewer words before the cut. A candidate goes if a longer candidate holds it and 100 * its count >= ``share`` * a.
    The first ``keep`` of each language come back by score, count (both falling) and phrase.

    Memory is bounded: buckets, tries and runs have a largest size. Beyond some 10^8 words buckets fill up, so more phrases are
    sent with their counts, up to all whose parts are frequent; tries hold only those that add up to ``least``.

    Null texts are empty, a null language is ``und``; empty texts have no words. Repeated rows count again, ids and other
    columns play no part, an empty table gives no rows. Words are told apart by 64-bit keys that are checked to be
    all different (else other keys are taken), so counts are exact. Long texts are cut where pieces end.
    """
    spark = docs.sparkSession
    runs, words = _word_table(docs, lang_col, text_col)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    known = cut_lineage(
        words.filter(F.col("n") >= least).select(F.array("key").alias("phrase"), F.col("n").alias("a"), "lang", "word"), "frequent")
    all_words = sum(r["n"] for r in totals.collect())  # one row a language
    buckets = buckets_for(all_words)
    blocks = max(64, buckets >> 12, all_words >> 18)

    def word_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for batch in batches:
            yield np.unique(_bucket(_hashes_of(_rows_of_keys(batch.column(0))), buckets), return_counts=True)

    levels = [known.select("phrase", "a")]
    frequent = [_summed(known.select("phrase"), word_hashes, buckets, 1) > 0]
    for size in range(2, longest + 1):
        found, of_size = _frequent_of_size(spark, runs, size, least, frequent, buckets, blocks)
        if not of_size.any():
            break
        levels.append(found)
        frequent.append(of_size)
    counts = levels[0]
    for level in levels[1:]:
        counts = counts.unionByName(level)
    candidates = counts.filter(F.size("phrase") > 1)
    # All cuts of each candidate; the parts are counted phrases themselves.
    cut = candidates.select("phrase", "a", F.explode(F.sequence(F.lit(1), F.size("phrase") - 1)).alias("k"))
    cut = cut.select(
        "phrase", "a", "k", F.expr("slice(phrase, 1, k)").alias("first"), F.expr("slice(phrase, k + 1, size(phrase) - k)").alias("rest"))
    # Files of phrases are far smaller than their rows, so Spark would broadcast more than the driver may hold.
    cut = cut.join(counts.select(F.col("phrase").alias("first"), F.col("a").alias("l")).hint("shuffle_merge"), "first")
    cut = cut.join(counts.select(F.col("phrase").alias("rest"), F.col("a").alias("r")).hint("shuffle_merge"), "rest")
    named = candidates.select("phrase", F.posexplode("phrase").alias("place", "key"))
    named = named.join(known.select(F.col("phrase")[0].alias("key"), "lang", "word"), "key").groupBy("phrase").agg(
        F.first("lang").alias("lang"),
        F.concat_ws(" ", F.transform(F.array_sort(F.collect_list(F.struct("place", "word"))), lambda w: w["word"])).alias("words"))
    cut = cut.join(named.hint("shuffle_merge"), "phrase").join(totals, "lang")
    wide = {c: F.col(c).cast("decimal(38,0)") for c in ("a", "n", "l", "r")}
    cut = cut.withColumns({"over": wide["a"] * wide["n"] * 1000, "under": wide["l"] * wide["r"]})
    cut = cut.withColumn("score", F.expr("over div under"))
    best = cut.groupBy("lang", "phrase", "words", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # The largest count of a longer candidate around each phrase.
    size = F.size("phrase")
    around = candidates.filter(size > 2).select("phrase", "a", F.explode(F.sequence(F.lit(2), size - 1)).alias("m"))
    around = around.select("phrase", "a", "m", F.explode(F.expr("sequence(1, size(phrase) - m + 1)")).alias("s"))
    around = around.groupBy(F.expr("slice(phrase, s, m)").alias("phrase")).agg(F.max("a").alias("held"))
    left = best.join(around.hint("shuffle_merge"), "phrase", "left").filter(F.expr(f"held is null or 100 * held < {int(share)} * a"))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "words")
    ranked = left.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= keep)
    return ranked.select(
        "lang", "rank", F.col("words").alias("phrase"), "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n",
        F.col("cut.score").alias("score"))
