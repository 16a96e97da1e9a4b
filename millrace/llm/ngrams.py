"""Stupid-backoff scores of all texts under n-gram counts of the other texts.

Counts of n-grams of each order stand in tables that are partitioned by the n-gram's hash. Texts are stored in
chunks; each chunk counts its n-grams, sends the counts to the tables, and gets back the totals of those that
other chunks have too. Then each text is scored with its own counts taken off, so that it does not
vouch for itself.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import words as W
from millrace.llm.common import tasks_for, whole
from millrace.session import cut_lineage

PIECE_BYTES = 1 << 20  # text whose words are worked on at once, at about 100 bytes a byte
_BYTE = 255  # most that one entry counts; larger counts take several entries


def _squeezed(planes: np.ndarray) -> list[bytes]:
    """Each row of bytes compressed by itself, with its length before it."""
    packed = [pa.compress(p.tobytes(), codec="zstd", asbytes=True) for p in planes]
    return [x for blob in packed for x in (np.uint32(len(blob)).tobytes(), blob)]


def _unsqueezed(blob: bytes, at: int, rows: int, n: int) -> Iterator[np.ndarray]:
    for _ in range(rows):
        size = int.from_bytes(blob[at : at + 4], "little")
        yield np.frombuffer(pa.decompress(blob[at + 4 : at + 4 + size], decompressed_size=n, codec="zstd"), dtype=np.uint8)
        at += 4 + size


def pack_keys(keys: np.ndarray) -> bytes:
    """Rising keys of up to 64 bits: the first, then differences of as many bytes as the largest needs.

    Low bytes of differences are noise and stay as they are. The two highest are mostly small: all of
    one place stand together, compressed.
    """
    if not len(keys):
        return b""
    keys = keys.astype("<u8")
    step = np.diff(keys)
    width = max(-(-int(step.max()).bit_length() // 8), 1) if len(step) else 1
    step, low = step.view(np.uint8).reshape(-1, 8), max(width - 2, 0)
    head = bytes([width]) + keys[:1].tobytes() + np.uint32(len(step)).tobytes()
    return b"".join([head, step[:, :low].tobytes(), *_squeezed(step[:, low:width].T)])


def unpack_keys(blob: bytes) -> np.ndarray:
    if not blob:
        return np.zeros(0, dtype=np.uint64)
    width, n = blob[0], int.from_bytes(blob[9:13], "little")
    low = max(width - 2, 0)
    wide = np.zeros((n + 1, 8), dtype=np.uint8)
    wide[0] = np.frombuffer(blob, dtype=np.uint8, count=8, offset=1)
    wide[1:, :low] = np.frombuffer(blob, dtype=np.uint8, count=n * low, offset=13).reshape(n, low)
    for place, plane in enumerate(_unsqueezed(blob, 13 + n * low, width - low, n), low):
        wide[1:, place] = plane
    return np.cumsum(wide.view("<u8").reshape(-1), dtype=np.uint64)


def pack_numbers(numbers: np.ndarray) -> bytes:
    """Numbers of a stated type, none below 0 and most of them small, byte by byte as in ``pack_keys``."""
    if not len(numbers):
        return b""
    width = max(-(-int(numbers.max()).bit_length() // 8), 1)
    planes = np.ascontiguousarray(numbers).view(np.uint8).reshape(len(numbers), -1)[:, :width].T
    return b"".join([bytes([width]), np.uint32(len(numbers)).tobytes(), *_squeezed(planes)])


def unpack_numbers(blob: bytes, dtype: type) -> np.ndarray:
    if not blob:
        return np.zeros(0, dtype=dtype)
    n = int.from_bytes(blob[1:5], "little")
    wide = np.zeros((n, np.dtype(dtype).itemsize), dtype=np.uint8)
    for place, plane in enumerate(_unsqueezed(blob, 5, blob[0], n)):
        wide[:, place] = plane
    return wide.view(dtype).reshape(-1)


def _grams(text: pa.Array, order: int) -> tuple[W.Words, list[tuple[np.ndarray, np.ndarray]]]:
    """Words of some texts, and for each order up to ``order`` the hashes of the runs and their first words."""
    w = W.split(text, in_word=~W.GAP, lower=True)
    hashes = w.hashes()
    # The order is part of the hash.
    return w, [(W.mix(h + np.uint64(n)), at) for n in range(1, order + 1) for h, at in [W.runs_of(w, hashes, n)]]


def _chunk_texts(chunk: pa.Table) -> tuple[pa.Table, pa.Array]:
    chunk = chunk.sort_by([("md5", "ascending"), ("doc_id", "ascending")])
    column = chunk.column("text").cast(pa.large_string()).combine_chunks()
    return chunk, column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _chunk_counts(chunk: pa.Table, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams of a chunk, in rising order, and their counts."""
    _, column = _chunk_texts(chunk)
    found = []
    for s, e in W.pieces(column, PIECE_BYTES):
        for h, _ in _grams(column.slice(s, e - s), order)[1]:
            found.append(h)
    flat = np.concatenate(found) if found else np.zeros(0, dtype=np.uint64)
    found.clear()
    flat.sort()
    first = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]])) if len(flat) else np.zeros(0, dtype=np.int64)
    return flat[first], np.diff(np.concatenate([first, [len(flat)]]))


def _begins(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Where each partition begins among rising hashes; no array as long as these is made."""
    least = [-(-(p << 32) // parts) << 32 for p in range(parts)]
    return np.searchsorted(hashes, np.array(least, dtype=np.uint64))


def _blobs(hashes: np.ndarray, parts: int, *columns: np.ndarray):
    """For each partition: its number, the packed hashes, and bytes of the columns."""
    cuts = np.append(_begins(hashes, parts), len(hashes)).tolist()
    for part, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        if a < b:
            yield part, pack_keys(hashes[a:b]), *(c[a:b].tobytes() for c in columns)


def _count_chunk(order: int, parts: int):
    schema = pa.schema([("part", pa.int64()), ("chunk", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])

    def run(chunk: pa.Table) -> pa.Table:
        hashes, count = _chunk_counts(chunk, order)
        # Full entries of large counts come before the last one; few have any.
        many = np.flatnonzero(count > _BYTE)
        full = np.repeat(many, (count[many] - 1) // _BYTE)
        small = ((count - 1) % _BYTE + 1).astype(np.uint8)
        del count
        small, hashes = np.insert(small, full, _BYTE), np.insert(hashes, full, hashes[full])
        number = chunk.column("chunk")[0].as_py()
        rows = [(part, number, keys, counts) for part, keys, counts in _blobs(hashes, parts, small)]
        return pa.table([list(c) for c in zip(*rows, strict=True)] if rows else [[] for _ in schema], schema=schema)

    return run


def _count_packed(order: int, parts: int):
    """``_count_chunk`` with the counts compressed."""
    counted = _count_chunk(order, parts)

    def run(chunk: pa.Table) -> pa.Table:
        found = counted(chunk)
        counts = [pack_numbers(np.frombuffer(b, dtype=np.uint8)) for b in found.column("counts").to_pylist()]
        return found.set_column(found.schema.get_field_index("counts"), "counts", pa.array(counts, pa.binary()))

    return run


def _sum_table(rows: pa.Table) -> pa.Table:
    """One partition of the count tables: for each chunk the totals of its n-grams that others have too.

    ``keys`` of the result are places among the chunk's different hashes in this partition.
    """
    schema = pa.schema([("chunk", pa.int64()), ("part", pa.int64()), ("keys", pa.binary()), ("totals", pa.binary())])
    keys = [unpack_keys(b) for b in rows.column("keys").to_pylist()]
    counts = np.concatenate([np.frombuffer(b, dtype=np.uint8) for b in rows.column("counts").to_pylist()])
    owner = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
    place = np.concatenate([np.cumsum(np.diff(k, prepend=k[:1]) > 0) for k in keys])
    key = np.concatenate(keys)
    order = np.argsort(key, kind="stable")
    key, owner, place, counts = key[order], owner[order], place[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, dtype=np.int64)
    size = np.diff(np.concatenate([first, [len(key)]]))
    total = np.repeat(np.add.reduceat(counts.astype(np.int64), first), size)
    shared = np.repeat(np.minimum.reduceat(owner, first) != np.maximum.reduceat(owner, first), size)
    # A chunk with several entries for one n-gram gets the total once.
    shared &= np.concatenate([[True], (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])]) if len(key) else shared
    place, owner, total = place[shared], owner[shared], total[shared]
    order = np.argsort(owner, kind="stable")
    place, owner, total = place[order], owner[order], total[order]
    chunks, part = rows.column("chunk").to_pylist(), rows.column("part")[0].as_py()
    cuts = np.concatenate([[0], np.flatnonzero(owner[1:] != owner[:-1]) + 1, [len(owner)]]) if len(owner) else [0]
    out = [(chunks[owner[a]], part, pack_keys(place[a:b]), total[a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return pa.table([list(c) for c in zip(*out, strict=True)] if out else [[] for _ in schema], schema=schema)


def _sum_packed(rows: pa.Table) -> pa.Table:
    """``_sum_table`` on rows as they are sent: counts and totals packed."""
    counts = [unpack_numbers(b, np.uint8).tobytes() for b in rows.column("counts").to_pylist()]
    found = _sum_table(rows.set_column(rows.schema.get_field_index("counts"), "counts", pa.array(counts, pa.binary())))
    totals = [pack_numbers(np.frombuffer(b, dtype=np.int64)) for b in found.column("totals").to_pylist()]
    return found.set_column(found.schema.get_field_index("totals"), "totals", pa.array(totals, pa.binary()))


def _own_counts(text: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """How often the n-gram of each event is in its own text."""
    keyed = W.mix(hashes + text.astype(np.uint64) * W.BASE)
    _, at, count = np.unique(keyed, return_inverse=True, return_counts=True)
    return count[at]


def _score_chunk(order: int, parts: int, backoff: float, total_words: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("log_score", pa.float64()), ("n_backed_off", pa.int64())])

    def run(chunk: pa.Table, shared: pa.Table) -> pa.Table:
        if not chunk.num_rows:
            return schema.empty_table()
        known, count = _chunk_counts(chunk, order)
        if shared.num_rows:
            begin = _begins(known, parts)
            at = np.concatenate([
                begin[p] + unpack_keys(k).astype(np.int64)
                for p, k in zip(shared.column("part").to_pylist(), shared.column("keys").to_pylist(), strict=True)])
            totals = np.concatenate([unpack_numbers(b, np.int64) for b in shared.column("totals").to_pylist()])
            count[at] = totals
        chunk, column = _chunk_texts(chunk)
        scores, backed, number = [], [], []
        for s, e in W.pieces(column, PIECE_BYTES):
            w, grams = _grams(column.slice(s, e - s), order)
            # Counts of the other texts, for the run of each order that begins at each word (0: there is none).
            others = np.zeros((order + 1, len(w.start) + order), dtype=np.float64)
            for n, (h, at) in enumerate(grams, 1):
                others[n, at] = count[np.searchsorted(known, h)] - _own_counts(w.text[at], h)
            own_words = w.per_text()[w.text]
            words = np.arange(len(w.start))
            place = words - np.searchsorted(w.text, w.text, side="left")
            # Lowest order first; each higher order takes over where it was seen.
            rest = np.maximum(total_words - own_words, 1)
            unseen = backoff ** order / (rest + 1.0)
            seen = others[1][: len(words)] > 0
            score = np.where(seen, others[1][: len(words)] / rest, unseen / backoff ** (order - 1))
            used = np.ones(len(words), dtype=np.int64)
            most = np.minimum(place + 1, order)
            score = score * backoff ** (most - 1)
            for n in range(2, order + 1):
                start = words - (n - 1)
                able = place >= n - 1
                start = np.where(able, start, 0)
                context = others[n - 1][start]
                full = others[n][start]
                hit = able & (full > 0)
                score = np.where(hit, backoff ** (most - n) * full / np.maximum(context, 1), score)
                used = np.where(hit, n, used)
            scores.append(np.bincount(w.text, np.log(score), w.texts))
            backed.append(np.bincount(w.text, used < most, w.texts).astype(np.int64))
            number.append(w.per_text())
        return pa.table([chunk.column("doc_id"), np.concatenate(number), np.concatenate(scores), np.concatenate(backed)], schema=schema)

    return run


def backoff_scores(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = 3, backoff: float = 0.4,
    chunk_bytes: int = 12 << 20,
) -> DataFrame:
    """One row for each text: doc_id, n_words, log_score, n_backed_off, mean_log_score.

    Words are runs of other characters than the six white-space characters, with A-Z in lower case. A word's score is
    count(n-gram) / count(its first n-1 words) for the longest n-gram up to ``order`` that ends in the
    word and that other texts hold too, times ``backoff`` for each word of context given up; a word
    that no other text holds counts as less than one in all words. ``log_score`` is the sum of the
    natural logs, ``n_backed_off`` the number of words that gave up context. Exact copies count as
    other texts. Texts without words (null, empty) have sums 0 and a null mean. Repeated rows are
    texts of their own; an empty table gives no rows.

    Every text is counted; n-grams are told apart by all 64 bits of their hash.
    A chunk sends an n-gram once, however often it has it, so frequent ones make no hot partition.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole(text_col).alias("text")).withColumn("md5", F.md5("text"))
    total = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    chunks, parts = tasks_for(spark, total, chunk_bytes), max(64, tasks_for(spark, total, chunk_bytes))
    table = f"ngram_texts_{uuid.uuid4().hex[:12]}"
    (
        rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "md5"), F.lit(chunks))).repartition(chunks, "chunk")
        .write.option("compression", "zstd").bucketBy(chunks, "chunk").saveAsTable(table)
    )
    texts = spark.table(table)
    counted = texts.groupBy("chunk").applyInArrow(_count_packed(order, parts), "part long, chunk long, keys binary, counts binary")
    shared = counted.groupBy("part").applyInArrow(_sum_packed, "chunk long, part long, keys binary, totals binary")
    n_words = texts.agg(F.sum(F.size(F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")).cast("long"))).first()[0] or 0
    scored = texts.groupBy("chunk").cogroup(shared.groupBy("chunk")).applyInArrow(
        _score_chunk(order, parts, backoff, n_words), "doc_id long, n_words long, log_score double, n_backed_off long")
    scored = cut_lineage(scored, "ngram-scores")
    spark.sql(f"DROP TABLE {table}")
    return scored.withColumn("mean_log_score", F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")))
