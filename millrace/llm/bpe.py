"""Byte-level BPE encoding and decoding in two tiers.

A text is cut into pre-tokens by a pattern. The first tier looks all different pre-tokens of a run of texts up at once in a
minimal perfect hash over the vocabulary; what is in it is one token. The second tier merges the others: their bytes
form a linked list, a heap gives the pair of neighbours with the lowest rank, the leftmost first.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import words as W
from millrace.llm.common import whole

MOST_TOKENS = 2_000_000  # the vocabulary goes to every task
MOST_PIECE = 1 << 19  # pre-tokens of one text that are held at once
MOST_MEMO = 200_000  # merged pre-tokens that a task remembers, and as many older ones
_SPACE = 8  # hash slots of a level for each key left


def flat_bytes(items: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes in a row, and where each item begins (with the end of the last)."""
    ends = np.cumsum([0] + [len(i) for i in items], dtype=np.int64)
    return np.frombuffer(b"".join(items), dtype=np.uint8), ends


def take_runs(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each run, one run after the other."""
    before = np.cumsum(length) - length
    return np.repeat(start - before, length) + np.arange(int(length.sum()))


def hash_runs(data: np.ndarray, begin: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of each run of bytes between neighbouring begins."""
    length = np.diff(begin)
    out = np.full(len(length), np.uint64(seed), dtype=np.uint64) + length.astype(np.uint64)
    for i in range(int(length.max()) if len(length) else 0):  # byte by byte of all runs; bounded by the longest token
        on = np.flatnonzero(length > i)
        out[on] = W.mix(out[on] * W.BASE + data[begin[on] + i].astype(np.uint64))
    return out


@dataclass
class PerfectHash:
    """A minimal perfect hash: levels of bits, each for the keys that met another key on the levels before.

    A key's slot is the number of set bits before its own; n keys have the slots 0 to n - 1.
    """

    levels: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)

    @staticmethod
    def _place(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
        return (W.mix(hashes + np.uint64((level + 1) * int(W.BASE) & (1 << 64) - 1)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, hashes: np.ndarray) -> PerfectHash:
        out, left, slots = cls(), np.unique(hashes), 0
        if len(left) != len(hashes):
            raise ValueError("equal hashes have no perfect hash")
        while len(left):
            size = _SPACE * len(left)
            at = cls._place(left, len(out.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            out.levels.append((alone, slots + np.cumsum(alone, dtype=np.int32) - alone))
            slots += int(alone.sum())
            left = left[~alone[at]]
        return out

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for some of the hashes that are no key; others get some key's slot."""
        out = np.full(len(hashes), -1, dtype=np.int64)
        left = np.arange(len(hashes))
        for level, (taken, before) in enumerate(self.levels):
            at = self._place(hashes[left], level, len(taken))
            here = taken[at]
            out[left[here]] = before[at[here]]
            left = left[~here]
        return out


@dataclass
class Vocabulary:
    """Tokens by slot of the perfect hash (for encoding) and by id (for decoding)."""

    ranks: dict[bytes, int]
    seed: int
    hash: PerfectHash
    longest: int
    data: np.ndarray
    begin: np.ndarray
    id_at: np.ndarray
    id_data: np.ndarray
    id_begin: np.ndarray
    two: list[int]  # rank of each pair of bytes, -1 for none
    memo: dict[bytes, list[int]] = field(default_factory=dict)
    older: dict[bytes, list[int]] = field(default_factory=dict)

    @classmethod
    def build(cls, ranks: dict[bytes, int]) -> Vocabulary:
        if len(ranks) > MOST_TOKENS:
            raise ValueError(f"{len(ranks)} tokens are too many to give to every task")
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("a byte-level vocabulary has every single byte")
        tokens = sorted(ranks, key=ranks.get)
        data, begin = flat_bytes(tokens)
        seed = 1
        hashes = hash_runs(data, begin, seed)
        while len(np.unique(hashes)) < len(hashes):
            seed += 1
            hashes = hash_runs(data, begin, seed)
        perfect = PerfectHash.build(hashes)
        at = np.argsort(perfect.slots(hashes))
        by_slot, slot_begin = flat_bytes([tokens[i] for i in at])
        ids = np.array([ranks[t] for t in tokens], dtype=np.int64)
        by_id = [b""] * (int(ids[-1]) + 1)
        for token, i in ranks.items():
            by_id[i] = token
        id_data, id_begin = flat_bytes(by_id)
        two = [ranks.get(bytes([x, y]), -1) for x in range(256) for y in range(256)]
        return cls(ranks, seed, perfect, int(np.diff(begin).max()), by_slot, slot_begin, ids[at], id_data, id_begin, two)

    def whole_tokens(self, data: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """First tier: the id of each run of bytes that is a token as a whole, -1 for the others."""
        out = np.full(len(begin) - 1, -1, dtype=np.int64)
        length = np.diff(begin)
        able = np.flatnonzero(length <= self.longest)
        if not len(able):
            return out
        start, length = begin[:-1][able], length[able]
        packed = data[take_runs(start, length)]
        bounds = np.concatenate([[0], np.cumsum(length)])
        slot = self.hash.slots(hash_runs(packed, bounds, self.seed))
        # The slot's token has to be the same bytes.
        same = (slot >= 0) & (length > 0)
        same[same] = np.diff(self.begin)[slot[same]] == length[same]
        at, slot = np.flatnonzero(same), slot[same]
        if len(at):
            runs = length[at]
            equal = packed[take_runs(bounds[:-1][at], runs)] == self.data[take_runs(self.begin[slot], runs)]
            equal = np.logical_and.reduceat(equal, np.cumsum(runs) - runs)
            out[able[at[equal]]] = self.id_at[slot[equal]]
        return out

    def merged(self, piece: bytes) -> list[int]:
        """Second tier: merges neighbours, the pair of the lowest rank first and the leftmost of equal ones."""
        rank_of, n = self.ranks.get, len(piece)
        shift = n.bit_length()
        mask = (1 << shift) - 1
        after, before = list(range(1, n + 1)), list(range(-1, n))
        # Rank of the part that begins here merged with the next one; -1 for none, or where no part begins.
        pair = [self.two[x << 8 | y] for x, y in zip(piece, piece[1:])] + [-1]
        heap = [r << shift | i for i, r in enumerate(pair) if r >= 0]
        heapq.heapify(heap)
        while heap:
            key = heapq.heappop(heap)
            i = key & mask
            if pair[i] != key >> shift:
                continue  # one of the two has changed since
            middle = after[i]
            stop = after[i] = after[middle]
            pair[middle] = -1
            if stop < n:
                before[stop] = i
                r = pair[i] = rank_of(piece[i : after[stop]], -1)
                if r >= 0:
                    heapq.heappush(heap, r << shift | i)
            else:
                pair[i] = -1
            left = before[i]
            if left >= 0:
                r = pair[left] = rank_of(piece[left:stop], -1)
                if r >= 0:
                    heapq.heappush(heap, r << shift | left)
        out, i = [], 0
        while i < n:
            out.append(rank_of(piece[i : after[i]]))
            i = after[i]
        return out

    def encode(self, pre_tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pre-tokens in a row, and the number of ids of each pre-token."""
        if not pre_tokens:
            return np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
        place = {p: i for i, p in enumerate(dict.fromkeys(pre_tokens))}
        code = np.fromiter(map(place.__getitem__, pre_tokens), dtype=np.int64, count=len(pre_tokens))
        pieces = [p.encode() for p in place]
        known = self.whole_tokens(*flat_bytes(pieces))
        missing = np.flatnonzero(known < 0)
        parts = [self._remembered(pieces[i]) for i in missing]
        count = np.ones(len(pieces), dtype=np.int64)
        count[missing] = [len(p) for p in parts]
        start = np.cumsum(count) - count
        flat = np.empty(int(count.sum()), dtype=np.uint32)
        flat[start[known >= 0]] = known[known >= 0]
        flat[take_runs(start[missing], count[missing])] = list(chain.from_iterable(parts))
        return flat[take_runs(start[code], count[code])], count[code]

    def _remembered(self, piece: bytes) -> list[int]:
        got = self.memo.get(piece)
        if got is None:
            got = self.older.pop(piece, None)
            if got is None:
                got = self.merged(piece)
            if len(piece) <= 64:
                if len(self.memo) >= MOST_MEMO:  # what was not asked for since the last change goes
                    self.memo, self.older = {}, self.memo
                self.memo[piece] = got
        return got

    def decode(self, ids: np.ndarray) -> bytes:
        ids = ids.astype(np.int64)
        start = self.id_begin[ids]
        return self.id_data[take_runs(start, self.id_begin[ids + 1] - start)].tobytes()


def read_ranks(path: str) -> dict[bytes, int]:
    """A file of lines ``base64 rank``."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def _encoded(texts: list[str], pattern: regex.Pattern, vocabulary: Vocabulary) -> list[bytes]:
    """Little-endian ids of each text. Texts share look-ups; one with very many pre-tokens goes piece by piece."""
    out: list[list[bytes]] = [[] for _ in texts]
    held: list[str] = []
    owners: list[tuple[int, int]] = []

    def flush() -> None:
        ids, count = vocabulary.encode(held)
        ends = np.concatenate([[0], np.cumsum(count)])
        at = 0
        for text, number in owners:
            out[text].append(ids[ends[at] : ends[at + number]].astype("<u4").tobytes())
            at += number
        held.clear()
        owners.clear()

    for i, text in enumerate(texts):
        matches = (m.group() for m in pattern.finditer(text)) if len(text) > MOST_PIECE else iter(pattern.findall(text))
        while found := list(islice(matches, MOST_PIECE)):
            held.extend(found)
            owners.append((i, len(found)))
            if len(held) >= MOST_PIECE:
                flush()
    flush()
    return [b"".join(parts) for parts in out]


def _mapped(column: int, work: Callable[[pa.Array], pa.Array], out: str, keep: bool = False):
    """Rows with the first column, the worked one if ``keep``, and the result; some megabytes at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in _slices(batch.column(column)):
                part = batch.slice(start, stop - start)
                columns = {part.schema.names[i]: part.column(i) for i in ([0, column] if keep else [0])}
                yield pa.RecordBatch.from_pydict({**columns, out: work(part.column(column))})

    return run


def _slices(column: pa.Array, most_bytes: int = 6 << 20) -> Iterator[tuple[int, int]]:
    """Cuts a batch into runs of a few megabytes; a longer value is a run of its own."""
    ends = np.cumsum([0 if v is None else v for v in pc.binary_length(column).to_pylist()], dtype=np.int64)
    start = 0
    while start < len(column):
        done = ends[start - 1] if start else 0
        stop = max(int(np.searchsorted(ends, done + most_bytes, side="right")), start + 1)
        yield start, stop
        start = stop


def encode(
    docs: DataFrame, vocabulary: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row for each text: doc_id and ``ids``, its token ids as little-endian unsigned 32-bit integers in a row.

    Each match of ``pattern`` is encoded by itself; text between matches has no ids; there are no special tokens. Null
    and empty texts have no ids (an empty value). Rows are taken as they come: repeated rows and null ids stay, other
    columns play no part, an empty table gives no rows. Texts are whole, however long; memory holds the text
    and some 520,000 pre-tokens of it. The vocabulary (checked to be bounded) goes to the tasks once.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(Vocabulary.build(vocabulary))

    def work(column: pa.Array) -> pa.Array:
        return pa.array(_encoded(column.to_pylist(), regex.compile(pattern), shared.value), pa.binary())

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole(text_col).alias("text"))
    return rows.mapInArrow(_mapped(1, work, "ids"), "doc_id long, ids binary")


def decode(
    encoded: DataFrame, vocabulary: dict[bytes, int], id_col: str = "doc_id", ids_col: str = "ids", keep_ids: bool = False,
) -> DataFrame:
    """One row for each row: doc_id and ``bytes``, the bytes of its tokens in a row; null ids have no bytes.

    ``keep_ids`` adds the ids as they came. An id that the vocabulary lacks is an error.
    """
    spark = encoded.sparkSession
    shared = spark.sparkContext.broadcast(Vocabulary.build(vocabulary))

    def work(column: pa.Array) -> pa.Array:
        return pa.array([shared.value.decode(np.frombuffer(v or b"", dtype="<u4")) for v in column.to_pylist()], pa.binary())

    rows = encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(_mapped(1, work, "bytes", keep_ids), "doc_id long, " + "ids binary, " * keep_ids + "bytes binary")
