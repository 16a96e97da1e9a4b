"""Remove long strings that an earlier document has, by suffix sorting with a difference cover.

Sorting every suffix of all texts at once would write many times the input. So texts first meet at
synchronising positions: of the short hashes in each window of ``length`` bytes the least one is the
window's anchor, alike wherever the same bytes stand. Only windows whose anchor occurs in other texts go
on, to the partition of their anchor. There the suffixes of all such pieces are sorted by the
difference-cover algorithm (triples at two of three positions are sorted and named, the names are sorted in
the same way until all differ, the third part is sorted by its first symbol and the next rank and
merged), and neighbours with equal prefixes are compared. Equal strings have equal anchors, so none is missed.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import words as W
from millrace.llm.common import put_back, set_apart, tasks_for, whole
from millrace.session import cut_lineage

LENGTH, ANCHOR = 50, 20  # bytes of a repeated string; bytes of an anchor
NO_ID = (1 << 63) - 1  # stands for a null id, which is smaller than none
HEAVY = 16_384  # pieces of an anchor, about a megabyte, from which they are dealt by window
WINDOWS = 1 << 18  # windows of heavy anchors that a task holds at once


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Starts of all suffixes of an array of positive whole numbers, in rising order."""
    n = len(symbols)
    if n < 12:
        short = symbols.tolist()
        return np.array(sorted(range(n), key=lambda i: short[i:]), dtype=np.int64)
    zeros = 3 - n % 3
    order = _difference_cover(np.concatenate([symbols.astype(np.int64), np.zeros(zeros, dtype=np.int64)]))
    return order[order < n]


def _packed(*columns: np.ndarray) -> np.ndarray:
    """One number for each row that orders rows by the columns in turn."""
    out = columns[0].astype(np.uint64)
    for c in columns[1:]:
        most = int(c.max()) + 1 if len(c) else 1
        if int(out.max() if len(out) else 0) * most >= 1 << 63:
            out = np.unique(out, return_inverse=True)[1].astype(np.uint64)
        out = out * np.uint64(most) + c.astype(np.uint64)
    return out


def _difference_cover(s: np.ndarray) -> np.ndarray:
    """Suffix order of ``s``, whose length is a multiple of 3 and whose last 1 to 3 symbols are 0."""
    n = len(s)
    t = np.concatenate([s, np.zeros(3, dtype=np.int64)])
    sample = np.concatenate([np.arange(1, n, 3), np.arange(2, n, 3)])
    key = _packed(t[sample], t[sample + 1], t[sample + 2])
    order = np.argsort(key)
    ordered = key[order]
    names = np.empty(len(sample), dtype=np.int64)
    names[order] = np.cumsum(np.concatenate([[1], ordered[1:] != ordered[:-1]]))
    if names.max() < len(sample):
        order = suffix_order(names)
        names[order] = np.arange(1, len(sample) + 1)
    rank = np.zeros(n + 3, dtype=np.int64)
    rank[sample] = names
    by_rank = sample[order]
    # The other third: first symbol, then the rank of what follows.
    rest = np.arange(0, n, 3)
    ones, twos = by_rank[by_rank % 3 == 1], by_rank[by_rank % 3 == 2]
    key = _packed(np.concatenate([t[rest], t[ones]]), np.concatenate([rank[rest + 1], rank[ones + 1]]))
    rest_order = np.argsort(key[: len(rest)])
    below = np.searchsorted(key[len(rest):], key[: len(rest)][rest_order])
    rest = rest[rest_order]
    key = _packed(*(np.concatenate([c[rest + k], c[twos + k]]) for c, k in ((t, 0), (t, 1), (rank, 2))))
    below = below + np.searchsorted(key[len(rest):], key[: len(rest)])
    out = np.empty(n, dtype=np.int64)
    at = np.arange(len(rest)) + below
    free = np.ones(n, dtype=bool)
    free[at] = False
    out[at] = rest
    out[free] = by_rank
    return out


def anchors(texts: pa.Array, length: int = LENGTH, anchor: int = ANCHOR) -> Iterator[tuple]:
    """Runs of windows with one anchor: text, first and last window, the hashes of anchor and run.

    Yields for each half megabyte of text: index of its first text, its bytes, where texts begin,
    and those five arrays. Positions are in the bytes of that part.
    """
    span = length - anchor + 1
    for begin, stop in W.pieces(texts, most_bytes=1 << 19):
        data, offsets = W.text_buffers(texts.slice(begin, stop - begin))
        n = len(data) - length + 1
        if n <= 0:
            continue
        up, inverse = W.powers(len(data) + 1)
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
        grams = len(data) - anchor + 1
        hashes = W.mix((sums[anchor:] - sums[:-anchor]) * inverse[:grams])
        # The place in the low bits: the leftmost of hashes with equal high bits, and where it is.
        low = np.uint64(0xFFFFFFFF)
        least = (hashes & ~low) | np.arange(grams, dtype=np.uint64)
        width = 1
        while width * 2 <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < span:
            least = np.minimum(least[: n], least[span - width :][: n])
        at = (least[:n] & low).astype(np.int64)
        inside = np.zeros(len(data) + 1, dtype=np.int8)
        full = np.diff(offsets) >= length
        np.add.at(inside, offsets[:-1][full], 1)
        np.add.at(inside, offsets[1:][full] - length + 1, -1)
        valid = np.cumsum(inside[:n]) > 0
        starts = np.flatnonzero(valid & np.concatenate([[True], (at[1:] != at[:-1]) | ~valid[:-1]]))
        ends = np.flatnonzero(valid & np.concatenate([(at[1:] != at[:-1]) | ~valid[1:], [True]]))
        # Texts are apart by windows that are not valid, so no run crosses them.
        text = np.searchsorted(offsets, starts, side="right") - 1
        content = W.mix((sums[ends + length] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
        yield begin, data, offsets, text, starts, ends, hashes[at[starts]], content


def _sorted_chunk(chunk: pa.Table) -> pa.Table:
    """The texts of a chunk in an order that is the same each time."""
    return chunk.sort_by([("md5", "ascending"), ("doc_key", "ascending")])


def _one_array(column: pa.ChunkedArray, kind: pa.DataType) -> pa.Array:
    return column.cast(kind).combine_chunks() if column.num_chunks != 1 else column.chunk(0).cast(kind)


def _texts(chunk: pa.Table) -> pa.Array:
    return _one_array(chunk.column("text"), pa.large_string())


def _blobs(part: np.ndarray, *columns: np.ndarray) -> list[tuple]:
    """Rows (part, bytes of each column) from columns sorted by part."""
    if not len(part):
        return []
    cuts = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(part)]])
    return [(int(part[a]), *(c[a:b].tobytes() for c in columns)) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _first_texts(rows: pa.Table, firsts: pa.Table) -> pa.Table:
    """The rows whose id is the first with their text, each once."""
    if not rows.num_rows or not firsts.num_rows:
        return rows.slice(0, 0)
    first = set(zip(firsts.column("md5").to_pylist(), firsts.column("doc_key").to_pylist(), strict=True))
    take = []
    for i, key in enumerate(zip(rows.column("md5").to_pylist(), rows.column("doc_key").to_pylist(), strict=True)):
        if key in first:
            first.remove(key)
            take.append(i)
    return rows.take(pa.array(take, pa.int64()))


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows without most repeats in one task, so that no chunk gathers many equal rows."""
    seen: set[tuple] = set()
    for batch in batches:
        if len(seen) > 200_000:
            seen.clear()
        take = []
        for i, key in enumerate(zip(batch.column("md5").to_pylist(), batch.column("doc_key").to_pylist(), strict=True)):
            if key not in seen:
                seen.add(key)
                take.append(i)
        yield batch if len(take) == batch.num_rows else batch.take(pa.array(take, pa.int64()))


def _anchor_lists(parts: int):
    """For each chunk: its anchors by partition of the hash, with the bits of how many pieces have each.

    The highest bit of ``several`` says that several texts of the chunk have the anchor.
    """
    schema = pa.schema([("part", pa.int64()), ("chunk", pa.int64()), ("keys", pa.binary()), ("several", pa.binary())])

    def run(chunk: pa.Table) -> pa.Table:
        chunk = _sorted_chunk(chunk)
        hashes, text = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.int64)]
        for begin, _, _, t, _, _, h, _ in anchors(_texts(chunk)):
            hashes.append(h)
            text.append(t + begin)
        h, t = np.concatenate(hashes), np.concatenate(text)
        order = np.argsort(h)
        h, t = h[order], t[order]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, dtype=np.int64)
        several = np.minimum.reduceat(t, first) != np.maximum.reduceat(t, first) if len(h) else np.zeros(0, dtype=bool)
        pieces = np.diff(np.concatenate([first, [len(h)]]))
        several = (np.frexp(pieces)[1] | np.where(several, 128, 0)).astype(np.uint8)
        h = h[first]
        part = ((h >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        rows = _blobs(part[order], h[order].astype(np.uint32), several[order])
        number = chunk.column("chunk")[0].as_py()
        return pa.table([[r[0] for r in rows], [number] * len(rows), [r[1] for r in rows], [r[2] for r in rows]], schema=schema)

    return run


def _shared_anchors(lists: pa.Table, heavy: int) -> pa.Table:
    """For each chunk, which anchors of one partition other texts have too, and which have about ``heavy`` pieces."""
    schema = pa.schema([("chunk", pa.int64()), ("part", pa.int64()), ("keys", pa.binary()), ("heavy", pa.binary())])
    keys = [np.frombuffer(b, dtype=np.uint32) for b in lists.column("keys").to_pylist()]
    several = np.concatenate([np.frombuffer(b, dtype=np.uint8) for b in lists.column("several").to_pylist()])
    owner = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
    flat = np.concatenate(keys)
    order = np.argsort(flat, kind="stable")
    flat, owner, several = flat[order], owner[order], several[order]
    same = flat[1:] == flat[:-1]
    first = np.flatnonzero(np.concatenate([[True], ~same])) if len(flat) else np.zeros(0, dtype=np.int64)
    pieces = np.add.reduceat(np.int64(1) << (several & 127).astype(np.int64), first) if len(flat) else first
    large = np.repeat(pieces > heavy, np.diff(np.concatenate([first, [len(flat)]])))
    shared = several >= 128
    shared[1:] |= same
    shared[:-1] |= same
    # What several texts of one chunk share is shared for each chunk that has it.
    flat, owner, large = flat[shared], owner[shared], large[shared]
    order = np.lexsort((flat, owner))
    rows = _blobs(owner[order], flat[order], large[order])
    chunks, part = lists.column("chunk").to_pylist(), lists.column("part")[0].as_py()
    return pa.table([[chunks[r[0]] for r in rows], [part] * len(rows), [r[1] for r in rows], [r[2] for r in rows]], schema=schema)


_PIECE = (
    "part long, chunk long, keys binary, docs binary, numbers binary, starts binary, lengths binary, bytes binary")


def _pieces_of_chunk(parts: int, length: int = LENGTH):
    """Pieces of text around shared anchors, for the partition of the anchor; ``part`` -1: already decided.

    Of equal pieces in one chunk only those of the smallest id are sent; the others are covered by it.
    Pieces of a heavy anchor go window by window to the partition of the window's hash, so that many
    surroundings of one frequent string are spread and equal windows still meet. They are taken in turns by
    their hash, so that memory is bounded however many of a chunk's windows are heavy.
    """
    schema = pa.schema([("part", pa.int64()), ("chunk", pa.int64()), *((c, pa.binary()) for c in (
        "keys", "docs", "numbers", "starts", "lengths", "bytes"))])

    def run(chunk: pa.Table, shared: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        if chunk.num_rows and shared.num_rows:
            chunk = _sorted_chunk(chunk)
            known = np.concatenate([
                (np.uint64(p) << np.uint64(32)) | np.frombuffer(k, dtype=np.uint32).astype(np.uint64)
                for p, k in zip(shared.column("part").to_pylist(), shared.column("keys").to_pylist(), strict=True)])
            heavy = np.concatenate([np.frombuffer(b, dtype=bool) for b in shared.column("heavy").to_pylist()])
            order = np.argsort(known)
            rows = found(chunk, known[order], heavy[order])
        return pa.table([list(c) for c in zip(*rows, strict=True)] if rows else [[] for _ in schema], schema=schema)

    def found(chunk: pa.Table, known: np.ndarray, heavy: np.ndarray) -> list[tuple]:
        texts, doc_of = _texts(chunk), chunk.column("doc_key").to_numpy()
        number = chunk.column("chunk")[0].as_py()
        out, bytes_ = [], []
        held = 0
        for begin, data, offsets, text, starts, ends, h, content in anchors(texts, length):
            part = (h >> np.uint64(32)) % np.uint64(parts)
            key = (part << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF))
            at = np.minimum(np.searchsorted(known, key), len(known) - 1)
            hit = known[at] == key
            text, starts, ends, part, key, content, large = (
                x[hit] for x in (text, starts, ends, part, key, content, heavy[at]))
            size = ends - starts + length
            take = _ranges(starts, size)
            bytes_.append(data[take])
            out.append((part.astype(np.int64), key & np.uint64(0xFFFFFFFF), text + begin, starts - offsets[text], size,
                        held + np.cumsum(size) - size, content, large))
            held += len(take)
        if not out or not held:
            return []
        part, key, text, start, size, at, content, large = (np.concatenate(c) for c in zip(*out, strict=True))
        data, doc = np.concatenate(bytes_), doc_of[text]
        covered = _equal_pieces(data, at, size, content, doc)
        rows: list[tuple] = []

        def send(covered: np.ndarray, part: np.ndarray, key: np.ndarray, text: np.ndarray, start: np.ndarray, size: np.ndarray,
                 at: np.ndarray) -> None:
            if covered.any():
                rows.append((-1, number, b"", b"", text[covered].astype(np.int32).tobytes(), start[covered].astype(np.int64).tobytes(),
                             size[covered].astype(np.int32).tobytes(), b""))
            keep = np.flatnonzero(~covered)
            keep = keep[np.argsort(part[keep], kind="stable")]
            part, key, text, start, size, at = (x[keep] for x in (part, key, text, start, size, at))
            cuts = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(part)]]) if len(part) else [0]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                rows.append((
                    int(part[a]), number, key[a:b].astype(np.uint32).tobytes(), doc_of[text[a:b]].astype(np.int64).tobytes(),
                    text[a:b].astype(np.int32).tobytes(), start[a:b].astype(np.int64).tobytes(),
                    size[a:b].astype(np.int32).tobytes(), data[_ranges(at[a:b], size[a:b])].tobytes()))

        whole_pieces = covered | ~large
        send(covered[whole_pieces], *(x[whole_pieces] for x in (part, key, text, start, size, at)))
        cut = np.flatnonzero(~whole_pieces)
        windows = size[cut] - length + 1
        ends = np.cumsum(windows)
        hashed = [np.zeros(0, dtype=np.uint64)]
        for a, b in _slices(ends, WINDOWS):
            first = _ranges(at[cut[a:b]], windows[a:b])
            hashed.append(_hashes(data, first, np.full(len(first), length, dtype=np.int64)))
        hashed = np.concatenate(hashed)
        turns = -(-len(hashed) // WINDOWS)
        for turn in range(turns):
            w = np.flatnonzero((hashed >> np.uint64(8)) % np.uint64(turns) == np.uint64(turn))
            which = np.searchsorted(ends, w, side="right")
            piece, step, h = cut[which], w - (ends - windows)[which], hashed[w]
            full = np.full(len(w), length, dtype=np.int64)
            part_w = ((h >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
            covered_w = _equal_pieces(data, at[piece] + step, full, h, doc[piece])
            send(covered_w, part_w, h & np.uint64(0xFFFFFFFF), text[piece], start[piece] + step, full, at[piece] + step)
        return rows

    return run


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of several ranges, one after the other."""
    total = int(sizes.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    ends = np.cumsum(sizes)
    return np.arange(total) + np.repeat(starts - (ends - sizes), sizes)


def _slices(ends: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Cuts rows whose running sizes are ``ends`` into runs of about ``most`` in size; a larger row is a run of its own."""
    a = 0
    while a < len(ends):
        b = max(int(np.searchsorted(ends, (ends[a - 1] if a else 0) + most, side="right")), a + 1)
        yield a, b
        a = b


def _hashes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, most_bytes: int = 1 << 19) -> np.ndarray:
    """Hashes of so many bytes from each start; the starts rise. Sums are held for half a megabyte of bytes at a time."""
    out = [np.zeros(0, dtype=np.uint64)]
    for a, b in _slices(starts + 1 - (starts[0] if len(starts) else 0), most_bytes):
        at, end = starts[a:b] - starts[a], starts[a:b] + sizes[a:b] - starts[a]
        part = data[starts[a] : starts[a] + end.max()]
        up, inverse = W.powers(len(part) + 1)
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[: len(part)], out=sums[1:])
        out.append(W.mix((sums[end] - sums[at]) * inverse[at]))
    return np.concatenate(out)


def _leads(data: np.ndarray, at: np.ndarray, size: np.ndarray, content: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each piece one of the smallest id with the same bytes, or itself; ``content`` is a hash of the bytes."""
    order = np.lexsort((doc, content, size))
    first = np.concatenate([[True], (content[order][1:] != content[order][:-1]) | (size[order][1:] != size[order][:-1])])[: len(order)]
    lead = np.empty(len(at), dtype=np.int64)
    lead[order] = order[np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))] if len(at) else order
    own = np.flatnonzero(lead != np.arange(len(at)))
    for k in range(int(size[own].max()) if len(own) else 0):
        more = own[size[own] > k]
        other = more[data[at[more] + k] != data[at[lead[more]] + k]]
        lead[other] = other
    return lead


def _equal_pieces(data: np.ndarray, at: np.ndarray, size: np.ndarray, content: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which pieces are, byte for byte, a piece of a smaller id; ``content`` is a hash of the bytes."""
    return doc > doc[_leads(data, at, size, content, doc)]


def _repeats_in(data: np.ndarray, size: np.ndarray, doc: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows that a smaller id has too: piece, first window, last window + 1 (runs of windows in a piece)."""
    order = suffix_order(data.astype(np.int64) + 1)
    begin = np.cumsum(size) - size
    piece = np.repeat(np.arange(len(size)), size)
    offset = np.arange(len(data)) - begin[piece]
    order = order[offset[order] <= (size - length)[piece[order]]]  # whole windows only
    # Equal windows are neighbours: compare them by eight bytes at a time, the last eight overlapping.
    wide = np.zeros(len(data), dtype=np.uint64)
    for k in range(8):
        wide[: len(data) - k] |= data[k:].astype(np.uint64) << np.uint64(8 * k)
    equal = np.ones(max(len(order) - 1, 0), dtype=bool)
    for k in [*range(0, length - 7, 8), length - 8]:
        w = wide[order + k]
        equal &= w[1:] == w[:-1]
    first = np.flatnonzero(np.concatenate([[True], ~equal])) if len(order) else np.zeros(0, dtype=np.int64)
    owner = doc[piece[order]]
    least = np.repeat(np.minimum.reduceat(owner, first), np.diff(np.concatenate([first, [len(order)]]))) if len(order) else owner
    covered = np.zeros(len(data) + 1, dtype=bool)
    covered[order[owner > least]] = True
    start = np.flatnonzero(covered[:-1] & ~np.concatenate([[False], covered[:-2]]) | covered[:-1] & (offset == 0))
    after = np.concatenate([offset[1:] == 0, [True]])
    end = np.flatnonzero(covered[:-1] & (~covered[1:] | after)) + 1
    p = piece[start]
    return p, offset[start], offset[start] + (end - start)


def _repeats_of_partition(length: int = LENGTH, most_bytes: int = 1 << 19):
    """Sort the suffixes of all different pieces of a partition, a share of the anchors at a time.

    Of pieces with the same bytes one of the smallest id is sorted. What it has in common with smaller ids, the others of
    its id have too; those of larger ids are covered by it.
    """
    schema = pa.schema([("chunk", pa.int64()), ("numbers", pa.binary()), ("starts", pa.binary()), ("lengths", pa.binary())])

    def run(rows: pa.Table) -> pa.Table:
        read = lambda name, kind: [np.frombuffer(b, dtype=kind) for b in rows.column(name).to_pylist()]
        keys, docs, numbers, starts, lengths = (np.concatenate(read(n, k)) for n, k in (
            ("keys", np.uint32), ("docs", np.int64), ("numbers", np.int32), ("starts", np.int64), ("lengths", np.int32)))
        data = np.concatenate(read("bytes", np.uint8))
        chunk = np.repeat(rows.column("chunk").to_numpy(), [len(b) // 4 for b in rows.column("keys").to_pylist()])
        lengths = lengths.astype(np.int64)
        at = np.cumsum(lengths) - lengths
        lead = _leads(data, at, lengths, _hashes(data, at, lengths), docs)
        order = np.flatnonzero(lead == np.arange(len(lead)))
        order = order[np.argsort(keys[order], kind="stable")]
        filled = np.cumsum(lengths[order])
        out = []
        a = 0
        while a < len(order):
            b = int(np.searchsorted(filled, (filled[a - 1] if a else 0) + most_bytes, side="right"))
            b = max(b, a + 1)
            # All pieces of one anchor stay together.
            while b < len(order) and keys[order[b]] == keys[order[b - 1]]:
                b += 1
            own = order[a:b]
            p, first, last = _repeats_in(data[_ranges(at[own], lengths[own])], lengths[own], docs[own], length)
            out.append((own[p], first, last))
            a = b
        piece, first, last = (np.concatenate([np.zeros(0, dtype=np.int64), *c]) for c in (zip(*out, strict=True) if out else [[]] * 3))
        order = np.argsort(piece, kind="stable")
        piece, first, last = piece[order], first[order], last[order]
        alike = np.flatnonzero((lead != np.arange(len(lead))) & (docs == docs[lead]))
        later = np.flatnonzero(docs > docs[lead])
        low = np.searchsorted(piece, lead[alike], side="left")
        runs = np.searchsorted(piece, lead[alike], side="right") - low
        same = _ranges(low, runs)
        piece, first, last = (np.concatenate(c) for c in (
            (piece, np.repeat(alike, runs), later), (first, first[same], np.zeros(len(later), dtype=np.int64)),
            (last, last[same], lengths[later] - length + 1)))
        found = [chunk[piece], numbers[piece], starts[piece] + first, last - first + length - 1]
        order = np.argsort(found[0], kind="stable")
        c, number, start, size = (x[order] for x in found)
        made = _blobs(c, number.astype(np.int32), start.astype(np.int64), size.astype(np.int32))
        return pa.table([list(x) for x in zip(*made, strict=True)] if made else [[] for _ in schema], schema=schema)

    return run


def _cut_texts(chunk: pa.Table, covered: pa.Table) -> pa.Table:
    """What is left of each text of a chunk."""
    schema = pa.schema([
        ("md5", pa.string()), ("doc_key", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
        ("kept_sha256", pa.string()), ("kept", pa.string())])
    if not chunk.num_rows:
        return schema.empty_table()
    chunk = _sorted_chunk(chunk)
    data, offsets = W.text_buffers(_texts(chunk))
    read = lambda name, kind: np.concatenate([
        np.zeros(0, dtype=kind), *(np.frombuffer(b, dtype=kind) for b in covered.column(name).to_pylist())])
    number, start, size = read("numbers", np.int32).astype(np.int64), read("starts", np.int64), read("lengths", np.int32)
    start = start + offsets[number]
    marks = np.zeros(len(data) + 1, dtype=np.int32)
    np.add.at(marks, start, 1)
    np.add.at(marks, start + size, -1)
    gone = np.cumsum(marks, dtype=np.int32, out=marks)[:-1] > 0
    del marks
    bounds = np.zeros(len(data) + 1, dtype=bool)
    bounds[offsets] = True
    opens = gone & np.concatenate([[True], ~gone[:-1] | bounds[1:-1]])[: len(gone)]
    # Text by text: running sums over a whole chunk would take sixteen bytes a byte.
    ranges = list(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True))
    removed, spans = (pa.array([np.count_nonzero(x[a:b]) for a, b in ranges], pa.int64()) for x in (gone, opens))
    kept = [data[a:b][~gone[a:b]].tobytes() for a, b in ranges]
    return pa.table([
        chunk.column("md5").cast(pa.string()), chunk.column("doc_key"), removed, spans, [hashlib.sha256(k).hexdigest() for k in kept],
        [k.decode("utf-8", "ignore") for k in kept]], schema=schema)


def _marked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = whole(text_col)
    return docs.withColumns({
        "_doc_key": F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)), "_md5": F.md5(text),
        "_n_bytes": F.octet_length(text).cast("long"),
    })


def search_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False, chunk_bytes: int = 8 << 20,
    heavy: int = HEAVY,
) -> DataFrame:
    """What goes of each different text of 50 bytes or more: _md5, _doc_key, n_removed, n_spans, kept_sha256.

    ``keep_text`` adds kept, the rest of the text without characters that were cut in part. Of
    exact copies only the one with the smallest id is searched and listed; the others go whole.
    Texts are stored once, in buckets of chunks, and read three times from there without another
    shuffle. Work for a partition grows with the anchors in it, which hash spreads; of equal pieces
    a chunk sends one, and anchors of more than about ``heavy`` pieces are dealt by window. Equal rows
    are dropped by each task that reads them.
    """
    spark = docs.sparkSession
    marked = _marked(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "doc_id", "text")
    long = marked.filter(F.col("_n_bytes") >= LENGTH)
    keys = cut_lineage(long.select("_md5", "_doc_key", "_n_bytes"), "suffix-keys")
    total = keys.agg(F.sum("_n_bytes")).first()[0] or 0
    chunks = tasks_for(spark, total, chunk_bytes)
    parts = tasks_for(spark, total, 2 * chunk_bytes)
    chunk: Column = F.pmod(F.xxhash64("md5", "doc_key"), F.lit(chunks)).alias("chunk")
    firsts = keys.groupBy(F.col("_md5").alias("md5")).agg(F.min("_doc_key").alias("doc_key")).select(chunk, "md5", "doc_key")
    every = long.select(F.col("_md5").alias("md5"), F.col("_doc_key").alias("doc_key"), "text").select(chunk, "md5", "doc_key", "text")
    table = f"suffix_texts_{uuid.uuid4().hex[:12]}"
    (
        every.mapInArrow(_once, "chunk long, md5 string, doc_key long, text string").repartition(chunks, "chunk").groupBy("chunk").cogroup(firsts.groupBy("chunk"))
        .applyInArrow(_first_texts, "chunk long, md5 string, doc_key long, text string")
        .write.option("compression", "zstd").bucketBy(chunks, "chunk").saveAsTable(table)
    )
    texts = spark.table(table)
    lists = texts.groupBy("chunk").applyInArrow(_anchor_lists(parts), "part long, chunk long, keys binary, several binary")
    shared = lists.groupBy("part").applyInArrow(
        lambda rows: _shared_anchors(rows, heavy), "chunk long, part long, keys binary, heavy binary")
    pieces = cut_lineage(
        texts.groupBy("chunk").cogroup(shared.groupBy("chunk")).applyInArrow(_pieces_of_chunk(parts), _PIECE), "suffix-pieces")
    repeats = pieces.filter("part >= 0").groupBy("part").applyInArrow(
        _repeats_of_partition(), "chunk long, numbers binary, starts binary, lengths binary")
    covered = repeats.unionByName(pieces.filter("part < 0").select("chunk", "numbers", "starts", "lengths"))
    done = texts.groupBy("chunk").cogroup(covered.groupBy("chunk")).applyInArrow(
        _cut_texts, "md5 string, doc_key long, n_removed long, n_spans long, kept_sha256 string, kept string")
    done = done.withColumnsRenamed({"md5": "_md5", "doc_key": "_doc_key"})
    done = cut_lineage(done if keep_text else done.drop("kept"), "suffix-done")
    spark.sql(f"DROP TABLE {table}")
    return done


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each text: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A byte is removed if a string of 50 bytes around it also starts in a text with a smaller id.
    Null text is empty. A null id is smaller than none, so such texts lose what any other has. Texts
    with the same id take nothing from each other. Repeated rows are all returned. An empty table
    gives no rows.
    """
    short = F.col("_n_bytes") < LENGTH
    base = _marked(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "doc_id", "text").select(
        "doc_id", "_doc_key", "_md5", "_n_bytes",
        F.when(short, F.sha2(whole("text").cast("binary"), 256)).alias("_short_hash"))
    # No row there: shorter than the length, so nothing goes; or a later copy, so all goes.
    empty = hashlib.sha256(b"").hexdigest()
    return base.join(search_repeats(docs, id_col, text_col), ["_md5", "_doc_key"], "left").select(
        "doc_id", F.col("_n_bytes").alias("n_bytes"),
        F.when(short, F.lit(0)).otherwise(F.coalesce("n_removed", "_n_bytes")).cast("long").alias("n_removed"),
        F.when(short, F.lit(0)).otherwise(F.coalesce("n_spans", F.lit(1))).cast("long").alias("n_spans"),
        F.when(short, F.col("_short_hash")).otherwise(F.coalesce("kept_sha256", F.lit(empty))).alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated strings cut out of the texts; texts of which no word is left go.

    All columns stay, whatever their names; a text that loses nothing stays as it is, null too.
    """
    roles = {"doc_id": id_col, "text": text_col}
    done = search_repeats(docs, id_col, text_col, keep_text=True)
    own = (F.col("_n_bytes") < LENGTH) | (F.col("n_removed") == 0)
    # Long texts come back with the result, so they need not be shuffled from here.
    slim = _marked(set_apart(docs, **roles), "doc_id", "text").withColumn("text", F.when(F.col("_n_bytes") < LENGTH, F.col("text")))
    joined = slim.join(done, ["_md5", "_doc_key"], "left")
    text = F.when(F.col("_n_bytes") < LENGTH, F.col("text")).otherwise(F.coalesce("kept", F.lit("")))
    left = joined.withColumn("text", text).filter(own | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return put_back(left, docs, **roles)
