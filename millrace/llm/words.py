"""Words of many texts at once as numpy arrays, for use inside Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
GAP = np.zeros(256, dtype=bool)
GAP[[0x20, *range(0x09, 0x0E)]] = True
# Letters, digits and all bytes of characters beyond ASCII.
LETTER = np.array([chr(b).isalnum() or b >= 0x80 for b in range(128)] + [True] * 128)
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)

_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and its inverse modulo 2^64, for i below n at least."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 16)
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        _powers[:] = [
            np.concatenate([[np.uint64(1)], np.cumprod(np.full(size, b, dtype=np.uint64))]) for b in (BASE, inverse)]
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, and where each begins (with the end of the last); null is empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    if len(offsets) == 0:
        return data[:0], np.zeros(1, dtype=np.int64)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(texts: pa.Array, most_bytes: int = 4 << 20, most_texts: int = 4096) -> Iterator[tuple[int, int]]:
    """Cuts a batch into runs of texts that fit memory; a longer text is a run of its own."""
    _, offsets = text_buffers(texts)
    start = 0
    while start < len(texts):
        stop = int(np.searchsorted(offsets, offsets[start] + most_bytes, side="right")) - 1
        stop = min(max(stop, start + 1), start + most_texts, len(texts))
        yield start, stop
        start = stop


@dataclass
class Words:
    """Words of a run of texts: begin and end in ``data``, index of the text, and text boundaries."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    sums: np.ndarray

    @property
    def texts(self) -> int:
        return len(self.offsets) - 1

    def hash_of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the bytes between, the same wherever they stand."""
        _, inverse = powers(len(self.data) + 1)
        return mix((self.sums[end] - self.sums[start]) * inverse[start] + (end - start).astype(np.uint64))

    def hashes(self) -> np.ndarray:
        return self.hash_of(self.start, self.end)

    def per_text(self, values: np.ndarray | None = None, index: np.ndarray | None = None) -> np.ndarray:
        """Sum for each text of values given for each word (or of ones, for the texts in ``index``)."""
        return np.bincount(self.text if index is None else index, weights=values, minlength=self.texts)


def split(texts: pa.Array, in_word: np.ndarray = ~GAP, lower: bool = False) -> Words:
    """Split texts into runs of the bytes for which ``in_word`` is set; no word crosses texts."""
    data, offsets = text_buffers(texts)
    if lower:
        data = LOWER[data]
    inside = in_word[data]
    n = len(data)
    begins = np.zeros(n + 1, dtype=bool)
    begins[offsets] = True
    first, last = inside.copy(), inside.copy()
    if n:
        first[1:] &= ~inside[:-1] | begins[1:n]
        last[:-1] &= ~inside[1:] | begins[1:n]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, _ = powers(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    # The text of a word: how many texts begin at or before it. Empty texts begin where the next does.
    text = np.searchsorted(offsets, start, side="right") - 1
    return Words(data, offsets, start, end, text, sums)


def runs_of(words: Words, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words inside one text, and the index of their first word."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    same = words.text[:n] == words.text[size - 1 :]
    at = np.flatnonzero(same)
    out = hashes[at]
    for k in range(1, size):
        out = mix(out * BASE + hashes[at + k])
    return out, at


def repeats_per_text(hashes: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
    """For each text, how many of its hashes are equal to an earlier one of the same text."""
    low = np.uint64(0xFFF)
    keyed = np.sort((hashes & ~low) | text.astype(np.uint64))
    again = keyed[1:][keyed[1:] == keyed[:-1]]
    return np.bincount((again & low).astype(np.int64), minlength=texts)
