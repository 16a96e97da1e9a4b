"""Quality classifier: a generalised additive model with pairwise interactions.

Boosted shallow trees, one feature at a time in turn, add up to one lookup table for each feature and
for each chosen pair of features. A score is a sum of table entries, so it needs bins and additions only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import words as W
from millrace.llm.common import unlike
from millrace.llm.labels import fit_rows
from millrace.llm.rules import STOP_WORDS

FEATURES = (
    "log_words", "word_bytes", "longest_word", "symbols", "shouts", "capitals", "digits", "stops", "beyond_ascii",
    "sentence_ends", "commas", "line_words", "repeated_lines", "repeated_runs", "distinct_words", "odd_words",
)
_CLASSES = {
    "symbols": b"#*$%&|<>@^~_=+\\/{}[]", "shouts": b"!?", "capitals": bytes(range(65, 91)), "digits": b"0123456789",
    "beyond_ascii": bytes(range(0x80, 0x100)), "sentence_ends": b".", "commas": b",;:", "newlines": b"\n",
}


def _hash_words(words: list[str]) -> np.ndarray:
    return np.unique(W.split(pa.array(sorted(words))).hashes())


def features(texts: pa.Array) -> np.ndarray:
    """One row of numbers for each text; ratios of an empty text are 0."""
    w = W.split(texts)
    n = w.texts
    data, size = w.data, np.diff(w.offsets)
    total = w.per_text().astype(np.float64)
    per_word = 1.0 / np.maximum(total, 1)
    # Bytes by class: a table of byte counts would be large, so one running sum for each class.
    by_class = {}
    for name, members in _CLASSES.items():
        table = np.zeros(256, dtype=np.uint8)
        table[list(members)] = 1
        sums = np.concatenate([[0], np.cumsum(table[data], dtype=np.int64)])
        by_class[name] = (sums[w.offsets[1:]] - sums[w.offsets[:-1]]).astype(np.float64)
    length = (w.end - w.start).astype(np.float64)
    hashes = w.hashes()
    longest = np.zeros(n)
    np.maximum.at(longest, w.text, length)
    # Words that hold a byte other than letters and digits before their last byte.
    letter = np.concatenate([[0], np.cumsum(W.LETTER[data], dtype=np.int64)])
    odd = (length - (letter[w.end] - letter[w.start]) >= 2).astype(np.float64)
    breaks = np.flatnonzero(data == 10)
    line_start = np.concatenate([w.offsets[:-1][size > 0], breaks + 1])
    line_start = np.unique(line_start[line_start < len(data)])
    line_end = np.searchsorted(breaks, line_start)
    line_end = np.concatenate([breaks, [len(data)]])[line_end]
    line_text = np.searchsorted(w.offsets, line_start, side="right") - 1
    line_end = np.minimum(line_end, w.offsets[line_text + 1])
    full = line_end - line_start >= 2
    line_start, line_end, line_text = line_start[full], line_end[full], line_text[full]
    lines = np.bincount(line_text, minlength=n).astype(np.float64)
    runs, at = W.runs_of(w, hashes, 3)
    columns = {
        "log_words": np.log1p(total),
        "word_bytes": w.per_text(length) * per_word,
        "longest_word": np.log1p(longest),
        "symbols": by_class["symbols"] * per_word,
        "shouts": by_class["shouts"] * per_word,
        "capitals": by_class["capitals"] / np.maximum(size, 1),
        "digits": by_class["digits"] / np.maximum(size, 1),
        "stops": w.per_text(np.isin(hashes, _STOPS).astype(np.float64)) * per_word,
        "beyond_ascii": by_class["beyond_ascii"] / np.maximum(size, 1),
        "sentence_ends": by_class["sentence_ends"] * per_word,
        "commas": by_class["commas"] * per_word,
        "line_words": np.log1p(total / np.maximum(lines, 1)),
        "repeated_lines": W.repeats_per_text(w.hash_of(line_start, line_end), line_text, n) / np.maximum(lines, 1),
        "repeated_runs": W.repeats_per_text(runs, w.text[at], n) * per_word,
        "distinct_words": 1 - W.repeats_per_text(hashes, w.text, n) * per_word,
        "odd_words": w.per_text(odd) * per_word,
    }
    return np.column_stack([columns[name] for name in FEATURES]).astype(np.float64)


_STOPS = _hash_words(STOP_WORDS)


def feature_rows(texts: pa.Array) -> np.ndarray:
    """``features`` for a whole Arrow batch, a megabyte of text at a time."""
    parts = [features(texts.slice(s, e - s)) for s, e in W.pieces(texts, most_bytes=1 << 20)]
    return np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))


@dataclass
class AdditiveModel:
    """Bin edges and tables: log odds = intercept + one entry for each feature and each pair."""

    edges: list[np.ndarray]
    intercept: float = 0.0
    tables: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.intercept)
        for i, table in enumerate(self.tables):
            out += table[np.searchsorted(self.edges[i], x[:, i], side="right")]
        for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
            out += table[
                np.searchsorted(self.pair_edges[i], x[:, i], side="right"),
                np.searchsorted(self.pair_edges[j], x[:, j], side="right")]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(x), -30, 30)))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    """Bin edges at quantiles; a value that is frequent keeps a bin of its own."""
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1], method="higher")) if len(values) else values


def _gain(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    return g * g / (h + ridge)


def _step(g: np.ndarray, h: np.ndarray, leaves: int, ridge: float) -> np.ndarray:
    """Values of a tree with so many leaves over ordered bins: the best cut is made again and again."""
    parts = [(0, len(g))]
    sum_g, sum_h = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    while len(parts) < leaves:
        best = (1e-9, None, None)
        for p, (a, b) in enumerate(parts):
            if b - a < 2:
                continue
            left_g, left_h = sum_g[a + 1 : b] - sum_g[a], sum_h[a + 1 : b] - sum_h[a]
            all_g, all_h = sum_g[b] - sum_g[a], sum_h[b] - sum_h[a]
            gain = _gain(left_g, left_h, ridge) + _gain(all_g - left_g, all_h - left_h, ridge) - _gain(all_g, all_h, ridge)
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (gain[k], p, a + 1 + k)
        if best[1] is None:
            break
        a, b = parts.pop(best[1])
        parts += [(a, best[2]), (best[2], b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = (sum_g[b] - sum_g[a]) / (sum_h[b] - sum_h[a] + ridge)
    return out


def _pair_step(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[np.ndarray, float]:
    """Values of the best cut of both features at once (four leaves), and its gain."""
    cum_g, cum_h = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    if g.shape[0] < 2 or g.shape[1] < 2:
        return np.zeros_like(g), 0.0
    def corners(c):
        a = c[:-1, :-1]
        b = c[:-1, -1:] - a
        d = c[-1:, :-1] - a
        return a, b, d, c[-1, -1] - a - b - d
    parts = list(zip(corners(cum_g), corners(cum_h), strict=True))
    gain = sum(_gain(a, b, ridge) for a, b in parts) - _gain(cum_g[-1, -1], cum_h[-1, -1], ridge)
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    value = [a[i, j] / (b[i, j] + ridge) for a, b in parts]
    out = np.empty_like(g)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = value
    return out, float(gain[i, j])


def fit_additive(
    x: np.ndarray, y: np.ndarray, bins: int = 48, rounds: int = 150, rate: float = 0.15, leaves: int = 4,
    pairs: int = 6, pair_bins: int = 12, pair_rounds: int = 40, ridge: float = 4.0,
) -> AdditiveModel:
    """Fit the model; without rows, or with one label only, every score is the share of label 1 (0.5 without rows)."""
    share = (y.sum() + 1.0) / (len(y) + 2.0)
    model = AdditiveModel([_cuts(c, bins) for c in x.T], float(np.log(share / (1 - share))))
    model.pair_edges = [_cuts(c, pair_bins) for c in x.T]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    if len(np.unique(y)) < 2:
        return model
    at = [np.searchsorted(e, c, side="right") for e, c in zip(model.edges, x.T, strict=True)]
    odds = np.full(len(y), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-odds))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for i, table in enumerate(model.tables):
            g, h = slopes()
            size = len(table)
            step = rate * _step(np.bincount(at[i], g, size), np.bincount(at[i], h, size), leaves, ridge)
            table += step
            odds += step[at[i]]
    coarse = [np.searchsorted(e, c, side="right") for e, c in zip(model.pair_edges, x.T, strict=True)]
    sizes = [len(e) + 1 for e in model.pair_edges]

    def pair_sums(i: int, j: int, values: np.ndarray) -> np.ndarray:
        return np.bincount(coarse[i] * sizes[j] + coarse[j], values, sizes[i] * sizes[j]).reshape(sizes[i], sizes[j])

    g, h = slopes()
    gains = sorted(
        ((_pair_step(pair_sums(i, j, g), pair_sums(i, j, h), ridge)[1], i, j) for i, j in combinations(range(x.shape[1]), 2)),
        reverse=True)
    model.pairs = [(i, j) for gain, i, j in gains[:pairs] if gain > 1e-9]
    model.pair_tables = [np.zeros((sizes[i], sizes[j])) for i, j in model.pairs]
    for _ in range(pair_rounds):
        for (i, j), table in zip(model.pairs, model.pair_tables, strict=True):
            g, h = slopes()
            step = rate * _pair_step(pair_sums(i, j, g), pair_sums(i, j, h), ridge)[0]
            table += step
            odds += step[coarse[i], coarse[j]]
    return model


def fit_quality(docs: DataFrame, labels: DataFrame, most: int = 20_000, **settings) -> AdditiveModel:
    """Fit on at most ``most`` labelled rows outside the held-out share (``labels.fit_rows``).

    Their features, ``most`` short rows, come to the driver; the texts stay on the executors.
    """
    rows = fit_rows(docs, labels, "quality", 4, 2, most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = feature_rows(batch.column(0))
            yield pa.RecordBatch.from_arrays([
                pa.array(list(x), pa.list_(pa.float64())), batch.column(1)], names=["x", "label"])

    found = rows.mapInArrow(run, "x array<double>, label int").toPandas()
    x = np.array(found["x"].tolist()).reshape(-1, len(FEATURES))
    order = np.lexsort((*x.T, found["label"].to_numpy(dtype=np.int64)))  # the same order on every run
    return fit_additive(x[order], found["label"].to_numpy(dtype=np.float64)[order], **settings)


def score_quality(docs: DataFrame, model: AdditiveModel, out: str = "score", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and the score, from 0 to 1; null text is scored as empty.

    Repeated rows get equal scores; an empty table gives no rows. A column named as ``out`` is replaced.
    """
    rows = docs.drop(out).withColumn(unlike(docs, "_text"), F.col(text_col))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.drop(out).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.score(feature_rows(batch.column(batch.num_columns - 1)))
            columns = [*batch.columns[:-1], pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], out])

    return rows.mapInArrow(run, f"{fields}, `{out}` double" if fields else f"`{out}` double")
