"""Toxic passages by maximum-scoring segments of token log-odds.

A token's score is its log-odds between toxic and other labelled texts, with Dirichlet priors, less a drift.
A linear scan finds every maximal segment of positive total (no part of it and no extension scores more).
Segment scores are calibrated by the extreme-value law of the best segment of a clean text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import words as W
from millrace.llm.labels import fit_rows

STEM_BYTES = 6
EULER = 0.5772156649015329


@dataclass
class ToxicModel:
    """Token scores by hash slot, the extreme-value law of clean texts, and the final logistic curve."""

    scores: np.ndarray
    rate: float = 1.0
    size: float = 1.0
    intercept: float = -3.0
    slope: float = 1.0

    def evidence(self, best: np.ndarray, total: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """Minus log of the chance that a clean text of this length holds such segments.

        The best segment counts by the extreme-value law; what further segments score counts by
        its exponential tail.
        """
        expected = self.size * np.maximum(tokens, 1) * np.exp(-np.clip(self.rate * best, 0, 500))
        chance = -np.expm1(-expected)
        return -np.log(np.maximum(chance, 1e-290)) + 0.5 * self.rate * (total - best)

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.intercept + self.slope * evidence, -30, 30)))


def tokens(texts: pa.Array) -> W.Words:
    """Runs of letters and digits, A-Z in lower case."""
    return W.split(texts, in_word=W.LETTER, lower=True)


def _slots(w: W.Words, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash slots of each token and of its stem; the stem of a short token is the token."""
    whole = w.hash_of(w.start, w.end)
    stem = w.hash_of(w.start, np.minimum(w.end, w.start + STEM_BYTES)) ^ np.uint64(0x5BD1E995)
    return (whole % np.uint64(slots)).astype(np.int64), (stem % np.uint64(slots)).astype(np.int64)


def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal segments (start, end, total) of a list of scores, in linear time.

    Each candidate holds the running sum before it and at its end, and the place of the last earlier one
    that starts lower. A new one is joined with the last earlier one that starts lower and ends lower
    than it, and with all in between. The links skip what an earlier search has passed (Ruzzo and Tompa).
    """
    held: list[tuple[int, int, float, float, int]] = []
    running = 0.0
    for i, s in enumerate(scores):
        before, running = running, running + s
        if s <= 0:
            continue
        start, low, high = i, before, running
        j = len(held) - 1
        while True:
            while j >= 0 and held[j][2] >= low:
                j = held[j][4]
            if j < 0 or held[j][3] >= high:
                held.append((start, i + 1, low, high, j))
                break
            start, low, link = held[j][0], held[j][2], held[j][4]
            del held[j:]
            j = link
    return [(a, b, high - low) for a, b, low, high, _ in held]


def _segments_of(values: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Segments of many texts: text, first token, last token + 1, total.

    Tokens between two positive ones are one step, so the scan visits positive tokens only.
    """
    up = np.flatnonzero(values > 0)
    sums = np.concatenate([[0.0], np.cumsum(values)])
    out = []
    bounds = np.flatnonzero(np.diff(text[up])) + 1 if len(up) else []
    for part in np.split(up, bounds) if len(up) else []:
        steps = np.empty(2 * len(part) - 1)
        steps[::2] = values[part]
        steps[1::2] = sums[part[1:]] - sums[part[:-1] + 1]
        for a, b, total in maximal_segments(steps.tolist()):
            # A segment begins and ends with a positive token, at even places.
            out.append((text[part[0]], part[a // 2], part[(b - 1) // 2] + 1, total))
    if not out:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, np.zeros(0)
    t, a, b, s = zip(*out, strict=True)
    return np.array(t), np.array(a), np.array(b), np.array(s)


def _best(model_scores: np.ndarray, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best segment, total of all segments, and number of tokens, for each text of a batch."""
    best, total, number = [], [], []
    for s, e in W.pieces(texts):
        w = tokens(texts.slice(s, e - s))
        own, stem = _slots(w, len(model_scores))
        t, _, _, score = _segments_of(np.maximum(model_scores[own], model_scores[stem]).astype(np.float64), w.text)
        most = np.zeros(w.texts)
        np.maximum.at(most, t, score)
        best.append(most)
        total.append(np.bincount(t, score, w.texts).astype(np.float64))
        number.append(w.per_text())
    if not best:
        return np.zeros(0), np.zeros(0), np.zeros(0)
    return np.concatenate(best), np.concatenate(total), np.concatenate(number)


def log_odds(toxic: np.ndarray, other: np.ndarray, n1: int, n0: int, prior: float) -> np.ndarray:
    """Log-odds of tokens between n1 toxic and n0 other texts, with ``prior`` counts in the joint shares."""
    share = (n1 + 1) / (n1 + n0 + 2)
    return np.log((toxic + prior * share) / share) - np.log((other + prior * (1 - share)) / (1 - share))


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, most: int = 20_000, slots: int = 1 << 21,
    prior: tuple[float, float] = (2.0, 1 / 80), drift: float = 2.0,
) -> ToxicModel:
    """Fit on at most ``most`` labelled rows outside the held-out share (``labels.fit_rows``).

    Texts vote once for each token and stem that they hold. The prior counts are ``prior[0]`` and
    ``prior[1]`` more for each toxic text, so that a token needs a share of them to count. Only
    slots that some toxic text has come to the driver, ``slots`` at most; all others score minus
    ``drift``. Then each row's best segment, at most ``most`` numbers, gives the law of clean
    texts and the logistic curve.
    """
    rows = fit_rows(docs, labels, "toxic", 5, 0, most)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((2, slots + 1), dtype=np.int64)  # the last slot counts the texts
        for batch in batches:
            label = batch.column(1).to_numpy(zero_copy_only=False)
            held[:, slots] += np.bincount(label, minlength=2)
            for s, e in W.pieces(batch.column(0)):
                w = tokens(batch.column(0).slice(s, e - s))
                own, stem = _slots(w, slots)
                once = np.unique(np.concatenate([w.text, w.text]) * slots + np.concatenate([own, stem]))
                mine = label[s:e][once // slots]
                for k in (0, 1):
                    held[k, :slots] += np.bincount(once[mine == k] % slots, minlength=slots)
        at = np.flatnonzero(held.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(held[1][at]), pa.array(held[0][at])], names=["slot", "toxic", "other"])

    counts = rows.mapInArrow(count, "slot long, toxic long, other long").groupBy("slot").agg(
        F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    found = counts.filter(f"toxic > 0 OR slot = {slots}").toPandas()
    of_texts = found["slot"] == slots
    n1, n0 = int(found.loc[of_texts, "toxic"].sum()), int(found.loc[of_texts, "other"].sum())
    found = found[~of_texts]
    scores = np.full(slots, -drift, dtype=np.float32)
    scores[found["slot"].to_numpy(dtype=np.int64)] = log_odds(
        found["toxic"].to_numpy(dtype=np.float64), found["other"].to_numpy(dtype=np.float64), n1, n0,
        prior[0] + prior[1] * n1) - drift

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, total, number = _best(scores, batch.column(0))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(best), pa.array(total), pa.array(number.astype(np.float64))],
                names=["label", "best", "total", "number"])

    seen = rows.mapInArrow(measure, "label int, best double, total double, number double").toPandas()
    seen = seen.sort_values(["label", "best", "total", "number"])
    return calibrate(scores, *(seen[c].to_numpy(dtype=np.float64) for c in ("label", "best", "total", "number")))


def calibrate(
    scores: np.ndarray, label: np.ndarray, best: np.ndarray, total: np.ndarray, number: np.ndarray,
) -> ToxicModel:
    """The law of the best segment in clean texts by its moments, and the logistic curve by Newton's method."""
    model = ToxicModel(scores)
    clean = (label == 0) & (number > 0)
    if clean.sum() >= 2:
        spread = max(float(best[clean].std()), 0.25)
        model.rate = np.pi / (spread * np.sqrt(6))
        # The mean of the law is (log(size n) + EULER) / rate.
        model.size = float(np.exp(np.mean(model.rate * best[clean] - np.log(number[clean])) - EULER))
    if len(np.unique(label)) == 2:
        x = model.evidence(best, total, number)
        x = np.minimum(x, 50.0)
        a, b = 0.0, 0.0
        for _ in range(60):
            p = 1 / (1 + np.exp(-np.clip(a + b * x, -30, 30)))
            h = p * (1 - p) + 1e-9
            g = label - p
            m = np.array([[h.sum() + 0.01, (h * x).sum()], [(h * x).sum(), (h * x * x).sum() + 0.1]])
            step = np.linalg.solve(m, [g.sum() - 0.01 * a, (g * x).sum() - 0.1 * b])
            a, b = a + step[0], b + step[1]
            if np.abs(step).max() < 1e-9:
                break
        model.intercept, model.slope = float(a), float(max(b, 1e-6))
    return model


def score_toxicity(docs: DataFrame, model: ToxicModel, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The columns ``keep`` and score (0 to 1, higher: toxic likelier) of each whole text.

    Null and empty texts have no tokens and get the lowest score. Repeated rows get equal scores; an empty
    table gives no rows.
    """
    rows = docs.select(*keep, F.col(text_col).alias("_text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.drop("_text").schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, total, number = _best(model.scores, batch.column(batch.num_columns - 1))
            score = model.probability(np.minimum(model.evidence(best, total, number), 50.0))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(score)], names=[*batch.schema.names[:-1], "score"])

    return rows.mapInArrow(run, f"{fields}, score double")


def toxic_passages(
    docs: DataFrame, model: ToxicModel, chance: float = 0.01, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text",
) -> DataFrame:
    """Every significant passage: the columns ``keep``, first_byte, end_byte, total, p_value.

    A passage is significant when a clean text of that length holds such a segment with at most this chance.
    """
    rows = docs.select(*keep, F.col(text_col).alias("_text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.drop("_text").schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for s, e in W.pieces(texts):
                w = tokens(texts.slice(s, e - s))
                own, stem = _slots(w, len(model.scores))
                t, a, b, score = _segments_of(np.maximum(model.scores[own], model.scores[stem]).astype(np.float64), w.text)
                if not len(t):
                    continue
                number = w.per_text()[t]
                p = -np.expm1(-model.size * number * np.exp(-model.rate * score))
                ok = p <= chance
                t, a, b = t[ok], a[ok], b[ok]
                kept = [c.slice(s, e - s).take(pa.array(t)) for c in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(w.start[a] - w.offsets[t]), pa.array(w.end[b - 1] - w.offsets[t]),
                     pa.array(score[ok]), pa.array(p[ok])],
                    names=[*batch.schema.names[:-1], "first_byte", "end_byte", "total", "p_value"])

    return rows.mapInArrow(run, f"{fields}, first_byte long, end_byte long, total double, p_value double")
