"""Model search by successive halving, with a time limit."""

from __future__ import annotations

import math
import threading
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.sql import DataFrame

from millrace.operators.sampling import hash_sample, hash_split
from millrace.session import cut_lineage


@dataclass(frozen=True)
class Search:
    """The best model, its setting, and a row for each try: rung, share, rows, setting, loss, kept."""

    model: Model
    setting: dict
    tries: DataFrame
    in_time: bool


def _within(df: DataFrame, deadline: float | None, clock: Callable[[], float], work: Callable):
    """``work()``, or None if the deadline came first; the Spark jobs that it started are cancelled then."""
    if deadline is None:
        return work()
    context, tag, done = df.sparkSession.sparkContext, f"search-{uuid.uuid4().hex}", threading.Event()
    late = threading.Event()

    def watch():
        # Again and again, as work may be between two jobs when the time is over.
        while not done.wait(0.1):
            if clock() >= deadline:
                late.set()
                context.cancelJobsWithTag(tag)

    context.addJobTag(tag)
    watcher = threading.Thread(target=watch, daemon=True)
    watcher.start()
    try:
        return work()
    except Exception:
        if late.is_set():
            return None
        raise
    finally:
        done.set()
        watcher.join()
        context.removeJobTag(tag)


def halving_search(
    df: DataFrame, key: str | Sequence[str], settings: Sequence[dict], fit: Callable[[DataFrame, dict], Model],
    loss: Callable[[DataFrame], float], *, shares: Sequence[float] = (1 / 9, 1 / 3, 1.0), keep: float = 1 / 3,
    held_out: float = 0.25, seed: int = 123, seconds: float | None = None, clock: Callable[[], float] = time.monotonic,
) -> Search:
    """Try all settings on a small share of the rows, the better ones on a larger share, and so on.

    The rows are split by hash of ``key`` once; all tries are measured on the same held-out rows by
    ``loss`` of the scored rows (smaller is better, ties to the earlier setting). The shares are
    nested samples by hash, so a row of a small share is in all larger ones. Of each rung the best
    ``keep`` of the settings go on, one at least; the last rung decides.

    After ``seconds`` the running jobs are cancelled and the best setting of the last complete rung is
    returned (of the unfinished first one, if none is complete). Running out of time before any try
    has ended is a ``TimeoutError``. A rung with all rows of the table costs as much as one fit of each
    setting left, so the first rungs are what makes a large grid affordable.
    """
    if not settings or not shares or list(shares) != sorted(set(shares)) or not 0 < shares[0] <= shares[-1] <= 1:
        raise ValueError("there are settings, and shares that rise from above 0 to 1 at most")
    deadline = None if seconds is None else clock() + seconds
    train, test = (cut_lineage(part, "search") for part in hash_split(df, key, 1 - held_out, seed))
    tries: list[tuple] = []
    alive = list(range(len(settings)))
    best: tuple[Model, int] | None = None
    complete = 0
    for rung, share in enumerate(shares):
        sample = train if share >= 1 else hash_sample(train, key, share, seed + 1)
        rows = sample.count()
        found: dict[int, tuple[float, Model]] = {}
        for number in alive:
            if deadline is not None and clock() >= deadline:
                break

            def work(number=number):
                model = fit(sample, settings[number])
                return float(loss(model.transform(test))), model

            result = _within(df, deadline, clock, work)
            if result is None:
                break
            found[number] = (math.inf if math.isnan(result[0]) else result[0], result[1])
        order = sorted(found, key=lambda n: (found[n][0], n))
        whole = len(found) == len(alive)
        kept = order[:max(1, math.ceil(len(order) * keep))] if whole else []
        tries += [(rung, float(share), rows, str(settings[n]), found[n][0], n in kept) for n in found]
        if order and (whole or best is None):
            best = (found[order[0]][1], order[0])
        if not whole:
            break
        complete, alive = complete + 1, kept
    if best is None:
        raise TimeoutError("no try ended in time")
    table = df.sparkSession.createDataFrame(tries, "rung int, share double, rows long, setting string, loss double, kept boolean")
    return Search(best[0], settings[best[1]], table, complete == len(shares))
