"""Window features of an unbounded stream."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.store import FeatureTable
from millrace.sources import files


def watermarked(stream: DataFrame, ts: str, delay: str) -> DataFrame:
    """Declare how late rows may come. A timestamp without a zone is cast: watermarks need one with it."""
    kind = stream.schema[ts].dataType.simpleString()
    if kind == "timestamp_ntz":
        stream = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    return stream.withWatermark(ts, delay)


def stream_features(
    stream: DataFrame, ts: str, delay: str, compute: Callable[[DataFrame], DataFrame],
    table: FeatureTable, checkpoint: str, once: bool = True,
) -> StreamingQuery:
    """Compute window features on the stream and upsert them as windows close.

    A window is written once, when the watermark has passed its end, so the newest windows of a
    finished run stay open until later rows arrive. State holds the open windows only.
    """
    return table.write_stream(compute(watermarked(stream, ts, delay)), checkpoint, once=once)


def each_batch(
    stream: DataFrame, add: Callable[[DataFrame, str], None], checkpoint: str, once: bool = True,
) -> StreamingQuery:
    """Start a query that calls ``add`` with each micro-batch and an id, the same one when the batch comes again."""
    def run(batch: DataFrame, number: int) -> None:
        held = batch.persist()
        try:
            # The id in the checkpoint: a stream that starts anew, with a new checkpoint, has another.
            query = json.loads(files.read_text(batch.sparkSession, f"{checkpoint}/metadata"))["id"]
            add(held, f"{query}#{number}")
        finally:
            held.unpersist()

    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


@dataclass
class WindowStates:
    """Sums of window panes in a feature table, kept up to date by each micro-batch, however late its rows.

    ``sums`` are mergeable: counts and sums by column name. Each batch is summed up first, to one row for each key and pane, and
    only the panes it touches are read and written again. So every row counts, open windows included, and late ones too.
    ``late`` is the table of counts: for each batch, its rows and those of them that came after ``delay`` had passed.
    """

    panes: FeatureTable
    late: FeatureTable
    key: str
    ts: str
    pane: str
    sums: dict[str, Column]
    delay: str = "0 seconds"

    @classmethod
    def create(
        cls, spark, path: str, key: str, key_type: str, ts: str, pane: str, sums: dict[str, tuple[Column, str]],
        delay: str = "0 seconds",
    ) -> WindowStates:
        """Empty states at ``path``; ``sums`` gives an expression and a type for each name."""
        columns = "".join(f", `{name}` {kind}" for name, (_, kind) in sums.items())
        panes = FeatureTable.create(
            spark, f"{path}/panes", key, schema=T.StructType.fromDDL(f"`{key}` {key_type}, pane_start timestamp{columns}"),
            timestamp_key="pane_start")
        late = FeatureTable.create(
            spark, f"{path}/late", "batch",
            schema=T.StructType.fromDDL("batch string, n_rows long, n_late long, n_undated long, latest timestamp"))
        return cls(panes, late, key, ts, pane, {name: column for name, (column, _) in sums.items()}, delay)

    def add(self, batch: DataFrame, batch_id: str | None = None) -> None:
        """Add the rows of a batch; one with an id that was added before changes nothing.

        Rows without a time belong to no window; they are counted. Null keys are left out, as in any keyed table.
        """
        spark = batch.sparkSession
        rows = batch.withColumn(self.ts, F.col(self.ts).cast("timestamp"))
        known = self.late.read().agg(F.max("latest")).first()[0]
        # Rows before the latest time of the earlier batches, less the delay, are late.
        bar = F.lit(known).cast("timestamp") - F.expr(f"INTERVAL {self.delay}")
        counts = rows.agg(
            F.count("*").alias("n_rows"), F.count_if(F.col(self.ts) < bar).alias("n_late"),
            F.count_if(F.col(self.ts).isNull()).alias("n_undated"), F.max(self.ts).alias("latest"))
        new = rows.filter(F.col(self.key).isNotNull() & F.col(self.ts).isNotNull()).groupBy(
            self.key, F.window(self.ts, self.pane)["start"].alias("pane_start")).agg(
            *[column.alias(name) for name, column in self.sums.items()])
        # Days of the batch bound what is read of the table.
        low, high = rows.agg(F.min(self.ts), F.max(self.ts)).first()
        if low is not None:
            keys = [self.key, "pane_start"]
            old = self.panes.read(low.replace(hour=0, minute=0, second=0, microsecond=0).isoformat())
            old = old.filter(F.col("pane_start") <= F.lit(high)).join(new.select(*keys), keys, "left_semi")
            merged = old.unionByName(new).groupBy(*keys).agg(*[F.sum(name).alias(name) for name in self.sums])
            self.panes.upsert(merged.select(*self.panes.schema.names), batch_id)
        # The counts come last and under the same id: a batch that stopped half way is added once all the same.
        self.late.upsert(counts.select(F.lit(batch_id or uuid.uuid4().hex).alias("batch"), *counts.columns), batch_id)

    def write_stream(self, stream: DataFrame, checkpoint: str, once: bool = True) -> StreamingQuery:
        """Start a query that adds each micro-batch under an id of its own."""
        return each_batch(stream, self.add, checkpoint, once)

    def windows(self, panes_per_window: int, start=None, end=None) -> DataFrame:
        """Sums of all windows of so many panes, each starting where a pane does: key, window_end and the sums.

        Windows that the newest rows are in are there too, as far as rows came. Each pane's sums go to the windows it is in.
        """
        panes = self.panes.read(start, end)
        step = F.expr(f"INTERVAL {self.pane}")
        ends = F.array(*[F.col("pane_start") + step * i for i in range(1, panes_per_window + 1)])
        spread = panes.select(self.key, F.explode(ends).alias("window_end"), *self.sums)
        return spread.groupBy(self.key, "window_end").agg(*[F.sum(name).alias(name) for name in self.sums])

    def late_rows(self) -> DataFrame:
        """Rows in all, late ones and ones without a time, over all batches."""
        return self.late.read().agg(
            *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_rows", "n_late", "n_undated")])
