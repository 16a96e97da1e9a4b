"""Keyed feature tables in folders of parquet files, with upsert and readable earlier versions.

A table is split into parts: days of its time key, or hash buckets of its keys when it has none. A
write makes a new folder of parts under ``data`` and then publishes a small snapshot file that says
which folders hold each part. An upsert writes its batch once, beside what is there. Parts in which
it replaces rows are cleared of those; all others are left as they are, and parts that the batch
has no rows for are not opened.
Readers see the last published snapshot, so a job that dies half way leaves the table as it was.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from millrace.functions.times import clock_seconds
from millrace.operators.filters import time_range
from millrace.sources import files

_PART = "__part"

# A part in this many folders is written to one again, so that small batches do not pile up.
_MAX_FOLDERS = 16


@dataclass
class FeatureTable:
    spark: SparkSession
    path: str
    keys: list[str]
    timestamp_key: str | None
    description: str
    schema: T.StructType
    buckets: int = 16
    _snapshots: dict[int, dict] = field(default_factory=dict, repr=False)

    # -- making and finding -------------------------------------------------------------------

    @classmethod
    def create(
        cls, spark: SparkSession, path: str, keys: str | Sequence[str], *,
        df: DataFrame | None = None, schema: T.StructType | None = None,
        timestamp_key: str | None = None, description: str = "", buckets: int = 16,
    ) -> FeatureTable:
        """Make a table from data, or an empty one from a schema."""
        if (df is None) == (schema is None):
            raise ValueError("give either df or schema")
        if files.exists(spark, f"{path}/_table.json"):
            raise FileExistsError(path)
        schema = df.schema if df is not None else schema
        keys = [keys] if isinstance(keys, str) else list(keys)
        missing = [k for k in [*keys, *([timestamp_key] if timestamp_key else [])] if k not in schema.names]
        if missing:
            raise ValueError(f"key columns missing from schema: {missing}")
        if timestamp_key:
            kind = schema[timestamp_key].dataType
            if not isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
                raise TypeError(f"{timestamp_key} is {kind.simpleString()}, not a timestamp or date")
            if timestamp_key in keys:
                raise ValueError(f"{timestamp_key} cannot be both a key and the timestamp key")
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])
        table = cls(spark, path.rstrip("/"), keys, timestamp_key, description, schema, buckets)
        # The data is written and checked first, so a create that fails leaves the name free. Only then
        # the table is claimed by its description, and its first version published.
        parts = table._write_parts(table._shaped(df), 1) if df is not None else None
        if parts is not None:
            table._check_keys(table._read_parts(parts))
        files.write_text(spark, f"{table.path}/_table.json", json.dumps({
            "keys": keys, "timestamp_key": timestamp_key, "description": description,
            "schema": schema.jsonValue(), "buckets": buckets,
        }))
        if parts is not None:
            table._publish(table._next_version(), parts, None)
        return table

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> FeatureTable:
        meta = json.loads(files.read_text(spark, f"{path.rstrip('/')}/_table.json"))
        return cls(
            spark, path.rstrip("/"), meta["keys"], meta["timestamp_key"], meta["description"],
            T.StructType.fromJson(meta["schema"]), meta["buckets"],
        )

    # -- reading ------------------------------------------------------------------------------

    def versions(self) -> list[int]:
        names = files.list_names(self.spark, f"{self.path}/_snapshots")
        return [int(n.removesuffix(".json")) for n in names if n.endswith(".json")]

    def _snapshot(self, version: int | None = None) -> dict:
        known = self.versions()
        version = (known[-1] if known else 0) if version is None else version
        if version == 0:
            return {"version": 0, "batches": {}, "parts": {}}
        if version not in self._snapshots:
            text = files.read_text(self.spark, f"{self.path}/_snapshots/{version:08d}.json")
            self._snapshots[version] = json.loads(text)
        return self._snapshots[version]

    def read(
        self, start: datetime | str | None = None, end: datetime | str | None = None,
        version: int | None = None,
    ) -> DataFrame:
        """The table, or ``start <= timestamp key < end`` of it; days well outside are not opened."""
        parts = self._snapshot(version)["parts"]
        if self.timestamp_key:
            # Parts are days in UTC and the bounds are in the session's zone, so a day to spare.
            low, high = (datetime.fromisoformat(str(b)) if b is not None else None for b in (start, end))
            low, high = low and (low - timedelta(days=1)).isoformat()[:10], high and (high + timedelta(days=1)).isoformat()[:10]
            parts = {
                p: v for p, v in parts.items() if (low is None or p >= low) and (high is None or p <= high)
            }
        df = self._read_parts(parts)
        return time_range(df, self.timestamp_key, start, end)

    def _read_parts(self, parts: dict[str, list[str]]) -> DataFrame:
        folders = [f"{self.path}/data/{f}/{_PART}={p}" for p, held in parts.items() for f in held]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    # -- writing ------------------------------------------------------------------------------

    def _part(self) -> Column:
        if self.timestamp_key:
            # The day must not depend on the session's zone: a later batch has to find the same part.
            seconds = clock_seconds(self.timestamp_key, self.schema[self.timestamp_key].dataType)
            return F.date_from_unix_date(F.floor(seconds / 86400).cast("int")).cast("string")
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("string")

    def _shaped(self, df: DataFrame) -> DataFrame:
        missing = [n for n in self.schema.names if n not in df.columns]
        extra = [c for c in df.columns if c not in self.schema.names]
        if missing or extra:
            raise ValueError(f"columns differ from the table: missing {missing}, unknown {extra}")
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema])

    def _write_parts(self, df: DataFrame, version: int) -> dict[str, list[str]]:
        """Write to a folder of its own, so that two writers never mix; returns part and folder."""
        folder = f"{version:08d}-{uuid.uuid4().hex[:8]}"
        # Rebalancing makes few files per day and still splits a day that is too large for a task.
        parted = df.withColumn(_PART, self._part()).hint("rebalance", F.col(_PART))
        parted.write.partitionBy(_PART).parquet(f"{self.path}/data/{folder}")
        names = files.list_names(self.spark, f"{self.path}/data/{folder}")
        return {n.removeprefix(f"{_PART}="): [folder] for n in names if n.startswith(_PART)}

    def _check_keys(self, written: DataFrame) -> None:
        """One row per full key and no null in it, within one batch."""
        full = self._full_key()
        no_key = F.greatest(*[F.col(k).isNull().cast("int") for k in full], F.lit(0)) == 1
        bad = written.groupBy(*full).agg(F.count("*").alias("__n")).filter((F.col("__n") > 1) | no_key)
        for row in bad.limit(1).collect():
            kind = "duplicate keys" if row["__n"] > 1 and None not in row else "null"
            raise ValueError(f"{kind} in key columns {full} of one batch: {row.asDict()}")

    def _publish(self, version: int, parts: dict[str, list[str]], batch_id: str | None) -> int:
        batches = dict(self._snapshot(version - 1)["batches"])
        if batch_id:
            stream, number = _batch(batch_id)
            batches[stream] = number
        snapshot = {"version": version, "batches": batches, "parts": parts}
        # This fails if another writer has published the version meanwhile.
        files.write_text(self.spark, f"{self.path}/_snapshots/{version:08d}.json", json.dumps(snapshot))
        return version

    def _next_version(self) -> int:
        return self._snapshot()["version"] + 1

    def overwrite(self, df: DataFrame) -> int:
        """Replace the contents; earlier versions stay readable. Returns the version number."""
        version = self._next_version()
        parts = self._write_parts(self._shaped(df), version)
        self._check_keys(self._read_parts(parts))
        return self._publish(version, parts, None)

    def upsert(self, df: DataFrame, batch_id: str | None = None) -> int:
        """Insert rows; a row whose full key is there already replaces it. Returns the version.

        A batch with a ``batch_id`` published earlier is skipped, so a replay changes nothing. Of ids
        ``<stream>#<number>`` the last number of each stream is kept for good, and batches up to it
        count as published; other ids are all kept.
        """
        if batch_id is not None:
            stream, number = _batch(batch_id)
            if self._snapshot()["batches"].get(stream, -1) >= number:
                return self._snapshot()["version"]
        version = self._next_version()
        current = self._snapshot()["parts"]
        fresh = self._write_parts(self._shaped(df), version)
        self._check_keys(self._read_parts(fresh))
        shared = {p: held for p, held in current.items() if p in fresh}
        beside = {**shared, **self._without(shared, {p: fresh[p] for p in shared}, version)}
        merged = {p: held + beside.get(p, []) for p, held in fresh.items()}
        return self._publish(version, {**current, **merged}, batch_id)

    def _without(
        self, old: dict[str, list[str]], new: dict[str, list[str]], version: int
    ) -> dict[str, list[str]]:
        """The old parts that have to be written again, because rows of ``new`` replace some of
        theirs or because they are in too many folders, with the folders of what remains."""
        if not old:
            return {}
        full = self._full_key()
        replacing = self._read_parts(new).select(*full)
        hit = self._read_parts(old).select(*full).join(replacing, full, "left_semi")
        changed = {row[0] for row in hit.select(self._part()).distinct().collect()}
        again = {p: held for p, held in old.items() if p in changed or len(held) >= _MAX_FOLDERS}
        if not again:
            return {}
        kept = self._write_parts(self._read_parts(again).join(replacing, full, "left_anti"), version)
        return {p: kept.get(p, []) for p in again}

    def forget(self, keep: int = 10) -> None:
        """Remove all but the last ``keep`` versions, and the data that none of those refers to.

        For a time when no job reads the old versions or writes a new one.
        """
        versions = self.versions()
        used = {f for v in versions[-keep:] for held in self._snapshot(v)["parts"].values() for f in held}
        for v in versions[:-keep]:
            files.remove(self.spark, f"{self.path}/_snapshots/{v:08d}.json")
            self._snapshots.pop(v, None)
        for folder in files.list_names(self.spark, f"{self.path}/data"):
            if folder not in used:
                files.remove(self.spark, f"{self.path}/data/{folder}")

    @staticmethod
    def drop(spark: SparkSession, path: str) -> None:
        """Remove a feature table, if it is there. Any other folder is refused."""
        if files.exists(spark, f"{path}/_table.json"):
            files.remove(spark, path)
        elif not files.is_empty(spark, path):
            raise ValueError(f"{path} is not a feature table")

    def _full_key(self) -> list[str]:
        return [*self.keys, *([self.timestamp_key] if self.timestamp_key else [])]

    def write(self, df: DataFrame, mode: str = "merge", **stream_options):
        """``merge`` or ``overwrite``; a streaming DataFrame is merged batch by batch."""
        if df.isStreaming:
            if mode != "merge":
                raise ValueError("a stream can only be merged")
            return self.write_stream(df, **stream_options)
        return {"merge": self.upsert, "overwrite": self.overwrite}[mode](df)

    def write_stream(self, df: DataFrame, checkpoint: str, name: str | None = None, once: bool = True):
        """Start a query that upserts each micro-batch under an id of its own."""
        def merge(batch: DataFrame, number: int) -> None:
            # The id in the checkpoint: a stream that starts anew, with a new checkpoint, has another.
            stream = json.loads(files.read_text(self.spark, f"{checkpoint}/metadata"))["id"]
            self.upsert(batch, batch_id=f"{stream}#{number}")

        writer = df.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
        if name:
            writer = writer.queryName(name)
        return (writer.trigger(availableNow=True) if once else writer).start()


def _batch(batch_id: str) -> tuple[str, int]:
    """Stream and number of a batch id; an id without a number is a stream of its own."""
    stream, mark, number = batch_id.rpartition("#")
    return (stream, int(number)) if mark and number.isdecimal() else (batch_id, 0)


def upserted(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``old`` whose key is not in ``new``, and all of ``new``."""
    return old.join(new.select(*keys), list(keys), "left_anti").select(*new.columns).unionByName(new)
