"""Small driver-side file helpers on the Hadoop file system that a path belongs to."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; empty when the folder is missing."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p))


def is_empty(spark: SparkSession, path: str) -> bool:
    """True when the folder is missing or has nothing in it."""
    return not list_names(spark, path)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = False) -> None:
    """Write beside the target, then rename in one step: readers see the old file, the new one, or none.

    Each writer has a name of its own for the part. Without ``overwrite`` only one writer gets the
    target; the others fail with ``FileExistsError``.
    """
    fs, target = _fs(spark, path)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    part = hadoop.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}.part")
    stream = fs.create(part, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    context = hadoop.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    rename = getattr(hadoop, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE if overwrite else rename.NONE
    try:
        context.rename(fs.makeQualified(part), fs.makeQualified(target), options)
    except Py4JJavaError as error:
        fs.delete(part, False)
        if not overwrite and fs.exists(target):
            raise FileExistsError(path) from error
        raise


def set_modified(spark: SparkSession, path: str, millis: int) -> None:
    """Give all files of a folder this modification time, as copies that keep times have."""
    fs, p = _fs(spark, path)
    for status in fs.listStatus(p):
        fs.setTimes(status.getPath(), millis, -1)


def move_into(spark: SparkSession, source: str, folder: str, prefix: str = "") -> None:
    """Move the data files of one folder into another, under names with a prefix."""
    fs, p = _fs(spark, source)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    fs.mkdirs(hadoop.Path(folder))
    for status in fs.listStatus(p):
        name = status.getPath().getName()
        if not name.startswith(("_", ".")):
            fs.rename(status.getPath(), hadoop.Path(folder, f"{prefix}{name}"))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all that is in it."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)
