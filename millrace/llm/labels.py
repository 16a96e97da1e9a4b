"""Labelled rows for fitting: a bounded sample, with a share held out by the id's checksum."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import hash_order


def held_out(id_col: Column | str, modulus: int, remainder: int) -> Column:
    """True for rows whose crc32 of the id as text has the remainder; a null id is never held out."""
    text = (F.col(id_col) if isinstance(id_col, str) else id_col).cast("string")
    return F.coalesce(F.pmod(F.crc32(text.cast("binary")), F.lit(modulus)) == remainder, F.lit(False))


def fit_rows(
    docs: DataFrame, labels: DataFrame, label: str, modulus: int, remainder: int, most: int,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """At most ``most`` labelled rows that are not held out: text, label (0 or 1).

    The rows are those whose ids come first in hash order, so the sample is the same on every run and
    is spread over all labelled rows. Labels other than 0 and 1, null ids and repeated labels for
    one id are left out. The list of ids is broadcast: ``most`` bounds it.
    """
    chosen = (
        labels.select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("_label"))
        .filter(F.col("_id").isNotNull() & F.col("_label").isin(0, 1) & ~held_out("_id", modulus, remainder))
        .groupBy("_id").agg(F.min("_label").alias("_label"), F.max("_label").alias("_other"))
        .filter("_label = _other").orderBy(hash_order("_id"), "_id").limit(most)
    )
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    return texts.join(F.broadcast(chosen), "_id").select("text", F.col("_label").alias("label"))
