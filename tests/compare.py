"""Compare a Spark result with DuckDB's on the same parquet tables."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{Path(folder) / name}.parquet')")
    return con


def plain(value):
    """A value in a form that both engines share; floats to 12 significant digits."""
    if value is None:
        return None
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}") + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


# Column types that both sides have to agree on, by DuckDB name.
KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def differences(spark_df, con, sql: str) -> list[str]:
    """What differs: columns, types, row counts, rows. Empty when all is equal."""
    relation = con.sql(sql)
    expected_types = dict(zip(relation.columns, map(str, relation.types)))
    got_types = {name: KINDS.get(kind, kind) for name, kind in spark_df.dtypes}
    if expected_types != got_types:
        return [f"types: spark {got_types} duckdb {expected_types}"]
    got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    want = rows_of(relation.columns, relation.fetchall())
    if got == want:
        return []
    extra, missing = list((got - want).items())[:3], list((want - got).items())[:3]
    return [f"rows: spark {sum(got.values())} duckdb {sum(want.values())}", f"only spark {extra}", f"only duckdb {missing}"]
