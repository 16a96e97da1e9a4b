"""Small tables with the awkward cases: nulls, empty and long texts, ties, repeats, clashing names."""

from __future__ import annotations

import random

LONG = " ".join(f"w{i % 997}x{i % 13}" for i in range(30_000))
# Names that the operators use inside, as extra columns of the caller's.
CLASHING = [
    "size", "score", "fp", "row", "_md5", "_doc_key", "_n_bytes", "kept", "n_removed", "n_spans", "kept_sha256", "_id", "_text",
    "_copies", "_copy", "_quality", "_quality_", "others", "doc_key", "chunk", "slot", "taken", "root", "component_id",
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)


def awkward_rows() -> list[tuple]:
    rng = random.Random(5)
    clash, none = ["clash"] * len(CLASHING), [None] * len(CLASHING)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "ne", "pu", "ta") for b in ("r", "s", "t", "nd", "lle", "ing")]
    prose = [" ".join(rng.choice(words) for _ in range(rng.randint(60, 160))) + "." for _ in range(12)]
    texts = [
        None, "", " \t\n\x0b\x0c\r ", "one", "one two", "Released under the MIT License.", "é ß 漢字 😀", *prose,
        prose[0], prose[0], prose[1] + " extra tail", prose[2][:400] + prose[3][:300], LONG, "a b c " * 100, "x", "x",
    ]
    rows = [(i, t, "en", f"s{i % 4}" if i % 7 else None, None, *clash) for i, t in enumerate(texts)]
    rows += [rows[8], rows[8]]  # repeated rows
    rows.append((None, prose[4], None, None, 3, *none))
    rows.append((None, "no id", None, "s1", None, *none))
    return rows


def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
