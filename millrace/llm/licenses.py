"""Find licence notices: MinHash bands over short overlapping windows and single shingles retrieve templates, shingles verify.

Everything is projections and filters, with the templates as a literal; no Python runs on the data.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import let, whole

# Usual notices of public licences.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "BSD-clause": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": "it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "MIT": "Released under the MIT License.",
    "MIT-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
SHINGLE, WINDOW, BANDS = 5, 2, 8
_NOT_WORD = "[^a-z0-9]+"


def shingles_of(text: str, size: int = SHINGLE) -> list[str]:
    """Distinct shingles of a template, in order; one of all words where there are fewer."""
    words = [w for w in re.split(_NOT_WORD, text.lower()) if w]
    runs = [" ".join(words[i : i + size]) for i in range(max(len(words) - size + 1, 1))] if words else []
    return list(dict.fromkeys(runs))


def _band_values(hashes: Column) -> Column:
    """Values of all bands of all windows of so many neighbouring shingles: the least hash of the band's own."""
    def windows(own: Column) -> Column:
        def window(i: Column) -> Column:
            return F.array(*[F.least(*[F.get(F.get(own, i + d), F.lit(j)) for d in range(WINDOW)]) for j in range(BANDS)])

        return F.flatten(F.transform(F.sequence(F.lit(0), F.greatest(F.size(own) - WINDOW, F.lit(0))), window))

    own = F.transform(hashes, lambda h: F.array(*[F.xxhash64(h, F.lit(j)) for j in range(BANDS)]))
    return F.when(F.size(hashes) > 0, let(own, windows)).otherwise(F.array().cast("array<bigint>"))


def _sure(hashes: list[int], least: float) -> list[int]:
    """So many shingles of a template that a text with ``least`` of all has one of them."""
    needed = next((k for k in range(1, len(hashes) + 1) if k / len(hashes) >= least), len(hashes))
    return hashes[: len(hashes) - needed + 1]


def template_table(spark, templates: dict[str, str]) -> DataFrame:
    """license, shingles, hashes, bands: one row for each template that has a shingle."""
    rows = [(name, shingles_of(text)) for name, text in sorted(templates.items()) if shingles_of(text)]
    made = spark.createDataFrame(rows, "license string, shingles array<string>")
    hashed = made.withColumn("hashes", F.transform("shingles", lambda s: F.xxhash64(s)))
    return hashed.withColumn("bands", F.array_distinct(_band_values(F.col("hashes"))))


def find_licenses(
    docs: DataFrame, templates: dict[str, str] | None = None, least: float = 0.8,
    keep: tuple[str, ...] = ("doc_id",), text_col: str = "text",
) -> DataFrame:
    """One row for each text and licence found: the columns ``keep``, license, n_shingles, n_found, containment.

    A licence is found if the text holds at least ``least`` of the distinct five-word shingles of
    its notice (words are runs of a-z and 0-9, any case). Templates are retrieved by bands over windows of 2
    neighbouring shingles, each band a hash of its own. A window inside an unchanged notice is a window of the
    template, so all its bands meet. Where no such window is sure (a notice of one shingle, shingles that stand
    apart) the hashes of the template's first shingles retrieve it, one more of them than may be missing.
    So no notice is missed.

    Null, empty and short texts hold no licence. Repeated rows each give their rows; an empty table or
    no templates give none. ``templates`` is a list to be held in a plan: a few thousand shingles at most.
    """
    spark = docs.sparkSession
    known = template_table(spark, TEMPLATES if templates is None else templates).collect()
    schema = docs.select(*keep).schema.add("license", "string").add("n_shingles", "integer").add("n_found", "integer").add("containment", "double")
    if not known:
        return spark.createDataFrame([], schema)
    all_hashes = sorted({h for t in known for h in t["hashes"]})
    keys = {t["license"]: sorted({*t["bands"], *_sure(t["hashes"], least)}) for t in known}
    all_keys = F.lit(sorted({k for own in keys.values() for k in own})).cast("array<bigint>")
    words = F.array_remove(F.split(F.lower(whole(text_col)), _NOT_WORD), "")

    listed = F.array(*[
        F.struct(
            F.lit(t["license"]).alias("license"), F.array(*[F.lit(s) for s in t["shingles"]]).alias("shingles"),
            F.lit(keys[t["license"]]).cast("array<bigint>").alias("keys"))
        for t in known
    ])
    none = F.array().cast("array<struct<license:string,n_shingles:int,n_found:int,containment:double>>")

    def shingle(w: Column, i: Column) -> Column:
        return F.concat_ws(" ", *[F.get(w, i + d) for d in range(SHINGLE)])

    def scan(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - SHINGLE), lambda i: F.xxhash64(shingle(w, i)))
        return F.when(F.size(w) < SHINGLE, none).otherwise(let(hashes, lambda h: let(
            F.array_intersect(F.concat(_band_values(h), h), all_keys),
            lambda met: F.when(F.size(met) == 0, none).otherwise(verify(w, h, met)))))

    def verify(w: Column, h: Column, met: Column) -> Column:
        """The retrieved templates of which the text has enough shingles, compared as text."""
        held = F.array_distinct(F.transform(
            F.filter(F.sequence(F.lit(0), F.size(h) - 1), lambda i: F.get(h, i).isin(all_hashes)), lambda i: shingle(w, i)))
        retrieved = F.filter(listed, lambda t: F.arrays_overlap(t["keys"], met))
        return let(held, lambda own: F.filter(F.transform(retrieved, lambda t: F.struct(
            t["license"].alias("license"), F.size(t["shingles"]).alias("n_shingles"),
            F.size(F.array_intersect(t["shingles"], own)).alias("n_found"),
            (F.size(F.array_intersect(t["shingles"], own)) / F.size(t["shingles"])).alias("containment"),
        )), lambda m: m["containment"] >= least))

    # One expression, so that the text is scanned once; a text without a match gives no row.
    return docs.select(*keep, F.explode(let(words, scan)).alias("_match")).select(*keep, "_match.*")
