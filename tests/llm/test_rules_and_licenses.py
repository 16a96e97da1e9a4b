"""Quality rules and licence scans on awkward rows, against plain Python."""

import re

from helpers import awkward, empty

from millrace.llm import licenses, rules


def counts(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    runs = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = {}
    for r in runs:
        seen[r] = seen.get(r, 0) + 1
    covered = {i + j for i, r in enumerate(runs) if seen[r] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_rules_on_awkward_rows(spark):
    df = awkward(spark)
    extra = spark.createDataFrame(
        [(900, "a|b #x\na|b #x\n\n \n*$%&<>" + " the cat sat on" * 30), (901, "x\ny\nx\r\nx"), (902, "a b c d e f")],
        "doc_id long, text string")
    both = df.select("doc_id", "text").unionByName(extra)
    got = rules.judge(both).collect()
    want = [(r.doc_id, *counts(r.text)) for r in both.collect()]
    assert sorted(map(str, ((
        r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got))) == sorted(map(str, want))
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)
    assert rules.judge(empty(spark)).count() == 0


def test_repeated_words_by_text(spark):
    """The exact count by text, used where hashes meet, gives the same."""
    from pyspark.sql import functions as F

    df = awkward(spark).filter("length(text) < 5000").select(rules.words_of("text").alias("w")).filter(F.size("w") >= 3)
    rows = df.select(
        rules.repeated_words(F.col("w")).alias("a"), rules.let(F.col("w"), lambda w: rules._covered_by_text(w, 3)).alias("b")).collect()
    assert rows and all(r.a == r.b for r in rows)


def test_licenses(spark):
    notice = licenses.TEMPLATES["GPL-3.0"]
    texts = [
        (1, "words before. " + notice + " words after"), (2, notice.upper().replace(" ", "\n")),
        (3, notice.replace("version 3", "version two")), (4, "This work is licensed"), (5, None), (6, ""),
        (7, licenses.TEMPLATES["MIT"] + " " + licenses.TEMPLATES["CC-BY-NC-4.0"]), (7, licenses.TEMPLATES["MIT"]), (None, licenses.TEMPLATES["MIT"]),
        (8, "released under the mit licence"), (9, "a " * 5000 + licenses.TEMPLATES["Apache-2.0"]),
    ]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = sorted(str((r.doc_id, r.license)) for r in licenses.find_licenses(df).collect())
    assert got == sorted(map(str, [
        (1, "GPL-3.0"), (2, "GPL-3.0"), (3, "GPL-3.0"), (7, "MIT"), (7, "CC-BY-NC-4.0"), (7, "MIT"), (None, "MIT"), (9, "Apache-2.0")]))
    assert licenses.find_licenses(awkward(spark)).select("license").collect()[0][0] == "MIT"
    assert licenses.find_licenses(empty(spark)).count() == 0
    assert licenses.find_licenses(df, templates={}).count() == 0


def test_short_notices_among_many_neighbours(spark):
    """One shingle at the start, the end or inside; shingles of a longer notice that stand apart."""
    mit, apart = licenses.TEMPLATES["MIT"], "alpha beta gamma delta epsilon {0} beta gamma delta epsilon zeta"
    texts = [t for i in range(300) for t in (f"left{i} {mit}", f"{mit} right{i}", f"a{i} {mit} b{i}", apart.format(f"mid{i}"))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = licenses.find_licenses(df, {"MIT": mit, "greek": "alpha beta gamma delta epsilon zeta"}).collect()
    assert sorted((r.doc_id, r.license) for r in got) == [(i, "greek" if i % 4 == 3 else "MIT") for i in range(1200)]


def test_licenses_run_no_python(spark, data):
    plan = licenses.find_licenses(spark.read.parquet(f"{data}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)
