"""Quality rules: a table of thresholds that becomes one projection of built-in functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import let, whole, words_of

# Frequent function words of English, French, German and Spanish, in lower case.
STOP_WORDS = (
    "the of and to in is that it for was on are as with be by at this or an "
    "le la les de des du et un une en que qui pour dans sur au aux ce il elle par "
    "der die das und ein eine zu den von mit ist im nicht auf dem sich des für "
    "el los las y se del que con su por para no una es al lo como"
).split()
# Characters counted as symbols, and marks of shouting.
SYMBOLS, SHOUTS = "#*$%&|<>", "!?"


@dataclass(frozen=True)
class Rule:
    """Keep a text if ``low * per <= value <= high * per``, both counts of that text."""

    value: str
    per: str | None = None
    low: float | None = None
    high: float | None = None


RULES = (
    Rule("n_words", low=50),
    Rule("word_chars", per="n_words", low=1.5, high=14),
    Rule("n_symbols", per="n_words", high=0.15),
    Rule("n_shouts", per="n_words", high=0.2),
    Rule("n_stop_words", per="n_words", low=0.04),
    Rule("n_dup_lines", per="n_lines", high=0.4),
    Rule("n_repeat_words", per="n_words", high=0.5),
)


def _covered(at: Column, window: int) -> Column:
    """Number of words in windows that start at these rising places."""
    return F.aggregate(
        F.transform(at, lambda p, k: F.least(F.lit(window).cast("long"), F.coalesce(F.get(at, k + 1) - p, F.lit(window)))),
        F.lit(0).cast("long"), lambda a, b: a + b,
    )


def _covered_by_text(words: Column, window: int) -> Column:
    """As ``repeated_words``, from the sorted texts of the windows themselves."""
    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - window),
        lambda i: F.struct(_window(words, i, window).alias("text"), i.cast("long").alias("at")),
    )
    return let(F.sort_array(windows), lambda s: let(
        F.sort_array(F.transform(
            F.filter(s, lambda x, k: (x["text"] == F.get(s, k - 1)["text"]) | (x["text"] == F.get(s, k + 1)["text"])),
            lambda x: x["at"],
        )),
        lambda at: _covered(at, window),
    ))


def _window(words: Column, start: Column, window: int) -> Column:
    return F.concat_ws(" ", *[F.get(words, start.cast("int") + j) for j in range(window)])


def repeated_words(words: Column, window: int = 3) -> Column:
    """How many words lie in windows of so many words that occur more than once in the text.

    Each window becomes one long: its hash, and its place in the lowest bits. Once these are
    sorted, equal windows are neighbours. If any neighbours with one hash differ in their words,
    the text is counted again by the windows' words, so the number is exact. Time n log n in the
    words. Every value that a lambda uses is bound by ``let``, else it is computed for each word.
    """
    def count(w: Column, bits: Column) -> Column:
        key = lambda x: F.call_function("shiftright", x, bits)
        at = lambda x: x.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1)
        hashed = F.transform(
            F.sequence(F.lit(0), F.size(w) - window),
            lambda i: F.call_function("shiftleft", F.xxhash64(*[F.get(w, i + j) for j in range(window)]), bits)
            .bitwiseOR(i.cast("long")),
        )
        twice = let(F.sort_array(hashed), lambda s: F.filter(
            s, lambda x, k: (key(x) == key(F.get(s, k - 1))) | (key(x) == key(F.get(s, k + 1)))))

        def sure(d: Column) -> Column:
            return F.forall(F.sequence(F.lit(1), F.size(d) - 1), lambda k: (key(F.get(d, k)) != key(F.get(d, k - 1))) | (
                _window(w, at(F.get(d, k)), window) == _window(w, at(F.get(d, k - 1)), window)))

        return let(twice, lambda d: F.when(F.size(d) == 0, F.lit(0).cast("long")).when(
            sure(d), let(F.sort_array(F.transform(d, at)), lambda p: _covered(p, window))
        ).otherwise(_covered_by_text(w, window)))

    return let(words, lambda w: F.when(
        F.size(w) >= window, let(F.length(F.bin(F.size(w).cast("long"))), lambda bits: count(w, bits))
    ).otherwise(F.lit(0).cast("long")))


def counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The counts that the rules compare, beside the given columns."""
    text, stop = whole(text_col), sorted(set(STOP_WORDS))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    by_word = let(words_of(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.size(F.filter(w, lambda x: x.isin(stop))).cast("long").alias("n_stop_words"),
        repeated_words(w).alias("n_repeat_words"),
    ))
    by_line = let(lines, lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"),
        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    ))
    found = df.withColumns({"_by_word": by_word, "_by_line": by_line}).withColumns({
        "n_symbols": F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long"),
        "n_shouts": F.regexp_count(text, F.lit(f"[{SHOUTS}]")).cast("long"),
    })
    return found.select("*", "_by_word.*", "_by_line.*").drop("_by_word", "_by_line")


def verdict(rules=RULES) -> Column:
    """True where the counts meet every rule."""
    kept = F.lit(True)
    for rule in rules:
        per = F.col(rule.per) if rule.per else F.lit(1)
        if rule.low is not None:
            kept = kept & (F.col(rule.value) >= F.lit(rule.low) * per)
        if rule.high is not None:
            kept = kept & (F.col(rule.value) <= F.lit(rule.high) * per)
    return kept


def judge(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), rules=RULES) -> DataFrame:
    """One row for each text with its counts, ``base_failed`` and ``kept``.

    ``base_failed``: fewer than 50 words, or over half of them in repeated windows. A null text
    counts as empty and fails. Repeated rows are judged alike; an empty table gives no rows. Only
    the columns in ``keep`` are carried, so others may have any name.
    """
    found = counts(df.select(*keep, text_col), text_col)
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return found.withColumn("base_failed", base).withColumn("kept", ~base & verdict(rules)).drop(text_col)
