"""Registered queries: splits, model checks, training and scoring."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from millrace.functions.numbers import FARE_BANDS
from millrace.operators import aggregates, answers, learn, quality, sampling, vectors
from millrace.operators.leafwise import LeafwiseTrees
from millrace.operators.search import halving_search
from millrace.plans.registry import Tables, query
from millrace.session import cut_lineage
from millrace.sources.catalog import drop_table

JUDGED_SQL = """
judged AS (
  SELECT l.doc_id, l.quality, l.toxic, d.lang, d.source, CAST(d.n_chars > 600 AS INTEGER) AS prediction, d.n_chars
  FROM labels l JOIN documents d USING (doc_id))"""


def judged(t: Tables):
    """Labelled documents; a rule on their length stands in for a model."""
    return t.labels.join(t.documents.select("doc_id", "lang", "source", "n_chars"), ["doc_id"]).withColumn(
        "prediction", (F.col("n_chars") > 600).cast("int")
    )


@query(f"""
WITH {JUDGED_SQL}
SELECT lang, toxic, CAST(sum(CAST(quality = prediction AS INTEGER)) AS BIGINT) AS acc, count(*) AS obs,
       avg(CAST(quality = prediction AS INTEGER)) AS pct_acc FROM judged GROUP BY lang, toxic""")
def slice_accuracy(t):
    return quality.slice_accuracy(judged(t), "lang,toxic", "quality", "prediction")


@query(f"""
WITH {JUDGED_SQL}, s AS (SELECT avg(CAST(quality = prediction AS INTEGER)) AS pct_acc FROM judged GROUP BY lang, toxic)
SELECT count(*) AS slices, min(pct_acc) AS worst, CAST(coalesce(min(pct_acc) >= 0.55, false) AS INTEGER) AS passed FROM s""")
def slice_gate(t):
    return quality.slice_gate(quality.slice_accuracy(judged(t), ["lang", "toxic"], "quality", "prediction"))


@query(f"WITH {JUDGED_SQL} SELECT quality, prediction, count(*) AS n FROM judged GROUP BY ALL")
def confusion(t):
    return quality.confusion(judged(t), "quality", "prediction")


@query(f"""
WITH {JUDGED_SQL}, c AS (
  SELECT CAST(sum(CAST(quality = 1 AND prediction = 1 AS INTEGER)) AS BIGINT) AS tp,
         CAST(sum(CAST(quality = 0 AND prediction = 1 AS INTEGER)) AS BIGINT) AS fp,
         CAST(sum(CAST(quality = 1 AND prediction = 0 AS INTEGER)) AS BIGINT) AS fn,
         CAST(sum(CAST(quality = 0 AND prediction = 0 AS INTEGER)) AS BIGINT) AS tn FROM judged)
SELECT *, (tp + tn) / nullif(tp + fp + fn + tn, 0) AS accuracy, tp / nullif(tp + fp, 0) AS precision,
       tp / nullif(tp + fn, 0) AS recall, 2 * tp / nullif(2 * tp + fp + fn, 0) AS f1 FROM c""")
def class_metrics(t):
    return quality.binary_metrics(judged(t), "quality", "prediction")


@query(f"""
WITH {JUDGED_SQL}, s AS (
  SELECT n_chars, sum(CAST(quality = 1 AS INTEGER)) AS p, sum(CAST(quality = 0 AS INTEGER)) AS n FROM judged GROUP BY ALL),
c AS (SELECT n_chars, CAST(sum(p) OVER w AS BIGINT) AS tp, CAST(sum(n) OVER w AS BIGINT) AS fp,
             sum(p) OVER () AS all_p, sum(n) OVER () AS all_n FROM s WINDOW w AS (ORDER BY n_chars DESC))
SELECT n_chars, tp, fp, tp / nullif(all_p, 0) AS tpr, fp / nullif(all_n, 0) AS fpr, tp / (tp + fp) AS precision FROM c""")
def roc_points(t):
    return quality.curve_points(judged(t), "n_chars", "quality")


PARTED_SQL = f"""{JUDGED_SQL}, parted AS (
  SELECT CASE WHEN doc_id % 10 < 6 THEN 'train' WHEN doc_id % 10 < 8 THEN 'validation' ELSE 'test' END AS part,
         quality, least(n_chars // 50, 39) / 40.0 AS score FROM judged)"""


def parted(t):
    """A score with many ties, in three parts."""
    digit = F.col("doc_id") % 10
    return judged(t).select(
        F.when(digit < 6, "train").when(digit < 8, "validation").otherwise("test").alias("part"), "quality",
        (F.least(F.floor(F.col("n_chars") / 50), F.lit(39)) / 40.0).alias("score"))


@query(f"""
WITH {PARTED_SQL}, pairs AS (
  SELECT a.part, avg(CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0.0 END) AS auc
  FROM parted a JOIN parted b ON a.part = b.part AND a.quality = 1 AND b.quality = 0 GROUP BY ALL)
SELECT part, count(*) AS n, round(any_value(auc), 9) AS auc,
       round(avg(-ln(CASE WHEN quality = 1 THEN greatest(score, 1e-15) ELSE 1 - score END)), 9) AS log_loss
FROM parted JOIN pairs USING (part) GROUP BY ALL""")
def probability_metrics(t):
    found = quality.probability_metrics(parted(t), "score", "quality", ["part"], bucket_rows=10)
    return found.withColumns({c: F.round(c, 9) for c in ("auc", "log_loss")})


@query(f"""
WITH {PARTED_SQL}
SELECT part, CAST(floor(score * 10) AS INTEGER) AS bin, count(*) AS n, round(avg(score), 9) AS mean_score,
       round(avg(CAST(quality = 1 AS DOUBLE)), 9) AS positive_share
FROM parted GROUP BY ALL""")
def calibration_bins(t):
    found = quality.calibration(parted(t), "score", "quality", ["part"])
    return found.withColumns({c: F.round(c, 9) for c in ("mean_score", "positive_share")})


# -- run tables, with events as the log of runs ------------------------------------------------

@query("""
SELECT event_id, ts, event_type, value FROM events WHERE event_type = 'purchase' ORDER BY ts DESC, event_id DESC LIMIT 1""")
def latest_row(t):
    return aggregates.latest_row(
        t.events.select("event_id", "ts", "event_type", "value"), "event_type", "purchase", "ts", "event_id"
    )


@query("""
SELECT event_id, event_type, CASE WHEN event_id % 5 > 0 THEN value END AS score FROM events
WHERE event_type = 'click' ORDER BY score DESC NULLS LAST, event_id LIMIT 1""")
def best_run(t):
    runs = t.events.select("event_id", "event_type", F.when(F.col("event_id") % 5 > 0, F.col("value")).alias("score"))
    return aggregates.best_run(runs, "score", status="event_type", finished="click", tie="event_id")


@query("SELECT max(CAST(user_id AS INTEGER)) AS version FROM events WHERE event_type = 'signup'")
def highest_version(t):
    versions = t.events.select("event_type", F.col("user_id").cast("int").alias("version"))
    return aggregates.highest(versions, "event_type", "signup", "version")


@query("SELECT p_partkey, p_name || ' ' || p_type AS description, CAST(length(p_name || ' ' || p_type) > 20 AS INTEGER) AS has_description FROM part")
def description_check(t):
    rows = t.part.select("p_partkey", F.concat_ws(" ", "p_name", "p_type").alias("description"))
    return quality.description_check(rows)


@query(f"""
WITH {JUDGED_SQL}, s AS (SELECT avg(CAST(quality = prediction AS INTEGER)) AS pct_acc FROM judged GROUP BY lang),
checks AS (SELECT CAST(min(pct_acc) >= 0.55 AS INTEGER) AS passed FROM s
           UNION ALL SELECT CAST(count(*) > 0 AS INTEGER) FROM judged)
SELECT count(*) AS checks, coalesce(min(passed), 0) AS accepted FROM checks""")
def release_decision(t):
    sliced = quality.slice_gate(quality.slice_accuracy(judged(t), ["lang"], "quality", "prediction"))
    gate = sliced.select(F.lit("slices").alias("check"), "passed")
    predicts = quality.scoring_check(t.spark, lambda: judged(t).select("prediction"))
    return quality.decision([gate, predicts])


# -- preparation -------------------------------------------------------------------------------

@query("""
WITH dirty AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 9 = 0 THEN ' ' ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS txt FROM lineitem),
     nums AS (SELECT l_orderkey, l_linenumber, TRY_CAST(txt AS DOUBLE) AS q FROM dirty),
     filled AS (SELECT l_orderkey, l_linenumber, coalesce(q, avg(q) OVER ()) AS quantity FROM nums)
SELECT l_orderkey, l_linenumber, round(quantity, 6) AS quantity,
       round((quantity - avg(quantity) OVER ()) / stddev_samp(quantity) OVER (), 6) AS scaled FROM filled""")
def impute_scale(t):
    text = F.when(F.col("l_partkey") % 9 == 0, " ").otherwise(F.col("l_quantity").cast("long").cast("string"))
    rows = learn.coerce_numeric(t.lineitem.select("l_orderkey", "l_linenumber", text.alias("quantity")), ["quantity"])
    filled = learn.impute_mean(rows, ["quantity"])
    scaled = learn.standardise(filled.withColumn("scaled", F.col("quantity")), ["scaled"])
    return scaled.withColumns({c: F.round(c, 6) for c in ("quantity", "scaled")})


# -- training and scoring ----------------------------------------------------------------------

def priced(t: Tables):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
        # The tables' prices do not depend on the other columns, so these set most of the price here.
        (F.col("l_quantity") * 1000 * (1 - F.col("l_discount")) + F.col("l_extendedprice") / 10).alias("price"), "l_returnflag", "l_linestatus",
    )


@query("""
SELECT l_orderkey, l_linenumber, true AS known_band, true AS better_than_mean FROM lineitem
WHERE substr(md5('123|' || l_orderkey || '|' || l_linenumber), 1, 8) >= 'c0000000'""")
def fare_model(t):
    """100 boosted trees for a price, trained on a hash split: bands and error on the rows held out."""
    train, test = sampling.hash_split(priced(t), ["l_orderkey", "l_linenumber"], 0.75, seed=123)
    model = learn.fare_regressor(train, "price", ["l_quantity", "l_discount", "l_tax"])
    scored = cut_lineage(model.transform(test).select("l_orderkey", "l_linenumber", "price", "prediction"), "scored")
    mean = train.agg(F.avg("price")).first()[0]
    error, of_mean = scored.agg(
        F.avg((F.col("price") - F.col("prediction")) ** 2), F.avg((F.col("price") - F.lit(mean)) ** 2)).first()
    bands = learn.banded(scored.withColumn("prediction", F.col("prediction") / 1000))
    return bands.select(
        "l_orderkey", "l_linenumber", F.col("prediction").isin([label for _, label in FARE_BANDS]).alias("known_band"),
        F.lit(error < of_mean).alias("better_than_mean"))


TRAITS = ["n_chars", "spaces", "digits", "capitals", "symbols", "lines", "different"]


def traits(t: Tables):
    """Shares of kinds of characters in the text of each labelled document, and of its words that differ."""
    text, size = F.coalesce("text", F.lit("")), F.greatest(F.length(F.coalesce("text", F.lit(""))), F.lit(1))
    words = F.split(text, "[ \\n]+")
    # What is left when runs of all other characters go: counting matches would make a list of them.
    others = {"spaces": "[^ ]+", "digits": "[^0-9]+", "capitals": "[^A-Z]+", "symbols": "[A-Za-z0-9 \\n]+", "lines": "[^\\n]+"}
    rows = t.documents.select(
        "doc_id", "n_chars", *[(F.length(F.regexp_replace(text, F.lit(p), F.lit(""))) / size).alias(n) for n, p in others.items()],
        (F.size(F.array_distinct(words)) / F.size(words)).alias("different"))
    return t.labels.select("doc_id", "quality").join(rows, "doc_id")


@query(f"""
WITH {JUDGED_SQL}
SELECT CASE WHEN doc_id % 4 = 0 THEN 'validation' ELSE 'train' END AS part, count(*) AS n,
       true AS below_base_rate FROM judged GROUP BY ALL""")
def leafwise_quality(t):
    """Leaf-wise trees for the quality label: log loss of both parts against that of the label's base rate.

    ``below_base_rate``: at most 0.7 times the loss of always saying the training part's share.
    """
    part = F.when(F.col("doc_id") % 4 == 0, "validation").otherwise("train")
    rows = cut_lineage(traits(t).withColumn("part", part), "traits")
    train = rows.filter("part = 'train'")
    model = LeafwiseTrees(
        inputCols=TRAITS, labelCol="quality", kind="logistic", rounds=10, leaves=16, rate=0.3, leastRows=3, l2=0.1).fit(train)
    share = train.agg(F.avg("quality")).first()[0] or 0.5
    scored = cut_lineage(model.transform(rows).select("part", "quality", "score"), "scores")
    found = quality.probability_metrics(scored, "score", "quality", ["part"])
    base = quality.probability_metrics(scored.withColumn("score", F.lit(share)), "score", "quality", ["part"])
    base = base.select("part", F.col("log_loss").alias("base_loss"))
    return found.join(base, "part").select("part", "n", (F.col("log_loss") <= 0.7 * F.col("base_loss")).alias("below_base_rate"))


@query("""
WITH hashed AS (SELECT md5('124|' || l_orderkey || '|' || l_linenumber) AS h FROM lineitem
                WHERE substr(md5('123|' || l_orderkey || '|' || l_linenumber), 1, 8) < 'c0000000'),
rungs(rung, share, edge, tried, kept) AS (VALUES (0, 1.0 / 9, '1c71c71c', 4, 2), (1, 1.0 / 3, '55555555', 2, 1), (2, 1.0, 'g', 1, 1))
SELECT rung, round(CAST(share AS DOUBLE), 6) AS share, (SELECT count(*) FROM hashed WHERE substr(h, 1, 8) < edge) AS sample_rows,
       CAST(tried AS BIGINT) AS tried, CAST(kept AS BIGINT) AS kept, true AS learns FROM rungs""")
def halving_search_rungs(t):
    """Four settings on a ninth of the rows, two on a third, the best on all: rungs as the search went.

    ``learns``: the settings whose step is too small to learn were left behind.
    """
    settings = [{"rate": rate, "leaves": leaves} for rate in (1e-6, 0.5) for leaves in (2, 8)]
    found = halving_search(
        priced(t), ["l_orderkey", "l_linenumber"], settings,
        lambda sample, s: LeafwiseTrees(inputCols=["l_quantity", "l_discount", "l_tax"], labelCol="price", rounds=2, **s).fit(sample),
        lambda scored: learn.regression_rmse(scored, "price"), keep=0.5, seconds=3600)
    learns = F.min(~F.col("kept") | F.col("setting").contains("0.5"))
    return found.tries.groupBy("rung", "share").agg(
        F.max("rows").alias("sample_rows"), F.count("*").alias("tried"), F.count_if("kept").alias("kept"), learns.alias("learns")
    ).withColumn("share", F.round("share", 6))


@query(f"""
WITH {JUDGED_SQL}, sizes AS (SELECT quality, count(*) AS n, CAST(ceil(count(*) * 0.75) AS BIGINT) AS k FROM judged GROUP BY quality)
SELECT 'train' AS dataset, CAST(sum(k) AS BIGINT) AS row_count, true AS learned FROM sizes
UNION ALL SELECT 'validation', CAST(sum(n - k) AS BIGINT), true FROM sizes""")
def churn_model_metrics(t):
    """Boosted trees of depth 8 on a row share each, on a stratified split; both parts measured.

    ``learned``: on the training part no worse than always saying the more frequent label.
    """
    rows = cut_lineage(sampling.stratified_split(judged(t).drop("prediction"), "doc_id", "quality", 0.75, seed=520), "split")
    train, test = rows.filter("is_train = 1"), rows.filter("is_train = 0")
    model = learn.churn_classifier(
        train, "quality", numeric=["n_chars"], categorical=["lang", "source"], passthrough=["toxic"], depth=8, subsample=0.8)
    metrics = learn.evaluate_sets({"train": model.transform(train), "validation": model.transform(test)}, "quality")
    frequent = rows.groupBy("is_train").agg(F.count("*").alias("row_count"), F.avg("quality").alias("share")).select(
        F.when(F.col("is_train") == 1, "train").otherwise("validation").alias("dataset"), "row_count",
        F.greatest("share", 1 - F.col("share")).alias("share"))
    learned = (F.col("dataset") == "validation") | (F.col("accuracy") >= F.col("share"))
    return metrics.join(frequent, "dataset").select("dataset", "row_count", learned.alias("learned"))


@query(f"WITH {JUDGED_SQL} SELECT doc_id, quality, true AS known_label FROM judged")
def searched_model_scores(t):
    """The better of two tree depths on a held-out part, applied to all labelled documents."""
    rows = judged(t).drop("prediction")
    search = learn.model_search(rows, "quality", ["n_chars"], ["lang"])
    scored = search.bestModel.transform(rows)
    return scored.select("doc_id", "quality", F.col("prediction").isin(0.0, 1.0).alias("known_label"))


@query(f"WITH {JUDGED_SQL} SELECT doc_id, true AS known_label FROM judged")
def scores_saved_as_table(t):
    """A classifier's scores saved as a table of key and prediction, and read back."""
    rows = judged(t).drop("prediction")
    model = learn.churn_classifier(rows, "quality", numeric=["n_chars"], categorical=["lang"], rounds=5)
    name = f"scores_{uuid.uuid4().hex[:8]}"
    table = learn.score_to_table(rows, model, "doc_id", name)
    kept = cut_lineage(table.select("doc_id", F.col("prediction").isin(0.0, 1.0).alias("known_label")), "scores")
    drop_table(t.spark, name)
    return kept


@query("""
SELECT l_orderkey, l_linenumber, l_quantity * 2.0 + l_tax AS prediction FROM lineitem""")
def column_model_scores(t):
    """A model that is a Python function, used as a column function and from SQL."""
    learn.register_model(t.spark, "millrace_price", lambda x: x["l_quantity"] * 2.0 + x["l_tax"])
    return t.lineitem.selectExpr(
        "l_orderkey", "l_linenumber", "millrace_price(struct(l_quantity, l_tax)) AS prediction"
    )


@query("""
WITH words AS (
  SELECT doc_id, unnest(list_filter(regexp_split_to_array(lower(text), '[^a-z0-9_]+'), lambda w: w <> '')) AS word FROM documents),
slots AS (
  SELECT doc_id, CAST('0x' || substr(md5(word), 1, 8) AS BIGINT) % 256 AS slot, count(*) AS tf FROM words GROUP BY ALL),
weights AS (
  SELECT doc_id, slot, tf * ln(((SELECT count(*) FROM documents) + 1) / (count(*) OVER (PARTITION BY slot) + 1)) AS w FROM slots)
SELECT doc_id, CAST(slot AS INTEGER) AS slot, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 4) AS weight FROM weights
WHERE w > 0""")
def document_vectors(t):
    """TF-IDF vectors of whole documents, one row for each slot that is not 0."""
    weighted = vectors.sentence_vectors(t.documents.select("doc_id", "text"), "text", kind="double").drop("text")
    slots = weighted.select("doc_id", F.posexplode("vector").alias("slot", "weight")).filter("weight > 0")
    return slots.select("doc_id", "slot", F.round("weight", 4).alias("weight"))


@query()
def dense_document_vectors(t):
    """Whole documents in the 64 directions in which their TF-IDF vectors vary most."""
    return vectors.dense_vectors(t.documents.select("doc_id", "text"), "text").drop("text")


# -- answers -----------------------------------------------------------------------------------

def _words(text: str) -> str:
    return f"list_distinct(list_filter(regexp_split_to_array(lower({text}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> ''))"


ANSWERS_SQL = f"""
pairs AS (
  SELECT a.conv_id, a.turn, a.text AS response, q.text AS expected, {_words('a.text')} AS got, {_words('q.text')} AS want
  FROM conversations a JOIN conversations q ON a.conv_id = q.conv_id AND a.turn = q.turn + 1 WHERE a.role = 'assistant'),
scored AS (
  SELECT conv_id, turn, CAST(trim(response) = trim(expected) AS INTEGER) AS exact_match,
         len(list_intersect(got, want)) / nullif(len(got), 0) AS word_precision,
         len(list_intersect(got, want)) / nullif(len(want), 0) AS word_recall,
         2 * len(list_intersect(got, want)) / nullif(len(got) + len(want), 0) AS word_f1,
         len(list_intersect(got, want)) / nullif(len(got), 0) AS context_coverage
  FROM pairs)"""


def answer_pairs(t: Tables):
    """Assistant turns as answers; the turn before stands in for expected answer and context."""
    asked = t.conversations.select(
        "conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("expected_response"),
        F.array(F.struct(F.col("role").alias("doc_uri"), F.col("text").alias("content"))).alias("retrieved_context"),
    )
    given = t.conversations.filter("role = 'assistant'").select("conv_id", "turn", F.col("text").alias("response"))
    return given.join(asked, ["conv_id", "turn"])


@query(f"WITH {ANSWERS_SQL} SELECT * FROM scored")
def answer_scores(t):
    return answers.evaluate_answers(answer_pairs(t)).drop("response", "expected_response", "retrieved_context")


@query(f"""
WITH {ANSWERS_SQL}
SELECT count(*) AS answers, avg(exact_match) AS mean_exact_match, round(avg(word_precision), 9) AS mean_word_precision,
       round(avg(word_recall), 9) AS mean_word_recall, round(avg(word_f1), 9) AS mean_word_f1,
       round(avg(context_coverage), 9) AS mean_context_coverage FROM scored""")
def answer_summary(t):
    summary = answers.answer_summary(answers.evaluate_answers(answer_pairs(t)))
    rounded = ["mean_word_precision", "mean_word_recall", "mean_word_f1", "mean_context_coverage"]
    return summary.withColumns({c: F.round(c, 9) for c in rounded})
