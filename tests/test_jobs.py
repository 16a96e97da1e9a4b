"""Generated data, customer-360, models, answers."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import answers, learn, synth, vectors
from millrace.plans.customers import customer_360
from millrace.streaming import silver


def test_cohorts(spark):
    assert synth.users_total() == 101_333
    people = synth.users(spark, partitions=8)
    assert people.count() == 101_333
    stats = people.agg(
        F.count_if(F.col("id").isNull()).alias("no_id"), F.countDistinct("id").alias("ids"),
        F.min("gender").alias("g0"), F.max("gender").alias("g1"), F.max("age_group").alias("a1"),
        F.count_if(F.col("canal").isNull()).alias("no_canal"),
    ).first()
    assert 1700 < stats["no_id"] < 2350 and stats["ids"] == 101_333 - stats["no_id"]
    assert (stats["g0"], stats["g1"], stats["a1"]) == (0.0, 1.0, 10.0) and 900 < stats["no_canal"] < 1400
    years = people.select(F.substring("creation_date", 7, 4).cast("int").alias("y")).filter("y < 2016").count()
    assert years == synth.OLD_USERS


def test_from_raw_to_customer_360(spark):
    people = synth.users(spark).limit(3000)
    orders = synth.user_orders(people.filter("id IS NOT NULL"), "id")
    per_user = orders.groupBy("user_id").count().agg(F.max("count").alias("m")).first()["m"]
    assert 5 < per_user < 13
    assert {r[0] for r in orders.select("item_count").distinct().collect()} == {1.0, 2.0, 3.0}
    events = synth.user_events(orders)
    assert events.count() == orders.count()
    assert synth.user_events(orders, events_per_order=4).count() == 4 * orders.count()
    labelled = synth.label_churn(people, orders, events)
    assert labelled.columns == [*people.columns, "churn"]
    share = labelled.agg(F.avg(F.col("churn").cast("int"))).first()[0]
    assert 0.2 < share < 0.9
    table = customer_360(
        silver.silver_users(labelled), silver.silver_orders(orders), events, as_of=F.lit("2024-02-01").cast("date")
    )
    rows = table.count()
    assert rows == labelled.count() == orders.select("user_id").distinct().count()
    assert {"order_count", "total_amount", "total_item", "platform", "event_count", "session_count", "last_event",
            "days_since_creation", "days_since_last_activity", "days_last_event"} <= set(table.columns)
    assert table.agg(F.sum("order_count")).first()[0] == orders.count()


def test_crm(spark):
    customers = synth.crm_customers(spark.range(1, 1001))
    orders, contacts = synth.crm_orders(spark.range(1, 301)), synth.crm_interactions(spark.range(1, 501))
    assert (customers.count(), orders.count(), contacts.count()) == (1000, 300, 500)
    assert orders.join(customers, "customer_id", "left_anti").count() == 0
    assert {r[0] for r in contacts.select("channel").distinct().collect()} == set(synth.CHANNELS)
    assert dict(orders.dtypes) == {"order_id": "bigint", "customer_id": "bigint", "order_date": "date", "amount": "bigint"}
    assert contacts.filter("notes IS NULL OR interaction_date IS NULL OR year(interaction_date) <> 2024").count() == 0


def points(spark, n=400):
    return spark.range(n).select(
        "id", (F.col("id") % 20).cast("double").alias("x"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("c"),
    ).withColumn("y", (F.col("x") >= 10).cast("int")).withColumn("price", F.col("x") * 3.0)


def test_regression_and_bands(spark):
    model = learn.fare_regressor(points(spark), "price", ["x"], rounds=5)
    scored = model.transform(points(spark))
    assert learn.regression_rmse(scored, "price") < 3
    assert {r[0] for r in learn.banded(scored).select("prediction").distinct().collect()} <= {"$0 - $9.99", "$10 - $19.99", " > $20"}


def test_classifier_copes_with_unknown_categories_and_nulls(spark):
    model = learn.churn_classifier(points(spark), "y", numeric=["x"], categorical=["c"], rounds=3, depth=2)
    odd = points(spark, 3).withColumn("c", F.lit("never seen")).withColumn("x", F.lit(None).cast("double"))
    assert model.transform(odd).count() == 3
    metrics = learn.evaluate_sets({"train": model.transform(points(spark))}, "y").first()
    assert metrics["accuracy"] > 0.95 and metrics["dataset"] == "train"
    got = learn.score_to_table(points(spark), model, "id", "t_scores")
    assert got.columns == ["id", "prediction"] and got.count() == 400
    spark.sql("DROP TABLE t_scores")


def test_search(spark):
    search = learn.model_search(points(spark), "y", ["x"], depths=(1, 2), rounds=2)
    assert len(search.validationMetrics) == 2 and max(search.validationMetrics) > 0.9


def test_preparation(spark):
    df = spark.createDataFrame([("1",), ("3",), (" ",), ("x",)], "v string")
    filled = learn.impute_mean(learn.coerce_numeric(df, ["v"]), ["v"])
    assert [r["v"] for r in filled.collect()] == [1.0, 3.0, 2.0, 2.0]
    scaled = learn.standardise(filled, ["v"]).agg(F.avg("v").alias("m"), F.stddev_samp("v").alias("s")).first()
    assert scaled["m"] == pytest.approx(0) and scaled["s"] == pytest.approx(1)
    same = learn.standardise(spark.range(3).select(F.lit(4.0).alias("v")), ["v"])
    assert {r["v"] for r in same.collect()} == {0.0}


def test_column_model(spark):
    twice = learn.column_model(lambda x: x["x"] * 2)
    got = points(spark, 5).select(twice(F.struct("x", "id")).alias("p"))
    assert [r["p"] for r in got.collect()] == [0.0, 2.0, 4.0, 6.0, 8.0]


def test_vectors(spark):
    df = spark.createDataFrame([(1, "one two"), (2, "one two"), (3, "three")], "id int, text string")
    got = {r["id"]: r["vector"] for r in vectors.sentence_vectors(df, "text", dims=32).collect()}
    assert got[1] == got[2] != got[3] and sum(v * v for v in got[1]) == pytest.approx(1, abs=1e-5)

    def load():
        return lambda texts: [[len(t), 1] for t in texts]

    own = learn.encode_with(df, "text", load).collect()
    assert [list(r["vector"]) for r in own] == [[7, 1], [7, 1], [5, 1]]


def test_answers(spark):
    rows = [
        ("Spark is fast.", "Spark is fast.", [("d1", "Spark, a fast engine")]),
        ("Not possible", "Use the toPandas method", [("d2", "call toPandas")]), ("", None, []),
    ]
    df = spark.createDataFrame(
        rows, "response string, expected_response string, retrieved_context array<struct<doc_uri: string, content: string>>"
    )
    a, b, c = answers.evaluate_answers(df).collect()
    assert (a["exact_match"], a["word_f1"], a["context_coverage"]) == (1, 1.0, pytest.approx(2 / 3))
    assert (b["exact_match"], b["word_precision"], b["word_recall"], b["context_coverage"]) == (0, 0.0, 0.0, 0.0)
    assert (c["exact_match"], c["word_precision"]) == (0, None)
    assert answers.answer_summary(answers.evaluate_answers(df)).first()["answers"] == 3
    chat = spark.createDataFrame(
        [((([("user", "hi"), ("user", "how?")]),),)], "request struct<messages: array<struct<role: string, content: string>>>"
    )
    assert chat.select(answers.request_text(chat).alias("t")).first()["t"] == "how?"
    plain = spark.createDataFrame([("q",)], "request string")
    assert plain.select(answers.request_text(plain).alias("t")).first()["t"] == "q"


def test_trees_get_rows_that_are_alike_once(spark, monkeypatch):
    """400 rows with 20 values: the passes of the boosting read 20 rows, and rare values keep bins of their own."""
    read, fit = [], learn.GBTRegressor.fit
    monkeypatch.setattr(learn.GBTRegressor, "fit", lambda self, rows: read.append(rows.count()) or fit(self, rows))
    rare = F.when(F.col("id") == 7, -5.0).otherwise(F.col("x"))
    rows = points(spark).withColumn("x", rare).withColumn("price", F.when(F.col("x") < 0, 90.0).otherwise(F.col("x") * 3))
    model = learn.fare_regressor(rows, "price", ["x"], rounds=5)
    assert read == [21]
    found = model.transform(rows.filter("id = 7").union(rows.filter("id = 5"))).select("prediction").collect()
    assert abs(found[0][0] - 90) < 5 and abs(found[1][0] - 15) < 5


def test_trees_refuse_missing_labels(spark):
    rows = points(spark).withColumn("price", F.when(F.col("id") > 3, F.col("price")))
    with pytest.raises(Exception, match="(?i)label"):
        learn.fare_regressor(rows, "price", ["x"], rounds=2)
