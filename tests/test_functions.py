"""Names, times, numbers, texts and hash draws."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace import functions as fn
from millrace.functions.names import SNAKE_REPAIRS


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize("raw, clean", [
    ("customerID", "customer_id"), ("StreamingTV", "streaming_tv"), ("gender", "gender"),
    ("SeniorCitizen", "senior_citizen"), ("Total Charges (net)", "total__charges_net"), ("A__B", "a__b"),
])
def test_bronze_names(spark, raw, clean):
    assert fn.clean_columns(spark.createDataFrame([(1,)], [raw])).columns == [clean]


def test_bronze_rule_alone_splits_acronyms():
    assert fn.bronze_name("StreamingTV") in SNAKE_REPAIRS


@pytest.mark.parametrize("raw, clean", [
    ("payment_method_Credit card (automatic)", "payment_method_credit_card__automatic_"),
    ("payment_method_Bank transfer (automatic)", "payment_method_bank_transfer__automatic_"),
    ("contract_Month-to-month", "contract_month_to_month"),
    ("multiple_lines_No phone service", "multiple_lines_no_phone_service"),
])
def test_feature_names(raw, clean):
    assert fn.feature_name(raw) == clean


def test_colliding_names_are_an_error(spark):
    with pytest.raises(ValueError, match="collide"):
        fn.clean_columns(spark.createDataFrame([(1, 2)], ["aB", "a_b"]))


@pytest.mark.parametrize("value, label", [
    (9.99, "$0 - $9.99"), (10.0, "$10 - $19.99"), (19.99, "$10 - $19.99"), (20.0, " > $20"), (-1.0, "$0 - $9.99"),
    (None, None),
])
def test_fare_bands(spark, value, label):
    assert one(spark, fn.fare_band(F.lit(value).cast("double"))) == label


@pytest.mark.parametrize("text, flag", [
    ("2024-01-06 03:00:00", 0),  # still Friday in New York
    ("2024-01-06 12:00:00", 1), ("2024-01-08 04:59:59", 1), ("2024-01-08 05:00:00", 0), (None, None),
])
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_weekend_in_new_york(spark, text, flag, kind):
    assert one(spark, fn.weekend_flag(F.lit(text).cast(kind))) == flag


def test_weekend_source_zone(spark):
    late_friday = F.lit("2024-01-05 23:30:00").cast("timestamp_ntz")
    assert one(spark, fn.weekend_flag(late_friday, source_zone="America/New_York")) == 0
    assert one(spark, fn.weekend_flag(late_friday, zone="Asia/Tokyo", source_zone="UTC")) == 1


@pytest.mark.parametrize("text, parsed", [
    ("03-09-2016 00:05:06", datetime(2016, 3, 9, 0, 5, 6)), ("03-09-2016 7:05:06", None),
    ("2016-03-09", None), ("13-01-2016 00:00:00", None), (None, None),
])
def test_parse_timestamp(spark, text, parsed):
    if text and " 7:" in text:  # one-digit hours need the one-letter pattern
        assert one(spark, fn.parse_timestamp(F.lit(text), "MM-dd-yyyy H:mm:ss")) == datetime(2016, 3, 9, 7, 5, 6)
    else:
        assert one(spark, fn.parse_timestamp(F.lit(text))) == parsed


def test_strict_parse_raises(spark):
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP|parse"):
        one(spark, fn.parse_timestamp(F.lit("bad"), strict=True))


@pytest.mark.parametrize("text, number, whole", [("7.9", 7.9, 7), (" ", None, None), ("x", None, None), (None, None, None), ("-2", -2.0, -2)])
def test_lenient_numbers(spark, text, number, whole):
    c = F.lit(text).cast("string")
    assert one(spark, fn.lenient_double(c)) == number
    assert one(spark, fn.lenient_int(c)) == whole


def test_label_mapping(spark):
    rows = spark.createDataFrame([("Yes",), ("No",), ("Maybe",), (None,)], "s string")
    got = rows.select(fn.label_to_int("s", {"Yes": 1, "No": 0}).alias("n"))
    assert got.dtypes == [("n", "int")]
    assert [r["n"] for r in got.collect()] == [1, 0, None, None]


def test_text_functions(spark):
    assert one(spark, fn.swap_url_host(F.lit("http://a.example.com/x/y?z"))) == "https://shop.example.com/x/y?z"
    assert one(spark, fn.swap_url_host(F.lit("no url"))) == "no url"
    assert len(one(spark, fn.pseudonym(F.lit("a@b.example")))) == 40
    assert one(spark, fn.initial_caps(F.lit("aNNA maria-lou"))) == "Anna Maria-lou"
    assert one(spark, fn.name_like(F.lit("big"), "%G%")) is True


def test_days_and_millis(spark):
    c = F.lit("2024-01-01 23:59:59").cast("timestamp")
    assert one(spark, fn.days_between(c, F.lit("2024-01-03").cast("date"))) == 2
    assert one(spark, fn.epoch_millis(F.lit(1_458_081_226_051))) == datetime(2016, 3, 15, 22, 33, 46, 51000)
    assert one(spark, fn.whole_second(F.lit("2024-01-01 00:00:01.75").cast("timestamp"))) == datetime(2024, 1, 1, 0, 0, 1)
    assert one(spark, fn.formatted(c)) == "01-01-2024 23:59:59"


def test_draws_depend_on_the_key_only(spark):
    def draws(df):
        return {r["id"]: (r["u"], r["p"]) for r in df.select(
            "id", fn.unit_of(5, "u", "id").alias("u"),
            fn.pick_weighted((("a", 0.5), ("b", 0.3), (None, 0.1)), 5, "p", "id").alias("p"),
        ).collect()}

    first = draws(spark.range(2000))
    assert first == draws(spark.range(2000).repartition(7))
    assert all(0 <= u < 1 for u, _ in first.values())
    share = {v: sum(p == v for _, p in first.values()) / 2000 for v in ("a", "b", None)}
    assert abs(share["a"] - 5 / 9) < 0.05 and abs(share["b"] - 3 / 9) < 0.05 and abs(share[None] - 1 / 9) < 0.05


def test_normal_draws(spark):
    stats = spark.range(5000).select(fn.normal_of(3.0, 2.0, 1, "n", "id").alias("n")).agg(
        F.avg("n").alias("mean"), F.stddev("n").alias("sd")
    ).first()
    assert abs(stats["mean"] - 3) < 0.15 and abs(stats["sd"] - 2) < 0.15
