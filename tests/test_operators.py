"""Window borders, as-of edges, one-hot, splits and running totals, against brute force."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.operators import aggregates, filters, onehot, quality, sampling
from millrace.operators.asof import Features, asof_join, asof_join_all, keyed_lookup
from millrace.operators.keys import hot_groups
from millrace.operators.ranks import running_total
from millrace.operators.windows import sliding_mean_count
from millrace.plans.features import CHURN_CATEGORIES, churn_features, dropoff_features, pickup_features, unmapped_labels

T0 = datetime(2024, 1, 6, 12, 0)


def at(minutes, micros=0):
    return T0 + timedelta(minutes=minutes, microseconds=micros)


# -- windows -----------------------------------------------------------------------------------

def trips(spark, rows):
    schema = "pickup_zip int, dropoff_zip int, tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, fare_amount double"
    return spark.createDataFrame(rows, schema)


def test_row_on_a_border_starts_a_window(spark):
    df = trips(spark, [(1, 1, at(0), at(0), 10.0), (1, 1, at(0, -1), at(0, -1), 20.0)])
    got = {r["ts"]: (r["mean_fare_window_1h_pickup_zip"], r["count_trips_window_1h_pickup_zip"])
           for r in pickup_features(df).collect()}
    assert got == {at(0): (20.0, 1), at(15): (15.0, 2), at(30): (15.0, 2), at(45): (15.0, 2), at(60): (10.0, 1)}
    half = {r["ts"]: r["count_trips_window_30m_dropoff_zip"] for r in dropoff_features(df).collect()}
    assert half == {at(0): 1, at(30): 1}


def test_feature_types_and_weekend(spark):
    df = trips(spark, [(1, 2, at(0), at(5), 10.0)])
    assert pickup_features(df).dtypes == [
        ("zip", "int"), ("ts", "timestamp"), ("mean_fare_window_1h_pickup_zip", "float"),
        ("count_trips_window_1h_pickup_zip", "int"),
    ]
    assert dropoff_features(df).collect()[0].asDict() == {
        "zip": 2, "ts": at(30), "count_trips_window_30m_dropoff_zip": 1, "dropoff_is_weekend": 1,
    }


def test_null_values_and_keys_in_windows(spark):
    df = trips(spark, [(None, 1, at(0), at(0), None), (None, 1, at(1), at(1), 4.0)])
    got = [r for r in pickup_features(df).collect() if r["ts"] == at(60)]
    assert [(r["zip"], r["mean_fare_window_1h_pickup_zip"], r["count_trips_window_1h_pickup_zip"]) for r in got] == [(None, 4.0, 2)]


@pytest.mark.parametrize("start, end, kept", [
    (None, None, [0, 10, 20]), (at(10), None, [10, 20]), (None, at(10), [0]), (at(10), at(20), [10]), (at(5), at(6), []),
])
def test_time_range(spark, start, end, kept):
    df = spark.createDataFrame([(at(m), m) for m in (0, 10, 20)], "ts timestamp, m int")
    assert sorted(r["m"] for r in filters.time_range(df, "ts", start, end).collect()) == kept


def test_whole_windows_match_an_unbounded_run(spark):
    rng = random.Random(1)
    df = trips(spark, [(rng.randrange(3), 1, at(rng.randrange(600)), at(0), float(rng.randrange(50))) for _ in range(400)])
    start, end = at(100), at(400)  # not on a window border
    full = {tuple(r) for r in pickup_features(df).collect() if start < r["ts"] <= end}
    ranged = pickup_features(df, start=start, end=end, whole_windows=True)
    assert {tuple(r) for r in ranged.collect()} == full
    cut = {tuple(r) for r in pickup_features(df, start=start, end=end).collect()}
    assert cut != full


def test_panes_equal_direct_windows(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(2), 1, at(rng.randrange(300), rng.randrange(10**6)), at(0), rng.choice([None, 1.0, 2.5, 8.0])) for _ in range(300)]
    df = trips(spark, rows)
    assert sorted(map(tuple, pickup_features(df, panes=True).collect()), key=str) == sorted(
        map(tuple, pickup_features(df).collect()), key=str
    )
    assert sliding_mean_count(df, "pickup_zip", "tpep_pickup_datetime", "fare_amount", 4, "15 minutes").count() > 0


# -- as-of -------------------------------------------------------------------------------------

def brute_asof(lookups, features, inclusive):
    """For each (id, key, time): the features of the last row before it."""
    out = {}
    for i, key, ts in lookups:
        seen = [f for f in features if key is not None and ts is not None and f[0] == key and f[1] is not None
                and (f[1] < ts or (inclusive and f[1] == ts))]
        out[i] = max(seen, key=lambda f: f[1])[2] if seen else None
    return out


def random_asof(seed, rows=250):
    rng = random.Random(seed)

    def key():
        return rng.choice([1, 1, 1, 1, 1, 2, 3, None])

    lookups = [(i, key(), rng.choice([None] + [at(60 * rng.randrange(40)) for _ in range(9)])) for i in range(rows)]
    lookups += [(rows + i, 1, at(60 * 7)) for i in range(60)]  # many lookups at one instant
    times = {(key(), at(60 * rng.randrange(40))) for _ in range(rows)}
    features = [(k, ts, rng.choice([None, rng.randrange(100)])) for k, ts in sorted(times, key=str)]
    features.append((1, None, 7))
    return lookups, features


@pytest.mark.parametrize("inclusive", [False, True])
@pytest.mark.parametrize("options", [
    {"hot_keys": None}, {"max_group_rows": 20, "bin_seconds": 4 * 3600}, {"hot_keys": [(1,)], "max_group_rows": 5},
    {"max_group_rows": 1, "bin_seconds": 10**9},
])
@pytest.mark.parametrize("seed", [1, 2])
def test_asof_equals_brute_force(spark, seed, options, inclusive):
    lookups, features = random_asof(seed)
    left = spark.createDataFrame(lookups, "id int, k int, t timestamp_ntz")
    right = spark.createDataFrame(features, "key int, ts timestamp_ntz, v int")
    got = asof_join(
        left, right, keys="k", right_keys="key", left_ts="t", right_ts="ts", values=["v"], inclusive=inclusive, **options
    )
    assert got.columns == ["id", "k", "t", "v"]
    rows = got.collect()
    assert len(rows) == len(lookups)
    assert {r["id"]: r["v"] for r in rows} == brute_asof(lookups, features, inclusive)


@pytest.mark.parametrize("options", [{"hot_keys": None}, {"max_group_rows": 15, "bin_seconds": 6 * 3600}])
def test_two_feature_tables_in_one_join(spark, options):
    lookups, first = random_asof(3)
    _, second = random_asof(4, rows=30)
    left = spark.createDataFrame(lookups, "id int, k int, t timestamp")
    frames = [spark.createDataFrame(f, f"key int, ts timestamp, v{i} int") for i, f in enumerate([first, second])]
    got = asof_join_all(
        left, [Features(f, ["key"], "ts", [f"v{i}"]) for i, f in enumerate(frames)], keys=["k"], left_ts="t", **options
    ).collect()
    assert {r["id"]: r["v0"] for r in got} == brute_asof(lookups, first, False)
    assert {r["id"]: r["v1"] for r in got} == brute_asof(lookups, second, False)


def test_dense_bins_and_crowded_instants_are_cut(spark):
    """No group stays far above the limit, few features are copied, and text ids spread over the salts."""
    from pyspark.sql import types as T

    from millrace.operators import asof

    limit = 100
    seconds = F.timestamp_seconds(F.col("id") % 3600)
    left = spark.range(4000).select(F.md5(F.col("id").cast("string")).alias("name"), F.lit(1).alias("k"), seconds.alias("__time"))
    left = left.unionByName(spark.range(1000).select(
        F.md5(F.concat(F.lit("x"), "id")).alias("name"), F.lit(1).alias("k"), F.timestamp_seconds(F.lit(7)).alias("__time")))
    right = spark.range(3600).select(F.lit(1).alias("k"), F.timestamp_seconds("id").alias("__time"), F.struct(F.col("id").alias("v")).alias("__hit0"))
    cut_left, cut_right, _ = asof._cut(
        left, right, [T.StructField("k", T.IntegerType())], ["__hit0"], [(1,)], limit, 3600, asof._dealing_columns(left.schema, ["k", "__time"]))
    sizes = cut_left.select("__bin", "__salt").unionAll(cut_right.select("__bin", "__salt")).groupBy("__bin", "__salt").count()
    assert sizes.agg(F.max("count")).first()[0] < 2.5 * limit
    assert cut_right.count() < 3 * 3600
    assert cut_left.filter(F.col("__salt") > 0).select("__salt").distinct().count() > 5


def test_asof_edges(spark):
    left = spark.createDataFrame([(1, at(0)), (2, at(0)), (9, at(0))], "k int, t timestamp")
    right = spark.createDataFrame([(1, at(0), 5), (2, at(-5), None), (2, at(-9), 6)], "k int, ts timestamp, v int")
    call = dict(keys="k", left_ts="t", right_ts="ts", values=["v"])
    assert {r["k"]: r["v"] for r in asof_join(left, right, **call).collect()} == {1: None, 2: None, 9: None}
    assert {r["k"]: r["v"] for r in asof_join(left, right, inclusive=True, **call).collect()} == {1: 5, 2: None, 9: None}
    empty = asof_join(left, right.limit(0), **call)
    assert [r["v"] for r in empty.collect()] == [None] * 3
    with pytest.raises(ValueError, match="already"):
        asof_join(left.withColumn("v", F.lit(1)), right, **call)
    with pytest.raises(TypeError):
        asof_join(left, right.withColumn("ts", F.col("ts").cast("date")), **call)


def test_asof_two_part_key(spark):
    left = spark.createDataFrame([("a", 1, at(5)), ("a", 2, at(5))], "x string, y int, t timestamp")
    right = spark.createDataFrame([("a", 1, at(1), 10), ("a", 2, at(9), 20)], "x string, y int, ts timestamp, v int")
    for options in ({}, {"max_group_rows": 1}):
        got = asof_join(left, right, keys=["x", "y"], left_ts="t", right_ts="ts", values=["v"], **options)
        assert {r["y"]: r["v"] for r in got.collect()} == {1: 10, 2: None}


@pytest.mark.parametrize("options", [{"hot_keys": None}, {"max_group_rows": 3}])
def test_keyed_lookup(spark, options):
    left = spark.createDataFrame([(i, 1 if i < 8 else i if i < 12 else None) for i in range(15)], "id int, k int")
    right = spark.createDataFrame([(1, "one"), (9, "nine"), (77, "none")], "key int, v string")
    got = keyed_lookup(left, right, keys="k", right_keys="key", values=["v"], **options)
    assert got.columns == ["id", "k", "v"]
    want = {i: "one" if i < 8 else "nine" if i == 9 else None for i in range(15)}
    rows = got.collect()
    assert len(rows) == 15 and {r["id"]: r["v"] for r in rows} == want


def test_asof_over_a_clock_change(spark):
    times = [datetime(2024, 3, 10, 1, 50) + timedelta(minutes=10 * i) for i in range(15)]
    left = spark.createDataFrame([(1, t) for t in times], "k int, t timestamp_ntz")
    right = spark.createDataFrame([(1, t - timedelta(minutes=1), i) for i, t in enumerate(times)], "k int, ts timestamp_ntz, v int")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = asof_join(left, right, keys="k", left_ts="t", right_ts="ts", values=["v"], max_group_rows=1, bin_seconds=600)
        assert [r["v"] for r in sorted(got.collect(), key=lambda r: r["t"])] == list(range(15))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_hot_groups_are_bounded(spark):
    df = spark.range(100).select((F.col("id") % 10).alias("k"))
    assert hot_groups([df], ["k"], 9, limit=4) and len(hot_groups([df], ["k"], 9, limit=4)) == 4
    assert hot_groups([df], ["k"], 10) == []
    assert len(hot_groups([df, df], ["k"], 10)) == 10


def test_hot_groups_on_a_sample(spark):
    df = spark.range(200_000).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("k"))
    (key, rows), = hot_groups([df], ["k"], 20_000)
    assert key == 0 and 85_000 < rows < 115_000


def test_sorted_rows_spread_a_frequent_value(spark):
    df = spark.range(20_000).select("id", F.when(F.col("id") % 100 == 0, F.col("id")).otherwise(7).alias("v"))
    got = aggregates.sorted_rows(df.repartition(8), F.desc("v"))
    values = [r["v"] for r in got.collect()]
    assert values == sorted(values, reverse=True)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "__row" in plan and got.columns == ["id", "v"]


# -- one-hot -----------------------------------------------------------------------------------

def test_one_hot_nulls_and_unseen_values(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None)], "id int, c string")
    got = onehot.one_hot(df, ["c"])
    assert got.columns == ["id", "c_a", "c_b"] and dict(got.dtypes)["c_a"] == "bigint"
    assert sorted(map(tuple, got.collect())) == [(1, 0, 1), (2, 1, 0), (3, 0, 0)]
    given = onehot.one_hot(df, ["c"], {"c": ["a", "z"]})
    assert sorted(map(tuple, given.collect())) == [(1, 0, 0), (2, 1, 0), (3, 0, 0)]


def test_one_hot_of_many_values(spark):
    """The most frequent values get columns, at every size; the others share one flag."""
    df = spark.range(6000).select("id", F.when(F.col("id") < 3000, F.col("id") % 2 + 5000).otherwise(F.col("id")).cast("string").alias("c"))
    assert onehot.category_values(df, ["c"], most=2) == {"c": ["5000", "5001"]}
    got = onehot.one_hot(df, ["c"], {"c": ["5000", "5001"]}, other=True).agg(*[
        F.sum(c) for c in ("c_5000", "c_5001", "c_other_values")]).first()
    assert tuple(got) == (1501, 1501, 2998)
    assert len(onehot.category_values(df, ["c"])["c"]) == 1000


def test_one_hot_never_cuts_in_silence(spark):
    df = spark.range(1001).select("id", F.col("id").cast("string").alias("c"), F.lit("Yes").alias("churn"))
    with pytest.raises(ValueError, match="more than 1000 values"):
        onehot.one_hot(df, ["c"])
    with pytest.raises(ValueError, match="more than 1000 values"):
        churn_features(df, ["c"])
    small = df.filter("id < 5")
    assert len(onehot.one_hot(small, ["c"], most=5).columns) == 7
    flagged = churn_features(small, ["c"], other=True, most=3)
    assert flagged.agg(F.sum("c_other_values")).first()[0] == 2


def test_churn_frame_has_41_flags_and_45_inputs(spark):
    yes_no, internet = ["Yes", "No"], ["Yes", "No", "No internet service"]
    values = {
        "gender": ["Female", "Male"], "partner": yes_no, "dependents": yes_no, "phone_service": yes_no,
        "multiple_lines": ["Yes", "No", "No phone service"], "internet_service": ["DSL", "Fiber optic", "No"],
        "online_security": internet, "online_backup": internet, "device_protection": internet, "tech_support": internet,
        "streaming_tv": internet, "streaming_movies": internet, "contract": ["Month-to-month", "One year", "Two year"],
        "paperless_billing": yes_no,
        "payment_method": ["Bank transfer (automatic)", "Credit card (automatic)", "Electronic check", "Mailed check"],
    }
    rows = []
    for i in range(4):
        row = {c: values[c][i % len(values[c])] for c in CHURN_CATEGORIES}
        rows.append({**row, "customer_id": str(i), "senior_citizen": 0, "tenure": i, "monthly_charges": 1.5,
                     "total_charges": 3.0, "churn": ["Yes", "No", "Yes", "Unknown"][i]})
    df = spark.createDataFrame(rows)
    got = churn_features(df)
    flags = [c for c in got.columns if any(c.startswith(f"{x}_") for x in CHURN_CATEGORIES)]
    assert len(flags) == 41 and "payment_method_credit_card__automatic_" in flags and "contract_month_to_month" in flags
    assert len(got.columns) == 41 + 4 + 2  # and customer_id, churn
    assert sorted((r["customer_id"], r["churn"]) for r in got.collect()) == [("0", 1), ("1", 0), ("2", 1)]
    assert [tuple(r) for r in unmapped_labels(df).collect()] == [("Unknown", 1)]
    scoring = churn_features(df.drop("churn").limit(1), label=None, values=values)
    assert set(scoring.columns) == set(got.columns) - {"churn"}


# -- splits and totals -------------------------------------------------------------------------

def test_stratified_split_is_exact(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 10 == 0, "rare").when(F.col("id") % 7 > 0, "common").alias("y"))
    got = sampling.stratified_split(df, "id", "y", 0.75)
    counts = {r["y"]: (r["n"], r["k"]) for r in got.groupBy("y").agg(F.count("*").alias("n"), F.sum("is_train").alias("k")).collect()}
    assert set(counts) == {"rare", "common", None}
    assert all(k == -(-n * 3 // 4) for n, k in counts.values())


def test_stratified_split_of_many_labels(spark):
    df = spark.range(22_000).select("id", (F.col("id") % 11_000).alias("y"))
    got = sampling.stratified_split(df, "id", "y", 0.5)
    assert got.groupBy("y").agg(F.sum("is_train").alias("k")).filter("k != 1").count() == 0 and got.count() == 22_000


def test_keyed_lookup_refuses_several_rows_for_a_key(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "d")], "k int, v string")
    with pytest.raises(ValueError, match="several rows"):
        keyed_lookup(left, right, keys="k", values=["v"])
    once = keyed_lookup(left, right.filter("v != 'b'"), keys="k", values=["v"])
    assert sorted(map(str, once.collect())) == ["Row(k=1, v='a')", "Row(k=2, v=None)"]


def test_first_by_puts_unknown_order_last(spark):
    df = spark.createDataFrame([("a", None, 1, "bad"), ("a", 5, 2, "late"), ("a", 3, 3, "early"), ("b", None, 9, "y"), ("b", None, 4, "x")],
                               "k string, d int, tie int, v string")
    got = df.groupBy("k").agg(aggregates.first_by("v", "d", "tie").alias("v")).collect()
    assert dict(map(tuple, got)) == {"a": "early", "b": "x"}


def test_curve_points_of_odd_scores(spark):
    rows = [(float("inf"), 1), (float("-inf"), 0), (float("nan"), 1), (0.5, 1), (0.4, 0), (0.5, None), (None, 1)]
    df = spark.createDataFrame(rows, "score double, y int")
    for bucket_rows in (1, 2, 100_000):
        got = sorted((r["tp"], r["fp"], str(r["score"])) for r in quality.curve_points(df, "score", "y", bucket_rows).collect())
        assert got == [(1, 0, "inf"), (2, 0, "0.5"), (2, 1, "0.4"), (2, 2, "-inf"), (3, 2, "nan")]


def test_hash_split_and_samples(spark):
    df = spark.range(1000)
    train, test = sampling.hash_split(df, "id", 0.75)
    assert train.count() + test.count() == 1000 and train.join(test, "id").count() == 0
    again, _ = sampling.hash_split(spark.range(2000).repartition(5), "id", 0.75)
    assert train.join(again, "id", "left_anti").count() == 0
    assert sampling.fixed_sample(df, "id", 100).count() == 100 and sampling.fixed_sample(df, "id", 5000).count() == 1000
    assert sampling.hash_sample(df, "id", 0.0).count() == 0 and sampling.hash_sample(df, "id", 1.0).count() == 1000
    assert 200 < sampling.random_sample(df, 0.3).count() < 400


def test_running_total(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["a", None]), i, rng.randrange(9)) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, o int, v long").withColumn("b", F.floor(F.col("o") / 16))
    got = running_total(df, ["v"], bucket="b", order=[F.col("o")], within=["g"], grand_total=True).collect()
    want, sums = {}, {}
    for g, o, v in rows:
        sums[g] = sums.get(g, 0) + v
        want[o] = sums[g]
    assert {r["o"]: r["v"] for r in got} == want
    assert all(r["v_total"] == sums[r["g"]] for r in got)


# -- checks on predictions ---------------------------------------------------------------------

def judged(spark):
    rows = [("x", 1, 1), ("x", 0, 0), ("x", 1, 0), ("y", 1, 1), ("z", 0, 1), ("z", None, 1)]
    return spark.createDataFrame(rows, "part string, label int, prediction int")


def test_slices_and_gate(spark):
    sliced = quality.slice_accuracy(judged(spark), "part", "label", "prediction")
    got = {r["part"]: (r["acc"], r["obs"]) for r in sliced.collect()}
    assert got == {"x": (2, 3), "y": (1, 1), "z": (0, 2)}
    assert quality.slice_gate(sliced).first()["passed"] == 0
    assert quality.slice_gate(sliced.filter("part <> 'z'")).first()["passed"] == 1
    assert quality.slice_gate(sliced.limit(0)).first()["passed"] == 0
    with pytest.raises(ValueError, match="unknown slice"):
        quality.slice_accuracy(judged(spark), "part,seniorCitizen", "label", "prediction")


def test_curve_points(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(30) / 30, rng.randrange(2)) for _ in range(300)]
    df = spark.createDataFrame(rows, "score double, y int")
    got = {r["score"]: (r["tp"], r["fp"]) for r in quality.curve_points(df, "score", "y", bucket_rows=20).collect()}
    want = {s: (sum(y for x, y in rows if x >= s), sum(1 - y for x, y in rows if x >= s)) for s, _ in rows}
    assert got == want
    same = quality.curve_points(df.withColumn("score", F.lit(0.5)), "score", "y").collect()
    assert len(same) == 1 and same[0]["tpr"] == 1.0


def test_metrics_and_reports(spark):
    m = quality.binary_metrics(judged(spark), "label", "prediction").first()
    assert (m["tp"], m["fp"], m["fn"], m["tn"]) == (2, 1, 1, 1) and m["f1"] == pytest.approx(2 / 3)
    report = quality.schema_report(judged(spark), spark.createDataFrame([], "label int, part int, more double").schema)
    assert {r["check"]: r["passed"] for r in report.collect()} == {"label": 1, "part": 0, "more": 0}
    good = quality.scoring_check(spark, lambda: judged(spark))
    bad = quality.scoring_check(spark, lambda: judged(spark).select("gone"))
    assert good.first()["passed"] == 1 and bad.first()["passed"] == 0
    assert quality.decision([good]).first()["accepted"] == 1
    assert quality.decision([good, bad]).first()["accepted"] == 0
    texts = spark.createDataFrame([("short",), ("x" * 20,), ("x" * 21,), (None,)], "description string")
    assert [r["has_description"] for r in quality.description_check(texts).collect()] == [0, 0, 1, 0]


def test_runs_and_first_values(spark):
    runs = spark.createDataFrame(
        [("a", "FINISHED", None, 1), ("b", "FINISHED", 0.7, 2), ("c", "FAILED", 0.9, 3), ("d", "FINISHED", 0.8, 4)],
        "run string, status string, f1 double, version int",
    )
    assert aggregates.best_run(runs, "f1").first()["run"] == "d"
    assert aggregates.latest_row(runs, "status", "FINISHED", "version").first()["run"] == "d"
    assert aggregates.highest(runs, "status", "FAILED", "version").first()["version"] == 3
    assert aggregates.highest(runs, "status", "NONE", "version").first()["version"] is None
    first = runs.groupBy("status").agg(aggregates.first_by("run", "version").alias("run"))
    assert {r["status"]: r["run"] for r in first.collect()} == {"FINISHED": "a", "FAILED": "c"}
    counts = spark.createDataFrame([(1,), (1,), (2,), (None,)], "rating int")
    assert sorted(r["n"] for r in aggregates.value_counts_only(counts, "rating").collect()) == [0, 1, 2]


def test_rule_score(spark):
    df = spark.createDataFrame([(1, None), (0, 1), (0, None), (None, None)], "a int, b int")
    score = filters.score_if_any([F.col("a") == 1, F.col("b") == 1], hit=80, miss=20, base=5)
    assert [r["s"] for r in df.select(score.alias("s")).collect()] == [85, 85, 25, 25]


@pytest.mark.parametrize("bucket_rows", [3, 100_000])
def test_probability_metrics(spark, bucket_rows):
    import math
    import random

    rng = random.Random(11)
    rows = [(rng.choice(["a", "b", None]), rng.choice([0, 1, None]), rng.choice([None, 0.0, 0.25, 0.5, 0.75, 1.0, rng.random()])) for _ in range(400)]
    rows += [("one class", 1, 0.3), ("one class", 1, 0.3)]
    df = spark.createDataFrame(rows, "part string, y int, p double")

    def expected(of):
        found = [(y, p) for part, y, p in rows if of(part) and y is not None and p is not None]
        ones, zeros = [p for y, p in found if y], [p for y, p in found if not y]
        won = sum((a > b) + (a == b) / 2 for a in ones for b in zeros)
        loss = -sum(math.log(max(p if y else 1 - p, 1e-15)) for y, p in found) / len(found)
        return len(found), won / (len(ones) * len(zeros)) if ones and zeros else None, loss

    got = {r["part"]: (r["n"], r["auc"], r["log_loss"]) for r in quality.probability_metrics(df, "p", "y", ["part"], bucket_rows).collect()}
    assert set(got) == {"a", "b", None, "one class"}
    for part, (n, auc, loss) in got.items():
        want = expected(lambda x: x == part)
        assert (n, auc) == (want[0], want[1] if want[1] is None else pytest.approx(want[1])) and loss == pytest.approx(want[2])
    (whole,) = quality.probability_metrics(df, "p", "y", bucket_rows=bucket_rows).collect()
    assert tuple(whole) == pytest.approx(expected(lambda x: True))
    bins = {(r["part"], r["bin"]): r for r in quality.calibration(df, "p", "y", ["part"], 4).collect()}
    inside = [y for part, y, p in rows if part == "a" and y is not None and p is not None and p >= 0.75]
    assert bins["a", 3]["n"] == len(inside) and bins["a", 3]["positive_share"] == pytest.approx(sum(inside) / len(inside))
    assert quality.probability_metrics(df.limit(0), "p", "y").collect() == []


def test_traits_count_characters_without_lists(spark, tmp_path):
    from types import SimpleNamespace

    from millrace.plans.model_queries import traits

    texts = ["Ab 12\n\nc  é# 𝄞Z", "", None, "   ", "ABC", "x\ty 9"]
    docs = spark.createDataFrame([(i, x, len(x or "")) for i, x in enumerate(texts)], "doc_id int, text string, n_chars int")
    labels = spark.createDataFrame([(i, 1) for i in range(len(texts))], "doc_id int, quality int")
    found = traits(SimpleNamespace(documents=docs, labels=labels))
    for r in found.collect():
        x = texts[r.doc_id] or ""
        size = max(len(x), 1)
        assert (r.spaces, r.lines) == (x.count(" ") / size, x.count("\n") / size)
        assert r.digits == sum(c in "0123456789" for c in x) / size
        assert r.capitals == sum("A" <= c <= "Z" for c in x) / size
        assert r.symbols == sum(not (c.isascii() and c.isalnum()) and c not in " \n" for c in x) / size
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan and "regexp_count" not in plan
