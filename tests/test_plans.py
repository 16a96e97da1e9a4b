"""What the physical plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from millrace.operators.filters import time_range
from millrace.operators.store import FeatureTable
from millrace.plans.catalogue import QUERIES
from millrace.plans.registry import Tables

# Queries whose building runs training or streams are left to their own tests.
SLOW_TO_BUILD = {
    "churn_model_metrics", "fare_model", "searched_model_scores", "document_vectors", "dense_document_vectors", "feature_table_merge",
    "feature_table_range", "score_with_lookups", "score_saved_model", "stored_training_set", "streamed_features", "streamed_silver_orders",
    "streamed_silver_users", "streamed_tables", "rescued_fields", "evolving_table", "table_from_select",
    "types_of_files", "ingested_late_files", "ingested_mixed_csv", "ingested_new_field", "scores_saved_as_table", "controlled_streams", "deleted_rows",
    "table_made_empty", "table_in_own_database", "catalog_listing", "rebuild_test", "written_in_so_many_files",
}
# The trees of a trained model are walked in a pandas UDF.
PYTHON = {"column_model_scores", "score_trained_bands"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW_TO_BUILD))
def test_no_cross_joins_and_no_python(spark, data, name):
    text = plan(QUERIES[name](spark, data))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert ("EvalPython" in text or "InPandas" in text) == (name in PYTHON)


@pytest.mark.parametrize("name", ["asof_training_set", "asof_strict_ties", "sliding_features"])
def test_no_window_or_sort_in_one_task(spark, data, name):
    assert "SinglePartition" not in plan(QUERIES[name](spark, data))


def test_two_lookups_share_one_shuffle(spark, data):
    text = plan(QUERIES["asof_training_set"](spark, data))
    # One for each of the two window aggregates, one for the as-of join.
    assert text.count("Exchange hashpartitioning") == 3 and text.count("Window ") == 1


def test_ranges_reach_the_scan(spark, data):
    t = Tables(spark, data)
    text = plan(time_range(t.events, "ts", "2024-01-10", "2024-01-20").select("event_id"))
    assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text


def test_only_used_columns_are_read(spark, data):
    for part in plan(QUERIES["customer_360"](spark, data)).split("ReadSchema: ")[1:]:
        assert "props" not in part and "o_orderpriority" not in part


def test_sampled_rows_and_top_groups_stay_in_their_tasks(spark, data):
    assert "Exchange" not in plan(QUERIES["hash_sample"](spark, data))
    assert "TakeOrderedAndProject" in plan(QUERIES["fixed_sample"](spark, data))
    assert "TakeOrderedAndProject" in plan(QUERIES["busiest_countries"](spark, data))


def test_stratified_split_ranks_in_buckets(spark, data):
    """Rows are dealt by label and hash bucket, so no task gets all rows of a label."""
    text = plan(QUERIES["stratified_split"](spark, data))
    assert "Exchange hashpartitioning(__key" in text and "SinglePartition" not in text


def test_excluded_columns_are_not_carried(spark, data):
    """Text columns that the caller drops after an as-of join are not even read for it."""
    t = Tables(spark, data)
    from millrace.operators.asof import asof_join

    daily = t.events.groupBy("user_id", F.window("ts", "1 day").alias("w")).count().select(
        "user_id", F.col("w.end").alias("ts"), "count"
    )
    joined = asof_join(t.events, daily, keys="user_id", left_ts="ts", right_ts="ts", values=["count"], hot_keys=[])
    text = plan(joined.select("event_id", "count"))
    assert "props" not in text and "event_type" not in text


def test_feature_table_reads_wanted_days(spark, data, tmp_path):
    events = Tables(spark, data).events.select("user_id", "ts", "value")
    table = FeatureTable.create(spark, str(tmp_path / "t"), "user_id", df=events, timestamp_key="ts")
    days = {f.split("__part=")[1][:10] for f in table.read("2024-01-10", "2024-01-12").inputFiles()}
    assert days == {"2024-01-09", "2024-01-10", "2024-01-11", "2024-01-12", "2024-01-13"}
