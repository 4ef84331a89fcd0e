"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from stayline import operators as op
from stayline.plans.catalog import QUERIES, Tables
from stayline.session import durable
from stayline.sources import read_events, write_table
from tests.conftest import SF

MODELS = {
    "lr_predictions", "svc_predictions", "tree_predictions", "cv_leaderboard",
    "best_params", "validation_scores", "final_test_score", "grain_scores",
    "baseline_leaderboard", "baseline_best_params", "baseline_validation", "baseline_test",
    "baseline_by_grain", "rules_leaderboard", "rules_best_params", "rules_choice",
    "lr_optimality", "svc_optimality", "tree_predictions_categories",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan(df).split("Initial Plan")[0]


@pytest.fixture(scope="module")
def parquet_log(spark, raw, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("log") / "log.parquet")
    write_table(raw, path)
    return read_events(spark, path, "parquet")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - MODELS))
def test_no_python_and_no_nested_loops(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for word in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert word not in text
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text


def test_cleaning_reaches_the_scan(parquet_log):
    text = plan(op.drop_invalid(parquet_log).select("userId", "page"))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", text).group(1)
    assert "IsNotNull(userId)" in pushed and "IsNotNull(sessionId)" in pushed
    assert "Not(EqualTo(userId,))" in pushed
    assert "ReadSchema: struct<userId:string,sessionId:bigint,page:string>" in text


def test_activity_is_one_scan_one_shuffle_and_hashed(parquet_log):
    text = plan(op.user_activity(op.drop_invalid(parquet_log)))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("FileScan") == 1
    assert "SortAggregate" not in text


def test_facts_condense_the_log_before_anything_sorts(parquet_log):
    text = plan(op.user_facts(op.drop_invalid(parquet_log)))
    assert text.count("FileScan") == 1
    scan_side = text[text.rindex("Exchange hashpartitioning") :]
    assert "HashAggregate" in scan_side and "Sort" not in scan_side


def test_facts_with_a_profile_shuffle_no_event(spark):
    t = Tables(spark, SF)
    text = plan(t.facts())
    # the events scan that carries pages is aggregated before the first exchange above it
    assert "SortAggregate" not in text


def test_histograms_scan_the_log_once(spark):
    text = final_plan(QUERIES["hist_plays"](spark, SF))
    assert text.count("FileScan") == 1
    assert "ReusedExchange" in text


@pytest.mark.parametrize("name", ["box_plays", "box_normal_ratio"])
def test_boxes_read_the_condensed_values_only(spark, name):
    text = final_plan(QUERIES[name](spark, SF))
    assert "events.parquet" not in text and text.count("FileScan") <= 3
    assert text.count("Exchange hashpartitioning") <= 4
    assert "ObjectHashAggregate" not in text and text.count("Window [") <= 1


def test_nothing_runs_while_tables_are_built(spark, log, parquet_log):
    jobs = spark.sparkContext.statusTracker()
    users = op.user_activity(op.drop_invalid(parquet_log))
    before = len(jobs.getJobIdsForGroup(None))
    op.box_stats(users, "song_nums", by="latest_date", approx=True)
    op.histogram(users, "song_nums", by="latest_date", shared_edges=True)
    op.attach_facts(parquet_log, users, ["song_nums"])
    op.churn_phase(parquet_log)
    assert len(jobs.getJobIdsForGroup(None)) == before


def test_users_without_a_marker_pass_no_exchange(parquet_log):
    text = plan(op.churn_phase(op.drop_invalid(parquet_log)))
    silent = text[: text.index("Exchange hashpartitioning(userId")]
    assert "Union" in silent and "FileScan" in silent
    first = silent[silent.index("Union") :].split("FileScan", 1)[0]
    assert "Exchange hashpartitioning" not in first and "Sort" not in first


@pytest.mark.parametrize("how", ["inner", "left_semi", "left", "left_anti"])
def test_rows_of_other_users_pass_no_exchange(spark, parquet_log, how):
    """Beyond the broadcast limit a filter of the ids stands between the scan and the shuffle."""
    clean = op.drop_invalid(parquet_log)
    ids = durable(op.user_activity(clean).where("churn_users = 1").select("userId", "song_nums"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(op.join_lookup(clean, ids, "userId", how, n_ids=ids.count()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # every exchange above a scan of whole log rows has the filter's test below it
    for above in re.split(r"Exchange hashpartitioning\(userId", text)[1:]:
        below = above[: above.index("FileScan")]
        if "sessionId" in below:
            assert "BroadcastHashJoin [_word" in below and "Filter " in below
    if how in ("left", "left_anti"):
        far = text[text.index("Union") :]
        assert far.count("FileScan") >= 2


def test_bucketed_log_is_not_shuffled(spark, parquet_log):
    from stayline.sources.buckets import BucketedLog

    clean = op.drop_invalid(parquet_log)
    buckets = BucketedLog.store(clean, 8)
    text = plan(op.user_facts(buckets.log(), spread=buckets.SPREAD))
    scan = text[text.rindex("Exchange hashpartitioning") :]
    assert text.count("FileScan") == 1 and "Bucketed: true" in text
    assert scan.count("HashAggregate") >= 2  # combined and merged below the only exchange of states
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = buckets.attach(op.user_activity(clean).select("userId", "song_nums"))
        text = plan(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and "Exchange" not in text
    buckets.drop()


def test_log_with_user_columns_scans_the_events_twice(spark, monkeypatch):
    """Once as the log and once for the signups, however the users are joined."""
    from stayline.sources import star

    for limit in (0, 1 << 30):
        text = plan(star.event_log(spark, SF, broadcast_bytes=limit)).split("Initial Plan")[0]
        assert len(re.findall(r"FileScan parquet \[[^\]]*event_type", text)) == 2


def test_shuffles_are_sized_by_the_tables(spark, monkeypatch):
    from stayline.plans import catalog

    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    monkeypatch.setattr(catalog, "stored_bytes", lambda df: 10 * 1024**4)
    try:
        Tables(spark, SF)
        assert spark.conf.get(key) == str(10 * 1024**4 // (128 * 1024**2))
    finally:
        spark.conf.unset(key)


def test_preview_is_a_top_k(parquet_log):
    from stayline.sources import preview

    assert "TakeOrderedAndProject" in plan(preview(parquet_log, 3, ["ts"]))


def test_partition_pruning_of_the_written_log(spark, log, tmp_path):
    from stayline.functions import date_of

    path = str(tmp_path / "by-date")
    write_table(log.withColumn("event_date", date_of("ts")), path, partition_by="event_date")
    day = spark.read.parquet(path).where(F.col("event_date") == "2018-10-02")
    assert "PartitionFilters: [isnotnull(event_date" in plan(day)
    assert day.count() == 2
