"""Heavy keys take another way to the same rows."""

from collections import Counter

import pytest
from pyspark.sql import Window, functions as F

from stayline import operators as op
from stayline.operators.prefilter import MAX_WORDS, filter_words, marked_rows
from stayline.operators.skew import is_small, join_lookup
from stayline.sources.buckets import BucketedLog


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 events, a third of them of user 1 and a third of those in one moment."""
    n = 3000
    user = F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 50 + 2)
    moment = F.when((F.col("id") % 9 == 0), F.lit(1_000)).otherwise(
        F.col("id") % 97 * 1_800_000
    )
    page = (
        F.when(F.col("id") % 41 == 0, "Cancellation Confirmation")
        .when(F.col("id") % 2 == 0, "NextSong")
        .otherwise("Home")
    )
    return (
        spark.range(n)
        .select(
            user.cast("string").alias("userId"),
            (F.col("id") % 7).alias("sessionId"),
            page.alias("page"),
            moment.alias("ts"),
            F.lit(200).alias("status"),
        )
        .repartition(6)
        .persist()
    )


def bag(df):
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("small", [False, True])
def test_join_is_a_join(spark, skewed, how, small):
    rows = skewed.unionByName(
        spark.createDataFrame([(None, k % 2, "Home", 5, 200) for k in range(9)], skewed.schema)
    )
    lookup = (
        op.user_activity(skewed)
        .where(F.col("userId").cast("int") % 2 == 1)
        .select("userId", "song_nums")
    )
    got = join_lookup(rows, lookup, "userId", how, small)
    assert got.columns == rows.join(lookup, "userId", how).columns
    assert bag(got) == bag(rows.join(lookup, "userId", how))


def test_rows_without_a_key_are_spread(spark):
    rows = spark.range(2000).selectExpr("CAST(NULL AS STRING) AS userId", "id")
    lookup = spark.createDataFrame([("1", 5)], "userId string, n int").hint("shuffle_merge")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = join_lookup(rows, lookup.hint("merge"), "userId", "left")
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) > 1


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_prefiltered_join_is_a_join(spark, skewed, how):
    rows = skewed.unionByName(
        spark.createDataFrame([(None, k % 2, "Home", 5, 200) for k in range(9)], skewed.schema)
    )
    lookup = op.user_activity(skewed).where("userId % 5 = 1").select("userId", "song_nums")
    nobody = spark.createDataFrame([(None, 7)], lookup.schema)
    for ids in (lookup, lookup.limit(0), lookup.unionByName(nobody)):
        got = join_lookup(rows, ids, "userId", how, n_ids=10)
        assert bag(got) == bag(rows.join(ids, "userId", how))


def test_filter_lets_all_ids_and_few_others_pass(spark):
    ids = spark.range(20_000).selectExpr("CAST(id AS STRING) AS userId")
    rows = spark.range(100_000).selectExpr("CAST(id AS STRING) AS userId", "id")
    marked = marked_rows(rows, ids, "userId", filter_words(20_000))
    passed = marked.where("_may_match")
    assert passed.where("id < 20000").count() == 20_000
    assert passed.where("id >= 20000").count() < 0.05 * 80_000


def test_filter_is_sized_by_the_ids(spark, skewed):
    assert filter_words(0) == 1 and filter_words(4_000) == 1_000
    assert filter_words(10**7) == MAX_WORDS and filter_words(10**9) == 0
    users = op.user_activity(skewed).select("userId", "song_nums")
    assert bag(join_lookup(skewed, users, "userId", n_ids=10**9)) == bag(skewed.join(users, "userId"))


def test_buckets_split_heavy_users(spark, skewed):
    """No bucket holds the third of the rows that one user has, and results are as without buckets."""
    keyless = spark.createDataFrame([(None, k, "Home", k, 200) for k in range(900)], skewed.schema)
    rows = skewed.unionByName(keyless)
    buckets = BucketedLog.store(rows, 16)
    dealt = buckets.log()
    assert bag(dealt.drop(buckets.SPREAD)) == bag(rows)
    sizes = [r["count"] for r in dealt.groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) < rows.count() / 6
    assert {"1", None} <= {r._user for r in buckets.heavy.collect()}
    users = op.user_activity(skewed).select("userId", "song_nums")
    assert bag(buckets.attach(users)) == bag(rows.join(users, "userId"))
    profile = spark.createDataFrame(
        [("1", "F", "Lodi, CA", 5)], "userId string, gender string, location string, registration long"
    )
    found = op.user_facts(dealt, profile, spread=buckets.SPREAD)
    assert bag(found) == bag(op.user_facts(rows, profile))
    buckets.drop()


def test_bitmap_is_sized_by_the_markers(skewed):
    assert op.filter_bits_for(0) == 64 and op.filter_bits_for(10**6) == 1 << 24
    assert op.filter_bits_for(2 * 10**7) == 1 << 26 and op.filter_bits_for(10**9) == 0
    exact = skewed.where("page = 'Cancellation Confirmation'").select("userId").distinct().count()
    assert abs(op.marked_users(skewed) - exact) <= 0.15 * exact


def test_buckets_of_an_empty_log(skewed):
    buckets = BucketedLog.store(skewed.limit(0), 4)
    assert buckets.log().count() == 0
    assert buckets.attach(op.user_activity(skewed).select("userId", "song_nums")).count() == 0
    buckets.drop()


def test_size_is_in_bytes(spark):
    texts = spark.range(100).select(F.repeat(F.lit("x"), 1000).alias("text"))
    assert is_small(texts, 200_000) and not is_small(texts, 90_000)
    assert is_small(texts.limit(0), 0)


@pytest.mark.parametrize("bits", [0, 64, 1 << 25])
def test_running_churn(spark, skewed, bits):
    """Few bits make users share one; users without an id, and events without a time, count too."""
    log = skewed.where("userId <> '2' OR page <> 'Cancellation Confirmation'")
    pages = ("Home", "Cancellation Confirmation")
    odd = [(user, 1, page, ts, 200) for user in ("1", None) for page in pages for ts in (None, 7)]
    log = log.unionByName(spark.createDataFrame(odd, skewed.schema))
    latest_first = Window.partitionBy("userId").orderBy(F.desc("ts"))
    plain = op.mark_churn(log).withColumn(
        "churn_running",
        F.sum("churn").over(latest_first.rangeBetween(Window.unboundedPreceding, Window.currentRow)),
    )
    assert bag(op.churn_phase(log, filter_bits=bits)) == bag(plain)
    assert plain.agg(F.max("churn_running")).first()[0] > 5


def test_facts_joined_small_or_not(skewed):
    users = op.user_activity(skewed)
    results = []
    for small in (True, False):
        joined = op.attach_facts(skewed, users, ["song_nums"], small=small)
        text = joined._jdf.queryExecution().executedPlan().toString()
        assert not small or "BroadcastHashJoin" in text
        results.append(bag(joined))
    assert results[0] == results[1]


def test_facts_do_not_depend_on_partitioning(log, facts):
    for n in (1, 7):
        assert bag(op.user_facts(log.repartition(n))) == bag(facts)
