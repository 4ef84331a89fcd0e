"""Expected values worked out by hand on the fixture."""

from datetime import date

from pyspark.sql import functions as F
import pytest

from stayline import operators as op
from stayline.functions import area_of, as_int, date_of, days_between, hour_of, parse_date
from stayline.session import configure
from tests.conftest import DAY, OCT_1


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_clean_drops_null_and_blank_ids(raw, log):
    assert raw.count() == 24
    assert log.count() == 19
    assert {r[0] for r in log.select("userId").distinct().collect()} == {
        "11", "12", "13", "14", "15", "16", "17",
    }


def test_audit(raw):
    (audit,) = op.quality_audit(raw).collect()
    assert audit.asDict() == {
        "n_rows": 24,
        "null_userId": 1,
        "null_sessionId": 1,
        "blank_userId": 3,
        "n_corrupt": 0, "n_without_nulls": 22,
        "n_kept": 19,
        "n_removed": 5,
    }


def test_distinct_users_counts_blank_and_null(raw, log):
    assert rows(op.distinct_users(raw)) == [(9,)]
    assert rows(op.distinct_users(log)) == [(7,)]
    assert rows(op.distinct_users(log, approx=True)) == [(7,)]
    assert rows(op.distinct_users(log.limit(0))) == [(0,)]


def test_ranges(log):
    assert rows(op.date_range(log, "ts")) == [(date(2018, 10, 1), date(2018, 10, 3))]
    assert rows(op.date_range(log, "registration")) == [(date(2018, 9, 11), date(2018, 10, 1))]


def test_facts(facts):
    got = rows(
        facts.select(
            "userId", "gender", "area", "delta_time", "song_nums", "n_events",
            "n_normal", "n_problem", "churn_rows", "churn_users",
        ),
        "userId",
    )
    assert got == [
        ("11", "M", " CA", 11, 2, 3, 3, 0, 1, 1),
        ("12", "F", " NY-NJ-PA", 7, 1, 4, 4, 0, 2, 1),
        ("13", "M", " CA", 3, 0, 2, 2, 0, 1, 1),
        ("14", "F", "Boston", 21, 2, 2, 2, 0, 0, 0),
        ("15", None, None, 7, 1, 3, 0, 1, 0, 0),
        ("16", "M", " CA", 0, 1, 2, 1, 1, 0, 0),
        ("17", "M", " CA", 4, 3, 3, 3, 0, 0, 0),
    ]


def test_facts_with_a_profile_are_the_same(log, facts):
    profile = log.groupBy("userId").agg(
        F.max("gender").alias("gender"),
        F.max("location").alias("location"),
        F.min("registration").alias("registration"),
    )
    assert rows(op.user_facts(log, profile), "userId") == rows(facts, "userId")


def test_attributes_of_the_latest_event_that_has_them(spark):
    log = spark.createDataFrame(
        [
            ("1", 1, "M", "A, X", 5),
            ("1", 2, "F", "B, Y", 4),
            ("1", 2, "M", "B, Z", 4),
            ("1", 3, None, None, 3),
        ],
        "userId string, ts long, gender string, location string, registration long",
    ).withColumns({"page": F.lit("Home"), "status": F.lit(200)})
    (user,) = op.user_facts(log).collect()
    assert (user.gender, user.area, user.n_events) == ("M", " Z", 4)
    assert user.registration_date == date(1970, 1, 1)


def test_marker_page_is_a_parameter(log):
    users = op.user_activity(log, churn_page="Home")
    assert {r.userId for r in users.where("churn_users = 1").collect()} == {"12", "13", "15", "16"}


def test_zero_plays(log, facts):
    assert [r.userId for r in op.keep_players(facts).orderBy("userId").collect()] == [
        "11", "12", "14", "15", "16", "17",
    ]
    assert op.keep_players(facts, "keep").count() == 7
    with pytest.raises(ValueError):
        op.keep_players(facts, "maybe")
    plays = op.plays_per_user(log)
    assert op.with_plays(log, plays).count() == 17
    kept = op.with_plays(log, plays, zero_plays="keep")
    assert kept.count() == 19
    assert {r.song_nums for r in kept.where("userId = '13'").collect()} == {0}


def test_churn_rows_and_users(facts):
    (summary,) = op.churn_summary(facts).collect()
    assert (summary.marker_rows, summary.churned_users, summary.users) == (4, 3, 7)


def test_semi_and_anti_join(log, facts):
    assert op.rows_of_churned(log, facts).count() == 9
    assert op.rows_of_churned(log, facts, churned=False).count() == 10


def test_running_churn(log):
    got = op.churn_phase(log).where(F.col("userId").isin("11", "12"))
    assert rows(got.select("userId", "ts", "churn_running"), "userId", "ts") == [
        ("11", OCT_1 + 3_600_000, 1),
        ("11", OCT_1 + 7_200_000, 1),
        ("11", OCT_1 + DAY, 1),
        ("12", OCT_1 + 3_600_000, 2),
        ("12", OCT_1 + 7_200_000, 2),
        ("12", OCT_1 + 10_800_000, 1),
        ("12", OCT_1 + 2 * DAY, 0),
    ]


def test_enriched_log(log, facts):
    wide = op.enrich(log, facts)
    assert wide.count() == 17
    got = wide.where("userId = '14'").select(
        "event_date", "latest_date", "delta_time", "area", "song_nums", "churn", "churn_users"
    )
    assert rows(got) == [
        (date(2018, 10, 1), date(2018, 10, 2), 21, "Boston", 2, 0, 0),
        (date(2018, 10, 2), date(2018, 10, 2), 21, "Boston", 2, 0, 0),
    ]


def test_shares_by_gender(facts):
    got = op.cohort_share(op.keep_players(facts), "gender").collect()
    assert [tuple(r) for r in got] == [
        ("M", 3, 1, 2 / 3, 1 / 3),
        ("F", 2, 1, 0.5, 0.5),
        (None, 0, 0, None, None),
    ]


def test_counts_by_gender(facts):
    players = op.keep_players(facts)
    assert set(rows(op.users_by(players, "gender"))) == {("M", 3), ("F", 2), (None, 0)}
    assert set(rows(op.churn_by(players, "gender"))) == {
        (0, "M", 2), (1, "M", 1), (0, "F", 1), (1, "F", 1), (0, None, 0),
    }


def test_a_user_counts_once_per_level(log):
    levels = op.user_levels(log)
    assert levels.count() == 7
    assert rows(op.cohort_share(levels, "level", "user_levels").orderBy("level")) == [
        ("free", 4, 1, 0.75, 0.25),
        ("paid", 3, 1, 2 / 3, 1 / 3),
    ]


def test_status_tables(log):
    assert set(rows(op.status_by_user(log).where("userId = '15'"))) == {
        ("15", 0, None, 0), ("15", 0, 307, 1), ("15", 0, 404, 1),
    }
    assert set(rows(op.events_by_status(log))) == {(200, 13), (307, 1), (404, 2), (None, 0)}
    assert set(rows(op.problem_visits(log))) == {(404, "15", 0), (404, "16", 0)}
    assert op.problem_visits(log, problem=(404, 307)).count() == 3


def test_normal_visit_ratio(facts):
    ratios = {r.userId: r.ratio for r in op.normal_visit_ratio(facts).collect()}
    assert ratios["15"] == 0.0 and ratios["16"] == 0.5 and ratios["12"] == 1.0
    assert op.normal_visit_ratio(facts, require_normal=True).count() == 6


def test_scalar_functions(spark):
    places = [("a, b, c",), ("none",), ("x,",), (None,)]
    places = spark.createDataFrame(places, "p string")
    assert [r[0] for r in places.select(area_of("p")).collect()] == [" c", "none", "", None]
    assert [r[0] for r in places.select(area_of("p", trim=True)).collect()][0] == "c"
    texts = spark.createDataFrame([("12",), ("",), ("x",), (None,)], "t string")
    assert [r[0] for r in texts.select(as_int("t")).collect()] == [12, None, None, None]
    one = spark.range(1)
    got = one.select(
        date_of(F.lit(OCT_1 - 1)),
        hour_of(F.lit(OCT_1 - 1)),
        days_between(parse_date(F.lit("2018-02-27")), parse_date(F.lit("2018-03-02"))),
        parse_date(F.lit("no date")),
    ).first()
    assert tuple(got) == (date(2018, 9, 30), 23, 3, None)


def test_dates_follow_the_session_zone(spark, log):
    try:
        configure(spark, "Asia/Shanghai")
        late = op.user_activity(log).where("userId = '14'").first()
        (hour,) = log.where("userId = '14' AND level = 'free'").select(hour_of("ts")).first()
    finally:
        configure(spark)
    assert (late.latest_date, hour) == (date(2018, 10, 2), 7)


def test_shuffles_are_sized_by_the_input(spark):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        configure(spark, input_bytes=100 * 1024**4)
        assert spark.conf.get(key) == str(100 * 1024**4 // (128 * 1024**2))
        configure(spark, input_bytes=1)
        assert spark.conf.get(key) == "4"
    finally:
        spark.conf.unset(key)


def test_lookup_of_one_user(raw):
    assert op.events_of_user(raw, 14).count() == 2
    assert op.with_user_number(raw).where("user_number IS NULL").count() == 4


def test_feature_table_grains(log, facts):
    users = op.feature_table(facts)
    assert users.columns == [
        "userId", "gender", "area", "delta_time", "song_nums", "label", "weight",
    ]
    events = op.feature_table(facts, "event", log)
    assert events.count() == 17 == users.agg(F.sum("weight")).first()[0]
    with pytest.raises(ValueError):
        op.feature_table(facts, "event")
