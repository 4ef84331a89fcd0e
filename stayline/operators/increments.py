"""Facts kept up to date: a state for each user and day, and its merge.

A day's log is condensed to one state per user and written into the folder of that day; a day that
comes again replaces its folder, a late one adds it. Facts are merged from the states, which have a
row per user and active day, and the log is not read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from stayline.functions import CHURN_PAGE, PLAY_PAGE, area_of, date_of, days_between
from stayline.operators.facts import (
    ACTIVITY_COLUMNS,
    FACT_COLUMNS,
    NORMAL_STATUS,
    PROBLEM_STATUS,
    _churn_flag,
    _measures,
)
from stayline.sources.sinks import write_table

DAY = "day"
ATTRIBUTES = ("gender", "location")
STATE = (
    "userId string, latest long, song_nums long, n_events long, n_normal long, n_problem long,"
    " churn_rows long, registration long, gender struct<latest: long, value: string>,"
    " location struct<latest: long, value: string>, day date"
)


def daily_states(
    log: DataFrame,
    *,
    play_page: str = PLAY_PAGE,
    churn_page: str = CHURN_PAGE,
    normal: Sequence[int] = NORMAL_STATUS,
    problem: Sequence[int] = PROBLEM_STATUS,
) -> DataFrame:
    """One row per user and day of a cleaned log: maxima, counts, and the latest known attributes
    with their times. Events without a time have the day NULL."""
    measures = _measures(play_page, churn_page, normal, problem)
    parts = log.groupBy(date_of("ts").alias(DAY), "userId", *ATTRIBUTES).agg(
        *measures, F.min("registration").alias("registration")
    )
    known = {c: F.when(F.col(c).isNotNull(), F.struct("latest", F.col(c).alias("value"))) for c in ATTRIBUTES}
    return _merged(parts.withColumns(known), DAY, "userId")


def _merged(states: DataFrame, *keys: str) -> DataFrame:
    """States of the same keys as one; the order of merging doesn't matter."""
    return states.groupBy(*keys).agg(
        F.max("latest").alias("latest"),
        *[F.sum(c).alias(c) for c in ACTIVITY_COLUMNS],
        F.min("registration").alias("registration"),
        *[F.max(c).alias(c) for c in ATTRIBUTES],
    )


def store_days(states: DataFrame, path: str) -> None:
    """Write states into the folders of their days; only these folders are replaced."""
    write_table(states, path, partition_by=DAY, mode="replace")


def stored_states(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STATE).parquet(path)


def merged_facts(states: DataFrame, trim_area: bool = False) -> DataFrame:
    """What :func:`stayline.operators.user_facts` gives for the log the states were made of."""
    users = _merged(states, "userId")
    facts = users.select(
        "userId",
        F.col("gender.value").alias("gender"),
        area_of("location.value", trim_area).alias("area"),
        date_of("registration").alias("registration_date"),
        date_of("latest").alias("latest_date"),
        *ACTIVITY_COLUMNS,
        _churn_flag(),
    )
    tenure = days_between("registration_date", "latest_date")
    return facts.withColumn("delta_time", tenure).select(*FACT_COLUMNS)
