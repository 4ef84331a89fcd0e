"""Per-user facts: the log condensed to one row per user, and put back onto its rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from stayline.functions import (
    CHURN_PAGE,
    PLAY_PAGE,
    area_of,
    date_of,
    days_between,
    page_is,
    share,
)
from stayline.operators.skew import join_lookup

NORMAL_STATUS = (200,)
PROBLEM_STATUS = (404,)

FACT_COLUMNS = (
    "userId",
    "gender",
    "area",
    "registration_date",
    "latest_date",
    "delta_time",
    "song_nums",
    "n_events",
    "n_normal",
    "n_problem",
    "churn_rows",
    "churn_users",
)


ACTIVITY_COLUMNS = ("song_nums", "n_events", "n_normal", "n_problem", "churn_rows")


def _measures(
    play_page: str, churn_page: str, normal: Sequence[int], problem: Sequence[int]
) -> list[Column]:
    """What is counted per user; all fixed-width, so a hash aggregate combines before the shuffle."""
    return [
        F.max("ts").alias("latest"),
        F.count_if(F.col("page") == play_page).alias("song_nums"),
        F.count("*").alias("n_events"),
        F.count_if(F.col("status").isin(*normal)).alias("n_normal"),
        F.count_if(F.col("status").isin(*problem)).alias("n_problem"),
        F.count_if(F.col("page") == churn_page).alias("churn_rows"),
    ]


def user_activity(
    log: DataFrame,
    *,
    play_page: str = PLAY_PAGE,
    churn_page: str = CHURN_PAGE,
    normal: Sequence[int] = NORMAL_STATUS,
    problem: Sequence[int] = PROBLEM_STATUS,
) -> DataFrame:
    """What a cleaned log tells of each user without their attributes: last day,
    counts and the churn flag. One scan, one shuffle."""
    condensed = log.groupBy("userId").agg(*_measures(play_page, churn_page, normal, problem))
    return condensed.select(
        "userId", date_of("latest").alias("latest_date"), *ACTIVITY_COLUMNS, _churn_flag()
    )


def _churn_flag() -> Column:
    return (F.col("churn_rows") > 0).cast("int").alias("churn_users")


def user_facts(
    log: DataFrame,
    profile: DataFrame | None = None,
    *,
    play_page: str = PLAY_PAGE,
    churn_page: str = CHURN_PAGE,
    normal: Sequence[int] = NORMAL_STATUS,
    problem: Sequence[int] = PROBLEM_STATUS,
    trim_area: bool = False,
    keep: Sequence[str] = (),
    spread: str | None = None,
) -> DataFrame:
    """One row per user of a cleaned log.

    Gender and location are the non-NULL values of the user's latest event that
    has one (ties: the greater value), registration is the earliest seen. Where
    these live in a table of their own, pass it as ``profile`` (``userId``,
    ``gender``, ``location``, ``registration``): it is joined after the log is
    condensed, so no event row is shuffled for it. ``keep`` names attributes (``registration``,
    ``location``) to stay beside the facts made of them. ``spread`` names a column by which, with
    the user id, the log lies in buckets: it then is condensed where it lies.
    """
    measures = _measures(play_page, churn_page, normal, problem)
    dealt = ["userId", spread] if spread else ["userId"]
    if profile is not None:
        condensed = log.groupBy(*dealt).agg(*measures)
        if spread:
            sums = [F.sum(c).alias(c) for c in ACTIVITY_COLUMNS]
            condensed = condensed.groupBy("userId").agg(F.max("latest").alias("latest"), *sums)
        users = condensed.join(
            profile.select("userId", "gender", "location", "registration"), "userId", "left"
        )
    else:
        users = _with_attributes(log, measures, dealt)
    facts = users.select(
        "userId",
        "gender",
        area_of("location", trim_area).alias("area"),
        date_of("registration").alias("registration_date"),
        date_of("latest").alias("latest_date"),
        *ACTIVITY_COLUMNS,
        _churn_flag(),
        *keep,
    ).withColumn("delta_time", days_between("registration_date", "latest_date"))
    return facts.select(*FACT_COLUMNS, *keep)


def _with_attributes(log: DataFrame, measures: list[Column], dealt: list[str]) -> DataFrame:
    """Measures and attributes of a log that repeats the attributes on each row.

    An aggregate that keeps text (the latest gender) has to sort its input, so
    the attributes are grouping keys of a first, hash-based step, and only its
    few rows per user reach the sorting one.
    """
    parts = log.groupBy(*dealt, "gender", "location").agg(
        *measures, F.min("registration").alias("registration")
    )

    def latest_known(c: str) -> Column:
        known = F.when(F.col(c).isNotNull(), F.struct("latest", c))
        return F.max(known)[c].alias(c)

    return parts.groupBy("userId").agg(
        F.max("latest").alias("latest"),
        *[F.sum(c).alias(c) for c in ACTIVITY_COLUMNS],
        F.min("registration").alias("registration"),
        latest_known("gender"),
        latest_known("location"),
    )


def keep_players(users: DataFrame, zero_plays: str = "drop") -> DataFrame:
    """Users with at least one play (``"drop"``), or all of them (``"keep"``)."""
    if zero_plays not in ("drop", "keep"):
        raise ValueError("zero_plays is 'drop' or 'keep'")
    return users.where(F.col("song_nums") > 0) if zero_plays == "drop" else users


def user_values(
    log: DataFrame,
    column: str,
    *,
    zero_plays: str = "drop",
    play_page: str = PLAY_PAGE,
    churn_page: str = CHURN_PAGE,
) -> DataFrame:
    """One row per user and value of a low-cardinality column (level, status),
    with the events counted and the user's churn flag.

    The log is condensed first; the window that spreads the flag over a user's
    rows then sees as many rows per user as the column has values.
    """
    parts = log.groupBy("userId", column).agg(
        F.count("*").alias("n_events"),
        F.count_if(F.col("page") == play_page).alias("plays"),
        F.count_if(F.col("page") == churn_page).alias("marks"),
    )
    user = Window.partitionBy("userId")
    flagged = parts.select(
        "userId",
        column,
        "n_events",
        F.sum("plays").over(user).alias("song_nums"),
        (F.sum("marks").over(user) > 0).cast("int").alias("churn_users"),
    )
    return keep_players(flagged, zero_plays).drop("song_nums")


def user_levels(log: DataFrame, **options: str) -> DataFrame:
    """Users once for each level they held."""
    return user_values(log, "level", **options).select("userId", "level", "churn_users")


def status_by_user(log: DataFrame, **options: str) -> DataFrame:
    """Events per user and status; events without a status count as 0."""
    n = F.when(F.col("status").isNotNull(), F.col("n_events")).otherwise(0)
    return user_values(log, "status", **options).select(
        "userId", "churn_users", "status", n.alias("n")
    )


def events_by_status(log: DataFrame, **options: str) -> DataFrame:
    return status_by_user(log, **options).groupBy("status").agg(F.sum("n").alias("n"))


def problem_visits(
    log: DataFrame, problem: Sequence[int] = PROBLEM_STATUS, **options: str
) -> DataFrame:
    """Users that met one of these statuses, with their churn flag."""
    return (
        status_by_user(log, **options)
        .where(F.col("status").isin(*problem))
        .select("status", "userId", "churn_users")
    )


def normal_visit_ratio(facts: DataFrame, require_normal: bool = False) -> DataFrame:
    """Share of normal visits per user; ``require_normal`` leaves out users without any."""
    users = facts.where(F.col("n_normal") > 0) if require_normal else facts
    return users.select("userId", "churn_users", share("n_normal", "n_events").alias("ratio"))


def plays_per_user(log: DataFrame, play_page: str = PLAY_PAGE) -> DataFrame:
    """Plays of each user that has any."""
    return (
        log.where(F.col("page") == play_page)
        .groupBy("userId")
        .agg(F.count("*").alias("song_nums"))
    )


def events_per_user(facts: DataFrame) -> DataFrame:
    return facts.select("userId", "n_events").orderBy("userId")


def actions_in_window(
    log: DataFrame,
    page: str,
    days: int,
    *,
    churn_page: str = CHURN_PAGE,
) -> DataFrame:
    """Per cohort, the users and their events on ``page`` in the last ``days`` days of each user:
    (churn_users, users, acting_users, actions, actions_per_user).

    Events without a time lie in no window. Events are condensed to days before anything is
    joined, so no user's rows meet in one task; the days of a user are few.
    """
    day = F.floor(F.col("ts") / 86_400_000)
    by_day = log.groupBy("userId", day.alias("day")).agg(
        F.max("ts").alias("latest"),
        F.count_if(F.col("page") == churn_page).alias("marks"),
        F.count_if(F.col("page") == page).alias("on_page"),
    )
    users = by_day.groupBy("userId").agg(
        F.max("latest").alias("end"), (F.sum("marks") > 0).cast("int").alias("churn_users")
    )
    bounds = users.withColumn("begin", F.col("end") - days * 86_400_000)
    # Whole days inside the window from the day table, the day it begins in from the events.
    begin_day = F.floor(F.col("begin") / 86_400_000)
    whole = by_day.join(bounds, "userId").where(F.col("day") > begin_day)
    whole = whole.select("userId", F.col("on_page").alias("n"))
    edge = log.where(F.col("page") == page).join(bounds, "userId")
    edge = edge.where((day == begin_day) & (F.col("ts") > F.col("begin")))
    edge = edge.groupBy("userId").agg(F.count("*").alias("n"))
    acted = whole.unionByName(edge).groupBy("userId").agg(F.sum("n").alias("n"))
    per_user = users.join(acted, "userId", "left").fillna(0, ["n"])
    return per_user.groupBy("churn_users").agg(
        F.count("*").alias("users"),
        F.count_if(F.col("n") > 0).alias("acting_users"),
        F.sum("n").alias("actions"),
        share(F.sum("n"), F.count("*")).alias("actions_per_user"),
    )


def churn_summary(facts: DataFrame) -> DataFrame:
    """Marker rows and churned users; they differ where a user cancelled twice."""
    return facts.agg(
        F.sum("churn_rows").alias("marker_rows"),
        F.count_if(F.col("churn_users") == 1).alias("churned_users"),
        F.count("*").alias("users"),
    )


def mark_churn(log: DataFrame, churn_page: str = CHURN_PAGE) -> DataFrame:
    """The log with ``churn``: 1 on the rows of the marker page."""
    return log.withColumn("churn", page_is(churn_page))


def attach_facts(
    log: DataFrame,
    facts: DataFrame,
    columns: Sequence[str],
    how: str = "inner",
    small: bool = False,
    n_ids: int | None = None,
) -> DataFrame:
    """Log rows with facts of their user; starts no job.

    ``small`` says that the facts were stored and their size checked
    (:func:`stayline.operators.skew.is_small`): they are broadcast then. ``n_ids`` says that they
    are facts of so many users only, see :func:`stayline.operators.skew.join_lookup`.
    """
    return join_lookup(log, facts.select("userId", *columns), "userId", how, small, n_ids)


def with_plays(
    log: DataFrame, plays: DataFrame, zero_plays: str = "drop", small: bool = False
) -> DataFrame:
    """Log rows with ``song_nums`` from facts or :func:`plays_per_user`.

    ``"drop"`` loses the rows of users without plays, ``"keep"`` gives them 0.
    """
    if zero_plays == "drop":
        return attach_facts(log, keep_players(plays), ["song_nums"], "inner", small)
    joined = attach_facts(log, plays, ["song_nums"], "left", small)
    return joined.fillna(0, ["song_nums"])


def rows_of_churned(
    log: DataFrame,
    facts: DataFrame,
    churned: bool = True,
    small: bool = False,
    n_ids: int | None = None,
) -> DataFrame:
    """Rows of churned users (semi join), or of all others (anti join).

    ``n_ids`` is the number of churned users, where their ids are not small: it sizes a filter.
    """
    ids = facts.where(F.col("churn_users") == 1)
    return attach_facts(log, ids, [], "left_semi" if churned else "left_anti", small, n_ids)


def enrich(
    log: DataFrame,
    facts: DataFrame,
    zero_plays: str = "drop",
    churn_page: str = CHURN_PAGE,
    small: bool = False,
) -> DataFrame:
    """The wide log: event columns, dates, the churn marker and the user's facts.

    ``registration`` and ``location`` are taken from ``facts`` where the log does
    not carry them, so that one join brings all that belongs to the user.
    """
    wanted = ["latest_date", "delta_time", "song_nums", "churn_users"]
    wanted += [c for c in ("registration", "location") if c not in log.columns]
    users = keep_players(facts, zero_plays)
    return attach_facts(log, users, wanted, "inner", small).withColumns(
        {
            "event_date": date_of("ts"),
            "registration_date": date_of("registration"),
            "area": area_of("location"),
            "churn": page_is(churn_page),
        }
    )
