from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stayline.session import configure  # noqa: E402
from stayline.sources import EVENT_SCHEMA  # noqa: E402

SF = "/root/testdata/sf0.001"
DAY = 86_400_000
OCT_1 = 1_538_352_000_000  # 2018-10-01 00:00 UTC


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("stayline-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


def _rows():
    """The hand fixture: one user for each shape that is easy to get wrong."""

    def row(user, session, page, at, reg, level="free", status=200, gender="M", place="Lodi, CA"):
        reg_ms = None if reg is None else OCT_1 + reg * DAY
        return (user, session, page, OCT_1 + at, reg_ms, level, status, gender, place)

    play, cancel, home = "NextSong", "Cancellation Confirmation", "Home"
    hour = 3_600_000
    return [
        # without an id
        row("", 1, home, 0, None),
        row("", 1, play, hour, None),
        row("", 2, cancel, 2 * hour, None),
        row(None, 3, play, 0, None),
        # 11: the cancellation is the last row; one row without session
        row("11", 10, play, hour, -10, "paid"),
        row("11", 10, play, 2 * hour, -10, "paid"),
        row("11", None, play, 3 * hour, -10, "paid"),
        row("11", 10, cancel, DAY, -10, "paid"),
        # 12: two cancellations, and events after them
        row("12", 20, play, hour, -5, gender="F", place="New York-Newark, NY-NJ-PA"),
        row("12", 20, cancel, 2 * hour, -5, gender="F", place="New York-Newark, NY-NJ-PA"),
        row("12", 20, cancel, 3 * hour, -5, gender="F", place="New York-Newark, NY-NJ-PA"),
        row("12", 21, home, 2 * DAY, -5, gender="F", place="New York-Newark, NY-NJ-PA"),
        # 13: cancelled without a play
        row("13", 30, home, hour, -3),
        row("13", 30, cancel, 2 * hour, -3),
        # 14: both levels, no comma, events on both sides of midnight
        row("14", 40, play, DAY - 1, -20, "free", 200, "F", "Boston"),
        row("14", 40, play, DAY, -20, "paid", 200, "F", "Boston"),
        # 15: no normal visit, nothing known of the user
        row("15", 50, play, hour, -7, "free", 307, None, None),
        row("15", 50, home, 2 * hour, -7, "free", 404, None, None),
        row("15", 50, home, 3 * hour, -7, "free", None, None, None),
        # 16: registered on its last day
        row("16", 60, play, 5 * hour, 0),
        row("16", 60, home, 6 * hour, 0, "free", 404),
        # 17: two registrations
        row("17", 70, play, hour, -4, "paid"),
        row("17", 70, play, 2 * hour, -2, "paid"),
        row("17", 70, play, 2 * hour, -2, "paid"),
    ]


@pytest.fixture(scope="session")
def raw(spark):
    return spark.createDataFrame(_rows(), EVENT_SCHEMA).persist()


@pytest.fixture(scope="session")
def log(raw):
    from stayline.operators import drop_invalid

    return drop_invalid(raw).persist()


@pytest.fixture(scope="session")
def facts(log):
    from stayline.operators import user_facts

    return user_facts(log).persist()
