"""Running count of churn markers per user, latest event first."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from stayline.functions import CHURN_PAGE
from stayline.operators.facts import mark_churn

HOUR = 3_600_000
BEFORE_ALL = -(2**63)
# A bit for each hash of a user id: words of 64 bits, so at most 2**20 rows are broadcast.
FILTER_BITS, MAX_FILTER_BITS = 1 << 25, 1 << 26
BITS_PER_USER, LEAST_BITS_PER_USER = 16, 2


def filter_bits_for(users: int) -> int:
    """Bits for a number of users with a marker; 0 where most bits would be set by them."""
    if users * LEAST_BITS_PER_USER > MAX_FILTER_BITS:
        return 0
    return min(MAX_FILTER_BITS, max(64, 1 << (users * BITS_PER_USER).bit_length()))


def marked_users(log: DataFrame, churn_page: str = CHURN_PAGE) -> int:
    """About how many users have a marker, from one pass over the rows of that page."""
    marks = log.where(F.col("page") == churn_page)
    return marks.agg(F.approx_count_distinct("userId")).first()[0]


def churn_phase(
    log: DataFrame, churn_page: str = CHURN_PAGE, filter_bits: int = FILTER_BITS
) -> DataFrame:
    """The log with ``churn_running``: the user's marker rows at or after this event.

    Above 0 up to the marker, 0 after the last one. Rows of users without a marker are 0 and stay
    where they are; a bitmap of fixed size, filled with the hashes of users that have a marker,
    tells them. Only the others (and the few that share a hash with them) are counted.

    ``filter_bits`` sizes the bitmap, see :func:`filter_bits_for`; 0 does without one, where nearly
    all users have a marker or too many do.
    """
    marked = mark_churn(log, churn_page)
    if not filter_bits:
        return _counted(marked)
    bit = F.pmod(F.xxhash64("userId"), F.lit(filter_bits))
    place = {"_word": F.floor(bit / 64).cast("long"), "_bit": (bit % 64).cast("int")}
    bits = (
        log.where(F.col("page") == churn_page)
        .withColumns(place)
        .groupBy("_word")
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), "_bit")).alias("_bits"))
    )
    placed = marked.withColumns(place).join(F.broadcast(bits), "_word", "left")
    held = F.call_function("shiftrightunsigned", F.coalesce("_bits", F.lit(0)), F.col("_bit"))
    placed = placed.withColumn("_held", held.bitwiseAND(F.lit(1).cast("long")) == 1)
    silent = placed.where(~F.col("_held")).select(
        *marked.columns, F.lit(0).cast("long").alias("churn_running")
    )
    return silent.unionByName(_counted(placed.where("_held").select(*marked.columns)))


def _counted(marked: DataFrame) -> DataFrame:
    """The running count without holding a user's rows in one task.

    Rows are condensed to moments and summed within each hour, where at most 3.6 million distinct
    moments fit; the markers of later hours are added from a table with one row per user and hour.
    Events without a time count as earliest.
    """
    timed = marked.withColumn("_moment", F.coalesce("ts", F.lit(BEFORE_ALL)))
    moments = (
        timed.groupBy("userId", "_moment")
        .agg(F.sum("churn").alias("marks"))
        .withColumn("hour", F.floor(F.col("_moment") / HOUR))
    )
    hours = moments.groupBy("userId", "hour").agg(F.sum("marks").alias("hour_marks"))
    later_hours = (
        Window.partitionBy("userId")
        .orderBy(F.desc("hour"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    within_hour = (
        Window.partitionBy("userId", "hour")
        .orderBy(F.desc("_moment"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    later = hours.select(
        F.col("userId").alias("_user"),
        F.col("hour").alias("_hour"),
        F.coalesce(F.sum("hour_marks").over(later_hours), F.lit(0)).alias("later"),
    )
    same_hour = F.col("userId").eqNullSafe(F.col("_user")) & (F.col("hour") == F.col("_hour"))
    running = moments.join(later, same_hour).select(
        F.col("userId").alias("_of"),
        F.col("_moment").alias("_at"),
        (F.col("later") + F.sum("marks").over(within_hour)).alias("churn_running"),
    )
    same_moment = F.col("userId").eqNullSafe(F.col("_of")) & (F.col("_moment") == F.col("_at"))
    return timed.join(running, same_moment).drop("_moment", "_of", "_at")
