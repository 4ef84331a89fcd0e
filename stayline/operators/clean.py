"""Row filters, the audit of what they remove, and first looks at the log."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from stayline.functions import as_int, date_of, hour_of

CORRUPT = "_corrupt_record"

IDS = ("userId", "sessionId")
BLANK_IDS = ("userId",)


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(and_, conditions, F.lit(True))


def _corrupt(log: DataFrame) -> Column:
    """Whether a row comes from a malformed line; only a log read with its corrupt lines knows."""
    return F.col(CORRUPT).isNotNull() if CORRUPT in log.columns else F.lit(False)


def drop_invalid(
    log: DataFrame,
    ids: Sequence[str] = IDS,
    blank_ids: Sequence[str] = BLANK_IDS,
    drop_corrupt: bool = False,
) -> DataFrame:
    """Keep rows where no id is NULL and no text id is blank.

    A malformed line may have its ids all the same: ``drop_corrupt`` removes such rows, and the
    column that tells them, from a log read with ``keep_corrupt``.

    Written as plain predicates, as these reach a parquet scan and ``dropna``
    does not.
    """
    present = [F.col(c).isNotNull() for c in ids]
    filled = [F.col(c) != "" for c in blank_ids]
    kept = log.where(_all([*present, *filled]))
    return kept.where(~_corrupt(log)).drop(CORRUPT) if drop_corrupt else kept


def quality_audit(
    log: DataFrame,
    ids: Sequence[str] = IDS,
    blank_ids: Sequence[str] = BLANK_IDS,
    by: Sequence[str] = (),
) -> DataFrame:
    """One row of counts: all rows, NULL and blank ids, rows kept and removed, in one pass.

    ``by`` asks for a row for each value of these columns, such as the ``file`` of a log that was
    read with ``keep_file``.

    ``n_corrupt`` are rows of malformed lines, of a log read with ``keep_corrupt``; they count as
    kept where their ids are whole, as :func:`drop_invalid` keeps them unless told otherwise.
    """
    no_null = _all([F.col(c).isNotNull() for c in ids])
    kept = _all([no_null, *[F.coalesce(F.col(c) != "", F.lit(False)) for c in blank_ids]])
    return log.groupBy(*by).agg(
        F.count("*").alias("n_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in ids],
        *[F.count_if(F.col(c) == "").alias(f"blank_{c}") for c in blank_ids],
        F.count_if(_corrupt(log)).alias("n_corrupt"),
        F.count_if(no_null).alias("n_without_nulls"),
        F.count_if(kept).alias("n_kept"),
        F.count_if(~kept).alias("n_removed"),
    )


def distinct_users(log: DataFrame, approx: bool = False) -> DataFrame:
    """Number of distinct user ids; NULL counts as one value, as it does for ``distinct``.

    ``approx`` takes a HyperLogLog sketch, which shuffles a few KB per task.
    """
    count = F.approx_count_distinct if approx else F.count_distinct
    any_null = F.coalesce(F.max(F.col("userId").isNull().cast("int")), F.lit(0))
    return log.agg((count("userId") + any_null).cast("long").alias("users"))


def distinct_values(log: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values of a column."""
    return log.select(column).distinct().orderBy(column)


def date_range(log: DataFrame, column: str) -> DataFrame:
    """First and last date of an epoch-millisecond column.

    Dates grow with the milliseconds, so only two values per task are converted.
    """
    return log.agg(
        date_of(F.min(column)).alias("first_date"), date_of(F.max(column)).alias("last_date")
    )


def events_on_page(log: DataFrame, page: str) -> DataFrame:
    return log.where(F.col("page") == page)


def events_where(log: DataFrame, predicate: str) -> DataFrame:
    """Rows that meet a predicate given as SQL text."""
    return log.where(predicate)


def events_of_user(log: DataFrame, user: int, cast: bool = False) -> DataFrame:
    """Rows of one user, given as a number.

    Ids are compared as text, which a scan can filter by. ``cast`` compares numbers instead, so
    that ``08`` is user 8 as well; ids that are no number match nothing.
    """
    return log.where(as_int("userId") == user if cast else F.col("userId") == str(user))


def with_user_number(log: DataFrame) -> DataFrame:
    """The log with its user id as an integer column beside the text."""
    return log.withColumn("user_number", as_int("userId"))


def events_by_hour(log: DataFrame) -> DataFrame:
    return log.groupBy(hour_of("ts").alias("hour")).agg(F.count("*").alias("n"))
