"""Column expressions; all of them are native, so filters and codegen see through them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The pages that stand for a play and for a cancelled account.
PLAY_PAGE = "NextSong"
CHURN_PAGE = "Cancellation Confirmation"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_of(millis: Column | str) -> Column:
    """Calendar date of an epoch-millisecond value, in the session time zone."""
    return F.to_date(F.timestamp_millis(_col(millis)))


def date_text_of(millis: Column | str) -> Column:
    """The same date as ``yyyy-MM-dd`` text."""
    return F.date_format(F.timestamp_millis(_col(millis)), "yyyy-MM-dd")


def parse_date(text: Column | str) -> Column:
    """Date of ``yyyy-MM-dd`` text; NULL where the text is no date."""
    return F.try_to_date(_col(text), "yyyy-MM-dd")


def hour_of(millis: Column | str) -> Column:
    """Hour of day, in the session time zone."""
    return F.hour(F.timestamp_millis(_col(millis)))


def days_between(start: Column | str, end: Column | str) -> Column:
    """Whole days from ``start`` to ``end``."""
    return F.datediff(_col(end), _col(start))


def area_of(location: Column | str, trim: bool = False) -> Column:
    """Text after the last comma, or all of it without one; NULL stays NULL.

    The blank after the comma is part of the value unless ``trim`` is set.
    """
    area = F.substring_index(_col(location), ",", -1)
    return F.trim(area) if trim else area


def page_is(page: str) -> Column:
    """1 where the event is on this page, else 0, also where the page is NULL."""
    return F.when(F.col("page") == page, 1).otherwise(0)


def as_int(c: Column | str) -> Column:
    """Integer value, NULL where the text is no number (a plain cast would fail)."""
    return _col(c).try_cast("int")


def share(part: Column | str, whole: Column | str) -> Column:
    """``part / whole`` as a double; NULL for an empty whole."""
    return F.try_divide(_col(part).cast("double"), _col(whole).cast("double"))
