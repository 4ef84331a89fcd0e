from stayline.functions.columns import (
    CHURN_PAGE,
    PLAY_PAGE,
    area_of,
    as_int,
    date_of,
    date_text_of,
    days_between,
    hour_of,
    page_is,
    parse_date,
    share,
)

__all__ = [
    "CHURN_PAGE",
    "PLAY_PAGE",
    "area_of",
    "as_int",
    "date_of",
    "date_text_of",
    "days_between",
    "hour_of",
    "page_is",
    "parse_date",
    "share",
]
