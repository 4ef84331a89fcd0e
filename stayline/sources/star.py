"""An event log laid over the star-schema tables ``events``, ``customer`` and ``nation``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from stayline.operators.skew import BROADCAST_BYTES, is_small, join_lookup
from stayline.sources.events import EVENT_SCHEMA, map_columns

# How each log column is derived from the tables.
USER_ID = "CASE WHEN user_id % 50 = 0 THEN '' ELSE CAST(user_id AS STRING) END"
GENDER = "CASE WHEN user_id % 2 = 0 THEN 'M' ELSE 'F' END"
EVENT_COLUMNS = {
    "userId": USER_ID,
    "sessionId": "CASE WHEN event_id % 97 = 0 THEN NULL ELSE event_id DIV 20 END",
    "page": (
        "CASE WHEN event_type = 'error' AND value >= 200 THEN 'Cancellation Confirmation' "
        "WHEN event_type = 'view' AND value >= 100 THEN 'NextSong' ELSE event_type END"
    ),
    "ts": "unix_millis(CAST(ts AS TIMESTAMP))",
    "registration": "unix_millis(CAST(first_signup AS TIMESTAMP))",
    "level": "CASE WHEN value >= 50 THEN 'paid' ELSE 'free' END",
    "status": (
        "CASE WHEN event_type = 'error' AND value < 10 THEN 404 "
        "WHEN event_type = 'click' THEN 307 ELSE 200 END"
    ),
    "gender": GENDER,
    "location": "concat(c_name, ', ', n_name)",
}
# Columns that come from a user's rows in other tables.
USER_COLUMNS = ("registration", "location")

# The columns the log is made of; a given schema spares the job that reads file footers.
SCHEMAS = {
    "events": (
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE"
    ),
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT",
    "nation": "n_nationkey INT, n_name STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the tables, with the columns a log is made of."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer: name, nation and first signup."""
    signups = (
        table(spark, sf_dir, "events")
        .where(F.col("event_type") == "signup")
        .groupBy("user_id")
        .agg(F.min("ts").alias("first_signup"))
    )
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), "c_name", F.col("c_nationkey").alias("n_nationkey")
    )
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        customers.join(nations, "n_nationkey", "left")
        .join(signups, "user_id", "left")
        .drop("n_nationkey")
    )


def event_log(
    spark: SparkSession,
    sf_dir: str,
    columns: Sequence[str] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The event log, or some of its columns.

    Only ``registration`` and ``location`` need other tables; without them the log
    is a plain scan of ``events``. With them it is a scan and one join: users are broadcast if
    the customers take no more than ``broadcast_bytes``.
    """
    names = EVENT_SCHEMA.fieldNames() if columns is None else list(columns)
    source = table(spark, sf_dir, "events")
    if set(names) & set(USER_COLUMNS):
        users = _users(spark, sf_dir)
        small = is_small(table(spark, sf_dir, "customer"), broadcast_bytes)
        source = join_lookup(source, users, "user_id", "left", small)
    return map_columns(source, {c: EVENT_COLUMNS[c] for c in names})


def user_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The per-user columns of the log as a table of their own, users without an id left out."""
    mapping = {
        c: EVENT_COLUMNS[c] for c in ("userId", "gender", "location", "registration")
    }
    return map_columns(_users(spark, sf_dir), mapping).where(F.col("userId") != "")
