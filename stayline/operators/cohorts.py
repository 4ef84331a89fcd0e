"""Cohort tables: how churned and retained users differ."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stayline.functions import share


def users_by(users: DataFrame, by: str, name: str = "users") -> DataFrame:
    """Users per value; counts the value, so the NULL group shows 0."""
    return users.groupBy(by).agg(F.count(by).alias(name))


def churn_by(users: DataFrame, by: str, name: str = "users") -> DataFrame:
    """Users per value and churn flag."""
    return users.groupBy("churn_users", by).agg(F.count(by).alias(name))


def cohort_share(users: DataFrame, by: str, name: str = "users") -> DataFrame:
    """Retained and churned share of each value, the data of a stacked bar chart.

    One aggregate; both shares belong to the same row, so they cannot be paired
    with the wrong total.
    """
    counts = users.groupBy(by).agg(
        F.count(by).alias(name),
        F.count_if((F.col("churn_users") == 1) & F.col(by).isNotNull()).alias("churned"),
    )
    return counts.select(
        by,
        name,
        "churned",
        share(F.col(name) - F.col("churned"), name).alias("retained_share"),
        share("churned", name).alias("churn_share"),
    ).orderBy(F.desc(by))
