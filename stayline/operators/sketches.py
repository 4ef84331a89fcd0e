"""Counts and quantiles of any range of days from sketches that were stored per day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stayline.operators.distributions import CHURN_FLAG, QUARTILES

LOG_BUCKETS = 12
USERS_ERROR = 4 * 1.04 / 2 ** (LOG_BUCKETS / 2)  # four standard errors of a sketch
VALUES = 400
RANK_ERROR = 0.02  # of a quantile sketch of so many values, at 99 % confidence and more


def user_sketches(log: DataFrame, day: Column, log_buckets: int = LOG_BUCKETS) -> DataFrame:
    """(day, users): a sketch of the distinct user ids of each day."""
    return log.groupBy(day.alias("day")).agg(F.hll_sketch_agg("userId", log_buckets).alias("users"))


def users_by_range(sketches: DataFrame, of_day: Column) -> DataFrame:
    """(period, users): about how many distinct users each period has; its days are merged."""
    merged = sketches.groupBy(of_day.alias("period")).agg(F.hll_union_agg("users").alias("users"))
    return merged.select("period", F.hll_sketch_estimate("users").alias("users"))


def value_sketches(
    df: DataFrame, value: str, day: Column, by: str = CHURN_FLAG, values: int = VALUES
) -> DataFrame:
    """(by, day, values): a quantile sketch for each cohort and day; NULL and NaN are left out."""
    number = F.col(value).cast("double")
    known = df.where(number.isNotNull() & ~F.isnan(number))
    sketch = F.kll_sketch_agg_double(number, F.lit(values)).alias("values")
    return known.groupBy(by, day.alias("day")).agg(sketch)


def sketched_quantiles(
    sketches: DataFrame, by: str = CHURN_FLAG, probs: Sequence[float] = QUARTILES
) -> DataFrame:
    """(by, n, q1, q2, ...) of each cohort from the merged sketches of its days."""
    merged = sketches.groupBy(by).agg(F.kll_merge_agg_double("values").alias("values"))
    return merged.select(
        by,
        F.kll_sketch_get_n_double("values").alias("n"),
        *[
            F.kll_sketch_get_quantile_double("values", F.lit(float(p))).alias(f"q{i}")
            for i, p in enumerate(probs, 1)
        ],
    )


def rank_errors(
    counts: DataFrame, quantiles: DataFrame, by: str = CHURN_FLAG, probs: Sequence[float] = QUARTILES
) -> DataFrame:
    """(by, n, e1, e2, ...): how far each quantile's rank is from the one asked for.

    ``counts`` is a :func:`stayline.operators.value_counts` table. A value that many rows share
    has all their ranks.
    """
    asked = quantiles.drop("n").withColumnRenamed(by, "_cohort")
    joined = counts.join(asked, F.col(by).eqNullSafe(F.col("_cohort")))
    parts = [F.sum("n").alias("n")]
    for i in range(1, len(probs) + 1):
        parts.append(F.sum(F.when(F.col("v") < F.col(f"q{i}"), F.col("n")).otherwise(0)).alias(f"b{i}"))
        parts.append(F.sum(F.when(F.col("v") <= F.col(f"q{i}"), F.col("n")).otherwise(0)).alias(f"a{i}"))
    ranks = joined.groupBy(by).agg(*parts)
    n = F.col("n")
    return ranks.select(
        by,
        "n",
        *[
            F.greatest(F.lit(0.0), F.col(f"b{i}") / n - p, p - F.col(f"a{i}") / n).alias(f"e{i}")
            for i, p in enumerate(probs, 1)
        ],
    )
