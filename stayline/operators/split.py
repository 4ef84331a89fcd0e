"""Reproducible splits by user.

A hash of the user id decides, so that all rows of a user fall into one part,
and the result depends neither on partitioning nor on run order.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

SEED = 24
PARTS = {"train": 64, "valid": 16, "test": 20}  # 0.8 x 0.8, 0.8 x 0.2 and 0.2
FOLDS = 3


def user_bucket(seed: int | str, buckets: int) -> Column:
    """A number in [0, buckets) that depends on seed and user id only."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col("userId").cast("string")))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % buckets).cast("int")


def split_users(
    df: DataFrame, seed: int | str = SEED, parts: Mapping[str, int] = PARTS
) -> DataFrame:
    """``df`` with ``part``, drawn in the given proportions."""
    part, upper = F.lit(None).cast("string"), sum(parts.values())
    bucket = user_bucket(seed, upper)
    for name, weight in reversed(parts.items()):
        part = F.when(bucket < upper, name).otherwise(part)
        upper -= weight
    # branches were stacked from the last part inwards: the smallest bound is tested first
    return df.withColumn("part", part)


def with_fold(df: DataFrame, folds: int = FOLDS, seed: int | str = SEED) -> DataFrame:
    """``df`` with ``fold``, independent of the split by the same seed."""
    return df.withColumn("fold", user_bucket(f"fold:{seed}", folds))
