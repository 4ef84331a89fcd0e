"""Running sums over sorted rows, with no task that holds a whole group."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import DataFrame, Window, functions as F

from stayline.session import durable

ROWS_PER_PART = 500_000


def running_sums(
    stored: DataFrame,
    by: Sequence[str],
    order: str,
    sums: Sequence[str],
    rows_per_part: int = ROWS_PER_PART,
) -> DataFrame:
    """``stored`` with ``<sum>_before`` of each of ``sums``: its total over smaller ``order`` in the group.

    ``stored`` is a stored table, one row for each group and value of ``order``. Its count tells
    in how many range-sorted parts it is summed; totals of the parts before are added from a table
    with a row for each group and part. A table of one part needs no second one.
    """
    parts = ceil(max(1, stored.count()) / rows_per_part)
    earlier = Window.unboundedPreceding, -1
    keys = list(by)

    def before(c: str, window) -> F.Column:
        return F.coalesce(F.sum(c).over(window), F.lit(0))

    if parts == 1:
        window = Window.partitionBy(*keys).orderBy(order).rowsBetween(*earlier)
        return stored.withColumns({f"{c}_before": before(c, window) for c in sums})
    dealt = stored.repartitionByRange(parts, *keys, order)
    dealt = durable(dealt.withColumn("_part", F.spark_partition_id()))  # fixed from here on
    totals = dealt.groupBy(*keys, "_part").agg(*[F.sum(c).alias(c) for c in sums])
    of_parts = Window.partitionBy(*keys).orderBy("_part").rowsBetween(*earlier)
    renamed = [F.col(k).alias(f"_{k}") for k in keys]
    bases = totals.select(
        *renamed, F.col("_part").alias("_at"), *[before(c, of_parts).alias(f"_{c}") for c in sums]
    )
    same = F.col("_part") == F.col("_at")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    inside = Window.partitionBy("_part", *keys).orderBy(order).rowsBetween(*earlier)
    summed = dealt.withColumns({f"{c}_before": before(c, inside) for c in sums}).join(bases, same)
    return summed.select(
        *stored.columns, *[(F.col(f"{c}_before") + F.col(f"_{c}")).alias(f"{c}_before") for c in sums]
    )
