"""The first split of a decision tree, exactly: every threshold of every feature."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from stayline.operators.prefix import running_sums
from stayline.session import durable


def _gini(n: Column, positive: Column) -> Column:
    share = positive / n
    return 2 * share * (1 - share)


def split_gains(
    rows: DataFrame, features: Sequence[str], label: str = "label", weight: str | None = None
) -> DataFrame:
    """(feature, threshold, left, right, gain) of every threshold between two values of a feature.

    Features are condensed to distinct values with their class counts first, and what is left of
    each value comes from running sums over these; no row is looked at twice. The threshold is
    the middle of two neighbours; rows up to it go left. Rows without a value are left out.
    """
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    pairs = F.explode(
        F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("v")) for f in features])
    )
    counted = (
        rows.select(pairs.alias("p"), w.alias("w"), (w * F.col(label)).alias("y"))
        .where("p.v IS NOT NULL AND NOT isnan(p.v)")
        .groupBy("p.feature", "p.v")
        .agg(F.sum("w").alias("n"), F.sum("y").alias("positive"))
    )
    counted = durable(counted)
    totals = counted.groupBy(F.col("feature").alias("_feature")).agg(
        F.sum("n").alias("total"), F.sum("positive").alias("positives")
    )
    ranked = running_sums(counted, ["feature"], "v", ["n", "positive"])
    # The value before the first of a part is the largest of the parts before: look by running sum.
    ends = ranked.select(
        F.col("feature").alias("_f"),
        F.col("v").alias("below"),
        (F.col("n_before") + F.col("n")).alias("_up_to"),
    )
    met = ranked.join(
        ends, (F.col("feature") == F.col("_f")) & (F.col("n_before") == F.col("_up_to"))
    ).join(F.broadcast(totals), F.col("feature") == F.col("_feature"))
    left, right = F.col("n_before"), F.col("total") - F.col("n_before")
    left_positive, right_positive = F.col("positive_before"), F.col("positives") - F.col("positive_before")
    gain = (
        _gini(F.col("total"), F.col("positives"))
        - left / F.col("total") * _gini(left, left_positive)
        - right / F.col("total") * _gini(right, right_positive)
    )
    return met.select(
        "feature",
        ((F.col("below") + F.col("v")) / 2).alias("threshold"),
        left.alias("left"),
        right.alias("right"),
        gain.alias("gain"),
    )


def best_splits(gains: DataFrame) -> DataFrame:
    """The best threshold of each feature; the smallest of equal ones."""
    best = F.min(F.struct((-F.round("gain", 12)).alias("loss"), "threshold", "left", "right", "gain"))
    found = gains.groupBy("feature").agg(best.alias("b"))
    return found.select("feature", "b.threshold", "b.left", "b.right", "b.gain")


def first_split(gains: DataFrame, features: Sequence[str]) -> DataFrame:
    """The best split of all, the earlier feature of equal ones."""
    place = F.array_position(F.array(*[F.lit(f) for f in features]), F.col("feature"))
    order = Window.orderBy(F.desc(F.round("gain", 12)), place)
    ranked = best_splits(gains).withColumn("place", F.row_number().over(order))  # a row a feature
    return ranked.where("place = 1").drop("place")
