"""Classification metrics as DataFrame aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stayline.functions import share


def confusion(predictions: DataFrame, weight: str | None = None) -> DataFrame:
    """Rows (or their weight) per label and prediction."""
    n = F.sum(weight) if weight else F.count("*")
    return predictions.groupBy(
        F.col("label").cast("double").alias("label"),
        F.col("prediction").cast("double").alias("prediction"),
    ).agg(n.cast("double").alias("n"))


def class_metrics(predictions: DataFrame, weight: str | None = None) -> DataFrame:
    """Support, precision, recall and F1 of each class, from one pass over the rows."""
    hit = F.col("label") == F.col("prediction")
    zero = F.lit(0.0)
    roles = F.array(
        F.struct(
            F.col("label").alias("class"),
            F.col("n").alias("support"),
            zero.alias("predicted"),
            F.when(hit, F.col("n")).otherwise(zero).alias("tp"),
        ),
        F.struct(
            F.col("prediction").alias("class"),
            zero.alias("support"),
            F.col("n").alias("predicted"),
            zero.alias("tp"),
        ),
    )
    per_class = (
        confusion(predictions, weight)
        .select(F.inline(roles))
        .groupBy("class")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "tp")])
    )
    return per_class.select(
        "class",
        "support",
        F.coalesce(share("tp", "predicted"), zero).alias("precision"),
        F.coalesce(share("tp", "support"), zero).alias("recall"),
        share(F.col("tp") * 2, F.col("support") + F.col("predicted")).alias("f1"),
    )


def classification_metrics(predictions: DataFrame, weight: str | None = None) -> DataFrame:
    """One row: rows, accuracy, and precision, recall and F1 weighted by true-class share."""
    classes = class_metrics(predictions, weight)

    def weighted(c: str):
        return share(F.sum(F.col("support") * F.col(c)), F.sum("support"))

    return classes.agg(
        F.sum("support").alias("n"),
        weighted("recall").alias("accuracy"),
        weighted("precision").alias("weighted_precision"),
        weighted("f1").alias("f1"),
    )
