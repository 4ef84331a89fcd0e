"""Histograms and box-plot statistics per cohort.

Both start from :func:`value_counts`, which condenses a cohort to its distinct
values. All later steps read that one shuffle (Spark reuses the exchange) or, for
exact quartiles, the stored table, and exchange small tables only; no cohort is
ever gathered in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from stayline.operators.prefix import ROWS_PER_PART, running_sums
from stayline.session import durable

QUARTILES = (0.25, 0.5, 0.75)
CHURN_FLAG = "churn_users"


def value_counts(df: DataFrame, value: str, by: str) -> DataFrame:
    """Rows per cohort and distinct value: (by, v, n); NULL and NaN are left out."""
    number = F.col(value).cast("double")
    return (
        df.where(number.isNotNull() & ~F.isnan(number))
        .groupBy(by, number.alias("v"))
        .agg(F.count("*").alias("n"))
    )


def _per_cohort(counts: DataFrame, stats: DataFrame, by: str) -> DataFrame:
    """``counts`` with its cohort's row of ``stats``; AQE broadcasts the smaller side if it is small."""
    stats = stats.withColumnRenamed(by, "_cohort")
    return counts.join(stats, F.col(by).eqNullSafe(F.col("_cohort"))).drop("_cohort")


def histogram(
    df: DataFrame,
    value: str,
    by: str = CHURN_FLAG,
    bins: int = 10,
    density: bool = True,
    shared_edges: bool = False,
) -> DataFrame:
    """Equal-width bins between each cohort's own minimum and maximum.

    The last bin includes the maximum, a constant column gets a range of
    +-0.5, empty bins are kept. ``shared_edges`` uses one range for all cohorts,
    which makes them comparable.
    """
    counts = value_counts(df, value, by)
    stats = counts.groupBy(by).agg(
        F.min("v").alias("v_min"), F.max("v").alias("v_max"), F.sum("n").alias("total")
    )
    if shared_edges:
        everyone = stats.agg(F.min("v_min").alias("all_min"), F.max("v_max").alias("all_max"))
        stats = stats.withColumns({"v_min": everyone.select("all_min").scalar(),
                                   "v_max": everyone.select("all_max").scalar()})
    constant = F.col("v_min") == F.col("v_max")
    edges = stats.select(
        by,
        F.when(constant, F.col("v_min") - 0.5).otherwise(F.col("v_min")).alias("v_lo"),
        F.when(constant, F.col("v_max") + 0.5).otherwise(F.col("v_max")).alias("v_hi"),
        "total",
    )
    bucket = F.least(F.width_bucket("v", "v_lo", "v_hi", F.lit(bins)), F.lit(bins).cast("long"))
    filled = (
        _per_cohort(counts, edges, by)
        .groupBy(F.col(by).alias("_cohort"), bucket.cast("int").alias("filled_bin"))
        .agg(F.sum("n").alias("filled"))
    )
    width = (F.col("v_hi") - F.col("v_lo")) / bins
    grid = edges.withColumn("bin", F.explode(F.sequence(F.lit(1), F.lit(bins))))
    n = F.coalesce("filled", F.lit(0))
    same_bin = F.col(by).eqNullSafe(F.col("_cohort")) & (F.col("bin") == F.col("filled_bin"))
    table = grid.join(filled, same_bin, "left").select(
        by,
        "bin",
        (F.col("v_lo") + width * (F.col("bin") - 1)).alias("lo"),
        (F.col("v_lo") + width * F.col("bin")).alias("hi"),
        n.alias("n"),
        (n / (F.col("total") * width)).alias("density"),
    )
    return table if density else table.drop("density")


def quantiles(
    counts: DataFrame,
    by: str,
    probs: Sequence[float] = QUARTILES,
    rows_per_part: int = ROWS_PER_PART,
) -> DataFrame:
    """Exact, linearly interpolated quantiles of a stored :func:`value_counts` table:
    (by, total, q1, q2, ...).

    Running sums over the sorted values tell which ranks each value holds; they are made in
    range-sorted parts of about ``rows_per_part`` values.
    """
    # A quantile lies between two 0-based ranks; rows hold the ranks from start to start + n.
    positions = [f"(total - 1) * {float(p)}D" for p in probs]
    ranks = [f"{end}({position})" for position in positions for end in ("floor", "ceil")]
    total = counts.groupBy(by).agg(F.sum("n").alias("total"))
    rows = _per_cohort(running_sums(counts, [by], "v", ["n"], rows_per_part), total, by)
    holds = "n_before <= {0} AND {0} < n_before + n"
    found = rows.groupBy(by).agg(
        F.max("total").alias("total"),
        *[F.expr(f"max(CASE WHEN {holds.format(r)} THEN v END) AS v{i}") for i, r in enumerate(ranks)],
    )
    return found.select(
        by,
        "total",
        *[
            F.expr(f"v{2 * i} + (v{2 * i + 1} - v{2 * i}) * ({p} - floor({p})) AS q{i + 1}")
            for i, p in enumerate(positions)
        ],
    )


def box_stats(
    df: DataFrame, value: str, by: str = CHURN_FLAG, approx: bool = False
) -> DataFrame:
    """Quartiles, whiskers and outliers of each cohort, the data of a box plot.

    Whiskers are the extreme values within 1.5 interquartile ranges of the box,
    or the box edge where no value lies between the two.
    The condensed values are stored, as three steps read them. ``approx`` takes
    the quartiles from one sketch per cohort, which stores nothing but is a little off.
    """
    counts = value_counts(df, value, by)
    if approx:
        number = F.col(value).cast("double")
        sketch = df.where(number.isNotNull() & ~F.isnan(number)).groupBy(by).agg(
            F.count("*").alias("total"),
            F.percentile_approx(number, list(QUARTILES), 10_000).alias("q"),
        )
        quartiles = sketch.select(by, "total", *[F.col("q")[i].alias(f"q{i + 1}") for i in range(3)])
    else:
        counts = durable(counts)
        quartiles = quantiles(counts, by)
    fences = quartiles.selectExpr(
        "*", "q1 - (q3 - q1) * 1.5 AS low", "q3 + (q3 - q1) * 1.5 AS high"
    )
    return (
        _per_cohort(counts, fences, by)
        .groupBy(by)
        .agg(
            F.expr("max(total) AS n"),
            F.expr("max(q1) AS q1"),
            F.expr("max(q2) AS median"),
            F.expr("max(q3) AS q3"),
            F.expr("least(max(q1), min(CASE WHEN v BETWEEN low AND high THEN v END)) AS whisker_lo"),
            F.expr("greatest(max(q3), max(CASE WHEN v BETWEEN low AND high THEN v END)) AS whisker_hi"),
            F.expr("sum(CASE WHEN v BETWEEN low AND high THEN 0 ELSE n END) AS n_outliers"),
        )
    )
