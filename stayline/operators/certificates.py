"""Are fitted linear models optimal? Slopes of their objective at the fitted coefficients.

One aggregate over the rows gives, for each vector slot, the slope of the mean loss. With the slope
of the penalty it has to be 0 at an optimum, or, where the objective has a kink, 0 has to lie within
the interval of its slopes. Nothing of the fit is repeated, and no row passes the driver.

Coefficients are penalized in units of the slots' deviations, as the estimators do by default, so
slopes are taken in these units, too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

LOSSES = ("logistic", "hinge")
INTERCEPT = -1
KINK = 1e-3  # margins this near 1 are taken for being on the kink of the hinge


def _margin(slots: Column, coefficients: Sequence[float], intercept: float) -> Column:
    beta = F.array(*[F.lit(float(b)) for b in coefficients])
    products = F.zip_with(slots, beta, lambda x, b: x * b)
    return F.aggregate(products, F.lit(float(intercept)), lambda total, p: total + p)


def loss_slopes(
    rows: DataFrame,
    coefficients: Sequence[float],
    intercept: float,
    loss: str = "logistic",
    vector: str = "features",
    label: str = "label",
    weight: str | None = None,
    kink: float = KINK,
) -> DataFrame:
    """(slot, deviation, least, most, loss): the interval of slopes of the mean loss by slot.

    ``least`` and ``most`` differ only where rows are on the kink of the hinge. The intercept is
    slot -1, with a deviation of 1.
    """
    if loss not in LOSSES:
        raise ValueError(f"loss is one of {LOSSES}")
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    slots = vector_to_array(vector)
    y = F.col(label).cast("double")
    known = rows.select(slots.alias("x"), y.alias("y"), w.alias("w"))
    known = known.withColumn("m", _margin(F.col("x"), coefficients, intercept))
    if loss == "logistic":
        slope = 1 / (1 + F.exp(-F.col("m"))) - F.col("y")
        known = known.withColumns(
            {
                "loss": F.greatest("m", F.lit(0.0)) - F.col("y") * F.col("m")
                + F.log1p(F.exp(-F.abs("m"))),
                "slope": slope,
                "free": F.lit(0.0),
            }
        )
    else:
        sign = 2 * F.col("y") - 1
        short = 1 - sign * F.col("m")
        on_kink = F.abs(short) <= kink
        known = known.withColumns(
            {
                "loss": F.greatest(short, F.lit(0.0)),
                "slope": F.when((short > 0) & ~on_kink, -sign).otherwise(0.0),
                "free": F.when(on_kink, -sign).otherwise(0.0),
            }
        )
    every = known.select(
        "w", "slope", "free", "loss", F.posexplode(F.concat("x", F.array(F.lit(1.0)))).alias("slot", "x")
    )
    free = F.col("w") * F.col("free") * F.col("x")
    sums = every.groupBy("slot").agg(
        F.sum("w").alias("w"),
        F.sum(F.col("w") * F.col("slope") * F.col("x")).alias("g"),
        F.sum(F.least(free, F.lit(0.0))).alias("low"),
        F.sum(F.greatest(free, F.lit(0.0))).alias("high"),
        F.sum(F.col("w") * F.col("loss")).alias("l"),
        F.stddev_samp("x").alias("plain"),
        (F.sum(F.col("w") * F.col("x") * F.col("x")) - F.sum(F.col("w") * F.col("x")) ** 2 / F.sum("w")).alias("ss"),
        F.sum(F.col("w") * F.col("w")).alias("w2"),
    )
    # The estimators take weights for reliabilities, not for counts.
    spread = F.sqrt(F.greatest(F.col("ss"), F.lit(0.0)) / (F.col("w") - F.col("w2") / F.col("w")))
    is_intercept = F.col("slot") == len(coefficients)
    deviation = F.when(is_intercept, 1.0).otherwise(spread if weight else F.col("plain"))
    unit = F.when(deviation > 0, deviation)
    scaled = lambda part: F.coalesce((F.col("g") + part) / F.col("w") / unit, F.lit(0.0))
    return sums.select(
        F.when(is_intercept, INTERCEPT).otherwise(F.col("slot")).alias("slot"),
        deviation.alias("deviation"),
        scaled(F.col("low")).alias("least"),
        scaled(F.col("high")).alias("most"),
        (F.col("l") / F.col("w")).alias("loss"),
    )


def optimality(
    slopes: DataFrame, coefficients: Sequence[float], reg: float = 0.0, elastic: float = 0.0
) -> DataFrame:
    """(slot, coefficient, residual): how far 0 is from the slopes of the whole objective.

    The penalty is ``reg`` times ``elastic`` parts absolute values and the rest half squares.
    """
    beta = F.array(*[F.lit(float(b)) for b in [*coefficients, 0.0]])
    at = F.when(F.col("slot") == INTERCEPT, len(coefficients)).otherwise(F.col("slot"))
    own = F.get(beta, at.cast("int"))
    coefficient = own * F.col("deviation")
    ridge = reg * (1 - elastic) * coefficient
    lasso = F.when(F.col("slot") == INTERCEPT, 0.0).otherwise(reg * elastic)
    at_zero = coefficient == 0
    low = F.col("least") + ridge + F.when(at_zero, -lasso).otherwise(F.signum(coefficient) * lasso)
    high = F.col("most") + ridge + F.when(at_zero, lasso).otherwise(F.signum(coefficient) * lasso)
    return slopes.select(
        "slot",
        own.alias("coefficient"),
        F.greatest(F.lit(0.0), low, -high).alias("residual"),
        "loss",
    )
