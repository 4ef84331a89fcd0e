"""Models whose scores can be worked out by hand, for the same tuning and choice as the others."""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, functions as F

from stayline.operators.features import FEATURES
from stayline.operators.models import Candidate


class _Rule(Params):
    slot = Param(Params._dummy(), "slot", "vector slot", TypeConverters.toInt)
    threshold = Param(Params._dummy(), "threshold", "least value for 1", TypeConverters.toFloat)
    vector = Param(Params._dummy(), "vector", "vector column", TypeConverters.toString)
    above = Param(Params._dummy(), "above", "class from the threshold on", TypeConverters.toFloat)


class RuleModel(Model, _Rule):
    """Predicts ``above`` from the threshold on, and the other class below."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        value = vector_to_array(self.getOrDefault(self.vector))[self.getOrDefault(self.slot)]
        above = self.getOrDefault(self.above)
        held = value >= self.getOrDefault(self.threshold)
        return dataset.withColumn("prediction", F.when(held, above).otherwise(1.0 - above))


class ThresholdRule(Estimator, _Rule):
    """Learns which side of the threshold has the larger share of label 1; above, on a tie."""

    def __init__(self, slot: int, threshold: float = 0.0, vector: str = "features1") -> None:
        super().__init__()
        self._set(slot=slot, threshold=threshold, vector=vector)

    def _fit(self, dataset: DataFrame) -> RuleModel:
        value = vector_to_array(self.getOrDefault(self.vector))[self.getOrDefault(self.slot)]
        held = value >= self.getOrDefault(self.threshold)
        up, down = dataset.agg(
            F.avg(F.when(held, F.col("label"))), F.avg(F.when(~held, F.col("label")))
        ).first()
        model = RuleModel()
        model._set(above=1.0 if (up or 0.0) >= (down or 0.0) else 0.0)
        return self._copyValues(model)


class ConstantModel(Model, _Rule):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn("prediction", F.lit(self.getOrDefault(self.above)))


class Constant(Estimator, _Rule):
    """The class ``above``, whatever the features."""

    def __init__(self, above: float = 0.0) -> None:
        super().__init__()
        self._set(above=above)

    def _fit(self, dataset: DataFrame) -> ConstantModel:
        return self._copyValues(ConstantModel())


# Thresholds to try. Plays are whole numbers, so 1.5 and 2 give the same rule.
PLAYS, TENURE = (1.5, 2.0, 3.0, 5.0), (100.0, 200.0)


def rule_candidates() -> list[Candidate]:
    """Two features with thresholds to try, and the two constants."""
    plays = ThresholdRule(FEATURES.index("song_nums"))
    tenure = ThresholdRule(FEATURES.index("delta_time"))
    constant = Constant()
    grid = lambda e, p, values: ParamGridBuilder().addGrid(p, list(values)).build()
    return [
        Candidate("plays_rule", plays, grid(plays, plays.threshold, PLAYS)),
        Candidate("tenure_rule", tenure, grid(tenure, tenure.threshold, TENURE)),
        Candidate("constant", constant, grid(constant, constant.above, (0.0, 1.0))),
    ]
