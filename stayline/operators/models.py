"""Churn models: grids, cross-validation, ranking and the final score."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from math import ceil

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import DecisionTreeClassifier, LinearSVC, LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.param import Param
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.storagelevel import StorageLevel

from stayline.operators.features import FeatureModel, fit_features
from stayline.operators.split import FOLDS, SEED, split_users, with_fold

MODELS = ("logistic_regression", "linear_svm", "decision_tree")
PARALLELISM = 8  # fits at a time; each is a chain of small jobs with pauses between them
ROWS_PER_TASK = 100_000


@dataclass
class Candidate:
    """A kind of model, and the parameter sets to try."""

    name: str
    estimator: Estimator
    grid: list[dict[Param, object]] = field(default_factory=lambda: [{}])


def candidates(
    names: Sequence[str] = MODELS,
    seed: int = SEED,
    weight: str | None = None,
    tree_input: str = "features",
    max_bins: int = 32,
) -> list[Candidate]:
    """The three models with their grids: 4, 2 and 4 parameter sets.

    ``tree_input="features1"`` gives the tree the unscaled vector, where area and
    gender still are marked as categories; ``max_bins`` then has to be at least
    :attr:`stayline.operators.features.FeatureModel.max_bins`, one more than there are areas.
    """
    # Iterations and grids.
    lr = LogisticRegression(maxIter=20)
    svm = LinearSVC(maxIter=5)
    tree = DecisionTreeClassifier(featuresCol=tree_input, maxBins=max_bins, seed=seed)
    grids = {
        "logistic_regression": (
            lr,
            ParamGridBuilder()
            .addGrid(lr.regParam, [0.3, 0.01])
            .addGrid(lr.elasticNetParam, [1.0, 0.0])
            .build(),
        ),
        "linear_svm": (svm, ParamGridBuilder().addGrid(svm.regParam, [0.3, 0.01]).build()),
        "decision_tree": (tree, ParamGridBuilder().addGrid(tree.maxDepth, [3, 5, 6, 8]).build()),
    }
    if weight:
        for estimator, _ in grids.values():
            estimator.setWeightCol(weight)
    return [Candidate(name, *grids[name]) for name in names]


def majority(weight: str | None = None) -> Candidate:
    """A yardstick: the more frequent class of the training rows, whatever the features."""
    stump = DecisionTreeClassifier(maxDepth=0)
    return Candidate("majority", stump.setWeightCol(weight) if weight else stump)


@dataclass
class Prepared:
    """Feature vectors of all users; the model that made them has seen train users only."""

    features: FeatureModel
    table: DataFrame
    weight: str | None = None

    def part(self, name: str) -> DataFrame:
        return self.table.where(F.col("part") == name)


def prepare(
    features: DataFrame,
    grain: str = "user",
    encode: str = "index",
    seed: int = SEED,
    folds: int = FOLDS,
) -> Prepared:
    """Split a user-grain feature table by user and fit the feature pipeline on train.

    The table is read several times, so it should be stored
    (:func:`stayline.session.durable`). With ``grain="event"`` a user counts as
    often as it has events, for indexes, scales, models and scores alike. A row without a number
    raises an error: take :func:`stayline.operators.features.complete_rows` before.
    """
    table = with_fold(split_users(features, seed), folds, seed)
    weight = "weight" if grain == "event" else None
    model = fit_features(table.where(F.col("part") == "train"), encode, weight)
    return Prepared(model, model.transform(table), weight)


def f1_evaluator(weight: str | None = None) -> MulticlassClassificationEvaluator:
    evaluator = MulticlassClassificationEvaluator(metricName="f1")
    return evaluator.setWeightCol(weight) if weight else evaluator


def _needed(df: DataFrame, weight: str | None) -> DataFrame:
    """The columns a fit reads, in no more partitions than the rows are worth.

    A fit runs dozens of jobs over the same rows, so tiny partitions cost a lot.
    """
    extra = [weight] if weight else []
    partitions = ceil(max(df.count(), 1) / ROWS_PER_TASK)
    return df.select("features1", "features", "label", "fold", *extra).coalesce(partitions)


@dataclass
class Tuned:
    """Mean F1 of every parameter set, and the best set of each model refitted on all of train."""

    rows: list[tuple[str, int, dict[str, str], float]]
    best: dict[str, Model]

    def leaderboard(self, spark: SparkSession) -> DataFrame:
        """(model, grid_pos, params, avg_f1), best first; ties keep grid order."""
        schema = "model string, grid_pos int, params map<string,string>, avg_f1 double"
        board = spark.createDataFrame(self.rows, schema)
        return board.orderBy(F.desc("avg_f1"), "model", "grid_pos")


def tune(
    prepared: Prepared,
    models: Sequence[Candidate] | None = None,
    folds: int = FOLDS,
    parallelism: int = PARALLELISM,
) -> Tuned:
    """Cross-validate every parameter set on train and refit the best of each model.

    Folds come from the ``fold`` column, a hash of the user. (Spark's own
    cross-validator checks such a column with a Python function on each row, so
    the loop is spelled out here.) Fits run side by side on the cluster; the
    driver sees one number for each.
    """
    weight = prepared.weight
    models = candidates(weight=weight) if models is None else models
    evaluator = f1_evaluator(weight)
    train = _needed(prepared.part("train"), weight).persist(StorageLevel.MEMORY_AND_DISK)
    in_session = inheritable_thread_target(train.sparkSession)
    fitting = [train.where(F.col("fold") != k) for k in range(folds)]
    held_out = [train.where(F.col("fold") == k) for k in range(folds)]

    def fold_score(job: tuple[Candidate, int, int]) -> float:
        model, pos, k = job
        fitted = model.estimator.fit(fitting[k], model.grid[pos])
        return evaluator.evaluate(fitted.transform(held_out[k]))

    def refit(job: tuple[Candidate, int]) -> Model:
        model, pos = job
        return model.estimator.fit(train, model.grid[pos])

    try:
        jobs = [(m, pos, k) for m in models for pos in range(len(m.grid)) for k in range(folds)]
        with ThreadPoolExecutor(parallelism) as pool:
            scores = list(pool.map(in_session(fold_score), jobs))
            means: dict[tuple[str, int], float] = {}
            for (m, pos, _), score in zip(jobs, scores):
                means[m.name, pos] = means.get((m.name, pos), 0.0) + score / folds
            # max() keeps the first of equals, which is grid order
            top = [(m, max(range(len(m.grid)), key=lambda p: means[m.name, p])) for m in models]
            fitted = list(pool.map(in_session(refit), top))
    finally:
        train.unpersist()
    rows = [
        (m.name, pos, {p.name: str(v) for p, v in m.grid[pos].items()}, means[m.name, pos])
        for m in models
        for pos in range(len(m.grid))
    ]
    return Tuned(rows, {m.name: model for (m, _), model in zip(top, fitted)})


def best_params(leaderboard: DataFrame) -> DataFrame:
    """The best parameter set of each model; the earlier one in the grid wins a tie."""
    best_first = Window.partitionBy("model").orderBy(F.desc("avg_f1"), "grid_pos")
    return (
        leaderboard.withColumn("place", F.row_number().over(best_first))
        .where(F.col("place") == 1)
        .drop("place")
    )


def score(models: dict[str, Model], frame: DataFrame, weight: str | None = None) -> dict[str, float]:
    """Weighted F1 of each model on a frame."""
    evaluator = f1_evaluator(weight)
    cached = frame.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return {name: evaluator.evaluate(m.transform(cached)) for name, m in models.items()}
    finally:
        cached.unpersist()


def select_model(valid_scores: dict[str, float]) -> str:
    """The model with the best validation score; on a tie the one named first."""
    return max(valid_scores, key=valid_scores.__getitem__)


def score_table(spark: SparkSession, scores: dict[str, float]) -> DataFrame:
    return spark.createDataFrame(list(scores.items()), "model string, f1 double")


def predictions(prepared: Prepared, name: str, part: str = "test") -> DataFrame:
    """Predictions of one model with its default parameters on a part: (userId, label, prediction)."""
    (candidate,) = candidates([name], weight=prepared.weight)
    model = candidate.estimator.fit(prepared.part("train"))
    return model.transform(prepared.part(part)).select(
        "userId", F.col("label").cast("double").alias("label"), "prediction"
    )
