"""Split, features, metrics, tuning."""

import math

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from stayline import operators as op
from stayline.operators import features
from stayline.operators.models import Candidate, candidates
from stayline.plans.study import cohort_tables, model_study, prepare_models
from stayline.session import durable, shared_dir, workspace


@pytest.fixture(scope="module")
def users(spark):
    """400 users whose label follows from their features but for a few."""
    i = F.col("id")
    label = ((i % 10 < 3) != (i % 37 == 0)).cast("int")
    return durable(
        spark.range(400).select(
            i.cast("string").alias("userId"),
            F.when(i % 2 == 0, "M").otherwise("F").alias("gender"),
            F.concat(F.lit(" S"), (i % 11).cast("string")).alias("area"),
            (i % 10 * 3).cast("int").alias("delta_time"),
            (i % 10 * 5 + i % 3).alias("song_nums"),
            label.alias("label"),
            (i % 4 + 1).alias("weight"),
        )
    )


def test_split_covers_and_is_by_user(users):
    split = op.split_users(users)
    sizes = {r.part: r["count"] for r in split.groupBy("part").count().collect()}
    assert sum(sizes.values()) == 400 and set(sizes) == {"train", "valid", "test"}
    assert 220 < sizes["train"] < 290 and 40 < sizes["valid"] < 90
    again = op.split_users(users.repartition(7))
    assert split.select("userId", "part").exceptAll(again.select("userId", "part")).count() == 0
    folds = op.with_fold(users, 3).groupBy("fold").count().collect()
    assert sorted(r.fold for r in folds) == [0, 1, 2]


def test_fit_sees_train_users_only(users):
    odd = users.withColumn("area", F.when(F.col("userId") == "0", " Nowhere").otherwise(F.col("area")))
    part = op.split_users(odd).where("userId = '0'").first().part
    prepared = op.prepare(odd)
    labels = {r.value for r in prepared.features.indexes["area"].collect()}
    assert (" Nowhere" in labels) == (part == "train")


def test_unseen_and_missing_values_get_their_own_index(spark, users):
    model = op.fit_features(users)
    row = [("x", None, " Unseen", 1, 2, 0, 1), ("y", "M", " S1", None, 2, 0, 1)]
    new = spark.createDataFrame(row, users.schema)
    found = model.transform(new.where("userId = 'x'")).collect()
    assert [(r.userId, r.area_feature, r.gender_feature) for r in found] == [("x", 11.0, 2.0)]
    # a row without a number is never left out unasked
    with pytest.raises(Exception, match="null"):
        model.transform(new).collect()
    assert tuple(op.incomplete_rows(new).first()) == (2, 1, 0, 1)
    assert [r.userId for r in op.complete_rows(new).collect()] == ["x"]


def test_missing_tenure_is_an_error_or_dropped_by_name(users):
    facts = users.selectExpr(
        "userId", "gender", "area", "song_nums", "label AS churn_users", "weight AS n_events",
        "CASE WHEN userId % 40 = 0 THEN NULL ELSE delta_time END AS delta_time",
    ).where("song_nums > 0")
    with pytest.raises(Exception, match="null"):
        prepare_models(facts).table.count()
    kept = prepare_models(facts, missing="drop").table
    assert kept.count() == facts.where("delta_time IS NOT NULL").count()


def test_index_of_many_labels(spark):
    """The places of 150,000 labels are those StringIndexer gives them."""
    rows = spark.range(150_000).select(F.concat(F.lit("a"), F.col("id") % 140_000).alias("area"))
    labels = StringIndexer(inputCol="area", outputCol="i").fit(rows).labels
    found = op.label_index(rows, "area").toPandas().sort_values("index")
    assert found["index"].tolist() == [float(i) for i in range(140_000)]
    assert found["value"].tolist() == labels


@pytest.mark.parametrize("name", ["logistic_regression", "decision_tree"])
def test_event_grain_is_training_on_repeated_rows(users, name):
    """Indexes, scales and the model itself, against a pipeline fitted on repeated rows."""
    uneven = users.withColumn("weight", F.expr("CAST(1 + userId % 5 * (userId % 3) AS BIGINT)"))
    repeated = uneven.withColumn("copy", F.explode(F.expr("sequence(1, int(weight))")))
    once = op.fit_features(repeated)
    weighted = op.fit_features(uneven, weight="weight")
    for c in ("area", "gender"):
        a, b = (m.indexes[c].orderBy("index").collect() for m in (once, weighted))
        assert a == b
    assert once.scale.getScalingVec().toArray() == pytest.approx(
        weighted.scale.getScalingVec().toArray()
    )
    (plain,) = candidates([name])
    (counted,) = candidates([name], weight="weight")
    a = plain.estimator.fit(once.transform(repeated))
    b = counted.estimator.fit(weighted.transform(uneven))
    both = [
        m.transform(once.transform(users)).orderBy("userId").select("prediction").collect()
        for m in (a, b)
    ]
    assert both[0] == both[1]


def test_scaled_slots_are_scaled_vectors(users):
    """Slots scaled by joined deviations, vectors, and a pipeline on repeated rows agree."""
    uneven = users.withColumn("weight", F.expr("CAST(1 + userId % 5 * (userId % 3) AS BIGINT)"))
    repeated = uneven.withColumn("copy", F.explode(F.expr("sequence(1, int(weight))")))
    model = op.fit_features(uneven, "onehot", "weight")
    vectors = op.vector_slots(model.transform(users), "features")
    slots = {(r.userId, r.slot): r.value for r in model.scaled_slots(users).collect()}
    assert slots == pytest.approx({(r.userId, r.slot): r.value for r in vectors.collect()})
    once = op.fit_features(repeated, "onehot")
    assert slots == pytest.approx({(r.userId, r.slot): r.value for r in once.scaled_slots(users).collect()})
    table = repeated.select("area", "gender", "song_nums").toPandas()
    of_user_4 = [v for (u, s), v in sorted(slots.items()) if u == "4"]
    deviations = [(table["area"] == " S4").std(), (table["gender"] == "M").std()]
    assert of_user_4[:2] == pytest.approx([1 / d for d in deviations])


def test_scaled_slots_of_many_labels(spark):
    """120,000 areas: what the driver holds of the model does not grow with them."""
    n = 120_000
    rows = spark.range(n + 1000).selectExpr(
        "CAST(id AS STRING) AS userId", f"concat('a', id % {n}) AS area", "'F' AS gender",
        "id % 7 AS song_nums", "id % 5 AS delta_time",
    )
    rows = durable(rows)
    model = op.fit_features(rows, "onehot")
    assert model.scale is None and len(model.scales) == 4
    slots = model.scaled_slots(rows)
    assert slots.agg(F.max("slot")).first()[0] == n + 1 + 1 + 2
    total = n + 1000
    scale = {k: ((k - k * k / total) / (total - 1)) ** -0.5 for k in (1, 2)}
    counts = slots.where(f"slot < {n}").groupBy(F.round("value", 6).alias("v")).count().collect()
    assert {r.v: r["count"] for r in counts} == {
        round(scale[1], 6): n - 1000, round(scale[2], 6): 2000
    }


@pytest.mark.parametrize("encode", ["index", "onehot"])
def test_stored_features_score_later_users(spark, users, tmp_path, encode):
    path = str(tmp_path / encode)
    model = op.fit_features(users, encode)
    model.save(path)
    loaded = op.load_features(spark, path)
    later = spark.createDataFrame(
        [("x", "M", " S1", 1, 2, 0, 1), ("y", None, " Unseen", 3, 0, 1, 1)], users.schema
    )
    for df in (users, later):
        a, b = (m.transform(df).select("userId", "features1", "features").orderBy("userId") for m in (model, loaded))
        assert a.collect() == b.collect()
    slots = 11 + 1 + 2 + 1 + 2 if encode == "onehot" else 4
    scored = op.linear_scores(loaded.transform(later), [0.0] * (slots - 2) + [1.0, 0.0], -1.0)
    margins = {r.userId: (r.margin, r.probability) for r in scored.collect()}
    for user, features in ((r.userId, r.features) for r in scored.collect()):
        m = features[slots - 2] - 1.0
        assert margins[user] == pytest.approx((m, 1 / (1 + math.exp(-m))))


def test_stored_features_must_be_todays(spark, users, tmp_path, monkeypatch):
    op.fit_features(users).save(str(tmp_path / "m"))
    monkeypatch.setattr(features, "FEATURES", ("area_feature",))
    with pytest.raises(ValueError, match="delta_time"):
        op.load_features(spark, str(tmp_path / "m"))


def test_categorical_tree(users):
    """The tree takes the unscaled vector with one bin for each label and one for unseen ones."""
    prepared = op.prepare(users)
    bins = prepared.features.max_bins
    assert bins == 12
    (tree,) = candidates(["decision_tree"], tree_input="features1", max_bins=bins)
    model = tree.estimator.fit(prepared.part("train"))
    assert model.numFeatures == 4
    (small,) = candidates(["decision_tree"], tree_input="features1", max_bins=bins - 1)
    with pytest.raises(Exception, match="maxBins"):
        small.estimator.fit(prepared.part("train"))


def test_logistic_regression_finds_the_optimum(spark, users):
    """Against Newton steps on the same objective: mean log loss plus an L2 penalty."""
    prepared = op.prepare(users)
    train = prepared.part("train").select("features", "label").collect()
    x = np.array([r.features.toArray() for r in train])
    y = np.array([float(r.label) for r in train])
    lr = LogisticRegression(
        regParam=0.1, elasticNetParam=0.0, maxIter=500, tol=1e-12, standardization=False
    )
    model = lr.fit(prepared.part("train"))
    z = np.column_stack([x, np.ones(len(x))])
    beta, penalty = np.zeros(5), np.diag([0.1] * 4 + [0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-z @ beta))
        gradient = z.T @ (p - y) / len(y) + penalty @ beta
        hessian = (z * (p * (1 - p))[:, None]).T @ z / len(y) + penalty
        beta -= np.linalg.solve(hessian, gradient)
    assert [*model.coefficients, model.intercept] == pytest.approx(beta, abs=1e-4)


def test_scaling_is_division_by_deviation(users):
    model = op.fit_features(users)
    rows = op.vector_columns(model.transform(users), "features").join(
        users.crossJoin(users.agg(F.stddev_samp("song_nums").alias("sd"))).select(
            "userId", (F.col("song_nums") / F.col("sd")).alias("expected")
        ),
        "userId",
    )
    assert rows.where(F.abs(F.col("song_nums") - F.col("expected")) > 1e-9).count() == 0


def test_onehot(users):
    wide = op.fit_features(users, encode="onehot").transform(users).first()
    assert wide.features.size == 12 + 3 + 2
    with pytest.raises(ValueError):
        op.fit_features(users, encode="hash")


@pytest.mark.parametrize("weight", [None, "weight"])
def test_metrics_equal_sparks_evaluator(users, weight):
    predictions = users.select(
        F.col("label").cast("double"),
        (F.col("song_nums") < 20).cast("double").alias("prediction"),
        F.col("weight").cast("double"),
    )
    mine = op.classification_metrics(predictions, weight).first()
    for name, metric in [
        ("f1", "f1"),
        ("accuracy", "accuracy"),
        ("weighted_precision", "weightedPrecision"),
    ]:
        evaluator = MulticlassClassificationEvaluator(metricName=metric)
        if weight:
            evaluator.setWeightCol(weight)
        assert math.isclose(mine[name], evaluator.evaluate(predictions), abs_tol=1e-9)


def test_metrics_of_a_class_never_predicted(spark):
    predictions = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0)], "label double, prediction double")
    classes = {r["class"]: r for r in op.class_metrics(predictions).collect()}
    assert classes[1.0].precision == 0.0 and classes[1.0].f1 == 0.0
    assert classes[0.0].recall == 1.0


def test_grids():
    sizes = {c.name: len(c.grid) for c in candidates()}
    assert sizes == {"logistic_regression": 4, "linear_svm": 2, "decision_tree": 4}


def test_tuning_is_repeatable_and_ranked(spark, users):
    prepared = op.prepare(users)
    tuned = op.tune(prepared)
    board = tuned.leaderboard(spark).collect()
    assert len(board) == 10
    assert [r.avg_f1 for r in board] == sorted((r.avg_f1 for r in board), reverse=True)
    assert board[0].model == "decision_tree" and board[0].avg_f1 > 0.9
    first = [Candidate(c.name, c.estimator, c.grid[:1]) for c in candidates()]
    again = op.tune(op.prepare(users.repartition(5)), first)
    means = {(name, pos): mean for name, pos, _, mean in tuned.rows}
    assert [r[3] for r in again.rows] == pytest.approx([means[c.name, 0] for c in first])
    best = {r.model: r for r in op.best_params(tuned.leaderboard(spark)).collect()}
    assert set(best) == set(tuned.best)
    for r in board:
        assert best[r.model].avg_f1 >= r.avg_f1


def test_ties_keep_grid_order(spark):
    rows = [("m", 1, {"a": "2"}, 0.5), ("m", 0, {"a": "1"}, 0.5), ("n", 0, {}, 0.1)]
    board = spark.createDataFrame(
        rows, "model string, grid_pos int, params map<string,string>, avg_f1 double"
    )
    assert {r.model: r.grid_pos for r in op.best_params(board).collect()} == {"m": 0, "n": 0}
    assert op.select_model({"b": 0.5, "a": 0.5}) == "b"


def test_event_grain_equals_repeated_rows(users):
    """Weights stand for repeated rows."""
    (tree,) = candidates(["decision_tree"])
    (weighted,) = candidates(["decision_tree"], weight="weight")
    model = op.fit_features(users)
    rows = model.transform(users)
    repeated = rows.withColumn("copy", F.explode(F.expr("sequence(1, int(weight))")))
    a = tree.estimator.fit(repeated.drop("weight"))
    b = weighted.estimator.fit(rows.withColumn("weight", F.col("weight").cast("double")))
    assert a.toDebugString.split("\n", 1)[1] == b.toDebugString.split("\n", 1)[1]


def test_study_end_to_end(spark, log, users):
    facts = users.selectExpr(
        "*", "label AS churn_users", "weight AS n_events"
    ).drop("label", "weight").where("song_nums > 0")
    models = [Candidate(c.name, c.estimator, c.grid[:1]) for c in candidates()]
    study = model_study(facts, models=models)
    assert study.chosen == max(study.valid_scores, key=study.valid_scores.get)
    assert 0 < study.test_score <= 1
    assert study.validation_table().count() == 3 and study.final_table().count() == 1
    weighted = model_study(facts, grain="event", models=models[2:])
    assert weighted.chosen == "decision_tree"
    train = study.prepared.part("train").select("userId")
    for part in ("valid", "test"):
        assert study.prepared.part(part).join(train, "userId", "left_semi").count() == 0


def test_a_study_leaves_nothing_behind(spark, users):
    from pathlib import Path

    facts = users.selectExpr("*", "label AS churn_users", "weight AS n_events")
    facts = facts.drop("label", "weight").where("song_nums > 0")
    folder = Path(shared_dir(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    with workspace(spark) as work:
        assert model_study(facts, models=[op.majority()]).chosen == "majority"
        assert list(Path(work.removeprefix("file:")).iterdir())
    assert set(folder.iterdir()) == before


def test_cohort_tables(log):
    tables = cohort_tables(log)
    shares = tables["share_by_gender"].where("gender IS NOT NULL").collect()
    assert all(abs(r.retained_share + r.churn_share - 1) < 1e-12 for r in shares)
    for name in ("hist_tenure", "hist_plays"):
        sizes = tables[name].groupBy("churn_users").agg(F.sum("n").alias("n")).collect()
        assert {r.churn_users: r.n for r in sizes} == {0: 4, 1: 2}
    assert {r.n for r in tables["box_plays"].collect()} == {4, 2}
    assert tables["box_normal_ratio"].count() == 2
    assert tables["share_by_level"].count() == 2
