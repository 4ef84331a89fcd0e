"""Certificates of fits, exact splits, rules, and facts and sketches that are merged."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from stayline import operators as op
from stayline.operators.models import Prepared
from stayline.sources import write_table


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(400, 3)) * [1, 5, 0.2] + [0, 3, 1]
    y = (x[:, 0] + 0.1 * x[:, 1] + rng.normal(size=400) > 0.5).astype(int)
    w = rng.integers(1, 5, 400)
    data = [(*map(float, r), int(k), int(c)) for r, k, c in zip(x, y, w)]
    df = spark.createDataFrame(data, "a double, b double, c double, label int, weight int")
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df).cache()


@pytest.mark.parametrize("loss", ["logistic", "hinge"])
@pytest.mark.parametrize("weight", [None, "weight"])
def test_slopes_are_those_of_the_loss(rows, loss, weight):
    beta, bias = [0.3, -0.1, 0.8], 0.2
    p = rows.toPandas()
    x, y = p[["a", "b", "c"]].to_numpy(), p.label.to_numpy()
    w = p.weight.to_numpy() if weight else np.ones(len(p))

    def mean(b):
        m = x @ b[:3] + b[3]
        each = np.logaddexp(0, m) - y * m if loss == "logistic" else np.maximum(0, 1 - (2 * y - 1) * m)
        return (w * each).sum() / w.sum()

    at = np.array([*beta, bias])
    got = {r.slot: r for r in op.loss_slopes(rows, beta, bias, loss, weight=weight, kink=0.0).collect()}
    for k, slot in enumerate([0, 1, 2, -1]):
        step = np.eye(4)[k] * 1e-7
        slope = (mean(at + step) - mean(at - step)) / 2e-7
        assert np.isclose(got[slot].least * got[slot].deviation, slope, atol=1e-5)
        assert np.isclose(got[slot].loss, mean(at))


def test_optimality_tells_a_fit_from_a_stop(rows):
    """Residuals are small after a fit to the end, and not after one step."""
    for reg, elastic in ((0.0, 0.0), (0.1, 0.0), (0.05, 1.0), (0.1, 0.5)):
        worst = []
        for steps in (1, 300):
            lr = LogisticRegression(regParam=reg, elasticNetParam=elastic, maxIter=steps, tol=1e-12)
            model = lr.fit(rows)
            slopes = op.loss_slopes(rows, model.coefficients, model.intercept)
            found = op.optimality(slopes, model.coefficients, reg, elastic)
            worst.append(found.agg(F.max("residual")).first()[0])
        assert worst[1] < 1e-5 < 1e-3 < worst[0], (reg, elastic)


def test_kink_gives_an_interval(spark, rows):
    slopes = op.loss_slopes(rows, [0.0, 0.0, 0.0], 1.0, "hinge").collect()
    # Rows of label 1 have a margin of just 1: their slopes may be anything from 0 to full.
    by_slot = {r.slot: r for r in slopes}
    share = rows.agg(F.avg("label")).first()[0]
    assert np.isclose(by_slot[-1].least, 1 - 2 * share) and np.isclose(by_slot[-1].most, 1 - share)


def test_first_split_is_the_root_of_a_tree(rows):
    gains = op.split_gains(rows, ["a", "b", "c"])
    (best,) = op.first_split(gains, ["a", "b", "c"]).collect()
    tree = DecisionTreeClassifier(maxDepth=1, maxBins=512).fit(rows)
    root = tree._call_java("rootNode")
    assert ["a", "b", "c"][root.split().featureIndex()] == best.feature
    assert np.isclose(root.split().threshold(), best.threshold)
    assert np.isclose(root.gain(), best.gain)
    assert op.split_gains(rows.limit(0), ["a"]).count() == 0


@pytest.mark.parametrize("per_part", [7, 1000])
def test_running_sums_in_many_parts(spark, tmp_path, per_part):
    df = spark.range(500).selectExpr("id % 3 AS g", "id AS v", "id * id % 11 AS n")
    df = df.union(spark.sql("SELECT CAST(NULL AS BIGINT), CAST(5 AS BIGINT), CAST(2 AS BIGINT)"))
    df.write.parquet(f"{tmp_path}/rows")
    found = op.running_sums(spark.read.parquet(f"{tmp_path}/rows"), ["g"], "v", ["n"], per_part)
    total: dict = {}
    for r in sorted(found.collect(), key=lambda r: r.v):
        assert r.n_before == total.get(r.g, 0)
        total[r.g] = total.get(r.g, 0) + r.n


def test_rules_learn_their_side(spark, rows):
    table = rows.withColumn("features1", F.col("features")).withColumn("part", F.lit("train"))
    table = table.withColumn("fold", F.col("weight") % 3)
    from stayline.operators.rules import Constant, ThresholdRule

    model = ThresholdRule(0, 0.5).fit(table)
    assert model.transform(table).where("(a >= 0.5) <> (prediction = 1)").isEmpty()
    flipped = table.withColumn("label", 1 - F.col("label"))
    other = ThresholdRule(0, 0.5).fit(flipped).transform(flipped)
    assert other.where("(a >= 0.5) <> (prediction = 0)").isEmpty()
    assert Constant(1.0).fit(table).transform(table).where("prediction <> 1").isEmpty()
    tied = op.tune(Prepared(None, table), op.rule_candidates()[:1])
    assert len(tied.rows) == 4


def test_days_can_come_late_and_again(spark, log, tmp_path):
    """Merged states are the facts of one pass, whatever the order of days."""
    path = f"{tmp_path}/states"
    days = [r[0] for r in op.daily_states(log).select("day").distinct().collect()]
    assert len(days) > 2
    for day in [*days[::-1], *days[:2]]:
        of_day = log.where(F.to_date(F.timestamp_millis("ts")) == day)
        op.store_days(op.daily_states(of_day), path)
    merged = op.merged_facts(op.stored_states(spark, path))
    assert sorted(map(tuple, merged.collect()), key=repr) == sorted(
        map(tuple, op.user_facts(log).collect()), key=repr
    )


def test_replace_needs_folders(spark, log, tmp_path):
    with pytest.raises(ValueError):
        write_table(log, f"{tmp_path}/x", mode="replace")


def test_sketches_are_near(spark):
    df = spark.range(60_000).selectExpr(
        "CAST(id % 20011 AS STRING) AS userId", "CAST(id % 2 AS INT) AS churn_users",
        "sqrt(id * 7919 % 60000) AS v", "CAST(date_from_unix_date(CAST(id % 40 AS INT)) AS DATE) AS day",
    )
    from stayline.operators.sketches import RANK_ERROR, USERS_ERROR

    users = op.users_by_range(op.user_sketches(df, F.col("day")), F.lit(0)).first().users
    assert abs(users - 20_011) <= USERS_ERROR * 20_011
    sketches = op.value_sketches(df, "v", F.col("day"))
    errors = op.rank_errors(op.value_counts(df, "v", "churn_users"), op.sketched_quantiles(sketches))
    found = errors.collect()
    assert len(found) == 2 and all(max(r.e1, r.e2, r.e3) <= RANK_ERROR for r in found)
    off = op.sketched_quantiles(sketches).withColumn("q1", F.col("q1") * 1.5)
    wrong = op.rank_errors(op.value_counts(df, "v", "churn_users"), off)
    assert all(r.e1 > RANK_ERROR for r in wrong.collect())
