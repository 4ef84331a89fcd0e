"""Histograms and box statistics against numpy, on awkward distributions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayline.operators import box_stats, histogram, quantiles, value_counts


def frame(spark, cohorts):
    rows = [(c, None if v is None else float(v)) for c, vs in cohorts.items() for v in vs]
    return spark.createDataFrame(rows, "churn_users int, v double").repartition(5)


def heavy_tail(n, seed):
    values = np.random.default_rng(seed).pareto(0.7, n)
    values[: n // 3] = 0.25  # a third of all rows share one value
    return values


COHORTS = {
    0: heavy_tail(3000, 1),
    1: np.random.default_rng(2).integers(0, 40, 501),
    2: [7.5],
    3: [3, 3, 3, 3],
    4: [0, 0, 0, 100],
}


@pytest.mark.parametrize("by", ["churn_users", "cohort"])
def test_quantiles_are_exact(spark, by):
    df = frame(spark, COHORTS).withColumnRenamed("churn_users", by)
    probs = (0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0)
    got = {r[0]: r for r in quantiles(value_counts(df, "v", by), by, probs).collect()}
    for c, values in COHORTS.items():
        assert got[c].total == len(values)
        expected = np.quantile(values, probs)
        assert np.allclose(list(got[c])[2:], expected, rtol=1e-12), c


def test_box(spark):
    got = {r[0]: r for r in box_stats(frame(spark, COHORTS), "v").collect()}
    for c, values in COHORTS.items():
        values = np.asarray(values, float)
        q1, q2, q3 = np.quantile(values, [0.25, 0.5, 0.75])
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = values[(values >= low) & (values <= high)]
        expected = [len(values), q1, q2, q3, min(q1, inside.min()), max(q3, inside.max())]
        assert np.allclose(list(got[c])[1:7], expected), c
        assert got[c].n_outliers == len(values) - len(inside)


def test_approximate_box_is_close(spark):
    df = frame(spark, {0: np.arange(10_001)})
    (box,) = box_stats(df, "v", approx=True).collect()
    assert abs(box.median - 5000) <= 2 and box.n == 10_001 and box.n_outliers == 0


@pytest.mark.parametrize("bins", [1, 7, 30])
def test_histogram_is_numpys(spark, bins):
    table = histogram(frame(spark, COHORTS), "v", bins=bins).orderBy("churn_users", "bin").collect()
    for c, values in COHORTS.items():
        mine = [r for r in table if r.churn_users == c]
        density, edges = np.histogram(values, bins=bins, density=True)
        counts, _ = np.histogram(values, bins=bins)
        assert [r.bin for r in mine] == list(range(1, bins + 1))
        assert [r.n for r in mine] == list(counts)
        assert np.allclose([r.lo for r in mine], edges[:-1])
        assert np.allclose([r.hi for r in mine], edges[1:])
        assert np.allclose([r.density for r in mine], density)
        assert np.isclose(sum(r.density * (r.hi - r.lo) for r in mine), 1)


def test_shared_edges(spark):
    df = frame(spark, {0: range(10), 1: range(20, 31)})
    table = histogram(df, "v", bins=3, shared_edges=True)
    assert table.select("lo", "hi").distinct().count() == 3
    got = table.orderBy("churn_users", "bin").select("n").collect()
    assert [r.n for r in got] == [10, 0, 0, 0, 0, 11]


def test_missing_values_are_left_out(spark):
    df = frame(spark, {0: [1, 2, None, 3], None: [4, 5]})
    table = histogram(df, "v", bins=2)
    assert table.groupBy("churn_users").agg(F.sum("n").alias("n")).orderBy("churn_users").collect() == [
        (None, 2),
        (0, 3),
    ]
    assert "density" not in histogram(df, "v", bins=2, density=False).columns
    assert {r.n for r in box_stats(df, "v").collect()} == {2, 3}


def test_nan_and_null_are_left_out(spark):
    rows = [(0, 1.0), (0, 3.0), (0, float("nan")), (0, None), (1, float("nan"))]
    df = spark.createDataFrame(rows, "churn_users int, x double")
    bins = histogram(df, "x", bins=2).orderBy("bin").collect()
    assert [(r.churn_users, r.lo, r.hi, r.n) for r in bins] == [(0, 1.0, 2.0, 1), (0, 2.0, 3.0, 1)]
    (box,) = box_stats(df, "x").collect()
    assert (box.n, box.q1, box.median, box.q3) == (2, 1.5, 2.0, 2.5)


def test_quantiles_do_not_depend_on_the_cuts(spark):
    """Running sums in one part, some and many give the same exact quantiles."""
    df = spark.range(3000).selectExpr("CAST(id % 2 AS INT) AS churn_users", "id * id % 1009 AS x")
    counts = value_counts(df, "x", "churn_users")
    found = [
        quantiles(counts, "churn_users", rows_per_part=n).orderBy("churn_users").collect()
        for n in (7, 300, 100_000)
    ]
    assert found[0] == found[1] == found[2]
