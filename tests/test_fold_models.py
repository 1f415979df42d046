import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lateralis.operators import models
from lateralis.operators.fold_models import LinearCandidate, fold_sums
from lateralis.operators.models import (
    FEATURES, LABEL, LabelEvaluator, build_regressor, cross_validated_ridge, cross_validated_rmse, search_parameters,
)
from lateralis.operators.split import fold_number


@pytest.fixture(scope="module")
def rows(spark):
    """Slots of very different units, one that never varies, and a third of the rows repeated."""
    df = spark.range(0, 900, 1, 4).select(
        F.col("id").cast("string").alias("key"), (100 + 10 * F.randn(1)).alias("a"), (1e-3 * F.randn(2)).alias("b"),
        F.lit(7.0).alias("c"), F.randn(3).alias("e"),
    )
    df = df.withColumn(LABEL, 50 + 0.2 * F.col("a") + 2000 * F.col("b") + F.col("e"))
    df = df.unionByName(df.where("cast(key AS int) % 3 = 0"))
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol=FEATURES).transform(df).persist()


def refitted(rows, estimators, evaluator, folds):
    """The scores by one fit and one evaluation per candidate and fold."""
    folded = rows.withColumn("_fold", fold_number(F.col("key"), folds))
    found = []
    for estimator in estimators:
        scores = [
            evaluator.evaluate(estimator.fit(folded.where(F.col("_fold") != k)).transform(folded.where(F.col("_fold") == k)))
            for k in range(folds)
        ]
        found.append(sum(scores) / folds)
    return found


@pytest.mark.parametrize("metric", ["rmse", "mse", "mape", "r2"])
def test_scores_equal_refits(rows, metric):
    grid = {"fit_intercept": [True, False]}
    found = search_parameters("LinearRegression", grid, rows, "key", folds=3, metric=metric)
    estimators = [build_regressor("LinearRegression", {"fit_intercept": f}, rows=1) for f in grid["fit_intercept"]]
    expected = refitted(rows, estimators, LabelEvaluator(metric=metric), 3)
    assert [s for _, s in found.scores] == pytest.approx(expected, rel=1e-5)


def test_scores_on_the_unscaled_label(rows):
    evaluator = LabelEvaluator(metric="mape", center=3.0, scale=2.0)
    found = models._fold_scores([build_regressor("LinearRegression", rows=1)], evaluator, rows, "key", 3, 42, 1)
    assert found == pytest.approx(refitted(rows, [build_regressor("LinearRegression", rows=1)], evaluator, 3), rel=1e-5)


def test_ridge_equals_plain_algebra(rows):
    collected = rows.withColumn("_fold", fold_number(F.col("key"), 4)).select(FEATURES, LABEL, "_fold").collect()
    x = np.array([r[0].toArray() for r in collected])
    y, fold = np.array([r[1] for r in collected]), np.array([r[2] for r in collected])
    for penalty, score in cross_validated_ridge(rows, "key", [0.5, 100.0], 4):
        errors = []
        for k in range(4):
            seen = fold != k
            mx, my = x[seen].mean(axis=0), y[seen].mean()
            z = x[seen] - mx
            w = np.linalg.solve(z.T @ z + penalty * np.eye(3), z.T @ (y[seen] - my))
            errors.append(np.sqrt(np.mean((y[~seen] - my - (x[~seen] - mx) @ w) ** 2)))
        assert score == pytest.approx(-np.mean(errors), rel=1e-7)


def test_a_fit_equals_the_fit_of_the_other_folds(rows):
    folded = rows.withColumn("_fold", fold_number(F.col("key"), 3))
    sums = fold_sums(folded, "_fold", 3, FEATURES, LABEL)
    assert sums.sums[:, 0, 0].sum() == rows.count() == 1200
    for k in range(3):
        model = build_regressor("LinearRegression", rows=1).fit(folded.where(F.col("_fold") != k))
        intercept, weights = sums.fit(k, LinearCandidate())
        assert weights == pytest.approx(model.coefficients.toArray(), rel=1e-5, abs=1e-9)
        assert weights[2] == 0 and intercept == pytest.approx(model.intercept, rel=1e-5)


def test_partitioning_and_jobs(rows, monkeypatch):
    estimator = build_regressor("LinearRegression", rows=1)
    whole = cross_validated_rmse(estimator, rows, "key", 3)
    assert whole == pytest.approx(cross_validated_rmse(estimator, rows.repartition(1), "key", 3), rel=1e-9)
    monkeypatch.setattr(models, "MOST_WIDTH", 2)  # wider models are refitted, with the same score
    assert whole == pytest.approx(cross_validated_rmse(estimator, rows, "key", 3), rel=1e-5)
    with pytest.raises(ValueError, match="slots"):
        cross_validated_ridge(rows, "key", [1.0], 3)


def test_empty_missing_and_sparse(spark):
    schema = spark.createDataFrame([("k", Vectors.dense([1.0]), 1.0)], ["key", FEATURES, LABEL]).schema
    with pytest.raises(ValueError, match="no rows"):
        cross_validated_ridge(spark.createDataFrame([], schema), "key", [0.0], 2)
    one = spark.createDataFrame([("k", Vectors.dense([1.0]), 1.0)] * 3, schema)
    with pytest.raises(ValueError, match="no rows outside"):
        cross_validated_ridge(one, "key", [0.0], 2)
    data = [(str(i), Vectors.sparse(2, [i % 2], [1.0 + i]), 3.0 * (1 + i) if i % 2 else 5.0 * (1 + i)) for i in range(40)]
    sparse = spark.createDataFrame(data, ["key", FEATURES, LABEL])
    assert cross_validated_ridge(sparse, "key", [0.0], 3)[0][1] == pytest.approx(0, abs=1e-6)
    gap = sparse.withColumn(LABEL, F.when(F.col("key") != "7", F.col(LABEL)).otherwise(float("nan")))
    assert np.isnan(cross_validated_ridge(gap, "key", [0.0], 3)[0][1])
    rare = spark.createDataFrame([(str(i), Vectors.dense([float(i)]), 2.0 * i) for i in range(3)], ["key", FEATURES, LABEL])
    assert cross_validated_ridge(rare, "key", [0.0], 50)[0][1] == float("-inf")  # folds without rows
