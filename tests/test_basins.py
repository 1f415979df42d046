"""Models of many groups at once, against single fits and numpy."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from lateralis.config import basin_config
from lateralis.operators.grouped_models import grouped_huber, grouped_least_squares, score_by_group
from lateralis.operators.models import FEATURES, build_regressor
from lateralis.plans import train as plans
from tests import wells as W


@pytest.fixture(scope="module")
def rows(spark):
    """Three basins of 3000, 900 and 40 rows, features of very different units, a tenth of gross outliers."""
    rng = np.random.default_rng(5)
    out = []
    for basin, n, weights in (("a", 3000, (3.0, -400.0, 0.01)), ("b", 900, (1.0, 50.0, 0.02)), ("c", 40, (0.5, 0.0, 0.0))):
        x = np.stack([rng.uniform(1, 50, n), rng.uniform(0, 0.1, n), rng.uniform(1e5, 2e5, n)], axis=1)
        y = 100 + x @ np.array(weights) + rng.normal(0, 2, n)
        y[rng.random(n) < 0.1] *= 5
        out += [(basin, *map(float, r), float(v)) for r, v in zip(x, y)]
    odd = [(None, 1.0, 1.0, 1.0, 1.0), ("a", None, 1.0, 1.0, 1.0), ("b", 1.0, float("nan"), 1.0, 1.0), ("b", 1.0, 1.0, 1.0, None)]
    return spark.createDataFrame(out + odd, "basin string, p double, q double, r double, y double").repartition(5).cache()


NAMES = ["p", "q", "r"]


def of(rows, basin):
    found = [r for r in rows.where(F.col("basin") == basin).dropna().collect() if r.q == r.q]
    return np.array([[r.p, r.q, r.r] for r in found]), np.array([r.y for r in found])


def test_least_squares_of_every_group(rows):
    fits = {r.basin: r for r in grouped_least_squares(rows, "basin", NAMES, "y").collect()}
    assert set(fits) == {"a", "b", "c"}
    for basin, fit in fits.items():
        x, y = of(rows, basin)
        want = np.linalg.lstsq(np.column_stack([np.ones(len(x)), x]), y, rcond=None)[0]
        assert fit.rows == len(x)
        np.testing.assert_allclose([fit.intercept, *fit.coefficients], want, rtol=1e-6)
        assert fit.scale == pytest.approx(np.sqrt(np.mean((y - want[0] - x @ want[1:]) ** 2)), rel=1e-6)


def test_robust_fits_have_a_zero_gradient(rows):
    epsilon, alpha = 1.35, 1e-4
    for fit in grouped_huber(rows, "basin", NAMES, "y").collect():
        x, y = of(rows, fit.basin)
        b, s = np.array(fit.coefficients), fit.scale
        left = y - fit.intercept - x @ b
        clipped = np.clip(left, -epsilon * s, epsilon * s)
        spread = x.std(axis=0)
        np.testing.assert_allclose((clipped @ (x - x.mean(axis=0)) - alpha * s * b) / spread / len(x) / s, 0, atol=1e-5)
        assert abs(clipped.sum()) / len(x) / s < 1e-5
        assert np.sum(clipped**2) / s**2 == pytest.approx(len(x), rel=1e-4)  # the scale's own condition
        assert 1 < fit.rounds < 200


def test_robust_fit_equals_the_single_one(rows):
    fit = grouped_huber(rows.where("basin = 'a'"), "basin", ["p", "q"], "y").head()
    train = VectorAssembler(inputCols=["p", "q"], outputCol=FEATURES, handleInvalid="skip").transform(
        rows.where("basin = 'a'").dropna().withColumnRenamed("y", "label")
    )
    single = build_regressor("HuberRegressor", {"max_iter": 1000, "tol": 1e-9}, rows=train.count()).fit(train)
    np.testing.assert_allclose(fit.coefficients, single.coefficients, rtol=1e-2)
    assert fit.intercept == pytest.approx(single.intercept, rel=1e-2) and fit.scale == pytest.approx(single.scale, rel=1e-2)


def test_awkward_groups(spark):
    rows = [("flat", 2.0, float(k), 3.0 * k + 1) for k in range(20)] + [("one", 5.0, 6.0, 7.0)] + [("none", None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "basin string, p double, q double, y double")
    for fits in (grouped_least_squares(df, "basin", ["p", "q"], "y"), grouped_huber(df, "basin", ["p", "q"], "y")):
        found = {r.basin: r for r in fits.collect()}
        assert set(found) == {"flat", "one"}
        np.testing.assert_allclose(found["flat"].coefficients, [0, 3], atol=1e-6)
        assert found["one"].coefficients == [0, 0] and found["one"].intercept == 7
        scored = score_by_group(df, fits, "basin", ["p", "q"])
        assert scored.columns == [*df.columns, "prediction"]
        for r in scored.collect():
            assert r.prediction is None if r.basin == "none" else r.prediction == pytest.approx(r.y, abs=1e-5)
    assert grouped_huber(df.limit(0), "basin", ["p"], "y").count() == 0


@pytest.fixture(scope="module")
def tables(spark):
    wells = W.completions(spark).cache()
    return wells, W.reference_costs(wells)


def linear(basin, **changes):
    return replace(basin_config(basin), reservoirs=W.RESERVOIRS, models={"LinearRegression": {}}, categories=("ReservoirGoldConsolidated",), **changes)


def test_one_scan_gives_the_same_models(tables):
    configs = {"midland": linear("MIDLAND"), W.BASIN: linear(W.BASIN)}
    once, each = (plans.train_basins(*tables, configs, one_scan=o, cv_folds=None, importance_repeats=0) for o in (True, False))
    assert list(once) == list(each) == ["MIDLAND", W.BASIN]
    for basin, result in once.items():
        assert result.metadata == each[basin].metadata
        np.testing.assert_allclose(result.fitted["LinearRegression"].model.coefficients, each[basin].fitted["LinearRegression"].model.coefficients, rtol=1e-6)
        assert not any(df.storageLevel.useMemory for df in result.persisted)


def test_only_the_best_are_tuned(tables):
    models = {"LinearRegression": {}, "RandomForestRegressor": {"n_estimators": 2, "max_depth": 1}, "HuberRegressor": {"max_iter": 50}}
    config = replace(
        linear(W.BASIN), models=models,
        tuning={"RandomForestRegressor": {"max_depth": [1, 2]}, "HuberRegressor": {"epsilon": [1.35, 2.0]}},
    )
    trained = plans.train_basin(*tables, W.BASIN, config=config, cv_folds=None, importance_repeats=0, tune_best=2)
    order = [r["models"] for r in trained.base_leaderboard.collect()]
    assert len(order) == 3 and set(trained.searches) == set(order[:2]) & set(config.tuning)
    assert {r["models"] for r in trained.leaderboard.collect()} == set(models)
    trained.release()


def test_failed_training_releases_what_it_persisted(spark, tables, monkeypatch):
    def fail(*_, **__):
        raise RuntimeError("no fit")

    monkeypatch.setattr(plans, "fit_and_evaluate", fail)
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    with pytest.raises(RuntimeError, match="no fit"):
        plans.train_basin(*tables, W.BASIN, config=linear(W.BASIN))
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) <= before
