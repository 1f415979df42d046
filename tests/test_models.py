import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from lateralis.operators.importance import permutation_importance, ranked_features, tree_importance
from lateralis.operators.models import (
    FEATURES, LABEL, build_regressor, cross_validated_rmse, fit_and_evaluate, parameter_candidates, search_parameters,
    tune_models,
)
from lateralis.operators.scaling import StandardColumnScaler
from lateralis.operators.split import split_rows


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(0, 2000, 1, 4).select(
        F.col("id").cast("string").alias("key"), F.randn(1).alias("a"), F.randn(2).alias("b"), F.randn(3).alias("noise")
    )
    clean = 50 + 5 * F.col("a") + 2 * F.col("b") + F.randn(4) * 0.1
    df = df.withColumn(LABEL, F.when(F.rand(5) < 0.04, clean + 100).otherwise(clean))
    return VectorAssembler(inputCols=["a", "b", "noise"], outputCol=FEATURES).transform(df).persist()


def test_robust_fit_ignores_outliers(rows):
    robust = build_regressor("HuberRegressor", {"max_iter": 500}, rows=2000).fit(rows)
    plain = build_regressor("LinearRegression", rows=2000).fit(rows)
    assert list(robust.coefficients) == pytest.approx([5, 2, 0], abs=0.05)
    assert robust.intercept == pytest.approx(50, abs=0.05)
    assert abs(plain.intercept - 50) > 2


def test_regressor_parameters():
    huber = build_regressor("HuberRegressor", {"alpha": 0.5, "epsilon": 2.0}, rows=100)
    assert huber.getRegParam() == 0.005 and huber.getEpsilon() == 2.0 and huber.getLoss() == "huber"
    boosted = build_regressor("XGBRegressor", {"n_estimators": 7, "subsample": 0.5}, rows=1)
    assert boosted.getMaxIter() == 7 and boosted.getSubsamplingRate() == 0.5 and boosted.getStepSize() == 0.3
    with pytest.raises(ValueError, match="does not take"):
        build_regressor("LinearRegression", {"gamma": 1}, rows=1)
    with pytest.raises(ValueError, match="unknown model"):
        build_regressor("Lasso", rows=1)


def test_fit_and_evaluate_with_scaled_label(rows):
    splits = split_rows(rows, "key")
    scaler = StandardColumnScaler(inputCols=[LABEL], outputCols=[LABEL]).fit(splits.train)
    plain = fit_and_evaluate(splits.train, splits.valid, {"LinearRegression": None})
    scaled = fit_and_evaluate(
        scaler.transform(splits.train), scaler.transform(splits.valid), {"LinearRegression": None}, label_scaler=scaler
    )
    name = "root_mean_squared_error (USDMM)"
    a, b = plain["LinearRegression"].performance, scaled["LinearRegression"].performance
    assert a[name] == pytest.approx(b[name], rel=1e-4)
    assert a["average cross-validated rmse (USDMM)"] is None
    with pytest.raises(ValueError):
        fit_and_evaluate(splits.train, splits.valid, {})


def test_search(rows):
    grid = {"n_estimators": [3], "max_depth": [1, 4]}
    assert len(parameter_candidates({"a": [1, 2], "b": [1, 2, 3]})) == 6
    drawn = parameter_candidates({"a": list(range(50))}, "random", 10)
    assert len(drawn) == 10 and drawn == parameter_candidates({"a": list(range(50))}, "random", 10)
    with pytest.raises(ValueError):
        parameter_candidates({"a": [1]}, "bayes")
    found = search_parameters("RandomForestRegressor", grid, rows, "key", folds=2)
    assert found.best_params == {"n_estimators": 3, "max_depth": 4} and found.best_score < 0
    assert len(found.scores) == 2
    splits = split_rows(rows, "key")
    searches, fitted = tune_models({"RandomForestRegressor": grid}, rows, splits.train, splits.valid, "key", folds=2, cv_folds=None)
    assert searches["RandomForestRegressor"].method == "random"
    assert fitted["RandomForestRegressor"].params["max_depth"] == 4


def test_cross_validation_is_repeatable(rows):
    estimator = build_regressor("LinearRegression", rows=2000)
    first = cross_validated_rmse(estimator, rows, "key", 3)
    assert first == pytest.approx(cross_validated_rmse(estimator, rows.repartition(3), "key", 3, parallelism=1), rel=1e-9)


def test_importance(rows):
    model = build_regressor("LinearRegression", rows=2000).fit(rows)
    names = ["a", "b", "noise"]
    whole = permutation_importance(model, rows, names, key="key", repeats=3)
    assert ranked_features(whole) == names
    assert abs(whole.where("feature = 'noise'").head()["importance_mean"]) < 0.01
    bucketed = permutation_importance(model, rows, names, key="key", repeats=3, bucket_rows=100)
    assert ranked_features(bucketed) == names
    with pytest.raises(TypeError):
        tree_importance(model, names, rows)
    forest = build_regressor("RandomForestRegressor", {"n_estimators": 5, "max_depth": 4}, rows=2000).fit(rows)
    assert tree_importance(forest, names, rows).head()["feature"] == "a"
    by_forest = permutation_importance(forest, rows, names, key="key", repeats=2)
    assert ranked_features(by_forest)[0] == "a"


def test_linear_shortcut_equals_full_evaluation(rows):
    """Moving a linear prediction by weight times change is the same as evaluating the changed vector."""
    model = build_regressor("LinearRegression", rows=2000).fit(rows)

    class Opaque:
        def transform(self, df):
            return model.transform(df)

    short = permutation_importance(model, rows, ["a", "b", "noise"], key="key", repeats=2).collect()
    full = permutation_importance(Opaque(), rows, ["a", "b", "noise"], key="key", repeats=2).collect()
    for s, f in zip(short, full):
        assert s["feature"] == f["feature"]
        assert s["importance_mean"] == pytest.approx(f["importance_mean"], rel=1e-9, abs=1e-12)


def test_importance_depends_on_no_partitioning(spark):
    rows = spark.range(0, 3000).select(
        F.col("id").cast("string").alias("k"), F.rand(1).alias("a"), F.rand(2).alias("b"), F.randn(3).alias("e")
    ).withColumn("label", 5 * F.col("a") + F.col("b") + 0.1 * F.col("e")).persist()
    ready = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows)
    for name in ("LinearRegression", "RandomForestRegressor"):
        model = build_regressor(name, {} if name == "LinearRegression" else {"n_estimators": 3, "max_depth": 4}, rows=3000).fit(ready)
        found = []
        for n in (2, 7):
            drops = permutation_importance(model, ready.repartition(n), ["a", "b"], key="k", repeats=2, bucket_rows=700)
            found.append([(r["feature"], round(r["importance_mean"], 9)) for r in drops.collect()])
        assert found[0] == found[1] and found[0][0][0] == "a"
        if name == "LinearRegression":  # the expected drop: 2 w^2 var(x) / var(y)
            variance = rows.agg(F.var_pop("a").alias("a"), F.var_pop("label").alias("y")).head()
            assert abs(found[0][0][1] - 2 * model.coefficients[0] ** 2 * variance["a"] / variance["y"]) < 0.1


def test_importance_sorts_once_however_many_repeats(spark, monkeypatch):
    """No window and one sort, whatever the repeats; copies of a row and rows without a key give what plain sorting gives."""
    key = F.when(F.col("id") % 5 == 0, None).otherwise((F.col("id") % 170).cast("string"))
    rows = spark.range(0, 600).select(key.alias("k"), F.round(F.rand(1), 1).alias("a"), F.rand(2).alias("b"), F.randn(3).alias("e"))
    rows = rows.union(rows.limit(1).crossJoin(spark.range(11_000)).drop("id")).withColumn("label", 5 * F.col("a") + F.col("b") + F.col("e"))
    ready = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows).persist()
    model = build_regressor("LinearRegression", rows=11_600).fit(ready)
    plans, collect = [], type(ready).collect

    def noted(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return collect(df)

    monkeypatch.setattr(type(ready), "collect", noted)
    table = permutation_importance(model, ready, ["a", "b"], key="k", repeats=4, seed=7, bucket_rows=4_000)
    monkeypatch.undo()
    sorts = [p.count(" Sort [") // max(p.count("== Initial Plan =="), 1) for p in plans]
    assert max(sorts) == 1 and not any("Window" in p for p in plans)
    found = {r["feature"]: r["importance_mean"] for r in table.collect()}

    base = model.transform(ready).select(
        "label", "prediction", F.array("a", "b").alias("x"), F.xxhash64("k").alias("id")
    ).withColumn("bucket", F.pmod(F.xxhash64(F.lit(7), "id", "label", "x"), F.lit(3)))
    plain = base.select("*", F.array(*[F.xxhash64(F.lit(7), F.lit(r), F.col("id")) for r in range(4)]).alias("order")).collect()
    mean = sum(r["label"] for r in plain) / len(plain)
    total = sum((r["label"] - mean) ** 2 for r in plain)
    error = sum((r["label"] - r["prediction"]) ** 2 for r in plain)
    for i, name in enumerate(["a", "b"]):
        moved = 0.0
        for repeat in range(4):
            for bucket in range(3):
                held = sorted((r for r in plain if r["bucket"] == bucket), key=lambda r: (r["order"][repeat], r["label"], r["x"]))
                for r, following in zip(held, held[1:] + held[:1]):
                    moved += (r["label"] - r["prediction"] - model.coefficients[i] * (following["x"][i] - r["x"][i])) ** 2
        assert found[name] == pytest.approx((moved / 4 - error) / total, rel=1e-9, abs=1e-12)
    ready.unpersist()


def test_search_metric(spark):
    rows = spark.range(0, 400).select(F.col("id").cast("string").alias("k"), (F.rand(1) + 1).alias("a")).withColumn("label", 3 * F.col("a"))
    ready = VectorAssembler(inputCols=["a"], outputCol="features").transform(rows).persist()
    for metric, best in (("r2", 1.0), ("rmse", 0.0)):
        found = search_parameters("LinearRegression", {"fit_intercept": [True]}, ready, "k", folds=2, metric=metric)
        assert abs(found.best_score - best) < 1e-6
    with pytest.raises(ValueError, match="unknown metric"):
        search_parameters("LinearRegression", {"fit_intercept": [True]}, ready, "k", folds=2, metric="none")
