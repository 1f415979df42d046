"""Forests grown from sums by cell against MLlib's, and what their scores may not depend on."""

import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from lateralis.operators import fold_forests, models
from lateralis.operators.metrics import mse
from lateralis.operators.models import FEATURES, LABEL, search_parameters
from lateralis.operators.split import SEED, fold_number

GRID = {"max_depth": [1, 3, 5]}


def frame(spark, rows=3000, values=20):
    df = spark.range(rows).select(
        F.concat(F.lit("k"), "id").alias("key"),
        *[(F.pmod(F.xxhash64("id", F.lit(c)), F.lit(values)) * 1.0).alias(c) for c in "ab"],
        (F.pmod(F.xxhash64("id", F.lit("noise")), F.lit(1000)) / 100.0).alias("noise"),
    ).withColumn(LABEL, F.expr("50 + a * 3 + IF(b > 12, 40, 0) + a * b / 10 + noise"))
    return VectorAssembler(inputCols=["a", "b"], outputCol=FEATURES).transform(df)


def by_cells(df, candidates, folds=3, width=2):
    rows = fold_forests.numbered(df, "key", fold_number(F.col("key"), folds), FEATURES, LABEL)
    return fold_forests.fold_scores(rows, folds, candidates, width, mse)


@pytest.mark.parametrize("least", [1, 60])
def test_trees_without_draws_are_those_of_mllib(spark, least):
    df = frame(spark).persist()
    depths = [1, 2, 4, 6]
    found = by_cells(df, [fold_forests.ForestCandidate(1, d, least, bootstrap=False) for d in depths])
    folded = df.withColumn("_fold", fold_number(F.col("key"), 3)).persist()
    for d, scores in zip(depths, found):
        forest = RandomForestRegressor(numTrees=1, maxDepth=d, minInstancesPerNode=least, bootstrap=False, featureSubsetStrategy="all")
        for k, score in enumerate(scores):
            model = forest.fit(folded.where(F.col("_fold") != k))
            expected = model.transform(folded.where(F.col("_fold") == k)).agg(mse(F.col(LABEL), F.col("prediction"))).head()[0]
            assert score == pytest.approx(expected, rel=1e-9)
    folded.unpersist(), df.unpersist()


def test_search_fits_no_forest_per_candidate_and_fold(spark, monkeypatch):
    def refuse(*_):
        raise AssertionError("a forest was fitted")

    df = frame(spark, 800).persist()
    search = lambda **o: search_parameters("RandomForestRegressor", GRID, df, "key", base={"n_estimators": 3}, metric="rmse", **o)
    with monkeypatch.context() as patched:
        patched.setattr(RandomForestRegressor, "fit", refuse)
        found = search()
    assert found.best_params == {"max_depth": 5}
    monkeypatch.setattr(fold_forests, "MOST_CELLS", 1)  # MLlib fits those of more cells
    for (a, own), (b, other) in zip(found.scores, search().scores):
        assert a == b and own == pytest.approx(other, rel=0.1)
    df.unpersist()


def test_scores_do_not_depend_on_the_partitions_or_the_passes(spark, monkeypatch):
    df = frame(spark, 600)
    candidates = [fold_forests.ForestCandidate(4, 3, seed=SEED), fold_forests.ForestCandidate(2, 2, seed=SEED), fold_forests.ForestCandidate(3, 3, seed=1)]
    found = by_cells(df.repartition(1), candidates)
    monkeypatch.setattr(fold_forests, "MOST_SUMS", 1)  # a pass a tree
    for a, b in zip(found, by_cells(df.repartition(7), candidates)):
        assert a == pytest.approx(b, rel=1e-9)
    assert found[0] != found[2]


def test_many_values_get_bins_of_equally_many_rows(spark):
    df = frame(spark, 2000, values=1500)
    tree, mean = by_cells(df, [fold_forests.ForestCandidate(8, 6), fold_forests.ForestCandidate(8, 0)])
    assert all(a < b / 20 for a, b in zip(tree, mean))
    values, counts = fold_forests._summary(np.arange(100_000.0))
    points = fold_forests.split_points(values, counts, 32)
    assert len(points) == 31 and np.allclose(points, np.arange(1, 32) * 3125, atol=400)


def test_summaries_of_many_parts_keep_the_ranks(spark, monkeypatch):
    values = np.random.default_rng(1).normal(size=60_000)
    parts = [fold_forests._summary(p) for p in np.split(values, 30)]
    v, n = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    merged = fold_forests._merged(fold_forests._summary_columns(fold_forests.pa.Table, 0, 0, v, n))
    found, counts = (merged.column(c).to_numpy() for c in "vn")
    assert len(found) <= fold_forests.MERGED_VALUES and counts.sum() == len(values)
    points = fold_forests.split_points(found, counts, 32)
    assert np.allclose([(values <= p).mean() for p in points], np.arange(1, 32) / 32, atol=0.004)
    # in many parts as in one
    df, candidates = frame(spark, 600), [fold_forests.ForestCandidate(2, 3)]
    whole = by_cells(df, candidates)
    monkeypatch.setattr(fold_forests, "SUMMARY_NUMBERS", 1)
    assert by_cells(df.repartition(5), candidates)[0] == pytest.approx(whole[0], rel=1e-9)


def test_draws_have_the_mean_and_variance_of_one():
    ids = np.arange(200_000, dtype=np.int64) - 100_000
    a, b = (fold_forests.draws(ids, SEED, t) for t in (0, 1))
    assert a.mean() == pytest.approx(1, abs=0.01) and a.var() == pytest.approx(1, abs=0.02)
    assert abs(np.corrcoef(a, b)[0, 1]) < 0.01


def test_odd_rows(spark):
    df = frame(spark, 300)
    candidates = [fold_forests.ForestCandidate(2, 2)]
    without = df.where(fold_number(F.col("key"), 3) != 1)
    assert by_cells(without, candidates)[0][1] is None  # no row to score
    found = search_parameters("RandomForestRegressor", {"max_depth": [1]}, without, "key", base={"n_estimators": 2}, folds=3)
    assert found.best_score == -math.inf
    with pytest.raises(ValueError, match="no rows outside of fold 0"):
        by_cells(df.where(fold_number(F.col("key"), 3) == 0), candidates)
    for label in ("CAST(NULL AS DOUBLE)", "double('NaN')"):
        with pytest.raises(Exception, match="labels must not be"):
            by_cells(df.withColumn(LABEL, F.expr(f"IF(key = 'k7', {label}, label)")), candidates)
    keyless = df.withColumn("key", F.expr("IF(a < 10, key, NULL)"))
    assert by_cells(keyless, candidates)[0] == pytest.approx(by_cells(df.where("a < 10"), candidates)[0], rel=1e-9)


def test_other_forests_are_left_to_mllib(spark):
    df = frame(spark, 50)
    forest = RandomForestRegressor(featuresCol=FEATURES, labelCol=LABEL, featureSubsetStrategy="all")
    assert models._forest_candidate(forest, df) == fold_forests.ForestCandidate(20, 5, seed=forest.getSeed())
    for other in ({"featureSubsetStrategy": "sqrt"}, {"subsamplingRate": 0.5}, {"minInfoGain": 0.1}, {"weightCol": "a"}):
        assert models._forest_candidate(forest.copy({forest.getParam(k): v for k, v in other.items()}), df) is None
