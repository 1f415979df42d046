"""What is persisted leaves the heap in small batches, of which few are held outside of Spark's accounts."""

from dataclasses import replace

import pytest
from pyspark import StorageLevel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from lateralis.config import basin_config
from lateralis.operators import models
from lateralis.operators.models import FEATURES, LABEL, search_parameters
from lateralis.plans import train
from lateralis.session import CACHED_ROWS, persisted
from tests import wells as W

SETTING = "spark.sql.inMemoryColumnarStorage.batchSize"


def batches(df):
    relation = df.select("*")._jdf.queryExecution().withCachedData().collectLeaves().head()
    return relation.cacheBuilder().cachedColumnBuffers().count()


@pytest.fixture
def usual(spark):
    usual = spark.conf.get(SETTING)
    yield usual
    spark.conf.set(SETTING, usual)


def test_batches_are_small_and_the_session_keeps_its_setting(spark, usual):
    rows = spark.range(0, 4500, 1, 1).withColumn("x", F.col("id") * 2.0)
    held = persisted(rows)
    assert batches(held) == 5 and spark.conf.get(SETTING) == usual
    assert held.count() == 4500 and held.agg(F.sum("x")).head()[0] == 4499 * 4500
    assert held.storageLevel == StorageLevel.MEMORY_AND_DISK_DESER
    held.unpersist()
    spark.conf.set(SETTING, 500)  # smaller ones are left as they are
    held = persisted(rows.where("id >= 0"))
    assert batches(held) == 9 and spark.conf.get(SETTING) == "500"
    held.unpersist()


def seen(monkeypatch, module):
    """Columns of the frames that a module persists, and whether as objects."""
    found = []

    def watched(df, *args):
        held = persisted(df, *args)
        found.append((held.columns, held.storageLevel.deserialized))
        return held

    monkeypatch.setattr(module, "persisted", watched)
    return found


def test_training_set_is_kept_as_objects_in_small_batches(spark, monkeypatch):
    found = seen(monkeypatch, train)
    config = replace(basin_config(W.BASIN), models={"LinearRegression": {}})
    completions = W.completions(spark)
    trained = train.train_basin(completions, W.reference_costs(completions), W.BASIN, config=config, cv_folds=None, importance_repeats=0)
    (held,) = trained.persisted
    assert held.storageLevel == StorageLevel.MEMORY_AND_DISK_DESER
    assert [d for _, d in found] == [True, True] and found[0][0] == held.columns
    least = held.count() / CACHED_ROWS
    assert least <= batches(held) <= least + held.rdd.getNumPartitions()
    trained.release()


def test_folds_are_kept_as_objects_in_small_batches(spark, monkeypatch):
    found = seen(monkeypatch, models)
    df = spark.range(200).select(F.col("id").cast("string").alias("key"), (F.col("id") % 7.0).alias("a"), (F.col("id") % 7 * 3.0).alias(LABEL))
    df = VectorAssembler(inputCols=["a"], outputCol=FEATURES).transform(df)
    search_parameters("LinearRegression", {"fit_intercept": [True, False]}, df, "key", folds=2)
    search_parameters("RandomForestRegressor", {"max_depth": [1, 2]}, df, "key", folds=2, base={"n_estimators": 2})
    assert found == [([FEATURES, LABEL, "_fold"], True), (["k", "id", "x", "y"], True)]
