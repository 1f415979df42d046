import math

import pytest
from pyspark.sql import functions as F

from lateralis.config import parse_config, split_ratio_key
from lateralis.functions.columns import (
    bin_label, bin_lower, col, composite_key, cost_anomaly, key_prefix, key_suffix, midpoint, unit_cost,
)
from lateralis.functions.transforms import apply_transforms, invert_transforms
from lateralis.operators.derive import derive_well_columns, keep_columns
from lateralis.operators.split import fold_number, split_label, split_rows
from lateralis.config import SplitConfig
from lateralis.sources.tables import nan_to_null


def values(df, name="v"):
    return [r[name] for r in df.collect()]


def test_midpoint_skips_missing(spark):
    df = spark.createDataFrame([(1.0, 3.0), (None, 3.0), (1.0, None), (None, None)], "a double, b double")
    assert values(df.select(midpoint(F.col("a"), F.col("b")).alias("v"))) == [2.0, 3.0, 1.0, None]


def test_unit_cost_of_zero_length_is_null(spark):
    df = spark.createDataFrame([(2.0, 4.0), (2.0, 0.0)], "a double, b double")
    assert values(df.select(unit_cost(F.col("a"), F.col("b")).alias("v"))) == [5e5, None]


def test_missing_ratio_is_an_anomaly(spark):
    df = spark.createDataFrame(
        [(10.0, 3.25), (10.0, 3.3), (10.0, None), (0.0, 1.0), (10.0, 3.2504)], "total double, drill double"
    )
    flags = values(df.select(cost_anomaly(F.col("total"), {"drill": 0.325}).alias("v")))
    assert flags == [False, True, True, True, False]


def test_composite_key(spark):
    df = spark.createDataFrame([("A B", "X_Y"), (None, "X")], "r string, o string")
    key = composite_key(F.col("r"), F.col("o"))
    rows = df.select(key.alias("k"), key_prefix(key).alias("p"), key_suffix(key).alias("s")).collect()
    assert [tuple(r) for r in rows] == [("A B_X_Y", "A B", "Y"), (None, None, None)]


def test_bins_are_right_closed(spark):
    df = spark.createDataFrame([(1000.0,), (1000.5,), (2000.0,), (2001.0,)], "x double")
    lower = bin_lower(F.col("x"), F.lit(1000.0))
    labels = values(df.select(bin_label(lower, F.lit(1000.0)).alias("v")))
    assert labels == ["0 - 1000", "1000 - 2000", "1000 - 2000", "2000 - 3000"]


def test_transforms_see_earlier_results_and_invert(spark):
    df = spark.createDataFrame([(8.0, 5.0), (2.0, 3.0)], "a double, b double")
    spec = {"a": "log", "b": {"multiply": ["a"]}}
    done = apply_transforms(df, spec)
    assert math.isclose(done.head()["b"], 5.0 * math.log(8.0))
    back = invert_transforms(done, spec).collect()
    assert all(math.isclose(x, y) for r, w in zip(back, df.collect()) for x, y in zip(r, w))
    assert apply_transforms(df, spec, order=["b"]).head()["b"] == 40.0
    with pytest.raises(ValueError, match="cube"):
        apply_transforms(df, {"a": "cube"})


def test_log_of_zero_is_null(spark):
    df = spark.createDataFrame([(0.0,), (-1.0,)], "a double")
    assert values(apply_transforms(df, {"a": "log"}), "a") == [None, None]


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), "x"), (1.0, "y")], "a double, s string")
    assert values(nan_to_null(df), "a") == [None, 1.0]


def test_derived_well_columns(spark):
    df = spark.sql(
        "select 35.0d LatitudeBHWGS84, 36.0d LatitudeSHWGS84, null::double LongitudeBHWGS84, -98.0d LongitudeSHWGS84,"
        " date'2019-03-01' CompletionDate, 8.0d TotalWellCost_USDMM, 10000.0d LateralLength_FT, 'w' API14"
    )
    row = derive_well_columns(df).head().asDict()
    assert row == {
        "TotalWellCost_USDMM": 8.0, "LateralLength_FT": 10000.0, "API14": "w", "LatitudeMP": 35.5,
        "LongitudeMP": -98.0, "CompletionYear": 2019, "cost/ft_Lateral": 800.0,
    }
    with pytest.raises(KeyError, match="absent"):
        keep_columns(df, ["API14", "absent"])


def test_split_is_complete_disjoint_and_independent_of_partitioning(spark):
    df = spark.range(20_000).withColumn("key", F.concat(F.lit("w"), "id"))
    labels = df.select("id", split_label(col("key")).alias("s"))
    again = df.repartition(7).select("id", split_label(col("key")).alias("s"))
    assert labels.exceptAll(again).count() == 0
    counts = {r["s"]: r["count"] for r in labels.groupBy("s").count().collect()}
    assert sum(counts.values()) == 20_000
    for name, share in (("test", 0.10), ("valid", 0.18), ("train", 0.72)):
        assert abs(counts[name] / 20_000 - share) < 0.01
    without_test = split_rows(df, "key", SplitConfig(test=False))
    assert without_test.test is None
    assert without_test.train.count() + without_test.valid.count() == 20_000
    folds = df.select(fold_number(col("key"), 4).alias("f")).groupBy("f").count().collect()
    assert sorted(r["f"] for r in folds) == [0, 1, 2, 3]


def test_config_parsing():
    raw = {
        "reservoirs_of_interest": ["R"],
        "filtering_config": {
            "cols_to_keep": ["a"],
            "technical_filtering": {"percentile": False, "thresholds": {"a": [0.1, 0.9]}},
            "statistical_filtering": {"threshold": 2.0, "type": "z-score"},
            "ratio_filtering": {"a / cost/ft": 0.3},
        },
        "input_features": ["a"],
        "target_features": ["cost/ft"],
        "encode": True,
        "categorical_feature": "ReservoirGoldConsolidated",
        "transformations": None,
        "split_data": {"test_data": False, "test_data_ratio": None, "validation_data_ratio": 0.25},
        "scale_data": {"scale_x": True, "scale_y": True},
        "training_config": {"HuberRegressor": None},
        "hyperparam_tuning_config": {"HuberRegressor": {"param_grid": {"alpha": [1, 2]}}},
    }
    with pytest.warns(UserWarning, match="percentiles"):
        config = parse_config(raw)
    assert config.categories == ("ReservoirGoldConsolidated",)
    assert config.operator_threshold == 50
    assert config.filtering.ratios == {("a", "cost/ft"): 0.3}
    assert config.filtering.statistical.kind == "z-score" and config.filtering.statistical.columns is None
    assert (config.split.test, config.split.test_ratio, config.split.valid_ratio) == (False, 0.1, 0.25)
    assert config.tuning == {"HuberRegressor": {"alpha": [1, 2]}}
    assert split_ratio_key("a/b") == ("a", "b")
    with pytest.raises(ValueError):
        split_ratio_key("a")
