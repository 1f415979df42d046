from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from lateralis.config import SplitConfig, StatisticalFilter, basin_config
from lateralis.functions.columns import col
from lateralis.operators.derive import add_midpoints
from lateralis.operators.errorbins import absolute_percentage_error, error_table
from lateralis.operators.importance import ranked_features
from lateralis.operators.split import split_rows
from lateralis.plans.score import (
    Package,
    locate_wells,
    predict_costs,
    recode_for_scoring,
    score_from_coefficients,
    score_wells,
    validate,
)
from lateralis.plans.train import prepare_wells, train_basin, train_basins
from lateralis.sources.artifacts import count_rows, load_package, performance_bundle, save_bundle, save_package
from tests import wells as W


@pytest.fixture(scope="module")
def tables(spark):
    completions = W.completions(spark).persist()
    return completions, W.reference_costs(completions)


@pytest.fixture(scope="module")
def trained(tables):
    return train_basin(*tables, W.BASIN, cv_folds=2, importance_repeats=2)


def test_training_end_to_end(spark, tables, trained, tmp_path):
    completions, reference = tables
    performance = trained.performance().head()
    assert performance["models"] == "HuberRegressor"
    assert performance["average cross-validated rmse (USDMM)"] > 0
    assert trained.features[:3] == ["Proppant_LBSPerFT", "Fluid_BBLPerFT", "LateralLength_FT"]
    # The composite operator dummies sum up to the reservoir dummy, so only numeric ranks are determined.
    numeric = [f for f in ranked_features(trained.importance) if f in trained.config.features]
    assert numeric[0] == "Proppant_LBSPerFT" and set(numeric[-2:]) == {"LatitudeMP", "LongitudeMP"}
    assert trained.error_table.count() > 0
    assert set(trained.residuals) == {"train", "valid", "test"}
    assert "residual_HuberRegressor" in trained.residuals["test"].columns

    package = Package.of(trained)
    wells = add_midpoints(prepare_wells(completions, reference, W.BASIN, W.RESERVOIRS))
    located, pairs = locate_wells(wells, W.areas(spark))
    scored = score_wells(located, package)
    # Only a lateral length of 0, which has no logarithm, cannot be scored.
    assert scored.where("score_note is not null and LateralLength_FT > 0").count() == 0
    assert scored.where("score_note is null and (LateralLength_FT = 0 or Cost_USDPerFT is null)").count() == 0
    metrics = validate(scored).head()
    assert metrics["mape"] < 60 and metrics["r2"] is not None

    save_package(spark, package, str(tmp_path / "package"))
    loaded = load_package(spark, str(tmp_path / "package"))
    assert loaded.composites == package.composites and loaded.metadata["model"] == trained.model_name
    assert loaded.metadata["training_rows"] == trained.metadata["training_rows"] and loaded.metadata["parameters"] == package.metadata["parameters"]
    again = score_wells(located, loaded)
    assert scored.exceptAll(again).count() == 0

    parts = performance_bundle(trained)
    save_bundle(parts, str(tmp_path / "bundle"))
    assert count_rows(parts).count() == len(parts)


def test_coefficient_scoring_equals_pipeline(trained):
    """The hand-written linear equation gives the packaged model's predictions (on the log scale)."""
    scored = trained.pipeline.transform(trained.splits.valid)
    names = [c for c in scored.columns if c.endswith("__transformed")]
    features = [f"{c}__transformed" if f"{c}__transformed" in names else c for c in trained.config.features]
    expression = F.exp(score_from_coefficients(trained.pipeline, features, trained.categories))
    worst = scored.select(F.max(F.abs(expression - col("prediction")))).head()[0]
    assert worst < 1e-6


def test_training_persists_one_narrow_set(tables):
    """All rows once with their split; the error table made from it is that of the packaged model on the raw rows."""
    trained = train_basin(*tables, W.BASIN, config=replace(basin_config(W.BASIN), models={"LinearRegression": {}}), cv_folds=None, importance_repeats=0)
    (held,) = trained.persisted
    assert held.columns == ["cost/ft_Lateral", *trained.bins.columns, "label", "features", "_split"] and held.storageLevel.useMemory
    sizes = {r["_split"]: r["count"] for r in held.groupBy("_split").count().collect()}
    splits = trained.splits
    assert sizes == {"train": splits.train.count(), "valid": splits.valid.count(), "test": splits.test.count()}
    raw = trained.pipeline.transform(splits.train)
    error = absolute_percentage_error(col(trained.config.target), col("prediction"))
    expected = error_table(raw.withColumn("_error", error), trained.bins, "_error")
    assert trained.error_table.exceptAll(expected).count() == 0 == expected.exceptAll(trained.error_table).count()
    trained.release()


def test_splits_are_the_labelled_rows(spark):
    rows = spark.range(0, 500).select("id", F.when(F.col("id") % 9 > 0, F.col("id").cast("string")).alias("k"))
    splits = split_rows(rows, "k")
    for name, part in (("train", splits.train), ("valid", splits.valid), ("test", splits.test)):
        assert part.columns == ["id", "k"]
        assert sorted(r["id"] for r in part.collect()) == sorted(r["id"] for r in splits.labelled.where(f"_split = '{name}'").collect())
    assert splits.train.where("k IS NULL").count() == 56


def test_unknown_categories(trained):
    package = Package.of(trained)
    base = trained.splits.valid.limit(3)
    unseen = predict_costs(base.withColumn("OperatorGold", F.lit("WOODFORD_NOBODY")), package)
    assert {r["OperatorGold"] for r in unseen.collect()} == {"WOODFORD_miscellaneous"}
    assert unseen.where("Cost_USDPerFT is null").count() == 0
    lost = predict_costs(base.withColumn("OperatorGold", F.lit("NOWHERE_NOBODY")), package)
    assert lost.where("Cost_USDPerFT is not null").count() == 0
    assert lost.where("score_note = 'unknown value in OperatorGold'").count() == 3


def test_recode(trained, spark):
    package = Package.of(trained)
    df = spark.createDataFrame([("WOODFORD", "NOBODY"), ("WOODFORD", trained.operators[0])], "ReservoirGoldConsolidated string, OperatorGold string")
    got = [r["OperatorGold"] for r in recode_for_scoring(df, package).collect()]
    assert got == ["WOODFORD_miscellaneous", f"WOODFORD_{trained.operators[0]}"]


def test_unknown_reservoir_is_refused(tables):
    with pytest.raises(ValueError, match="not configured"):
        train_basin(*tables, W.BASIN, ["NOT A RESERVOIR"])


def test_other_basin_config():
    assert basin_config("delaware").categories == ("ReservoirGoldConsolidated",)


def test_fractional_absolute_bounds_are_pointed_out():
    with pytest.warns(UserWarning, match="percentiles"):
        basin_config("POWDER RIVER")
    with pytest.raises(KeyError, match="no configuration"):
        basin_config("ATLANTIS")


def test_scaled_target_tuning_and_statistical_filter(tables):
    """A run with a standardised log target, a searched model, a masked column and no test split."""
    base = basin_config(W.BASIN)
    config = replace(
        base,
        filtering=replace(base.filtering, statistical=StatisticalFilter(("cost/ft_Lateral",), 6.0, "mad")),
        categories=("ReservoirGoldConsolidated",),
        scale_y=True,
        split=SplitConfig(test=False),
        models={"LinearRegression": {}, "RandomForestRegressor": {"n_estimators": 3, "max_depth": 3}},
        tuning={"RandomForestRegressor": {"max_depth": [2, 5]}},
    )
    trained = train_basin(*tables, W.BASIN, config=config, cv_folds=None, importance_repeats=1)
    assert trained.model_name == "RandomForestRegressor" and trained.operators is None
    assert trained.searches["RandomForestRegressor"].best_params == {"max_depth": 5}
    assert set(trained.residuals) == {"train", "valid"}
    scored = trained.pipeline.transform(trained.splits.valid)
    error = scored.agg(F.avg(F.abs(col("prediction") / col("cost/ft_Lateral") - 1))).head()[0]
    assert error < 0.2  # on the raw scale
    residual = trained.residuals["valid"].agg(F.max(F.abs("residual_RandomForestRegressor"))).head()[0]
    assert residual < 2  # on the log scale
    predicted = predict_costs(trained.splits.valid, Package.of(trained))
    assert predicted.where("Cost_USDPerFT is null").count() == 0
    trained.release()


def test_several_basins(tables):
    configs = {
        "MIDLAND": replace(basin_config("MIDLAND"), reservoirs=W.RESERVOIRS, models={"LinearRegression": {}}, operator_threshold=5),
        W.BASIN: replace(basin_config(W.BASIN), models={"LinearRegression": {}}),
    }
    trained = train_basins(*tables, configs, cv_folds=None, importance_repeats=0)
    assert list(trained) == ["MIDLAND", W.BASIN]
    for basin, result in trained.items():
        assert result.metadata["output_feature"] == "cost/ft_Lateral" and result.importance is None
        result.release()
    assert trained["MIDLAND"].metadata["training_rows"] < trained[W.BASIN].metadata["training_rows"]


def test_errors_on_the_modelling_scale(tables):
    config = replace(basin_config(W.BASIN), models={"LinearRegression": {}})
    trained = train_basin(*tables, W.BASIN, config=config, cv_folds=None, importance_repeats=0, original_scale_errors=False)
    # A log of about 7 with residuals of a few tenths: errors of a few percent.
    assert trained.error_table.agg(F.avg("mape_median")).head()[0] < 10
    trained.release()
