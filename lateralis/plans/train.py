"""Prepare the wells of a basin and train, evaluate and package its cost model."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lateralis.config import RunConfig, basin_config, check_reservoirs
from lateralis.functions.columns import col
from lateralis.functions.transforms import transform_column
from lateralis.operators.categories import collect_values, combine_with_prefix, group_rare, trained_values
from lateralis.operators.derive import derive_well_columns
from lateralis.operators.errorbins import BinSpec, absolute_percentage_error, bin_spec, error_table
from lateralis.operators.filters import Filtered, apply_filters
from lateralis.operators.importance import permutation_importance
from lateralis.operators.metrics import best_models, leaderboard, residual_frame
from lateralis.operators.models import FEATURES, LABEL, PREDICTION, Fitted, Search, fit_and_evaluate, tune_models
from lateralis.operators.repair import FLAG, flag_cost_anomalies, impute_from_reference
from lateralis.operators.split import SEED, SPLIT, Splits, split_parts, split_rows
from lateralis.plans.stages import fit_preprocessing, fit_target_scaler, package, slot_names
from lateralis.session import checkpointed, persisted, scratch_path
from lateralis.sources.tables import (
    COMPLETIONS_COLUMNS,
    REFERENCE_COLUMNS,
    read_snapshot,
    rename_costs,
    scan_completions,
    scan_reference_costs,
    write_snapshot,
)

RESERVOIR = "ReservoirGoldConsolidated"
OPERATOR = "OperatorGold"
KEY = "API14"
BASIN_COLUMN = "BasinQuantum"
PREDICATE_COLUMNS = ("CompletionDate", "HoleDirection", "TotalWellCost_ENV_USDMM", BASIN_COLUMN)
LATERAL, PROPPANT, FLUID = "LateralLength_FT", "Proppant_LBSPerFT", "Fluid_BBLPerFT"


def prepare_wells(
    completions: DataFrame, reference: DataFrame | None, basin: str, reservoirs: Sequence[str]
) -> DataFrame:
    """The basin's wells with uniform cost names; with ``reference``, anomalous costs are replaced."""
    wells = rename_costs(scan_completions(completions, basin, reservoirs))
    if reference is None:
        return wells
    return impute_from_reference(flag_cost_anomalies(wells), scan_reference_costs(reference, basin))


@dataclass
class ModellingFrame:
    """Filtered and recoded rows with their label, ready to be split."""

    df: DataFrame
    filtered: Filtered
    operators: list[str] | None
    composites: list[str] | None


def modelling_frame(
    derived: DataFrame,
    config: RunConfig,
    key: str = KEY,
    *,
    operator: str = OPERATOR,
    reservoir: str = RESERVOIR,
    storage: StorageLevel | None = StorageLevel.MEMORY_AND_DISK_DESER,
) -> ModellingFrame:
    """Filters, rare operators, composite operator key and the label; rows without a label go."""
    filtered = apply_filters(derived, config.filtering, carry=[key], storage=storage)
    df, operators, composites = filtered.df, None, None
    if operator in config.categories:
        grouped = group_rare(df, operator, config.operator_threshold)
        df, operators = combine_with_prefix(grouped.df, reservoir, operator), grouped.retained
        composites = collect_values(df, operator)
    target = col(config.target).cast("double")
    rule = config.target_transform
    df = df.withColumn(LABEL, target if rule is None else transform_column(target, rule)).dropna("any", subset=[LABEL])
    for name, rule in config.feature_transforms.items():  # a log of 0 has no value: the row cannot be used
        df = df.where(transform_column(col(name), rule).isNotNull())
    return ModellingFrame(df, filtered, operators, composites)


@dataclass
class Trained:
    config: RunConfig
    pipeline: PipelineModel
    model_name: str
    fitted: dict[str, Fitted]
    leaderboard: DataFrame
    base_leaderboard: DataFrame
    splits: Splits
    features: list[str]
    categories: dict[str, list[str]]
    operators: list[str] | None
    composites: list[str] | None
    bins: BinSpec | None
    error_table: DataFrame | None
    importance: DataFrame | None
    residuals: dict[str, DataFrame]
    searches: dict[str, Search] = field(default_factory=dict)
    metadata: dict[str, Any] = field(default_factory=dict)
    persisted: list[DataFrame] = field(default_factory=list)

    def performance(self) -> DataFrame:
        return self.leaderboard.where(F.col("models") == self.model_name)

    def release(self) -> None:
        for df in self.persisted:
            df.unpersist()


def train_model(
    frame: ModellingFrame,
    config: RunConfig,
    key: str = KEY,
    *,
    bin_columns: tuple[str, str, str] = (LATERAL, PROPPANT, FLUID),
    cv_folds: int | None = 5,
    importance_repeats: int = 10,
    search_on: str = "train",
    search_method: str = "random",
    search_metric: str = "mape",
    tune_best: int = 4,
    original_scale_errors: bool = True,
    seed: int = SEED,
    storage: StorageLevel = StorageLevel.MEMORY_AND_DISK_DESER,
) -> Trained:
    """Split, preprocess, fit every configured model, pick the best and package it.

    All rows with their split and feature vector, and what reports need beside it, are the one persisted data set: one pass
    makes it, and every optimiser step, fold and report reads it. The packaged model reuses the fitted stages, so
    nothing is fitted twice. The persisted rows of the filters are released as soon as that set is made.
    Of the models with a grid the ``tune_best`` best base fits are tuned; the leaderboard has tuned and untuned
    models, ``base_leaderboard`` all of them before. Where models were tuned, the best of those is packaged.
    A failed run releases what it persisted.
    """
    splits = split_rows(frame.df, key, config.split, seed)
    preprocessing = fit_preprocessing(splits.train, frame.df, config)
    target_scaler = fit_target_scaler(splits.train) if config.scale_y else None

    def ready(df: DataFrame) -> DataFrame:
        assembled = preprocessing.transform(df)
        return target_scaler.transform(assembled) if target_scaler is not None else assembled

    keyed = [key] if cv_folds or importance_repeats or config.tuning else []  # folds and permutations go by it
    read = [c for c in dict.fromkeys((*keyed, config.target, *bin_columns)) if c in frame.df.columns and c not in (LABEL, FEATURES)]
    everything = persisted(ready(splits.labelled).select(*[col(c) for c in (*read, LABEL, FEATURES, SPLIT)]), storage)
    sets = split_parts(everything, ("train", "valid", "test") if splits.test is not None else ("train", "valid"))
    try:
        return _fit_and_package(
            frame, config, key, splits, sets, everything, preprocessing, target_scaler, bin_columns, cv_folds, importance_repeats,
            search_on, search_method, search_metric, tune_best, original_scale_errors, seed, storage,
        )
    except BaseException:
        everything.unpersist()
        raise


def _fit_and_package(
    frame, config, key, splits, sets, everything, preprocessing, target_scaler, bin_columns, cv_folds, importance_repeats,
    search_on, search_method, search_metric, tune_best, original_scale_errors, seed, storage,
) -> Trained:
    spark = frame.df.sparkSession
    train, valid = sets["train"], sets["valid"]
    everything.count()
    frame.filtered.release()  # not read any more
    rows = train.count()
    fitted = fit_and_evaluate(
        train, valid, config.models, key=key, cv_folds=cv_folds, label_scaler=target_scaler, rows=rows
    )
    base_board = leaderboard(spark, {name: f.performance for name, f in fitted.items()})
    searches: dict[str, Search] = {}
    tuned: dict[str, Fitted] = {}
    if config.tuning:
        chosen = best_models(base_board, tune_best)
        grids = {name: grid for name, grid in config.tuning.items() if name in chosen or name not in fitted}
        searches, tuned = tune_models(
            grids, sets[search_on], train, valid, key,
            method=search_method, metric=search_metric, cv_folds=cv_folds, label_scaler=target_scaler, base=config.models, seed=seed,
        )
        fitted = {**fitted, **tuned}  # a model that is not tuned stays with its base fit
    board = leaderboard(spark, {name: f.performance for name, f in fitted.items()})
    best = best_models(board.where(F.col("models").isin(*tuned)) if tuned else board, 1)[0]
    regressor = fitted[best].model
    names = slot_names(preprocessing, config.features, config.categories)
    importance = (
        permutation_importance(regressor, train, names, key=key, repeats=importance_repeats, seed=seed, rows=rows)
        if importance_repeats
        else None
    )
    pipeline = package(preprocessing, regressor, config, target_scaler)
    prediction = PipelineModel(pipeline.stages[len(preprocessing.stages) :])  # of rows that have their features
    bins, errors = _training_errors(train, regressor, prediction, config, bin_columns, original_scale_errors, storage)
    residuals = {name: _residuals(df, fitted, names, name, target_scaler) for name, df in sets.items()}
    return Trained(
        config=config, pipeline=pipeline, model_name=best, fitted=fitted, leaderboard=board, base_leaderboard=base_board,
        splits=splits,
        features=names, categories=trained_values(preprocessing.stages), operators=frame.operators,
        composites=frame.composites, bins=bins, error_table=errors, importance=importance, residuals=residuals,
        searches=searches, metadata=_metadata(config, names, rows), persisted=[everything],
    )


def _training_errors(ready, regressor, prediction, config, columns, original_scale, storage):
    """The error table of the training rows, on the raw target scale unless told otherwise.

    Its aggregates read the errors and the three binned columns, persisted meanwhile. It is written once: scoring
    must not replay the training.
    """
    if not set(columns) <= set(ready.columns):
        return None, None
    if original_scale:
        scored = prediction.transform(ready)
        error = absolute_percentage_error(col(config.target), col(PREDICTION))
    else:
        scored = regressor.transform(ready)
        error = absolute_percentage_error(col(LABEL), col(PREDICTION), signed=True)
    errors = persisted(scored.select(*[col(c) for c in dict.fromkeys(columns)], error.alias("_error")), storage)
    try:
        spec = bin_spec(errors, *columns)
        return spec, None if spec is None else checkpointed(error_table(errors, spec, "_error"))
    finally:
        errors.unpersist()


def _residuals(df, fitted, names, split, target_scaler):
    """Residual frame of one split on the modelling scale, feature slots as named columns."""
    scored, predictions = df, {}
    for name, f in fitted.items():
        predictions[name] = f"_prediction_{name}"
        model = f.model.copy({f.model.getParam("predictionCol"): predictions[name]})
        scored = model.transform(scored)
    if target_scaler is not None:
        scored = target_scaler.inverse(scored, {LABEL: LABEL, **{p: LABEL for p in predictions.values()}})
    slots = vector_to_array(col(FEATURES))
    slots_named = [slots[i].alias(f"_slot{i}") for i in range(len(names))]
    wide = scored.select(col(LABEL), *predictions.values(), *slots_named)
    framed = residual_frame(wide, LABEL, predictions, [f"_slot{i}" for i in range(len(names))], split)
    return framed.withColumnsRenamed({f"_slot{i}": n for i, n in enumerate(names)})


def _metadata(config: RunConfig, features: Sequence[str], rows: int) -> dict[str, Any]:
    filtering = config.filtering
    return {
        "filtering_spec": {
            "columns": list(filtering.keep or ()),
            "percentile": filtering.percentile,
            "thresholds": {c: list(b) for c, b in filtering.thresholds.items()},
            "statistical": vars(filtering.statistical) if filtering.statistical else None,
            "ratios": {f"{a} / {b}": v for (a, b), v in filtering.ratios.items()},
        },
        "input_features": list(features),
        "output_feature": config.target,
        "split_spec": vars(config.split),
        "scaling_spec": {"scale_x": config.scale_x, "scaler": config.scaler, "scale_y": config.scale_y},
        "models": {name: dict(params or {}) for name, params in config.models.items()},
        "tuning_spec": {name: dict(grid) for name, grid in config.tuning.items()},
        "training_rows": rows,
    }


def train_basin(
    completions: DataFrame,
    reference: DataFrame | None,
    basin: str,
    reservoirs: Sequence[str] | None = None,
    config: RunConfig | None = None,
    **options,
) -> Trained:
    """Scan, repair, filter, train and package one basin."""
    basin = basin.upper()
    config = config or basin_config(basin)
    reservoirs = [r.upper() for r in (reservoirs or config.reservoirs) if r]
    check_reservoirs(config, reservoirs)
    wells = prepare_wells(completions, reference, basin, reservoirs)
    frame = modelling_frame(derive_well_columns(wells.drop(FLAG)), config)
    try:
        return train_model(frame, config, **options)
    finally:
        frame.filtered.release()


def train_basins(
    completions: DataFrame,
    reference: DataFrame | None,
    basins: Mapping[str, RunConfig | None] | Sequence[str],
    *,
    one_scan: bool = True,
    **options,
) -> dict[str, Trained]:
    """One packaged model per basin, of any kind of model; linear ones alone are fitted together by ``grouped_models``.

    The tables are scanned once: the rows of all wanted basins are written with a folder per basin, and each basin
    reads its own. ``one_scan=False`` leaves that out where the tables are partitioned by basin already. What a basin
    persists is released when its package is built; its residual frames are computed again if asked for.
    """
    configs = {b.upper(): c for b, c in (basins.items() if isinstance(basins, Mapping) else ((b, None) for b in basins))}
    if one_scan and len(configs) > 1:
        completions = _snapshot_by_basin(completions, list(configs), (*COMPLETIONS_COLUMNS, *PREDICATE_COLUMNS))
        reference = None if reference is None else _snapshot_by_basin(reference, list(configs), (*REFERENCE_COLUMNS, "CompletionDate", "HoleDirection", BASIN_COLUMN))
    trained = {}
    for basin, config in configs.items():
        trained[basin] = train_basin(completions, reference, basin, config=config, **options)
        trained[basin].release()
    return trained


def _snapshot_by_basin(table: DataFrame, basins: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The rows of the basins, in one scan, as a written table with a folder per basin."""
    spark = table.sparkSession
    path = scratch_path(spark, "basins")
    kept = table.where(col(BASIN_COLUMN).isin(list(basins))).select(*[col(c) for c in dict.fromkeys(columns)])
    write_snapshot(kept, path, [BASIN_COLUMN])
    # the basin stays a string: as a partition column its type would be guessed
    schema = T.StructType([f for f in kept.schema if f.name != BASIN_COLUMN] + [kept.schema[BASIN_COLUMN]])
    return read_snapshot(spark, path, schema)
