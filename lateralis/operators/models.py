"""Regressors by name, fitted and compared on Spark; cross-validation and parameter search."""

from __future__ import annotations

import itertools
import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param.shared import HasLabelCol, HasPredictionCol
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateralis.functions.columns import col
from lateralis.operators import fold_forests
from lateralis.operators.fold_models import MOST_WIDTH, LinearCandidate, fold_scores
from lateralis.operators.metrics import CV_RMSE, mape, mse, r2_score, regression_metrics
from lateralis.operators.split import SEED, fold_number
from lateralis.session import persisted

FEATURES = "features"
LABEL = "label"
PREDICTION = "prediction"

# Defaults of the robust regression and the accepted parameter names of each model.
HUBER_DEFAULTS = {"epsilon": 1.35, "alpha": 1e-4, "tol": 1e-5, "max_iter": 100}
_LINEAR_NAMES = {"fit_intercept": "fitIntercept"}
_HUBER_NAMES = {"epsilon": "epsilon", "tol": "tol", "max_iter": "maxIter", "fit_intercept": "fitIntercept"}
_FOREST_NAMES = {
    "n_estimators": "numTrees",
    "max_depth": "maxDepth",
    "min_samples_leaf": "minInstancesPerNode",
    "random_state": "seed",
}
_BOOSTING_NAMES = {
    "n_estimators": "maxIter",
    "learning_rate": "stepSize",
    "subsample": "subsamplingRate",
    "max_depth": "maxDepth",
    "random_state": "seed",
}
# Trees look at all features of a split; they are as deep as is sensible here, where unlimited depth is not offered.
_FOREST_DEFAULTS = {"n_estimators": 100, "max_depth": 12}
_BOOSTING_DEFAULTS = {"n_estimators": 100, "learning_rate": 0.3, "max_depth": 6}


def _renamed(params: Mapping[str, Any], names: Mapping[str, str], model: str) -> dict[str, Any]:
    unknown = sorted(set(params) - set(names))
    if unknown:
        raise ValueError(f"{model} does not take {unknown}; known: {sorted(names)}")
    return {names[k]: v for k, v in params.items()}


def build_regressor(
    name: str,
    params: Mapping[str, Any] | None = None,
    *,
    rows: int,
    features: str = FEATURES,
    label: str = LABEL,
    prediction: str = PREDICTION,
) -> Estimator:
    """An unfitted regressor. ``rows`` is the size of the training set.

    The robust loss here is averaged over the rows and halved, so an ``alpha`` that weighs against
    the summed loss becomes ``alpha / rows``.
    """
    params = dict(params or {})
    columns = {"featuresCol": features, "labelCol": label, "predictionCol": prediction}
    if name == "HuberRegressor":
        settings = {**HUBER_DEFAULTS, **params}
        alpha = settings.pop("alpha")
        return LinearRegression(
            **columns, loss="huber", solver="l-bfgs", standardization=False, regParam=alpha / max(rows, 1),
            **_renamed(settings, _HUBER_NAMES, name),
        )
    if name == "LinearRegression":
        return LinearRegression(**columns, regParam=0.0, **_renamed(params, _LINEAR_NAMES, name))
    if name == "RandomForestRegressor":
        settings = {**_FOREST_DEFAULTS, "random_state": SEED, **params}
        return RandomForestRegressor(**columns, featureSubsetStrategy="all", **_renamed(settings, _FOREST_NAMES, name))
    if name == "XGBRegressor":
        settings = {**_BOOSTING_DEFAULTS, "random_state": SEED, **params}
        return GBTRegressor(**columns, **_renamed(settings, _BOOSTING_NAMES, name))
    raise ValueError(f"unknown model {name!r}; known: {sorted(REGRESSORS)}")


REGRESSORS = ("HuberRegressor", "LinearRegression", "RandomForestRegressor", "XGBRegressor")


#: Metric by name, as (aggregate of actual and predicted, sign that makes larger better).
SEARCH_METRICS = {
    "mape": (mape, -1.0),
    "mse": (mse, -1.0),
    "rmse": (lambda actual, predicted: F.sqrt(mse(actual, predicted)), -1.0),
    "r2": (r2_score, 1.0),
}


class LabelEvaluator(Evaluator, HasLabelCol, HasPredictionCol):
    """One of ``SEARCH_METRICS``, signed so that larger is better: one aggregate.

    A label scaled by ``(y - center) / scale`` is brought back first: relative errors of values
    around zero would say nothing.
    """

    def __init__(
        self, label: str = LABEL, prediction: str = PREDICTION, center: float = 0.0, scale: float = 1.0, metric: str = "mape"
    ):
        super().__init__()
        if metric not in SEARCH_METRICS:
            raise ValueError(f"unknown metric {metric!r}; known: {sorted(SEARCH_METRICS)}")
        self._set(labelCol=label, predictionCol=prediction)
        self.center, self.scale, self.metric = center, scale, metric

    def _evaluate(self, dataset: DataFrame) -> float:
        actual, predicted = (
            col(c) * self.scale + self.center for c in (self.getLabelCol(), self.getPredictionCol())
        )
        measure, sign = SEARCH_METRICS[self.metric]
        value = dataset.agg(measure(actual, predicted)).head()[0]
        return float("-inf") if value is None else sign * value

    def isLargerBetter(self) -> bool:
        return True


@dataclass(frozen=True)
class Fitted:
    name: str
    params: Mapping[str, Any]
    model: Model
    performance: Mapping[str, float | None]


def fit_and_evaluate(
    train: DataFrame,
    valid: DataFrame,
    models: Mapping[str, Mapping[str, Any] | None],
    *,
    key: str | None = None,
    cv_folds: int | None = None,
    label: str = LABEL,
    label_scaler: Any | None = None,
    rows: int | None = None,
) -> dict[str, Fitted]:
    """Fit every configured model on ``train`` and measure it on ``valid``.

    Both frames hold the assembled features; persist them, as every optimiser step reads them. With
    ``cv_folds`` the cross-validated RMSE on the validation rows is added. With ``label_scaler``
    (an affine scaler fitted on the label) metrics are on the unscaled label.
    """
    if not models:
        raise ValueError("no training configuration given")
    rows = train.count() if rows is None else rows
    fitted = {}
    for name, params in models.items():
        estimator = build_regressor(name, params, rows=rows, label=label)
        model = estimator.fit(train)
        scored = model.transform(valid)
        if label_scaler is not None:
            source = label_scaler.getInputCols()[0]
            scored = label_scaler.inverse(scored, {label: source, PREDICTION: source})
        performance = regression_metrics(scored, label, PREDICTION).head().asDict()
        performance[CV_RMSE] = None
        if cv_folds and key:
            # every fold is fitted on this share of the validation rows
            seen = valid.count() * (cv_folds - 1) // cv_folds
            rmse = cross_validated_rmse(build_regressor(name, params, rows=seen, label=label), valid, key, cv_folds, label=label)
            performance[CV_RMSE] = rmse * _center_and_scale(label_scaler)[1]
        fitted[name] = Fitted(name, dict(params or {}), model, performance)
    return fitted


def _center_and_scale(label_scaler: Any | None) -> tuple[float, float]:
    if label_scaler is None:
        return 0.0, 1.0
    _, _, center, scale = label_scaler.parameters()[0]
    return center, scale


def _least_squares_candidate(estimator: Estimator) -> LinearCandidate | None:
    """What ``estimator`` is as a plain least-squares fit; None for any other model."""
    if not isinstance(estimator, LinearRegression) or estimator.getLoss() != "squaredError":
        return None
    if estimator.getRegParam() or estimator.isDefined("weightCol"):
        return None
    return LinearCandidate(estimator.getFitIntercept())


def _forest_candidate(estimator: Estimator, df: DataFrame) -> fold_forests.ForestCandidate | None:
    """What ``estimator`` is as a forest that :mod:`fold_forests` grows; None for any other model."""
    if not isinstance(estimator, RandomForestRegressor) or estimator.getFeatureSubsetStrategy() != "all":
        return None
    if estimator.isDefined("weightCol") and estimator.getWeightCol() or estimator.getSubsamplingRate() != 1.0:
        return None
    if estimator.getMinInfoGain() or estimator.getMinWeightFractionPerNode() or estimator.getImpurity() != "variance":
        return None
    attributes = df.schema[estimator.getFeaturesCol()].metadata.get("ml_attr", {}).get("attrs", {})
    if attributes.get("nominal"):  # split by subsets, not by thresholds
        return None
    return fold_forests.ForestCandidate(
        estimator.getNumTrees(), estimator.getMaxDepth(), estimator.getMinInstancesPerNode(), estimator.getMaxBins(),
        estimator.getSeed(), estimator.getBootstrap(),
    )


def _width(df: DataFrame, features: str) -> int:
    row = df.select(col(features)).head()
    return 0 if row is None else row[0].size


def _folded(df: DataFrame, key: str, folds: int, seed: int, estimators: Sequence[Estimator]) -> DataFrame:
    """The columns that the estimators read and the fold of each row, persisted."""
    read = [c for e in estimators for c in (e.getFeaturesCol(), e.getLabelCol())]
    read += [e.getWeightCol() for e in estimators if e.hasParam("weightCol") and e.isDefined("weightCol")]
    number = fold_number(col(key), folds, seed).alias("_fold")
    return persisted(df.select(*[col(c) for c in dict.fromkeys(read)], number))


def _scores_from_sums(
    candidates: Sequence[LinearCandidate], estimator: LinearRegression, evaluator: LabelEvaluator, folded: DataFrame, folds: int
) -> list[float]:
    measure, sign = SEARCH_METRICS[evaluator.metric]
    found = fold_scores(
        folded, "_fold", folds, candidates, estimator.getFeaturesCol(), estimator.getLabelCol(), measure, evaluator.center, evaluator.scale
    )
    folded.unpersist()
    return [_mean_score(scores, sign) for scores in found]


def _scores_from_cells(
    candidates: Sequence[fold_forests.ForestCandidate], estimator: RandomForestRegressor, evaluator: LabelEvaluator, df: DataFrame, key: str,
    folds: int, seed: int,
) -> list[float] | None:
    """None for an empty frame and for forests with too many cells."""
    measure, sign = SEARCH_METRICS[evaluator.metric]
    rows = fold_forests.numbered(df, key, fold_number(col(key), folds, seed), estimator.getFeaturesCol(), estimator.getLabelCol())
    rows = persisted(rows)
    try:
        first = rows.head()
        width = 0 if first is None else len(first["x"])
        if not width or width > fold_forests.MOST_WIDTH:
            return None
        found = fold_forests.fold_scores(rows, folds, candidates, width, measure, evaluator.center, evaluator.scale)
    finally:
        rows.unpersist()
    return None if found is None else [_mean_score(scores, sign) for scores in found]


def _mean_score(scores: Sequence[float | None], sign: float) -> float:
    return sum(float("-inf") if v is None else sign * v for v in scores) / len(scores)


def cross_validated_ridge(
    df: DataFrame,
    key: str,
    penalties: Sequence[float],
    folds: int = 5,
    *,
    features: str = FEATURES,
    label: str = LABEL,
    seed: int = SEED,
    metric: str = "rmse",
) -> list[tuple[float, float]]:
    """(penalty, mean score over the folds) of a ridge fit by each penalty; the folds are read once for all of them."""
    estimator = LinearRegression(featuresCol=features, labelCol=label)
    evaluator = LabelEvaluator(label=label, metric=metric)
    folded = _folded(df, key, folds, seed, [estimator])
    try:
        if _width(folded, features) > MOST_WIDTH:
            raise ValueError(f"more than {MOST_WIDTH} feature slots")
        candidates = [LinearCandidate(ridge=float(p)) for p in penalties]
        return list(zip(penalties, _scores_from_sums(candidates, estimator, evaluator, folded, folds)))
    finally:
        folded.unpersist()


def _fold_scores(
    estimators: Sequence[Estimator],
    evaluator: Evaluator,
    df: DataFrame,
    key: str,
    folds: int,
    seed: int,
    parallelism: int,
) -> list[float]:
    """Mean score over the folds per estimator, each fitted on the other folds.

    Least-squares fits come from sums that are added up once per fold (:mod:`fold_models`), forests of few features
    from sums by cell (:mod:`fold_forests`). Of other models, folds are predicates on one persisted frame; ``parallelism``
    fits run at a time. No model is refitted on all rows, as only the scores are wanted.
    """
    forests = [_forest_candidate(e, df) for e in estimators]
    if None not in forests and isinstance(evaluator, LabelEvaluator):
        scores = _scores_from_cells(forests, estimators[0], evaluator, df, key, folds, seed)
        if scores is not None:
            return scores
    folded = _folded(df, key, folds, seed, estimators)
    candidates = [_least_squares_candidate(e) for e in estimators]
    if None not in candidates and isinstance(evaluator, LabelEvaluator):
        try:
            if _width(folded, estimators[0].getFeaturesCol()) <= MOST_WIDTH:
                return _scores_from_sums(candidates, estimators[0], evaluator, folded, folds)
        except BaseException:
            folded.unpersist()
            raise

    def score(task: tuple[Estimator, int]) -> float:
        estimator, fold = task
        model = estimator.fit(folded.where(col("_fold") != fold))
        return float(evaluator.evaluate(model.transform(folded.where(col("_fold") == fold))))

    tasks = [(e, k) for e in estimators for k in range(folds)]
    try:
        with ThreadPool(min(parallelism, len(tasks))) as pool:
            scores = pool.map(inheritable_thread_target(df.sparkSession)(score), tasks)
    finally:
        folded.unpersist()
    return [sum(scores[i * folds : (i + 1) * folds]) / folds for i in range(len(estimators))]


def cross_validated_rmse(
    estimator: Estimator,
    df: DataFrame,
    key: str,
    folds: int = 5,
    *,
    label: str = LABEL,
    seed: int = SEED,
    parallelism: int = 2,
) -> float:
    """Mean over the folds of the RMSE of a model fitted on the other folds."""
    evaluator = LabelEvaluator(label=label, metric="rmse")
    return -_fold_scores([estimator], evaluator, df, key, folds, seed, parallelism)[0]


@dataclass(frozen=True)
class Search:
    best_params: dict[str, Any]
    best_score: float
    method: str
    scores: list[tuple[dict[str, Any], float]] = field(default_factory=list)


def parameter_candidates(
    grid: Mapping[str, Sequence[Any]], method: str = "grid", draws: int = 10, seed: int = SEED
) -> list[dict[str, Any]]:
    """All combinations of ``grid``, or ``draws`` different ones picked with a seed."""
    combinations = [dict(zip(grid, values)) for values in itertools.product(*grid.values())]
    if method == "grid":
        return combinations
    if method == "random":
        return random.Random(seed).sample(combinations, min(draws, len(combinations)))
    raise ValueError(f"unknown search method {method!r}: use 'grid' or 'random'")


def search_parameters(
    name: str,
    grid: Mapping[str, Sequence[Any]],
    df: DataFrame,
    key: str,
    *,
    base: Mapping[str, Any] | None = None,
    method: str = "grid",
    draws: int = 10,
    folds: int = 4,
    seed: int = SEED,
    parallelism: int = 2,
    label: str = LABEL,
    label_scaler: Any | None = None,
    metric: str = "mape",
) -> Search:
    """Cross-validated search for the parameters with the best ``metric`` on the unscaled label.

    Up to ``parallelism`` fits run at a time on the same persisted folds. Each fit is told the rows that it sees.
    """
    rows = df.count() * (folds - 1) // folds
    candidates = parameter_candidates(grid, method, draws, seed)
    estimators = [build_regressor(name, {**(base or {}), **c}, rows=rows, label=label) for c in candidates]
    center, scale = _center_and_scale(label_scaler)
    evaluator = LabelEvaluator(label=label, center=center, scale=scale, metric=metric)
    scores = _fold_scores(estimators, evaluator, df, key, folds, seed, parallelism)
    ranked = list(zip(candidates, scores))
    best_params, best_score = max(ranked, key=lambda pair: pair[1])
    return Search(best_params, best_score, method, ranked)


def tune_models(
    grids: Mapping[str, Mapping[str, Sequence[Any]]],
    search_on: DataFrame,
    train: DataFrame,
    valid: DataFrame,
    key: str,
    *,
    method: str = "random",
    cv_folds: int | None = 5,
    label: str = LABEL,
    label_scaler: Any | None = None,
    base: Mapping[str, Mapping[str, Any]] | None = None,
    **options,
) -> tuple[dict[str, Search], dict[str, Fitted]]:
    """Search every model's grid, refit the winners on ``train`` and measure them on ``valid``."""
    base = base or {}
    searches = {
        name: search_parameters(
            name, grid, search_on, key,
            base=base.get(name), method=method, label=label, label_scaler=label_scaler, **options,
        )
        for name, grid in grids.items()
    }
    winners = {name: {**base.get(name, {}), **s.best_params} for name, s in searches.items()}
    fitted = fit_and_evaluate(train, valid, winners, key=key, cv_folds=cv_folds, label=label, label_scaler=label_scaler)
    return searches, fitted
