"""The preprocessing and prediction stages of a packaged model."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateralis.config import RunConfig
from lateralis.functions.columns import col
from lateralis.functions.transforms import transform_column
from lateralis.operators.categories import encoded_columns, fit_encoders, onehot_column, onehot_names, trained_values
from lateralis.operators.models import FEATURES, LABEL, PREDICTION
from lateralis.operators.scaling import AffineScalerModel, RobustColumnScaler, StandardColumnScaler


SCALERS = {"robust": RobustColumnScaler, "standard": StandardColumnScaler}


def transformed_name(column: str) -> str:
    return f"{column}__transformed"


def scaled_name(column: str) -> str:
    return f"{column}__scaled"


class FeatureTransforms(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Configured transforms into new columns, so that the original values stay at hand for scoring."""

    spec = Param(Params._dummy(), "spec", "transforms by column, as JSON", TypeConverters.toString)

    @classmethod
    def of(cls, spec: Mapping[str, Any]) -> FeatureTransforms:
        stage = cls()
        stage._set(spec=json.dumps(dict(spec)))
        return stage

    def _transform(self, dataset: DataFrame) -> DataFrame:
        current: dict[str, str] = {}
        for column, rule in json.loads(self.getOrDefault(self.spec)).items():
            if isinstance(rule, dict):
                name, others = next(iter(rule.items()))
                rule = {name: [current.get(others[0], others[0])]}
            dataset = dataset.withColumn(transformed_name(column), transform_column(col(column), rule))
            current[column] = transformed_name(column)
        return dataset


class TargetInverse(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Brings a prediction back to the scale of the raw target: unscale, then undo its transform."""

    rule = Param(Params._dummy(), "rule", "target transform, as JSON", TypeConverters.toString)
    center = Param(Params._dummy(), "center", "center of the target scaler", TypeConverters.toFloat)
    scale = Param(Params._dummy(), "scale", "scale of the target scaler", TypeConverters.toFloat)

    @classmethod
    def of(cls, rule: Any | None, center: float = 0.0, scale: float = 1.0) -> TargetInverse:
        stage = cls()
        stage._set(rule=json.dumps(rule), center=center, scale=scale)
        return stage

    def _transform(self, dataset: DataFrame) -> DataFrame:
        center, scale = self.getOrDefault(self.center), self.getOrDefault(self.scale)
        value = col(PREDICTION)
        if (center, scale) != (0.0, 1.0):
            value = value * F.lit(scale) + F.lit(center)
        rule = json.loads(self.getOrDefault(self.rule))
        if rule is not None:
            value = transform_column(value, rule, inverse=True)
        return dataset.withColumn(PREDICTION, value)


def feature_inputs(config: RunConfig) -> list[str]:
    """The numeric input columns as they enter the scaler."""
    transformed = config.feature_transforms
    return [transformed_name(c) if c in transformed else c for c in config.features]


def fit_preprocessing(train: DataFrame, everything: DataFrame, config: RunConfig) -> PipelineModel:
    """Transforms, scaler, encoders and assembler.

    The scaler sees the training rows; the encoders see all rows, so that no split meets a category
    it has no slot for. Only numeric columns are scaled.
    """
    stages: list[Transformer] = []
    if config.feature_transforms:
        stages.append(FeatureTransforms.of(config.feature_transforms))
    numeric = feature_inputs(config)
    if config.scale_x:
        if config.scaler not in SCALERS:
            raise ValueError(f"unknown scaler {config.scaler!r}; known: {sorted(SCALERS)}")
        scaler = SCALERS[config.scaler](inputCols=numeric, outputCols=[scaled_name(c) for c in numeric])
        stages.append(scaler.fit(PipelineModel(list(stages)).transform(train)))
        numeric = [scaled_name(c) for c in numeric]
    encoders = fit_encoders(everything, config.categories)
    stages += encoders
    stages.append(VectorAssembler(inputCols=[*numeric, *encoded_columns(encoders)], outputCol=FEATURES, handleInvalid="keep"))
    return PipelineModel(stages)


def fit_target_scaler(train: DataFrame) -> AffineScalerModel:
    """Standard scaler of the label column, applied in place."""
    return StandardColumnScaler(inputCols=[LABEL], outputCols=[LABEL]).fit(train)


def slot_names(preprocessing: PipelineModel, features: Sequence[str], categories: Sequence[str]) -> list[str]:
    """Name of every slot of the feature vector."""
    values = trained_values(preprocessing.stages)
    return [*features, *[n for c in categories for n in onehot_names(c, values[c])]]


def package(
    preprocessing: PipelineModel, regressor: Transformer, config: RunConfig, target_scaler: AffineScalerModel | None
) -> PipelineModel:
    """One model from raw columns to a prediction on the raw target scale."""
    stages = [*preprocessing.stages, regressor]
    if target_scaler is not None:
        _, _, center, scale = target_scaler.parameters()[0]
        stages.append(TargetInverse.of(config.target_transform, center, scale))
    elif config.target_transform is not None:
        stages.append(TargetInverse.of(config.target_transform))
    return PipelineModel(stages)


def numeric_inputs(model: PipelineModel) -> list[str]:
    """The numeric columns the assembler of ``model`` reads."""
    assembler = next(s for s in model.stages if isinstance(s, VectorAssembler))
    return [c for c in assembler.getInputCols() if not c.endswith(onehot_column(""))]


def scaler_of(model: PipelineModel) -> AffineScalerModel | None:
    return next((s for s in model.stages if isinstance(s, AffineScalerModel)), None)
