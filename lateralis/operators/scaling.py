"""Scalers fitted with exact aggregates and applied as plain column arithmetic.

MLlib's own scalers differ where it matters here: its robust scaler uses approximate quantiles and
maps a constant column to 0, its standard scaler divides by the sample deviation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateralis.functions.columns import col
from lateralis.operators.quantiles import quantiles
from lateralis.session import persisted


class AffineScalerModel(Model, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """``(x - center) / scale`` per column."""

    centers = Param(Params._dummy(), "centers", "value subtracted, per input column", TypeConverters.toListFloat)
    scales = Param(Params._dummy(), "scales", "divisor, per input column", TypeConverters.toListFloat)

    @classmethod
    def of(
        cls, inputs: Sequence[str], outputs: Sequence[str], centers: Sequence[float], scales: Sequence[float]
    ) -> AffineScalerModel:
        model = cls()
        model._set(inputCols=list(inputs), outputCols=list(outputs), centers=list(centers), scales=list(scales))
        return model

    def parameters(self) -> list[tuple[str, str, float, float]]:
        names = zip(self.getInputCols(), self.getOutputCols())
        numbers = zip(self.getOrDefault(self.centers), self.getOrDefault(self.scales))
        return [(i, o, c, s) for (i, o), (c, s) in zip(names, numbers)]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumns({o: (col(i) - F.lit(c)) / F.lit(s) for i, o, c, s in self.parameters()})

    def inverse(self, dataset: DataFrame, columns: dict[str, str] | None = None) -> DataFrame:
        """Undo the scaling of the output columns in place, or of ``{column: input it was scaled like}``."""
        known = {i: (c, s) for i, _, c, s in self.parameters()}
        targets = columns or {o: i for i, o, _, _ in self.parameters()}
        return dataset.withColumns({t: col(t) * F.lit(known[i][1]) + F.lit(known[i][0]) for t, i in targets.items()})


class _ScalerEstimator(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCols: list[str] | None = None):
        super().__init__()
        given = {k: v for k, v in self._input_kwargs.items() if v is not None}
        self._set(**given)

    def _statistics(self, dataset: DataFrame, columns: list[str]) -> list[tuple[float, float]]:
        raise NotImplementedError

    def _fit(self, dataset: DataFrame) -> AffineScalerModel:
        columns = self.getInputCols()
        pairs = self._statistics(dataset, columns)
        if any(center is None for center, _ in pairs):
            raise ValueError("cannot fit a scaler on a column without values")
        return AffineScalerModel.of(
            columns, self.getOutputCols(), [c for c, _ in pairs], [s if s else 1.0 for _, s in pairs]
        )


class RobustColumnScaler(_ScalerEstimator):
    """Median and interquartile range, exact; a zero range scales by 1."""

    def _statistics(self, dataset, columns):
        rows = persisted(dataset.select(*[col(c) for c in dict.fromkeys(columns)]))
        try:  # the aggregates of the quantiles read these few columns once
            found = quantiles(rows, {c: [0.25, 0.5, 0.75] for c in columns})
        finally:
            rows.unpersist()
        return [(q[1], None if q[1] is None else q[2] - q[0]) for q in (found[c] for c in columns)]


class StandardColumnScaler(_ScalerEstimator):
    """Mean and population standard deviation; a zero deviation scales by 1."""

    def _statistics(self, dataset, columns):
        row = dataset.agg(
            *[F.avg(col(c)).alias(f"mean{i}") for i, c in enumerate(columns)],
            *[F.stddev_pop(col(c)).alias(f"std{i}") for i, c in enumerate(columns)],
        ).head()
        return [(row[f"mean{i}"], row[f"std{i}"]) for i in range(len(columns))]
