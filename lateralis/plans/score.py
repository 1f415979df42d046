"""Score, cost and validate whole tables of wells in one plan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lateralis.functions.columns import (
    COMPLETIONS_SHARE,
    DRILLING_SHARE,
    FACILITIES_SHARE,
    col,
    composite_key,
    cost_breakdown,
    key_suffix,
    linear_score,
    total_from_unit_cost,
    unit_cost,
)
from lateralis.operators.categories import onehot_names, recode_to_list, unknown_fallback
from lateralis.operators.errorbins import expected_error
from lateralis.operators.metrics import validation_metrics
from lateralis.operators.models import PREDICTION
from lateralis.operators.skew import skew_join
from lateralis.operators.spatial import spatial_join, well_paths
from lateralis.plans.stages import numeric_inputs, scaler_of
from lateralis.plans.train import FLUID, KEY, LATERAL, OPERATOR, PROPPANT, RESERVOIR, Trained
from lateralis.session import checkpointed

# Columns of the scored table, and the unit cost above which a well is not validated.
SCORED_AREA = "Type Curve Area"
EXPECTED = "expected_cost_variance_%"
UNIT_PREDICTION = "Cost_USDPerFT"
ACTUAL_UNIT = "ActualcostPerFT"
VALIDATION_CEILING = 3000.0


@dataclass(frozen=True)
class Package:
    """What scoring needs of a trained basin."""

    pipeline: PipelineModel
    categories: Mapping[str, Sequence[str]]
    operators: Sequence[str] | None = None
    error_table: DataFrame | None = None
    steps: tuple[float, float, float] | None = None
    composites: Sequence[str] | None = None
    metadata: Mapping[str, Any] = field(default_factory=dict)

    @classmethod
    def of(cls, trained: Trained) -> Package:
        return cls(
            trained.pipeline,
            trained.categories,
            trained.operators,
            trained.error_table,
            trained.bins.steps if trained.bins else None,
            trained.composites,
            {**trained.metadata, "model": trained.model_name, "parameters": dict(trained.fitted[trained.model_name].params)},
        )


def locate_wells(
    wells: DataFrame, areas: DataFrame, key: str = KEY, area: str = "Area", **options
) -> tuple[DataFrame, DataFrame]:
    """(wells with their area, area/well pairs). A well crossing several areas appears once per area.

    The pairs are two narrow columns and are written once: the join's look for hot keys, the join
    itself and any later report read them without repeating the spatial join.
    """
    pairs = checkpointed(spatial_join(areas, well_paths(wells, key), [area], [key], **options))
    return skew_join(wells, pairs, key), pairs


def recode_for_scoring(
    df: DataFrame, package: Package, operator: str = OPERATOR, reservoir: str = RESERVOIR
) -> DataFrame:
    """Operators outside the training list become ``miscellaneous``, then the composite key is formed."""
    if package.operators is None:
        return df
    listed = recode_to_list(col(operator), package.operators)
    return df.withColumn(operator, composite_key(col(reservoir), listed))


def predict_costs(
    df: DataFrame,
    package: Package,
    *,
    operator: str = OPERATOR,
    lateral: str = LATERAL,
    bin_columns: tuple[str, str, str] = (LATERAL, PROPPANT, FLUID),
    drilling: float = DRILLING_SHARE,
    facilities: float = FACILITIES_SHARE,
    completions: float = COMPLETIONS_SHARE,
) -> DataFrame:
    """Unit and total cost, the cost breakdown and the expected error of every row.

    A composite operator not seen in training falls back to its reservoir's ``miscellaneous``; a row
    whose categories are still unknown, or whose numeric inputs have no value after their transform,
    gets a NULL prediction and says so in ``score_note``.
    """
    known = package.categories
    if operator in known:
        df = df.withColumn(operator, unknown_fallback(col(operator), known[operator]))
    unknown = [F.when(~F.coalesce(col(c).isin(*values), F.lit(False)), F.lit(c)) for c, values in known.items()]
    df = df.withColumn("_unknown", F.concat_ws(", ", *unknown) if unknown else F.lit(""))
    # Rows that cannot be scored carry a trained value through the encoders and lose their prediction after.
    held = {f"_held_{c}": col(c) for c in known}
    stand_ins = {c: F.when(col(c).isin(*values), col(c)).otherwise(F.lit(values[0])) for c, values in known.items()}
    scored = package.pipeline.transform(df.withColumns(held).withColumns(stand_ins) if known else df)
    present = reduce(and_, [col(c).isNotNull() for c in numeric_inputs(package.pipeline)], F.lit(True))
    note = F.when(F.col("_unknown") != "", F.concat(F.lit("unknown value in "), F.col("_unknown"))).when(
        ~present, F.lit("no value for a numeric input")
    )
    scored = scored.select(
        *[col(f"_held_{c}").alias(c) if c in known else col(c) for c in df.columns if c != "_unknown"],
        note.alias("score_note"),
        F.when(note.isNull(), col(PREDICTION)).alias("_unit"),
    )
    parts = cost_breakdown(
        F.col("_unit") * col(lateral) / F.lit(1e6), drilling=drilling, facilities=facilities, completions=completions
    )
    parts = {name: F.round(value, 2) for name, value in parts.items()}
    parts["TotalCost_USDMM"] = total_from_unit_cost(F.col("_unit"), col(lateral))
    scored = scored.withColumns({UNIT_PREDICTION: F.round(F.col("_unit"), 2), **parts}).drop("_unit")
    if package.error_table is None or package.steps is None:
        return scored.withColumn(EXPECTED, F.lit(None).cast("double"))
    return expected_error(scored, package.error_table, package.steps, bin_columns, EXPECTED)


def score_wells(wells: DataFrame, package: Package, area: str = "Area", **options) -> DataFrame:
    """The scored table: complete wells with predicted, expected-error and actual cost columns."""
    complete = recode_for_scoring(wells.dropna("any"), package)
    scored = predict_costs(complete, package, **options)
    renamed = scored.withColumnRenamed(area, SCORED_AREA)
    return renamed.select(
        "API10", col(SCORED_AREA), PROPPANT, FLUID, "LatitudeMP", "LongitudeMP", LATERAL, OPERATOR, RESERVOIR,
        "TotalCost_USDMM", UNIT_PREDICTION, "Drilling_USDMM", "Facilities_USDMM", "Completions_USDMM",
        col(EXPECTED),
        col("TotalWellCost_USDMM").alias("Actualcost_USDMM"),
        unit_cost(col("TotalWellCost_USDMM"), col(LATERAL)).alias(ACTUAL_UNIT),
        "score_note",
    )


def validation_rows(scored: DataFrame, ceiling: float = VALIDATION_CEILING) -> DataFrame:
    """Scored wells with a plausible actual unit cost and the plain operator name."""
    return scored.where(col(ACTUAL_UNIT) < F.lit(ceiling)).withColumn(OPERATOR, key_suffix(col(OPERATOR)))


def validate(scored: DataFrame, by: Sequence[str] = (), ceiling: float = VALIDATION_CEILING) -> DataFrame:
    return validation_metrics(validation_rows(scored, ceiling), ACTUAL_UNIT, UNIT_PREDICTION, by)


def score_from_coefficients(
    pipeline: PipelineModel, features: Sequence[str], categories: Mapping[str, Sequence[str]]
) -> Column:
    """The linear model of a package as one column expression over the (transformed) input columns.

    Needs no model at run time: scaling, coefficients and dummies become literals of the plan.
    """
    linear = next(s for s in pipeline.stages if hasattr(s, "coefficients"))
    weights = list(linear.coefficients.toArray())
    scaler = scaler_of(pipeline)
    scales = {i: (c, s) for i, _, c, s in scaler.parameters()} if scaler is not None else {}
    numeric = [(col(f), *scales.get(f, (0.0, 1.0)), w) for f, w in zip(features, weights)]
    dummies, position = [], len(features)
    for column, values in categories.items():
        for offset, name in enumerate(onehot_names(column, values)):
            dummies.append((col(column), name[len(column) + 1:], weights[position + offset]))
        position += len(values) - 1
    return linear_score(linear.intercept, numeric, dummies)
