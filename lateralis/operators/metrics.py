"""Regression metrics, residual frames, summary statistics and the model leaderboard."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lateralis.functions.columns import col, ratio
from lateralis.operators.quantiles import SORTED_ROWS, group_quantiles, largest_group, quantiles, sorted_quantiles
from lateralis.session import persisted

# Metric names of the leaderboard.
R2 = "r2"
MAPE = "mean_absolute_percentage_error (%)"
RMSE = "root_mean_squared_error (USDMM)"
P90_P10 = "residual P90/P10"
RESIDUAL_STD = "residual std (USDMM)"
RESIDUAL_IQR = "residuals IQR (USDMM)"
CV_RMSE = "average cross-validated rmse (USDMM)"
METRICS = (R2, MAPE, RMSE, P90_P10, RESIDUAL_STD, RESIDUAL_IQR, CV_RMSE)

_TINY = 2.220446049250313e-16  # smallest denominator of a percentage error: the double epsilon


def r2_score(actual: Column, predicted: Column) -> Column:
    """1 - SSE/SST as one aggregate; a constant actual scores 1 when predicted exactly, else 0."""
    residual = F.sum((actual - predicted) * (actual - predicted))
    total = F.var_pop(actual) * F.count(actual)
    constant = F.when(residual == 0, 1.0).otherwise(0.0)
    return F.when(total == 0, constant).otherwise(1 - ratio(residual, total))


def mape(actual: Column, predicted: Column) -> Column:
    """Mean absolute percentage error as a fraction."""
    return F.avg(F.abs(actual - predicted) / F.greatest(F.abs(actual), F.lit(_TINY)))


def mse(actual: Column, predicted: Column) -> Column:
    return F.avg((actual - predicted) * (actual - predicted))


def regression_metrics(
    df: DataFrame, actual: str, predicted: str, by: Sequence[str] = (), **options
) -> DataFrame:
    """R2, MAPE, RMSE and residual spread, each at 5 decimals, overall or per group.

    RMSE is the root of the MSE at 5 decimals. Rows with a NULL or NaN on either side are left out. Small groups take one aggregate; where a group is
    large its residual quantiles are found by narrowing and joined to the sums.
    """
    probabilities = [0.1, 0.25, 0.75, 0.9]
    pairs = df.select(
        *[col(c) for c in by], col(actual).cast("double").alias("_y"), col(predicted).cast("double").alias("_p")
    ).where(F.col("_y").isNotNull() & F.col("_p").isNotNull() & ~F.isnan("_y") & ~F.isnan("_p"))
    pairs = pairs.withColumn("_r", F.col("_y") - F.col("_p"))
    y, p, r = F.col("_y"), F.col("_p"), F.col("_r")
    sums = [
        F.round(r2_score(y, p), 5).alias(R2),
        F.round(mape(y, p), 5).alias(MAPE),
        F.sqrt(F.round(mse(y, p), 5)).alias(RMSE),
        F.round(F.stddev_pop(r), 5).alias(RESIDUAL_STD),
    ]
    keys = [col(c) for c in by]
    most = largest_group(pairs, by)
    if most <= options.get("builtin_rows", SORTED_ROWS):
        rows = pairs.groupBy(*keys).agg(*sums, sorted_quantiles(r, probabilities).alias("_q"))
    else:
        totals = pairs.groupBy(*keys).agg(*sums)
        if by:
            spread = group_quantiles(pairs, {"_r": probabilities}, by, **{"rows_at_most": most, **options}).withColumnRenamed("_r", "_q")
            same = reduce(and_, [F.col(f"s.`{c}`").eqNullSafe(F.col(f"q.`{c}`")) for c in by])
            rows = totals.alias("s").join(spread.alias("q"), same).select("s.*", "q._q")
        else:
            residuals = persisted(pairs.select("_r"))
            try:  # one copy for all aggregates: no prediction is made again for each bound that it is compared with
                found = quantiles(residuals, {"_r": probabilities}, **{"rows_at_most": most, **options})["_r"]
            finally:
                residuals.unpersist()
            rows = totals.withColumn("_q", F.array(*[F.lit(v) for v in found]))
    q10, q25, q75, q90 = (F.col("_q")[i] for i in range(4))
    return rows.select(
        *keys,
        col(R2), col(MAPE), col(RMSE),
        (-F.round(ratio(q90, q10), 5)).alias(P90_P10),
        col(RESIDUAL_STD),
        F.round(q75 - q25, 5).alias(RESIDUAL_IQR),
    )


def validation_metrics(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """R2, MSE, RMSE and MAPE in percent of scored rows, overall or per group."""
    y, p = col(actual), col(predicted)
    pairs = df.where(y.isNotNull() & p.isNotNull())
    return pairs.groupBy(*[col(c) for c in by]).agg(
        r2_score(y, p).alias("r2"),
        mse(y, p).alias("mse"),
        F.sqrt(mse(y, p)).alias("rmse"),
        F.avg(F.abs(p - y) * 100 / F.when(y != 0, y)).alias("mape"),
    )


def residual_frame(
    df: DataFrame, actual: str, predictions: Mapping[str, str], features: Sequence[str], split: str
) -> DataFrame:
    """``y_<split>``, and ``y_pred_<model>`` and ``residual_<model>`` per model, beside the features.

    ``predictions`` maps a model name to the column of its predictions.
    """
    y = col(actual)
    predicted = [col(c).alias(f"y_pred_{m}") for m, c in predictions.items()]
    residuals = [(y - col(c)).alias(f"residual_{m}") for m, c in predictions.items()]
    return df.select(*predicted, y.alias(f"y_{split}"), *residuals, *[col(c) for c in features])


def describe(df: DataFrame, columns: Sequence[str], **options) -> DataFrame:
    """One row per column: count, mean, sample std, min, quartiles and max, all exact; NaN is missing like NULL."""
    df = df.select(*[col(c) if not isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)) else F.nanvl(col(c), F.lit(None)).alias(c) for c in columns])
    probabilities = [0.25, 0.5, 0.75]
    moments = [
        f(col(c)).alias(f"{n}{i}")
        for i, c in enumerate(columns)
        for n, f in (("count", F.count), ("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))
    ]
    rows = largest_group(df)
    if rows <= options.get("builtin_rows", SORTED_ROWS):
        row = df.agg(*moments, *[sorted_quantiles(col(c), probabilities).alias(f"q{i}") for i, c in enumerate(columns)])
    else:
        found = group_quantiles(df, {c: probabilities for c in columns}, **{"rows_at_most": rows, **options}).head()
        row = df.agg(*moments).withColumns(
            {f"q{i}": F.array(*[F.lit(v) for v in found[c]]) for i, c in enumerate(columns) if found[c]}
        )
    summaries = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"count{i}").alias("count"),
            F.col(f"mean{i}").cast("double").alias("mean"),
            F.col(f"std{i}").alias("std"),
            F.col(f"min{i}").cast("double").alias("min"),
            *[(F.col(f"q{i}")[j] if f"q{i}" in row.columns else F.lit(None).cast("double")).alias(f"p{round(p * 100)}") for j, p in enumerate(probabilities)],
            F.col(f"max{i}").cast("double").alias("max"),
        )
        for i, c in enumerate(columns)
    ]
    return row.select(F.inline(F.array(*summaries)))


def leaderboard(spark: SparkSession, performances: Mapping[str, Mapping[str, float | None]]) -> DataFrame:
    """One row per model, best MAPE first."""
    schema = "models string, " + ", ".join(f"`{m}` double" for m in METRICS)
    rows = [(name, *[performance.get(m) for m in METRICS]) for name, performance in performances.items()]
    return spark.createDataFrame(rows, schema).orderBy(col(MAPE), "models")


def best_models(board: DataFrame, n: int) -> list[str]:
    return [r["models"] for r in board.orderBy(col(MAPE), "models").limit(n).collect()]
