"""Linear models of many groups (basins) at once: one aggregate holds the normal equations of every group.

The sums of a group (weights, features, products of features, features with the label) are combined map-side, so a
group of any size reaches its row as one partial row a task, and the groups are solved in parallel, each from
(features + 1)^2 numbers. Features are centered by their group's means first, which keeps the sums well conditioned.

The robust fit minimises the Huber loss with its scale, ``sum(s + H((y - a - b x) / s) s) + alpha * b^2`` jointly
over a, b and s. In each round all groups advance together: rows weigh ``min(1, epsilon s / |r|)`` in the normal
equations of the round, and the scale follows from the squares of the inner residuals and the number of the outer
ones. After two such rounds a group leaps along the line that they show (squared extrapolation, which needs no
further sums), and goes on from there. Groups that have settled leave the rounds. The rows are read once and
persisted; a round is one aggregate.

Rows with a missing group, feature or label take no part. A group with fewer rows than coefficients gets the solution
of least norm; features that do not vary get the weight zero.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lateralis.functions.columns import col
from lateralis.session import broadcast_if_small, checkpointed

EPSILON, ALPHA, TOLERANCE, MOST_ROUNDS = 1.35, 1e-4, 1e-6, 200
LONGEST_LEAP = 64.0


def _rows(df: DataFrame, by: str, features: Sequence[str], label: str) -> DataFrame:
    """(g, x0, x1, ..., y) without missing values."""
    x = [F.nanvl(col(c).cast("double"), F.lit(None)).alias(f"x{i}") for i, c in enumerate(features)]
    return df.select(col(by).alias("g"), *x, F.nanvl(col(label).cast("double"), F.lit(None)).alias("y")).dropna("any")


def _products(values: Sequence[Column], y: Column, weight: Column) -> list[Column]:
    """The sums of weighted normal equations: 1, x, y, the upper triangle of x x', x y."""
    p = len(values)
    sums = [weight, *(weight * x for x in values), weight * y]
    sums += [weight * values[i] * values[j] for i in range(p) for j in range(i, p)]
    sums += [weight * x * y for x in values]
    return [F.sum(s) for s in sums]


def _solve(sums: np.ndarray, p: int, ridge: float = 0.0) -> tuple[float, np.ndarray]:
    """(intercept, weights) of the normal equations whose sums are given as :func:`_products` lists them."""
    total, x, y = sums[0], sums[1:p + 1], sums[p + 1]
    xx = np.zeros((p, p))
    xx[np.triu_indices(p)] = sums[p + 2:p + 2 + p * (p + 1) // 2]
    xx = xx + np.triu(xx, 1).T
    xy = sums[p + 2 + p * (p + 1) // 2:]
    if not total:
        return 0.0, np.zeros(p)
    inner = xx - np.outer(x, x) / total + ridge * np.eye(p)
    size = np.sqrt(np.maximum(np.diag(inner), 0))  # columns of one size: the units of the features differ by decades
    size[size <= 1e-9 * np.sqrt(np.maximum(np.diag(xx), 0))] = 0
    unit = np.where(size > 0, size, 1.0)
    scaled = np.where(np.outer(size, size) > 0, inner / np.outer(unit, unit), 0.0)
    weights = np.linalg.lstsq(scaled, np.where(size > 0, (xy - x * y / total) / unit, 0.0), rcond=1e-12)[0] / unit
    return float((y - x @ weights) / total), weights


def _fit_schema(group: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("g", group), T.StructField("rows", T.LongType()), T.StructField("intercept", T.DoubleType()),
        T.StructField("coefficients", T.ArrayType(T.DoubleType())), T.StructField("scale", T.DoubleType()),
        T.StructField("rounds", T.IntegerType()), T.StructField("settled", T.BooleanType()),
        T.StructField("center", T.ArrayType(T.DoubleType())), T.StructField("spread", T.ArrayType(T.DoubleType())),
        T.StructField("before", T.ArrayType(T.DoubleType())),
    ])


def _least_squares(rows: DataFrame, p: int, ridge: float) -> DataFrame:
    """A row per group, with the means and deviations of the features beside the fit."""
    xs = [F.col(f"x{i}") for i in range(p)]
    means = checkpointed(rows.groupBy("g").agg(
        F.array(*(F.avg(x) for x in xs)).alias("center"), F.array(*(F.stddev_pop(x) for x in xs)).alias("spread"), F.avg("y").alias("middle"),
    ))
    joined = rows.join(broadcast_if_small(means), "g")
    centered = [x - F.get("center", F.lit(i)) for i, x in enumerate(xs)]
    y = F.col("y") - F.col("middle")
    sums = joined.groupBy("g").agg(
        F.count(F.lit(1)).alias("rows"), F.array(*_products(centered, y, F.lit(1.0))).alias("sums"), F.sum(y * y).alias("yy"),
        F.first("center").alias("center"), F.first("spread").alias("spread"), F.first("middle").alias("middle"),
    )

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                sums = np.asarray(r.sums, float)
                inner, weights = _solve(sums, p, ridge)
                left = r.yy - inner * sums[p + 1] - weights @ sums[len(sums) - p:]  # of the squares, by the normal equations
                out.append((
                    r.g, r.rows, inner + r.middle - float(weights @ np.asarray(r.center)), weights.tolist(),
                    float(np.sqrt(max(left, 0.0) / r.rows)), 0, False, list(r.center), list(r.spread), [],
                ))
            yield pd.DataFrame(out, columns=[f.name for f in schema])

    schema = _fit_schema(rows.schema["g"].dataType)
    return checkpointed(sums.mapInPandas(solve, schema))


def _leap(base: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Where the steps base -> first -> second lead, if each is the same part of the one before."""
    step, bend = first - base, second - 2 * first + base
    size = np.linalg.norm(bend)
    length = min(max(np.linalg.norm(step) / size, 1.0), LONGEST_LEAP) if size else 1.0
    found = base + 2 * length * step + length**2 * bend
    return found if np.isfinite(found).all() and abs(found[-1] - second[-1]) < 3 else second


def _named(fits: DataFrame, by: str) -> DataFrame:
    return fits.select(F.col("g").alias(by), "rows", "intercept", "coefficients", "scale", "rounds")


def grouped_least_squares(df: DataFrame, by: str, features: Sequence[str], label: str, ridge: float = 0.0) -> DataFrame:
    """by, rows, intercept, coefficients, scale (root mean squared residual): one least-squares fit per group.

    ``ridge`` weighs the squared coefficients against the summed squares, the intercept is free.
    """
    return _named(_least_squares(_rows(df, by, features, label), len(features), ridge), by).drop("rounds")


def grouped_huber(
    df: DataFrame, by: str, features: Sequence[str], label: str, *, epsilon: float = EPSILON, alpha: float = ALPHA,
    tolerance: float = TOLERANCE, most_rounds: int = MOST_ROUNDS, storage: StorageLevel = StorageLevel.MEMORY_AND_DISK,
) -> DataFrame:
    """by, rows, intercept, coefficients, scale, rounds: one robust fit per group, all groups advancing together.

    A group has settled when a round moves no coefficient by more than ``tolerance`` scales a deviation of its feature.
    """
    p = len(features)
    rows = _rows(df, by, features, label).persist(storage)
    schema = _fit_schema(rows.schema["g"].dataType)
    names = [f.name for f in schema]

    def advance(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                inner, weights = _solve(np.asarray(r.sums, float), p, alpha * r.scale)
                center, spread, old = (np.asarray(v, float) for v in (r.center, r.spread, r.coefficients))
                free = r.rows - epsilon**2 * r.outer
                scale = float(np.sqrt(r.squares / free)) if free > 0 else r.scale
                here = np.array([(r.intercept + old @ center) / r.scale, *(old * spread / r.scale), 0.0])
                there = np.array([inner / r.scale, *(weights * spread / r.scale), np.log(scale / r.scale) if scale else -np.inf])
                done = scale == 0 or np.abs(there - here).max() <= tolerance
                before: list[float] = []
                if not done and len(r.before):
                    base = np.array(r.before, float)  # the place before last, in units of the scale it had
                    base[:-1], base[-1] = base[:-1] * np.exp(base[-1]) / r.scale, base[-1] - np.log(r.scale)
                    leap = _leap(base, here, there)
                    inner, weights = leap[0] * r.scale, np.where(spread > 0, leap[1:-1] * r.scale / np.where(spread > 0, spread, 1), weights)
                    scale = float(r.scale * np.exp(leap[-1]))
                elif not done:
                    before = [*here[:-1].tolist(), float(np.log(r.scale))]
                out.append((
                    r.g, r.rows, float(inner - weights @ center), weights.tolist(), scale, r.rounds + 1, bool(done),
                    list(center), list(spread), before,
                ))
            yield pd.DataFrame(out, columns=names)

    xs = [F.col(f"x{i}") - F.get("center", F.lit(i)) for i in range(p)]
    try:
        fits = _least_squares(rows, p, 0.0)
        settled = fits.where(F.col("scale") == 0)
        active = fits.where(F.col("scale") > 0)
        for _ in range(most_rounds):
            carried = names[2:6] + names[7:]
            joined = rows.join(broadcast_if_small(active.select("g", *carried)), "g")
            predicted = F.col("intercept") + sum((F.get("coefficients", F.lit(i)) * F.col(f"x{i}") for i in range(p)), F.lit(0.0))
            left = F.abs(F.col("y") - predicted)
            inside = left <= epsilon * F.col("scale")
            weight = F.when(inside, 1.0).otherwise(epsilon * F.col("scale") / left)
            sums = joined.groupBy("g").agg(
                F.count(F.lit(1)).alias("rows"), F.array(*_products(xs, F.col("y"), weight)).alias("sums"),
                F.sum(F.when(inside, left * left).otherwise(0.0)).alias("squares"), F.count_if(~inside).alias("outer"),
                *(F.first(c).alias(c) for c in carried),
            )
            moved = checkpointed(sums.mapInPandas(advance, schema))
            settled = settled.unionByName(moved.where("settled"))
            active = moved.where("NOT settled")
            if active.isEmpty():
                break
        return _named(checkpointed(settled.unionByName(active)), by)
    finally:
        rows.unpersist()


def score_by_group(df: DataFrame, fits: DataFrame, by: str, features: Sequence[str], name: str = "prediction") -> DataFrame:
    """``df`` with the prediction of its group's fit, NULL for a group without one; fits are joined by their size."""
    small = broadcast_if_small(fits.select(col(by).alias("_group"), F.col("intercept").alias("_a"), F.col("coefficients").alias("_b")))
    value = F.col("_a")
    for i, c in enumerate(features):
        value = value + F.get("_b", F.lit(i)) * col(c)
    return df.join(small, col(by) == F.col("_group"), "left").withColumn(name, value).drop("_group", "_a", "_b")
