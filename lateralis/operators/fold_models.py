"""Cross-validated linear fits from additive fold sums: no model is fitted twice on the same rows.

The products of (1, features, label) of every fold are summed in one pass. The sums of "all rows but fold k" are the
total less those of fold k, so the fits of all folds and of all candidates (with or without intercept, any ridge
weight) follow from them without reading a row again. One more pass scores every candidate on the fold it has not
seen. The work is that of three aggregates, however many folds and candidates there are; refits take one fit and one
evaluation each.

A task sends one partial sum per fold and entry, so a fold of any size is combined map-side. What reaches the driver is
``folds * (width + 2)^2`` numbers, which is why wide models (over ``MOST_WIDTH`` slots) are refitted instead.

A missing or NaN number in a row makes the scores NaN, a fold without rows scores minus infinity, a table without rows
is an error. Repeated rows count as often as they occur; slots that do not vary get the weight zero.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lateralis.functions.columns import col

MOST_WIDTH = 512


@dataclass(frozen=True)
class LinearCandidate:
    """A least-squares fit; ``ridge`` weighs the squared coefficients against the summed squares, the intercept is free."""

    fit_intercept: bool = True
    ridge: float = 0.0


@dataclass(frozen=True)
class FoldSums:
    """``sums[k]``: products of (1, x - center, y - middle) over fold k."""

    sums: np.ndarray
    center: np.ndarray
    middle: float

    @property
    def folds(self) -> int:
        return len(self.sums)

    def fit(self, fold: int, candidate: LinearCandidate) -> tuple[float, np.ndarray]:
        """(intercept, weights) of the rows outside of ``fold``."""
        sums = self.sums.sum(axis=0) - self.sums[fold]
        if not sums[0, 0]:
            raise ValueError(f"no rows outside of fold {fold}")
        raw = self._uncentered(sums)
        centered = sums - np.outer(sums[0], sums[0]) / sums[0, 0]
        varies = np.diag(centered)[1:-1] > 1e-18 * np.diag(raw)[1:-1]
        products = centered if candidate.fit_intercept else raw
        weights = _solve(products[1:-1, 1:-1], products[1:-1, -1], varies, candidate.ridge)
        intercept = (raw[0, -1] - raw[0, 1:-1] @ weights) / raw[0, 0] if candidate.fit_intercept else 0.0
        return float(intercept), weights

    def _uncentered(self, sums: np.ndarray) -> np.ndarray:
        shift = np.eye(len(sums))
        shift[1:, 0] = [*self.center, self.middle]
        return shift @ sums @ shift.T


def _solve(inner: np.ndarray, with_label: np.ndarray, varies: np.ndarray, ridge: float) -> np.ndarray:
    if not (np.isfinite(inner).all() and np.isfinite(with_label).all()):
        return np.full(len(with_label), np.nan)
    inner = inner + ridge * np.eye(len(inner))
    size = np.where(varies, np.sqrt(np.maximum(np.diag(inner), 0)), 0)  # slots of one size: their units differ by decades
    unit = np.where(size > 0, size, 1.0)
    scaled = np.where(np.outer(size, size) > 0, inner / np.outer(unit, unit), 0.0)
    return np.linalg.lstsq(scaled, np.where(size > 0, with_label / unit, 0.0), rcond=1e-12)[0] / unit


def fold_sums(df: DataFrame, fold: str, folds: int, features: str, label: str) -> FoldSums:
    """The sums of every fold; ``fold`` holds 0..folds-1. Two passes: means, then products about them."""
    if df.select(col(features)).head() is None:
        raise ValueError("no rows to fit")
    means = df.agg(Summarizer.mean(col(features)).alias("x"), F.avg(col(label).cast("double")).alias("y")).head()
    center, middle = means["x"].toArray(), float("nan") if means["y"] is None else means["y"]
    width = len(center) + 2

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((folds, width, width))
        for batch in batches:
            number = batch.column(0).to_numpy(zero_copy_only=False)
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width - 2)
            y = batch.column(2).to_numpy(zero_copy_only=False)
            z = np.column_stack([np.ones(len(y)), x - center, y - middle])
            for k in np.unique(number):
                rows = z[number == k]
                sums[k] += rows.T @ rows
        i, j = np.triu_indices(width)
        for k in range(folds):
            if sums[k, 0, 0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(i), k), pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(sums[k, i, j])],
                    names=["k", "i", "j", "part"],
                )

    rows = df.select(col(fold).cast("int").alias("k"), vector_to_array(col(features)).alias("x"), col(label).cast("double").alias("y"))
    entries = rows.mapInArrow(products, "k int, i int, j int, part double").groupBy("k", "i", "j").agg(F.sum("part").alias("s"))
    lines = entries.groupBy("k", "i").agg(F.array_sort(F.collect_list(F.struct("j", "s")))["s"].alias("line")).collect()
    sums = np.zeros((folds, width, width))
    for r in lines:
        sums[r["k"], r["i"], r["i"]:] = sums[r["k"], r["i"]:, r["i"]] = r["line"]
    return FoldSums(sums, center, middle)


def fold_scores(
    df: DataFrame, fold: str, folds: int, candidates: Sequence[LinearCandidate], features: str, label: str, measure,
    center: float = 0.0, scale: float = 1.0,
) -> list[list[float | None]]:
    """``measure`` of every candidate (outer list) on every fold (inner list), fitted on the other folds.

    ``measure`` is an aggregate of the actual and the predicted value, both brought back to ``value * scale + center``.
    None stands for a fold without rows. The rows are not shuffled: the fits are a broadcast of
    ``folds * candidates`` rows, and a row meets those of its own fold.
    """
    sums = fold_sums(df, fold, folds, features, label)
    fits = [
        (k, c, *sums.fit(k, candidate)) for k in range(folds) if sums.sums[k, 0, 0] for c, candidate in enumerate(candidates)
    ]
    table = df.sparkSession.createDataFrame(
        [(k, c, a, w.tolist()) for k, c, a, w in fits], "_k int, _c int, _a double, _w array<double>"
    )
    rows = df.select(col(fold).cast("int").alias("_k"), vector_to_array(col(features)).alias("_x"), col(label).cast("double").alias("_y"))
    predicted = F.col("_a") + _dot(F.col("_x"), F.col("_w"))
    scores = rows.join(F.broadcast(table), "_k").groupBy("_k", "_c").agg(
        measure(F.col("_y") * scale + center, predicted * scale + center).alias("score")
    )
    found: list[list[float | None]] = [[None] * folds for _ in candidates]
    for r in scores.collect():
        found[r["_c"]][r["_k"]] = r["score"]
    return found


def _dot(x: Column, w: Column) -> Column:
    return F.aggregate(F.zip_with(x, w, lambda a, b: a * b), F.lit(0.0), lambda total, term: total + term)
