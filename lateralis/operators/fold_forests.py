"""Cross-validated forests from binned cells: the rows are read three times, however many candidates, folds and levels there are.

A forest sees a feature by the bin that its value falls into, so all rows of one cell (a bin of every feature) are alike
to it. The first pass takes the split points of every fold's fit from the rows outside of it, by MLlib's rule: each
value its own bin where there are at most as many values as bins, bins of about equally many rows otherwise. The second adds up
weights and labels by cell for every tree and fold, each row as often as the tree has drawn it. All trees grow
from these sums on the driver, level by level as MLlib grows them: the split with the largest gain in variance, until it has
none, or ends at ``min_samples_leaf`` or ``max_depth``. A tree of a lower depth is the top of a deeper one. The third pass
scores every candidate on the fold that its trees have not seen.

A row's draws are Poisson numbers by a hash of its key, the seed and the tree, so they are the same under any
partitioning. The cells of a fit are at most ``MOST_CELLS``: forests of more features than that allows (three with 32 bins
each always fit, more of few values do) are refitted by MLlib. Of trees whose sums are more than ``MOST_SUMS`` some are grown at a time, each time in a pass of its own.

A missing or NaN label, or a feature that is not finite, is an error, as it is to MLlib; a fold without rows scores minus
infinity, no rows outside of a fold are an error. Rows without a fold are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import prod

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lateralis.functions.columns import col

MOST_CELLS = 50_000
MOST_SUMS = 1_000_000
MOST_WIDTH = 15  # more features that vary make more than MOST_CELLS cells with two bins each
SUMMARY_NUMBERS = 3_000_000
SUMMARY_VALUES = 256  # of one feature among so many numbers: exact up to here, blocks of equally many rows beyond
MERGED_VALUES = 4_096  # of one feature and fold on the driver
TASKS_A_CORE = 4

# Chance of at most 0, 1, 2 ... draws.
_DRAWS = np.cumsum([0.36787944117144233 / prod(range(1, n + 1)) for n in range(16)])


@dataclass(frozen=True)
class ForestCandidate:
    trees: int
    depth: int
    least: int = 1
    bins: int = 32
    seed: int = 0
    bootstrap: bool = True


def split_points(values: np.ndarray, counts: np.ndarray, bins: int) -> np.ndarray:
    """Thresholds between sorted different values: between all, or where about a ``bins``-th of the rows ends."""
    between = (values[:-1] + values[1:]) / 2
    if len(values) <= bins:
        return between
    below = np.cumsum(counts)
    stride = below[-1] / bins
    found, target = [], stride
    for i in range(len(between)):
        if abs(below[i] - target) < abs(below[i + 1] - target):
            found.append(between[i])
            target += stride
    return np.array(found)


def draws(ids: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """How often each row is drawn for a tree: Poisson numbers of mean 1 from a hash (splitmix64)."""
    start = (seed * 0x9E3779B97F4A7C15 + (tree + 1) * 0xD1342543DE82EF95) % 2**64
    z = ids.astype(np.uint64) + np.uint64(start)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 0x9E3779B97F4A7C15), (29, 1)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    return np.searchsorted(_DRAWS, (z >> np.uint64(11)) * 2.0**-53, side="right").astype(float)


def grow(weight: np.ndarray, total: np.ndarray, depths: Sequence[int], least: int) -> np.ndarray:
    """Predictions by depth and cell of a tree; ``weight`` and ``total`` have an axis a feature.

    A node is a box of cells. All nodes get their mean, so that a box keeps that of the deepest node allowed.
    """
    found = np.zeros((len(depths), *weight.shape))
    axes = range(weight.ndim)
    open_ = [(tuple(slice(0, n) for n in weight.shape), 0)]
    while open_:
        box, depth = open_.pop()
        w, s = weight[box], total[box]
        rows, whole = w.sum(), s.sum()
        for d, limit in enumerate(depths):
            if depth <= limit:
                found[d][box] = whole / rows if rows else 0.0
        if depth >= max(depths) or not rows:
            continue
        best = (0.0, 0, 0)
        for axis in axes:
            others = tuple(a for a in axes if a != axis)
            left, part = w.sum(axis=others).cumsum()[:-1], s.sum(axis=others).cumsum()[:-1]
            allowed = (left >= least) & (rows - left >= least)
            if not allowed.any():
                continue
            a, b = np.where(allowed, left, 1.0), np.where(allowed, rows - left, 1.0)
            gain = np.where(allowed, a * b * (part / a - (whole - part) / b) ** 2, -1.0)
            at = int(gain.argmax())
            if gain[at] > best[0]:
                best = (gain[at], axis, at + 1)
        gain, axis, cut = best
        if gain <= 0:
            continue
        middle = box[axis].start + cut
        for part in (slice(box[axis].start, middle), slice(middle, box[axis].stop)):
            open_.append(((*box[:axis], part, *box[axis + 1 :]), depth + 1))
    return found


def _numbers(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    number, ids, y = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("k", "id", "y"))
    x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    if batch.column("y").null_count or np.isnan(y).any():
        raise ValueError("labels must not be missing or NaN")
    if not np.isfinite(x).all():
        raise ValueError("features must be finite")
    return number, ids, x, y


def _summary(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different values and their counts; of many values the middle one of each block and the rows of the block."""
    found, counts = np.unique(values, return_counts=True)
    if len(found) <= SUMMARY_VALUES:
        return found, counts
    values = np.sort(values)
    ends = np.linspace(0, len(values), SUMMARY_VALUES + 1).astype(int)
    return values[(ends[:-1] + ends[1:]) // 2], np.diff(ends)


def _merged(table: pa.Table) -> pa.Table:
    """The summaries of one feature and fold as one."""
    v, n = table.column("v").to_numpy(), table.column("n").to_numpy()
    if table.column("i")[0].as_py() < 0:  # means
        v, n = np.array([v @ n / n.sum()]), np.array([n.sum()])
    else:
        v, place = np.unique(v, return_inverse=True)
        n = np.bincount(place, n).astype(int)
        if len(v) > MERGED_VALUES:
            through = n.cumsum()
            last = np.unique(np.searchsorted(through, np.linspace(0, through[-1], MERGED_VALUES + 1)[1:]).clip(max=len(v) - 1))
            rows = np.diff(through[last], prepend=0)
            v, n = v[np.searchsorted(through, through[last] - rows / 2)], rows
    return _summary_columns(pa.Table, table.column("k")[0].as_py(), table.column("i")[0].as_py(), v, n)


def _summary_columns(kind, k: int, i: int, v: np.ndarray, n: np.ndarray):
    columns = ((np.full(len(v), k), pa.int32()), (np.full(len(v), i), pa.int32()), (v, pa.float64()), (n, pa.int64()))
    return kind.from_arrays([pa.array(c, t) for c, t in columns], names=["k", "i", "v", "n"])


def _thresholds(rows: DataFrame, folds: int, width: int, bins: Sequence[int]) -> tuple[dict[int, list[list[np.ndarray]]], list[float]]:
    """By number of bins, the split points of every feature in each fold's fit; and the mean label of each fit."""

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def summary() -> Iterator[pa.RecordBatch]:
            number, x, y = (np.concatenate([h[i] for h in held]) for i in range(3))
            for k in np.unique(number):
                own = number == k
                for i in range(-1, width):
                    v, n = (np.array([y[own].mean()]), np.array([own.sum()])) if i < 0 else _summary(x[own, i])
                    yield _summary_columns(pa.RecordBatch, k, i, v, n)

        for batch in batches:
            number, _, x, y = _numbers(batch, width)
            held.append((number, x, y))
            size += x.size
            if size >= SUMMARY_NUMBERS:
                yield from summary()
                held, size = [], 0
        if size:
            yield from summary()

    schema = "k int, i int, v double, n long"
    found = rows.mapInArrow(summaries, schema).groupBy("k", "i").applyInArrow(_merged, schema).toArrow()
    k, i, v, n = (found.column(c).to_numpy() for c in ("k", "i", "v", "n"))
    points: dict[int, list[list[np.ndarray]]] = {b: [] for b in bins}
    means = []
    for fold in range(folds):
        seen = k != fold
        label = seen & (i == -1)
        if not label.any():
            raise ValueError(f"no rows outside of fold {fold}")
        means.append(float(v[label] @ n[label] / n[label].sum()))
        counted = []
        for slot in range(width):
            own = seen & (i == slot)
            values, place = np.unique(v[own], return_inverse=True)
            counted.append((values, np.bincount(place, n[own])))
        for b in bins:
            points[b].append([split_points(*c, min(b, int(n[label].sum()))) for c in counted])
    return points, means


def _cells(x: np.ndarray, points: Sequence[np.ndarray]) -> np.ndarray:
    """The number of each row's cell; a value that is a split point lies below it."""
    cell = np.zeros(len(x), dtype=np.int64)
    for i, p in enumerate(points):
        cell = cell * (len(p) + 1) + np.searchsorted(p, x[:, i])
    return cell


def _tree_sums(
    rows: DataFrame, points: Sequence[Sequence[np.ndarray]], means: Sequence[float], trees: range, seed: int, bootstrap: bool, width: int
) -> list[np.ndarray]:
    """Of every fold's fit, ``(trees, 2, cells)``: drawn rows and sums of their labels less the mean."""
    sizes = [prod(len(p) + 1 for p in own) for own in points]
    starts = np.cumsum([0, *[len(trees) * s for s in sizes]])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, starts[-1]))
        for batch in batches:
            number, ids, x, y = _numbers(batch, width)
            drawn = [draws(ids, seed, t) if bootstrap else np.ones(len(y)) for t in trees]
            for k, size in enumerate(sizes):
                seen = number != k
                cell, label = _cells(x[seen], points[k]), y[seen] - means[k]
                for t, w in enumerate(drawn):
                    w, at = w[seen], slice(starts[k] + t * size, starts[k] + (t + 1) * size)
                    total[0, at] += np.bincount(cell, w, size)
                    total[1, at] += np.bincount(cell, w * label, size)
        place = np.flatnonzero(total[0])
        for start in range(0, len(place), 50_000):
            part = place[start : start + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[0, part]), pa.array(total[1, part])], names=["place", "w", "s"])

    # few long tasks: each sends its sums once
    tasks = TASKS_A_CORE * rows.sparkSession.sparkContext.defaultParallelism
    found = rows.coalesce(tasks).mapInArrow(sums, "place long, w double, s double").groupBy("place").agg(F.sum("w").alias("w"), F.sum("s").alias("s")).toArrow()
    total = np.zeros((2, starts[-1]))
    place = found.column("place").to_numpy()
    total[0, place], total[1, place] = found.column("w").to_numpy(), found.column("s").to_numpy()
    return [total[:, starts[k] : starts[k + 1]].reshape(2, len(trees), size).swapaxes(0, 1) for k, size in enumerate(sizes)]


def _forests(rows: DataFrame, points, means: Sequence[float], candidates: Sequence[ForestCandidate], width: int) -> list[np.ndarray]:
    """Of every fold's fit the predictions by candidate and cell."""
    shapes = [[len(p) + 1 for p in own] for own in points]
    found = [np.zeros((len(candidates), prod(shape))) for shape in shapes]
    step = max(1, MOST_SUMS // sum(map(prod, shapes)))
    for seed, bootstrap in dict.fromkeys((c.seed, c.bootstrap) for c in candidates):
        own = [(i, c) for i, c in enumerate(candidates) if (c.seed, c.bootstrap) == (seed, bootstrap)]
        most = max(c.trees for _, c in own)
        for first in range(0, most, step):
            trees = range(first, min(first + step, most))
            sums = _tree_sums(rows, points, means, trees, seed, bootstrap, width)
            for k, least in itertools.product(range(len(means)), dict.fromkeys(c.least for _, c in own)):
                alike = [(i, c) for i, c in own if c.least == least]
                for tree, (w, s) in zip(trees, sums[k]):
                    grown = grow(w.reshape(shapes[k]), s.reshape(shapes[k]), [c.depth for _, c in alike], least)
                    for (i, c), prediction in zip(alike, grown):
                        if tree < c.trees:
                            found[k][i] += (prediction.ravel() + means[k]) / c.trees
    return found


def numbered(df: DataFrame, key: str, fold: Column, features: str, label: str) -> DataFrame:
    """What :func:`fold_scores` reads of a row: its fold, a number by its key that its draws follow, features and label."""
    rows = df.select(
        fold.cast("int").alias("k"), F.xxhash64(col(key)).alias("id"), vector_to_array(col(features)).alias("x"), col(label).cast("double").alias("y")
    )
    return rows.where(F.col("k").isNotNull())


def fold_scores(
    rows: DataFrame, folds: int, candidates: Sequence[ForestCandidate], width: int, measure, center: float = 0.0, scale: float = 1.0
) -> list[list[float | None]] | None:
    """``measure`` of every candidate (outer list) on every fold (inner list), fitted on the other folds.

    ``rows`` are those of :func:`numbered`, with ``width`` features; persist them. ``measure`` is an aggregate of the
    actual and the predicted value, both brought back to ``value * scale + center``. A score of None stands for a fold
    without rows, None instead of the list for too many cells.
    """
    bins = list(dict.fromkeys(c.bins for c in candidates))
    points, means = _thresholds(rows, folds, width, bins)
    if max(prod(len(p) + 1 for p in own) for b in bins for own in points[b]) > MOST_CELLS:
        return None
    found: list[list[float | None]] = [[None] * folds for _ in candidates]
    for b in bins:
        alike = [i for i, c in enumerate(candidates) if c.bins == b]
        predictions = _forests(rows, points[b], means, [candidates[i] for i in alike], width)
        names = [f"p{i}" for i in alike]
        scored = rows.mapInArrow(_scorer(points[b], predictions, width, names), ", ".join(["k int", "y double", *[f"{p} double" for p in names]]))
        measures = [measure(F.col("y") * scale + center, F.col(p) * scale + center).alias(p) for p in names]
        for r in scored.groupBy("k").agg(*measures).collect():
            for i, p in zip(alike, names):
                found[i][r["k"]] = r[p]
    return found


def _scorer(points, predictions: Sequence[np.ndarray], width: int, names: Sequence[str]):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, _, x, y = _numbers(batch, width)
            predicted = np.empty((len(predictions[0]), len(y)))
            for k in np.unique(number):
                own = number == k
                predicted[:, own] = predictions[k][:, _cells(x[own], points[k])]
            yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array(y), *map(pa.array, predicted)], names=["k", "y", *names])

    return score
