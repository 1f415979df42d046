"""Feature importance: permutation importance for any model, split gains for trees."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateralis.functions.columns import col
from lateralis.operators.metrics import r2_score
from lateralis.operators.models import FEATURES, LABEL, PREDICTION
from lateralis.operators.split import SEED

BUCKET_ROWS = 10_000
TASK_BUCKETS = 50  # of the default size, half a million rows are sorted by one task
FOREIGN_ROWS = 1_000


def permutation_importance(
    model: Model,
    df: DataFrame,
    names: Sequence[str],
    *,
    key: str,
    label: str = LABEL,
    features: str = FEATURES,
    repeats: int = 10,
    seed: int = SEED,
    bucket_rows: int = BUCKET_ROWS,
    rows: int | None = None,
) -> DataFrame:
    """Per feature the mean and deviation over ``repeats`` of the drop in R2 when its values are shuffled.

    One shuffle spreads the rows over hash buckets of about ``bucket_rows`` rows. Inside a bucket every
    repeat sorts by its own seeded hash and hands each row the feature vector of the next row, the last
    row that of the first: a random permutation without a join or a global sort. A row is sorted by Spark once;
    the orders of the repeats are taken of one bucket at a time, inside the task that sums or scores it. A linear
    model is not evaluated again for a copy: its prediction moves by the weight times the change of the feature.
    """
    rows = df.count() if rows is None else rows
    buckets = max(1, -(-rows // bucket_rows))
    base = model.transform(df).select(
        col(label).cast("double").alias("_y"),
        col(PREDICTION).alias("_p"),
        vector_to_array(col(features)).alias("_x"),
        F.xxhash64(col(key)).alias("_id"),
    )
    actual, predicted = F.col("_y"), F.col("_p")
    # Key and content decide, never the partitioning. Rows that are equal in both are interchangeable.
    content = F.xxhash64(F.lit(seed), F.col("_id"), F.col("_y"), F.col("_x"))
    dealt = base.select((actual - predicted).alias("_r"), "_y", "_x", "_id", F.pmod(content, F.lit(buckets)).alias("_bucket"))
    tasks = max(min(buckets, df.sparkSession.sparkContext.defaultParallelism), -(-buckets // TASK_BUCKETS))
    dealt = dealt.repartition(tasks, "_bucket").sortWithinPartitions("_bucket", "_id", "_y", "_x")
    order = F.array(*[F.xxhash64(F.lit(seed), F.lit(repeat), F.col("_id")) for repeat in range(repeats)])
    dealt = dealt.withColumn("_order", order)

    count = len(names)
    if hasattr(model, "coefficients"):
        # The residual moves by the weight times the change of the feature, so two sums per feature and repeat do.
        whole = base.agg(F.sum((actual - predicted) * (actual - predicted)).alias("error"), (F.var_pop("_y") * F.count("_y")).alias("total")).head()
        sums = (
            dealt.mapInArrow(_change_sums, "_k int, cross double, square double")
            .groupBy("_k").agg(F.sum("cross").alias("cross"), F.sum("square").alias("square")).collect()
        )  # features x repeats rows
        weights = [float(w) for w in model.coefficients]

        def r2(error: float) -> float:
            return (1 - error / whole["total"]) if whole["total"] else float(error == 0)

        drops = []
        for cell in sums:
            weight = weights[cell["_k"] % count]
            moved = whole["error"] - 2 * weight * cell["cross"] + weight * weight * cell["square"]
            drops.append((names[cell["_k"] % count], r2(whole["error"]) - r2(moved)))
    else:
        shuffled = dealt.mapInArrow(_foreign_values, "_y double, _x array<double>, _foreign array<double>")
        cells = shuffled.select("_y", "_x", F.posexplode("_foreign").alias("_k", "_foreign"))
        feature = F.pmod("_k", F.lit(count))
        replaced = F.concat(F.slice("_x", F.lit(1), feature), F.array("_foreign"), F.slice("_x", feature + 2, F.lit(count)))
        scores = model.transform(cells.select("_y", "_k", array_to_vector(replaced).alias(features))).groupBy("_k").agg(
            r2_score(actual, col(PREDICTION)).alias("r2")
        ).collect()  # features x repeats rows
        baseline = base.agg(r2_score(actual, predicted).alias("r2")).head()["r2"]
        drops = [(names[r["_k"] % count], baseline - r["r2"]) for r in scores]
    table = df.sparkSession.createDataFrame(drops, "feature string, drop double")
    return (
        table.groupBy("feature")
        .agg(F.avg("drop").alias("importance_mean"), F.stddev_pop("drop").alias("importance_std"))
        .orderBy(F.col("importance_mean").desc(), "feature")
    )


def _equal(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Per row; NaN equals NaN."""
    same = (a == b) | ((a != a) & (b != b))
    return same if same.ndim == 1 else same.all(axis=1)


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _whole_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, bool]]:
    """Of sorted rows, the different ones of each bucket as one batch (True), and copies of the row before them (False).

    A copy gets the vector of the next copy, which is its own, so that a batch holds a bucket's different rows only.
    """
    held: list[pa.RecordBatch] = []
    last, bucket = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        numbers = batch.column("_bucket").to_numpy(zero_copy_only=False)
        known = batch.column("_y").is_valid().to_numpy(zero_copy_only=False)
        read = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("_id", "_y")]
        columns = [numbers, *read, known, _matrix(batch, "_x")]
        before = [c[:1] for c in columns] if last is None else last
        same = np.logical_and.reduce([_equal(c, np.concatenate([b, c[:-1]])) for b, c in zip(before, columns)])
        same[0] &= last is not None
        last = [c[-1:] for c in columns]
        if same.any():
            yield batch.filter(pa.array(same)), False
        different = batch.filter(pa.array(~same)) if same.any() else batch
        numbers = numbers[~same]
        ends = [0, *(np.flatnonzero(np.diff(numbers)) + 1), len(numbers)]
        for start, end in zip(ends, ends[1:]):
            if start == end:
                continue
            if held and numbers[start] != bucket:
                yield pa.concat_batches(held), True
                held = []
            bucket = numbers[start]
            held.append(different.slice(start, end - start))
    if held:
        yield pa.concat_batches(held), True


def _following(order: np.ndarray) -> np.ndarray:
    """The row after each row in the order of one repeat; equal hashes keep the order of the rows."""
    rows = np.argsort(order, kind="stable")
    following = np.empty_like(rows)
    following[rows] = np.roll(rows, -1)
    return following


def _change_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per feature and repeat the sums of residual times change and of squared changes, one row a task."""
    cross = square = None
    for rows, different in _whole_buckets(batches):
        x, order = _matrix(rows, "_x"), _matrix(rows, "_order")
        if cross is None:
            cross, square = np.zeros((2, order.shape[1], x.shape[1]))
        if different:
            residual = rows.column("_r").fill_null(0.0).to_numpy(zero_copy_only=False)
            for repeat in range(order.shape[1]):
                change = x[_following(order[:, repeat])] - x
                cross[repeat] += residual @ change
                square[repeat] += np.einsum("ij,ij->j", change, change)
    if cross is not None:
        cells = [pa.array(np.arange(cross.size), pa.int32()), pa.array(cross.ravel()), pa.array(square.ravel())]
        yield pa.RecordBatch.from_arrays(cells, names=["_k", "cross", "square"])


def _foreign_values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every row with the vectors that it gets in the repeats, one after the other."""
    for rows, different in _whole_buckets(batches):
        x, order = _matrix(rows, "_x"), _matrix(rows, "_order")
        following = [_following(o) if different else np.arange(len(x)) for o in order.T]
        for start in range(0, len(x), FOREIGN_ROWS):
            part = slice(start, start + FOREIGN_ROWS)
            foreign = np.concatenate([x[f[part]] for f in following], axis=1)
            ends = np.arange(0, foreign.size + 1, foreign.shape[1], dtype=np.int32)
            columns = [rows.column(c)[part] for c in ("_y", "_x")]
            yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(ends, foreign.ravel())], names=["_y", "_x", "_foreign"])


def ranked_features(importance: DataFrame) -> list[str]:
    """Feature names, most important first; one row per feature."""
    return [r["feature"] for r in importance.orderBy(F.col("importance_mean").desc(), "feature").collect()]


def tree_importance(model: Model, names: Sequence[str], df: DataFrame) -> DataFrame:
    """The model's own importance per feature, for tree models."""
    if not hasattr(model, "featureImportances"):
        raise TypeError("the model has no own importance; use permutation_importance")
    gains = model.featureImportances.toArray()
    rows = [(n, float(g)) for n, g in zip(names, gains)]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(
        F.col("importance").desc(), "feature"
    )
