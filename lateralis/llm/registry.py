"""Registry of the queries of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function name, with the SQL of the same rows where SQL can express them."""

    def register(function):
        @wraps(function)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship(spark)
            return function(spark, folder)

        QUERIES[function.__name__] = run
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


_shipped: set[str] = set()
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
DEFAULT_BATCH_BYTES = "67108864b"  # Spark's own


def ship(spark: SparkSession) -> None:
    """Make a session ready: send this package to the executors, so that tasks can import it anywhere, once per
    application; and, where the session leaves it at Spark's default, bound an Arrow batch of whole texts at 8 MB.
    """
    context = spark.sparkContext
    if spark.conf.get(BATCH_BYTES, DEFAULT_BATCH_BYTES) == DEFAULT_BATCH_BYTES:
        spark.conf.set(BATCH_BYTES, "8m")
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    path = os.path.join(tempfile.mkdtemp(prefix="lateralis-"), "lateralis-package.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, str(source.relative_to(package.parent)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def shrink_heaps(spark: SparkSession) -> None:
    """Have the executors collect garbage, which also gives back the heap that earlier jobs needed and no longer use.

    A job of one short task a core. It is a request only: nothing depends on where its tasks run.
    """
    cores = spark.sparkContext.defaultParallelism
    collected = F.java_method(F.lit("java.lang.System"), F.lit("gc"))
    spark.range(cores, numPartitions=cores).select(collected.alias("collected")).write.format("noop").mode("overwrite").save()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(key: str, folds: int) -> Column:
    """crc32 of the key's text, modulo ``folds``; -1 for a null key."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % folds, F.lit(-1))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
