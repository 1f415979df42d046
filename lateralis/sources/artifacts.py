"""Saved models, error tables, category lists and result bundles, all as folders Spark can read."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lateralis.functions.columns import col
from lateralis.operators.errorbins import edge_table
from lateralis.plans.score import Package
from lateralis.plans.train import Trained

ERROR_SCHEMA = "bin_ll string, bin_prop string, bin_fluid string, mape_median double"
LIST_SCHEMA = "position int, value string"


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def save_error_table(table: DataFrame, path: str) -> None:
    table.write.mode("overwrite").json(path)


def load_error_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ERROR_SCHEMA).json(path)


def save_list(spark: SparkSession, values: Sequence[str], path: str) -> None:
    """An ordered list of categories; the position keeps the order across files."""
    rows = [(i, v) for i, v in enumerate(values)]
    spark.createDataFrame(rows, LIST_SCHEMA).write.mode("overwrite").json(path)


def load_list(spark: SparkSession, path: str) -> list[str]:
    """A list as :func:`save_list` wrote it, so as long as one that a driver has held."""
    rows = spark.read.schema(LIST_SCHEMA).json(path).orderBy("position").collect()
    return [r["value"] for r in rows]


def save_lists(spark: SparkSession, lists: Mapping[str, Sequence], path: str) -> None:
    """Several short named lists (edges, steps, categories) in one JSON folder."""
    rows = [(name, i, str(v)) for name, values in lists.items() for i, v in enumerate(values)]
    spark.createDataFrame(rows, f"name string, {LIST_SCHEMA}").write.mode("overwrite").json(path)


def load_lists(spark: SparkSession, path: str) -> dict[str, list[str]]:
    table = spark.read.schema(f"name string, {LIST_SCHEMA}").json(path).orderBy("name", "position")
    lists: dict[str, list[str]] = {}
    for r in table.collect():
        lists.setdefault(r["name"], []).append(r["value"])
    return lists


def save_package(spark: SparkSession, package: Package, path: str) -> None:
    save_model(package.pipeline, f"{path}/model")
    lists: dict[str, Sequence] = {f"category:{c}": v for c, v in package.categories.items()}
    if package.operators is not None:
        lists["operators"] = package.operators
    if package.error_table is not None and package.steps is not None:
        save_error_table(package.error_table, f"{path}/error_table")
        lists["steps"] = package.steps
    if package.composites is not None:
        lists["composites"] = package.composites
    lists["metadata"] = [json.dumps(package.metadata, default=str)]
    save_lists(spark, lists, f"{path}/lists")


def load_package(spark: SparkSession, path: str) -> Package:
    lists = load_lists(spark, f"{path}/lists")
    steps = tuple(float(v) for v in lists["steps"]) if "steps" in lists else None
    return Package(
        pipeline=load_model(f"{path}/model"),
        categories={k.split(":", 1)[1]: v for k, v in lists.items() if k.startswith("category:")},
        operators=lists.get("operators"),
        error_table=load_error_table(spark, f"{path}/error_table") if steps else None,
        steps=steps,
        composites=lists.get("composites"),
        metadata=json.loads(lists["metadata"][0]) if "metadata" in lists else {},
    )


def performance_bundle(trained: Trained) -> dict[str, DataFrame]:
    """The performance report of a trained basin by name, each part a table."""
    parts = {
        "overall_performance": trained.performance(),
        "feature_importance": trained.importance,
        "validation_performance": trained.residuals.get("valid"),
        "test_performance": trained.residuals.get("test"),
        "error_table": trained.error_table,
    }
    if trained.bins is not None:
        parts["error_bin_edges"] = edge_table(trained.leaderboard.sparkSession, trained.bins)
    return {name: df for name, df in parts.items() if df is not None}


def save_bundle(parts: Mapping[str, DataFrame], path: str) -> None:
    """Every part as a Parquet folder; characters Parquet readers trip over are replaced in names."""
    for name, df in parts.items():
        plain = df.select(*[col(c).alias(c.translate(str.maketrans(" ,;{}()\n\t=", "__________"))) for c in df.columns])
        plain.write.mode("overwrite").parquet(f"{path}/{name}")


def load_bundle(spark: SparkSession, path: str, names: Sequence[str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{path}/{name}") for name in names}


def count_rows(parts: Mapping[str, DataFrame]) -> DataFrame:
    """Part names with their row counts."""
    counts = [df.agg(F.lit(name).alias("part"), F.count(F.lit(1)).alias("rows")) for name, df in parts.items()]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result
