"""Expected-error table: median percentage error per nested lateral, proppant and fluid bin."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from math import floor

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lateralis.functions.columns import bin_floor, bin_label, bin_lower, col, ratio
from lateralis.operators.quantiles import group_quantiles
from lateralis.session import broadcast_if_small, checkpointed

# Bin widths of the error table.
LATERAL_STEP = 1000
PROPPANT_RANGE, PROPPANT_UNIT = 200, 10
FLUID_RANGE = 10

EXPORT_BINS = 100_000


@dataclass(frozen=True)
class BinSpec:
    """The three binned properties with their steps and global edges, and the rows they were taken from.

    The edges are ranges of whole numbers, so that an outlier makes them long but not large.
    """

    columns: tuple[str, str, str]
    steps: tuple[float, float, float]
    edges: tuple[range, range, range]
    rows: int | None = None


BIN_COLUMNS = ("bin_ll", "bin_prop", "bin_fluid")
EDGE_NAMES = ("error_bins_lateral_length", "error_bins_proppant", "error_bins_fluid")


def edges(minimum: float, maximum: float, step: float) -> list[float]:
    """Multiples of ``step`` from the one at or below ``minimum`` to the first one above ``maximum``."""
    first, last = floor(minimum / step), floor(maximum / step) + 1
    return [step * k for k in range(first, last + 1)]


def edge_range(minimum: float, maximum: float, step: int) -> range:
    """:func:`edges` of a whole step, without making the list."""
    first, last = floor(minimum / step), floor(maximum / step) + 1
    return range(step * first, step * last + 1, step)


def step_bins(df: DataFrame, column: str, step: float, name: str) -> DataFrame:
    """Right-closed bins of width ``step``; a minimum that is itself an edge falls in no bin."""
    lowest = df.agg(F.min(col(column))).head()[0]
    return df.withColumn(name, _label(col(column), F.lit(float(step)), F.lit(lowest)))


def _label(x: Column, step: Column, lowest: Column) -> Column:
    lower = bin_lower(x, step)
    return F.when(lower >= bin_floor(lowest, step), bin_label(lower, step))


def bin_spec(df: DataFrame, lateral: str, proppant: str, fluid: str) -> BinSpec | None:
    """Steps and edges from one min/max aggregate; None for an empty frame."""
    columns = (lateral, proppant, fluid)
    row = df.agg(
        *[F.min(col(c)).alias(f"lo{i}") for i, c in enumerate(columns)],
        *[F.max(col(c)).alias(f"hi{i}") for i, c in enumerate(columns)],
        F.count(F.lit(1)).alias("rows"),
    ).head()
    if any(v is None for v in row):
        return None
    lows, highs = [row[f"lo{i}"] for i in range(3)], [row[f"hi{i}"] for i in range(3)]
    proppant_step = max(PROPPANT_UNIT * floor((highs[1] - lows[1]) / PROPPANT_RANGE), 1)
    fluid_step = max(floor((highs[2] - lows[2]) / FLUID_RANGE), 1)
    steps = (LATERAL_STEP, proppant_step, fluid_step)
    spans = tuple(edge_range(lo, hi, s) for lo, hi, s in zip(lows, highs, steps))
    return BinSpec(columns, tuple(float(s) for s in steps), spans, row["rows"])


def nested_bins(df: DataFrame, spec: BinSpec) -> DataFrame:
    """The three bin labels; inner bins start at the minimum of the rows of their outer bin.

    All levels share one grid, so nesting only decides whether a value that is exactly the lowest
    edge of its subset has a bin. The minima of all levels come from one map-side combined aggregate.
    """
    cells = [bin_lower(col(c), F.lit(w)) for c, w in zip(spec.columns, spec.steps)]
    lows = [F.min(col(c)).alias(f"_low{i}") for i, c in enumerate(spec.columns)]
    # one pass: the least value of every level in each pair of outer cells
    pairs = checkpointed(df.groupBy(cells[0].alias("_a"), cells[1].alias("_b")).agg(*lows))
    lowest = pairs.agg(F.min("_low0")).head()[0]
    floor_of = [bin_floor(low, F.lit(w)) for low, w in zip((F.lit(lowest), F.col("_low1"), F.col("_low2")), spec.steps)]
    first = pairs.where(F.col("_a") >= floor_of[0]) if lowest is not None else pairs.limit(0)
    inner = first.withColumn("_low1", F.min("_low1").over(Window.partitionBy("_a")))  # a row per pair of cells
    held = inner.where(F.col("_b") >= floor_of[1]).select("_a", "_b", "_low2")
    joined = df.withColumns({"_a": cells[0], "_b": cells[1], "_c": cells[2]}).join(broadcast_if_small(held), ["_a", "_b"])
    labels = {n: bin_label(F.col(c), F.lit(w)) for n, c, w in zip(BIN_COLUMNS, ("_a", "_b", "_c"), spec.steps)}
    return joined.where(F.col("_c") >= floor_of[2]).withColumns(labels).drop("_a", "_b", "_c", "_low2")


def absolute_percentage_error(actual: Column, predicted: Column, signed: bool = False) -> Column:
    """``100 * |actual - predicted| / |actual|``; ``signed`` divides by the actual as it is."""
    return ratio(F.lit(100.0) * F.abs(actual - predicted), actual if signed else F.abs(actual))


def error_table(df: DataFrame, spec: BinSpec, error: str, **options) -> DataFrame:
    """``bin_ll, bin_prop, bin_fluid, mape_median``: exact medians at 2 decimals, however full a bin is.

    ``df`` holds the rows ``spec`` was taken from, so that its row count bounds every bin.
    """
    binned = nested_bins(df.select(*[col(c) for c in dict.fromkeys((*spec.columns, error))]), spec)
    table = group_quantiles(binned, {error: [0.5]}, BIN_COLUMNS, **{"rows_at_most": spec.rows, **options})
    return table.select(*BIN_COLUMNS, F.round(col(error)[0], 2).alias("mape_median")).where(
        F.col("mape_median").isNotNull()
    )


def edge_lists(spec: BinSpec) -> dict[str, range]:
    return dict(zip(EDGE_NAMES, spec.edges))


def edge_table(spark: SparkSession, spec: BinSpec) -> DataFrame:
    """``property, edge``: every edge of the three properties, counted out by the tasks."""
    parts = [
        spark.range(r.start, r.stop, r.step).select(F.lit(name).alias("property"), F.col("id").cast("double").alias("edge"))
        for name, r in edge_lists(spec).items()
    ]
    return reduce(DataFrame.unionAll, parts)


def occupied_edges(df: DataFrame, spec: BinSpec) -> DataFrame:
    """``property, edge``: the two edges of every bin that holds a row, so at most two a row and property.

    The part of :func:`edge_table` that tells rows apart: a single far outlier adds two edges, not all those before
    it. A value that is itself the lowest edge lies in no bin; missing and NaN values lie in none either.
    """
    cells = [
        F.struct(F.lit(name).alias("property"), F.ceil(col(c).cast("double") / F.lit(step)).alias("n"), F.lit(r.start).alias("lowest"), F.lit(step).alias("step"))
        for name, c, step, r in zip(EDGE_NAMES, spec.columns, spec.steps, spec.edges)
    ]
    numbers = [F.nanvl(col(c).cast("double"), F.lit(None)).alias(c) for c in dict.fromkeys(spec.columns)]
    held = df.select(*numbers).select(F.inline(F.array(*cells))).where("n IS NOT NULL").distinct()
    both = held.where(F.col("step") * (F.col("n") - 1) >= F.col("lowest")).select(
        "property", F.explode(F.array(F.col("step") * (F.col("n") - 1), F.col("step") * F.col("n"))).alias("edge")
    )
    return both.distinct()


def expected_error(
    df: DataFrame,
    table: DataFrame,
    steps: tuple[float, float, float],
    columns: tuple[str, str, str],
    name: str = "expected_cost_variance_%",
) -> DataFrame:
    """Look every row up by its three bins; NULL where a level has no entry.

    The error table has one row per bin, so its size is checked rather than assumed.
    """
    labels = {b: bin_label(bin_lower(col(c), F.lit(s)), F.lit(s)) for b, c, s in zip(BIN_COLUMNS, columns, steps)}
    bins = broadcast_if_small(table.select(*BIN_COLUMNS, F.col("mape_median").alias(name)))
    return df.withColumns(labels).join(bins, list(BIN_COLUMNS), "left").drop(*BIN_COLUMNS)


def nested_error_map(table: DataFrame, limit: int = EXPORT_BINS) -> Mapping[str, Mapping[str, Mapping[str, float]]]:
    """The table as nested dicts for a JSON export; refused beyond ``limit`` bins."""
    rows = table.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} bins; write the table itself instead")
    nested: dict = {}
    for r in rows:
        nested.setdefault(r["bin_ll"], {}).setdefault(r["bin_prop"], {})[r["bin_fluid"]] = r["mape_median"]
    return nested
