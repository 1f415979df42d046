"""Data-dependent row and cell filters with a log of what each step removed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from math import isfinite
from operator import and_

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lateralis.config import FilterConfig, StatisticalFilter
from lateralis.functions.columns import col, ratio
from lateralis.operators.derive import keep_columns, require_columns
from lateralis.operators.quantiles import group_quantiles, medians, quantiles
from lateralis.session import broadcast_if_small, checkpointed, persisted


@dataclass(frozen=True)
class Step:
    """One applied filter. ``condition`` is NULL-free: a row that fails it is dropped."""

    kind: str
    column: str
    lower: float | None
    upper: float | None
    condition: Column


@dataclass
class Filtered:
    df: DataFrame
    source: DataFrame
    steps: list[Step] = field(default_factory=list)
    persisted: DataFrame | None = None

    def log(self) -> DataFrame:
        return filter_log(self.source, self.steps)

    def release(self) -> None:
        if self.persisted is not None:
            self.persisted.unpersist()


def within(column: Column, lower: float | None, upper: float | None, strict: bool = False) -> Column:
    """``lower < column <= upper``. A bound of None is off, and so is 0 unless ``strict``."""
    conditions = []
    if lower is not None and (strict or lower != 0):
        conditions.append(column > F.lit(lower))
    if upper is not None and (strict or upper != 0):
        conditions.append(column <= F.lit(upper))
    return reduce(and_, conditions, F.lit(True))


def filter_range(
    df: DataFrame, column: str, lower: float | None = None, upper: float | None = None, strict: bool = False
) -> DataFrame:
    require_columns(df, [column])
    return df.where(within(col(column), lower, upper, strict))


def _truncated(value: float | None) -> int | None:
    """Toward zero; an infinite bound is none."""
    return None if value is None or not isfinite(value) else int(value)


def percentile_bounds(
    df: DataFrame, column: str, lower: float | None, upper: float | None, accuracy: int | None = None, **options
) -> tuple[int | None, int | None]:
    """Quantiles at two probabilities, truncated toward zero.

    Exact unless an ``accuracy`` for ``percentile_approx`` is given.
    """
    require_columns(df, [column])
    wanted = [p for p in (lower, upper) if p is not None]
    if not wanted:
        return None, None
    if accuracy:
        found = df.select(F.percentile_approx(col(column).cast("double"), [float(p) for p in wanted], accuracy)).head()[0]
        found = found or [None] * len(wanted)
    else:
        found = quantiles(df, {column: wanted}, **options)[column]
    values = iter(found)
    return tuple(_truncated(next(values)) if p is not None else None for p in (lower, upper))


def threshold_chain(
    df: DataFrame,
    thresholds: Mapping[str, tuple[float | None, float | None]],
    percentile: bool = False,
    *,
    strict: bool = False,
    accuracy: int | None = None,
    **options,
) -> Filtered:
    """Range filters in order. Percentile bounds are taken on the rows the earlier columns left over.

    The bounds enter the plan as literals, so every step reaches the scan as a pushed filter. With
    percentiles this is one small aggregate per column by definition; they share one persisted copy of
    the filtered columns, which is released before the return.
    """
    result = Filtered(df, df)
    rows = first = None
    if percentile and thresholds:
        # the aggregates of all steps read these few columns once
        rows = persisted(df.select(*[col(c) for c in dict.fromkeys(thresholds)]))
        first = rows
        if not accuracy and "rows_at_most" not in options:
            options["rows_at_most"] = rows.count()  # later steps have fewer rows: one count serves them all
    try:
        for column, (lower, upper) in thresholds.items():
            require_columns(df, [column])
            if percentile:
                lower, upper = percentile_bounds(rows, column, lower, upper, accuracy, **options)
                rows = filter_range(rows, column, lower, upper, strict)
            condition = within(col(column), lower, upper, strict)
            result.df = filter_range(result.df, column, lower, upper, strict)
            result.steps.append(Step("percentile" if percentile else "value", column, lower, upper, condition))
    finally:
        if first is not None:
            first.unpersist()
    return result


def grouped_threshold_chain(
    df: DataFrame,
    by: str,
    thresholds: Mapping[str, tuple[float, float]],
    *,
    strict: bool = False,
    **options,
) -> DataFrame:
    """:func:`threshold_chain` on percentiles taken per group, for all groups at once and any number of them.

    The bounds of one column are a written table with a row per group, joined by whatever strategy its size
    allows; rows of a large group are spread by the skew handling of adaptive execution.
    """
    options.setdefault("rows_at_most", df.count())
    for column, (lower, upper) in thresholds.items():
        bounds = group_quantiles(df, {column: [lower, upper]}, [by], **options)

        def bound(i: int) -> Column:
            value = F.get(col(column), F.lit(i))
            return F.when(F.abs(value) < 9e18, value.cast("long"))

        table = checkpointed(bounds.select(col(by).alias("_group"), bound(0).alias("_lo"), bound(1).alias("_hi")))
        inactive_low = F.col("_lo").isNull() | (F.lit(not strict) & (F.col("_lo") == 0))
        inactive_high = F.col("_hi").isNull() | (F.lit(not strict) & (F.col("_hi") == 0))
        df = (
            df.join(broadcast_if_small(table), col(by).eqNullSafe(F.col("_group")), "inner")
            .where((inactive_low | (col(column) > F.col("_lo"))) & (inactive_high | (col(column) <= F.col("_hi"))))
            .drop("_group", "_lo", "_hi")
        )
    return df


def ratio_filter(df: DataFrame, numerator: str, denominator: str, value: float) -> DataFrame:
    """Rows whose ratio is ``value`` at 3 decimals, rounded half to even."""
    require_columns(df, [numerator, denominator])
    return df.where(_ratio_is(numerator, denominator, value))


def _ratio_is(numerator: str, denominator: str, value: float) -> Column:
    return F.bround(ratio(col(numerator), col(denominator)), 3) == F.lit(float(value))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def mad_conditions(df: DataFrame, columns: Sequence[str], threshold: float = 3.0, **options) -> dict[str, Column]:
    """Per column: ``|x - median| <= threshold * MAD``, with the unscaled median absolute deviation."""
    rows = persisted(df.select(*[col(c) for c in columns]))
    try:
        options.setdefault("rows_at_most", rows.count())
        centre = medians(rows, columns, **options)
        usable = [c for c in columns if centre[c] is not None]
        deviations = rows.select(*[F.abs(col(c) - F.lit(centre[c])).alias(c) for c in usable])
        spread = medians(deviations, usable, **options) if usable else {}
    finally:
        rows.unpersist()
    return {
        c: F.abs(col(c) - F.lit(centre[c])) <= F.lit(threshold * spread[c]) if c in spread else F.lit(False)
        for c in columns
    }


def zscore_conditions(df: DataFrame, columns: Sequence[str], threshold: float = 3.0) -> dict[str, Column]:
    """Per column: ``|x - mean| / std <= threshold`` with the population std; a zero std fits no cell."""
    moments = df.agg(
        *[F.avg(col(c)).alias(f"mean{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(col(c)).alias(f"std{i}") for i, c in enumerate(columns)],
    ).head()
    conditions = {}
    for i, c in enumerate(columns):
        mean, std = moments[f"mean{i}"], moments[f"std{i}"]
        conditions[c] = F.abs((col(c) - F.lit(mean)) / F.lit(std)) <= F.lit(threshold) if std else F.lit(False)
    return conditions


def mask_cells(df: DataFrame, conditions: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(kept, outliers): the same rows, with failing cells NULL in one and all other cells NULL in the other.

    Columns without a condition stay whole in the kept frame and are NULL in the outlier frame.
    """
    kept, outliers = [], []
    for f in df.schema:
        cell, holds = col(f.name), conditions.get(f.name)
        if holds is None:
            kept.append(cell)
            outliers.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            kept.append(F.when(holds, cell).alias(f.name))
            outliers.append(F.when(~F.coalesce(holds, F.lit(False)), cell).alias(f.name))
    return df.select(*kept), df.select(*outliers)


def statistical_conditions(df: DataFrame, settings: StatisticalFilter, **options) -> dict[str, Column]:
    """The condition of every masked column."""
    columns = list(settings.columns or numeric_columns(df))
    require_columns(df, columns)
    if settings.kind == "mad":
        return mad_conditions(df, columns, settings.threshold, **options)
    if settings.kind == "z-score":
        return zscore_conditions(df, columns, settings.threshold)
    raise ValueError(f"unknown statistical filter {settings.kind!r}: use 'mad' or 'z-score'")


def statistical_mask(df: DataFrame, settings: StatisticalFilter, **options) -> tuple[DataFrame, DataFrame]:
    return mask_cells(df, statistical_conditions(df, settings, **options))


def _is_nan(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    return F.isnan(col(column)) if isinstance(kind, (T.DoubleType, T.FloatType)) else F.lit(False)


def apply_filters(
    df: DataFrame,
    settings: FilterConfig,
    carry: Sequence[str] = (),
    *,
    storage: StorageLevel | None = None,
    **options,
) -> Filtered:
    """Drop incomplete rows, project, mask outlier cells, apply the range chain and the ratio filters.

    ``carry`` names columns kept beside the configured ones (the row key of the later split). With
    ``storage`` the projected rows are persisted for the chain's aggregates; the caller releases
    the result when done.
    """
    complete = df.dropna("any")
    if settings.keep:
        complete = keep_columns(complete, list(dict.fromkeys([*carry, *settings.keep])))
    if storage is not None:
        complete = persisted(complete, storage)
    masked = complete
    first = [Step("complete", "*", None, None, reduce(and_, [col(c).isNotNull() & ~_is_nan(df, c) for c in df.columns]))]
    if settings.statistical:
        conditions = statistical_conditions(complete, settings.statistical, **options)
        masked, _ = mask_cells(complete, conditions)
        kept = reduce(and_, [F.coalesce(c, F.lit(False)) for c in conditions.values()], F.lit(True))
        first.append(Step(settings.statistical.kind, ", ".join(conditions), None, settings.statistical.threshold, kept))
    result = threshold_chain(masked, settings.thresholds, settings.percentile, **options)
    result.source = df
    result.steps[:0] = first
    for (numerator, denominator), value in settings.ratios.items():
        result.df = ratio_filter(result.df, numerator, denominator, value)
        condition = _ratio_is(numerator, denominator, value)
        result.steps.append(Step("ratio", f"{numerator} / {denominator}", value, value, condition))
    result.persisted = complete if storage is not None else None
    whole = reduce(and_, [col(c).isNotNull() for c in result.df.columns])
    result.steps.append(Step("complete", "*", None, None, whole))
    result.df = result.df.dropna("any")
    return result


LOG_SCHEMA = "step int, kind string, column string, lower double, upper double, rows_in long, rows_out long"


def filter_log(df: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """One row per step with the rows that went in and came out: a single conditional-count aggregate."""
    counts, passed = [F.count(F.lit(1)).alias("c0")], F.lit(True)
    for i, step in enumerate(steps, start=1):
        passed = passed & F.coalesce(step.condition, F.lit(False))
        counts.append(F.count_if(passed).alias(f"c{i}"))
    totals = df.agg(*counts)

    def bound(value: float | None) -> Column:
        return F.lit(None if value is None else float(value)).cast("double")

    rows = [
        F.struct(
            F.lit(i).alias("step"),
            F.lit(s.kind).alias("kind"),
            F.lit(s.column).alias("column"),
            bound(s.lower).alias("lower"),
            bound(s.upper).alias("upper"),
            F.col(f"c{i - 1}").alias("rows_in"),
            F.col(f"c{i}").alias("rows_out"),
        )
        for i, s in enumerate(steps, start=1)
    ]
    if not rows:
        return df.sparkSession.createDataFrame([], LOG_SCHEMA)
    return totals.select(F.inline(F.array(*rows)))
