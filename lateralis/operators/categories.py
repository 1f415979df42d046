"""Category columns: rare-value grouping, whitelists, dummies, one-hot stages, unknown values."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Transformer
from pyspark.ml.feature import OneHotEncoder, OneHotEncoderModel, StringIndexer, StringIndexerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lateralis.config import DEFAULT_OPERATOR_THRESHOLD
from lateralis.functions.columns import OTHER, col, composite_key, key_prefix

LITERAL_VALUES = 10_000


@dataclass(frozen=True)
class Grouped:
    df: DataFrame
    retained: list[str]


def group_rare(
    df: DataFrame,
    column: str,
    threshold: int = DEFAULT_OPERATOR_THRESHOLD,
    other: str = OTHER,
    literal_values: int = LITERAL_VALUES,
) -> Grouped:
    """Values with fewer than ``threshold`` rows become ``other``; also the rest, most frequent first.

    Up to ``literal_values`` retained values enter the plan as a literal set, so the data is neither joined
    nor shuffled; more are joined. The list itself is the trained model's category list, which is as long as
    the model is wide: at most the rows divided by ``threshold``.
    """
    kept = retained_values(df, column, threshold).collect()
    retained = [r[column] for r in kept]
    if len(kept) > literal_values:
        return Grouped(group_rare_joined(df, column, threshold, other), retained)
    value = col(column)
    recoded = F.when(value.isNull() | value.isin(*retained), value).otherwise(F.lit(other))
    return Grouped(df.withColumn(column, recoded), retained)


def retained_values(df: DataFrame, column: str, threshold: int) -> DataFrame:
    counts = df.where(col(column).isNotNull()).groupBy(col(column)).agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= threshold).orderBy(F.col("n").desc(), col(column))


def group_rare_joined(df: DataFrame, column: str, threshold: int, other: str = OTHER) -> DataFrame:
    """:func:`group_rare` for any number of values: a left join whose strategy and skew AQE decides."""
    kept = retained_values(df, column, threshold).select(col(column).alias("_kept"))
    joined = df.join(kept, col(column) == F.col("_kept"), "left")
    value = F.when(col(column).isNull() | F.col("_kept").isNotNull(), col(column)).otherwise(F.lit(other))
    return joined.withColumn(column, value).drop("_kept")


def recode_to_list(value: Column, allowed: Sequence[str], other: str = OTHER) -> Column:
    return F.when(value.isin(*allowed), value).otherwise(F.lit(other))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(col(column)).distinct()


def collect_values(df: DataFrame, column: str, limit: int = LITERAL_VALUES) -> list:
    """The distinct values in ascending order, after checking that there are at most ``limit``."""
    rows = distinct_values(df.where(col(column).isNotNull()), column).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{column!r} has more than {limit} distinct values")
    return sorted(r[0] for r in rows)


def add_dummies(df: DataFrame, column: str, values: Sequence | None = None) -> DataFrame:
    """One 0/1 column per value, named ``<column>_<value>``."""
    values = collect_values(df, column) if values is None else values
    return df.withColumns({f"{column}_{v}": F.coalesce(col(column) == F.lit(v), F.lit(False)).cast("int") for v in values})


def combine_with_prefix(df: DataFrame, prefix: str, column: str) -> DataFrame:
    """Replace ``column`` by the composite key ``<prefix>_<column>``."""
    return df.withColumn(column, composite_key(col(prefix), col(column)))


def unknown_fallback(value: Column, known: Sequence[str], other: str = OTHER) -> Column:
    """A composite key outside ``known`` falls back to ``<prefix>_miscellaneous``."""
    return F.when(value.isin(*known), value).otherwise(F.concat(key_prefix(value), F.lit(f"_{other}")))


def index_column(column: str) -> str:
    return f"{column}__index"


def onehot_column(column: str) -> str:
    return f"{column}__onehot"


def fit_encoders(df: DataFrame, columns: Sequence[str]) -> list[Transformer]:
    """Fitted stages that index and one-hot encode ``columns``; unseen values are errors.

    The alphabetically first value gets no slot: the index runs in descending order because
    ``dropLast`` drops its last entry. A column with a single value gets no slot at all.
    """
    if not columns:
        return []
    indexer = StringIndexer(
        inputCols=list(columns),
        outputCols=[index_column(c) for c in columns],
        stringOrderType="alphabetDesc",
        handleInvalid="error",
    ).fit(df)
    varied = [c for c, labels in zip(columns, indexer.labelsArray) if len(labels) > 1]
    if not varied:
        return [indexer]
    onehot = OneHotEncoder(
        inputCols=[index_column(c) for c in varied], outputCols=[onehot_column(c) for c in varied], dropLast=True
    )
    return [indexer, onehot.fit(indexer.transform(df))]


def encoded_columns(stages: Sequence[Transformer]) -> list[str]:
    """The vector columns that the stages of :func:`fit_encoders` produce."""
    return [c for s in stages if isinstance(s, OneHotEncoderModel) for c in s.getOutputCols()]


def trained_values(stages: Sequence[Transformer]) -> dict[str, list[str]]:
    """Per encoded column the values seen in training, ascending; the first one has no dummy."""
    found = {}
    for stage in stages:
        if isinstance(stage, StringIndexerModel):
            for column, labels in zip(stage.getInputCols(), stage.labelsArray):
                found[column] = list(reversed(labels))
    return found


def onehot_names(column: str, values: Sequence[str]) -> list[str]:
    """Names of the vector slots, in slot order (descending, first value left out)."""
    return [f"{column}={v}" for v in reversed(list(values)[1:])]
