"""Repair of anomalous well costs from a second source."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateralis.functions.columns import (
    COMPLETIONS_SHARE,
    DRILLING_SHARE,
    FACILITIES_SHARE,
    col,
    cost_anomaly,
)
from lateralis.operators.skew import HOT_ROWS, skew_join

# The cost columns of a well and their usual shares of the total.
TOTAL = "TotalWellCost_USDMM"
SHARES = {
    "DrillCost_USDMM": DRILLING_SHARE,
    "FacilitiesCost_USDMM": FACILITIES_SHARE,
    "CompletionCost_USDMM": COMPLETIONS_SHARE,
}
FLAG = "cost_filter"


def flag_cost_anomalies(
    df: DataFrame, total: str = TOTAL, shares: Mapping[str, float] = SHARES, flag: str = FLAG
) -> DataFrame:
    return df.withColumn(flag, cost_anomaly(col(total), shares))


def impute_from_reference(
    df: DataFrame,
    reference: DataFrame,
    key: str = "API14",
    columns: Mapping[str, str] | None = None,
    flag: str = FLAG,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Flagged rows with a match take every mapped column from ``reference``, NULLs included.

    ``columns`` maps own to reference column names. Only flagged rows with a key take part in the
    shuffle. More than one match for a flagged row is an error that names the key; it is raised by a
    condition on the joined rows, so it costs no extra pass and no later projection can prune it.
    """
    columns = dict(columns or {c: c for c in (TOTAL, *SHARES)})
    candidate = F.coalesce(col(flag), F.lit(False)) & col(key).isNotNull()
    lookup = (
        reference.where(col(key).isNotNull())
        .groupBy(col(key).alias("_key"))
        .agg(
            F.count(F.lit(1)).alias("_matches"),
            *[F.max(col(source)).alias(f"_ref{i}") for i, source in enumerate(columns.values())],
        )
        .withColumnRenamed("_key", key)
    )
    joined = skew_join(df.where(candidate), lookup, key, "left", hot_rows)
    several = F.raise_error(F.concat(F.lit(f"several reference rows for {key} "), col(key).cast("string")))
    # a condition on the rows, which no projection of the result can prune
    joined = joined.where(F.when(F.col("_matches") > 1, several.cast("boolean")).otherwise(F.lit(True)))
    replaced = {
        own: F.when(F.col("_matches") == 1, F.col(f"_ref{i}")).otherwise(col(own)) for i, own in enumerate(columns)
    }
    repaired = joined.select(*[replaced[c].alias(c) if c in replaced else col(c) for c in df.columns])
    return df.where(~candidate).unionByName(repaired)
